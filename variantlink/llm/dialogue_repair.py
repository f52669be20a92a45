"""Conversation structure repair by weighted CYK interval parsing (operator 13)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .chat import ranked
from .common import staged

#: Rows of a conversation that one task parses, and spans that one task combines.
PART = 64
ROLES = {"u": "user", "a": "assistant"}
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1

# The repair grammar in Chomsky normal form. A nonterminal stands for the role initials that a span gives: none (E), "s" alone
# (S), or an alternation of u and a, named by its first and last initial, with an s before it or not.
NONTERMINALS = ["E", "S", "UU", "UA", "AU", "AA", "SU", "SA"]
ACCEPTED = ["E", "UA", "SA"]
_AT = {name: k for k, name in enumerate(NONTERMINALS)}


def _rules() -> list[tuple[int, int, int]]:
    """All (left, right, whole): an alternation goes on with the other initial, s stands first alone, E adds nothing."""
    found = [("E", "E", "E"), *[r for x in NONTERMINALS[1:] for r in (("E", x, x), (x, "E", x))]]
    spans = ["UU", "UA", "AU", "AA"]
    found += [("S", x, "S" + x[1]) for x in spans if x[0] == "U"]
    found += [(x, y, x[0] + y[1]) for x in [*spans, "SU", "SA"] for y in spans if x[1] != y[0]]
    return [(_AT[x], _AT[y], _AT[z]) for x, y, z in found]


RULES = _rules()
#: A cell holds, for each nonterminal, the least (cost, audit) that derives it from a span; None: nothing does.
Cell = tuple[tuple[int, str] | None, ...]


def cell(**best: tuple[int, str]) -> Cell:
    return tuple(best.get(x) for x in NONTERMINALS)


def combined(a: Cell, b: Cell) -> Cell:
    """The cell of two adjacent spans. Of one span and one cost no audit begins another, as each more is an insertion
    that costs, so the least audit of the whole is made of the least audits of its parts."""
    out: list[tuple[int, str] | None] = [None] * len(NONTERMINALS)
    for x, y, z in RULES:
        if (p := a[x]) and (q := b[y]):
            new = (p[0] + q[0], p[1] + q[1])
            if out[z] is None or new < out[z]:
                out[z] = new
    return tuple(out)


#: The empty span: what insertions alone give. Longer ones never cost less.
INSERTED = cell(E=(0, ""), UU=(INSERT, "I"), AA=(INSERT, "I"), UA=(2 * INSERT, "II"), AU=(2 * INSERT, "II"))


@lru_cache(64)
def leaf(symbol: str) -> Cell:
    """The cell of one row, closed under insertions on both sides. A symbol is a role initial (x: no legal one) and a
    fault: b (blank), d (duplicate), t (truncated), - (none)."""
    initial, fault = symbol
    best = {"E": (DELETE, "D")}
    if fault not in "bd":
        more = TRUNCATED if fault == "t" else 0
        best |= {"UU": (REROLE + more, "R"), "AA": (REROLE + more, "R")}
        if initial in "sua":
            best[{"s": "S", "u": "UU", "a": "AA"}[initial]] = (more, "K")
    return combined(combined(INSERTED, cell(**best)), INSERTED)


def chart(spans: list[Cell]) -> Cell:
    """The cell of adjacent spans, bottom-up by span length. A row's edit belongs to the row alone, so every split of a
    span gives the same cell, and one split of each is combined: lengths double, and n rows take n - 1 combinations."""
    while len(spans) > 1:
        spans = [combined(*spans[k : k + 2]) if k + 1 < len(spans) else spans[k] for k in range(0, len(spans), 2)]
    return spans[0]


@lru_cache(1 << 14)
def parsed(symbols: str) -> Cell:
    return chart([leaf(symbols[k : k + 2]) for k in range(0, len(symbols), 2)])


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


CELL = "costs array<long>, audits array<string>, first string, last string, illegal long"


def packed(best: Cell, first: str, last: str, illegal: int) -> dict:
    return {"costs": [None if x is None else x[0] for x in best], "audits": [None if x is None else x[1] for x in best], "first": first, "last": last, "illegal": illegal}


def parse_parts(symbols: pa.Array) -> pa.Array:
    out = []
    for x in symbols.to_pylist():
        initials = x[::2]
        out.append(packed(parsed(x), initials[0], initials[-1], illegal_pairs(initials)))
    return pa.array(out, CELL_TYPE)


def combine_parts(lists: pa.Array) -> pa.Array:
    out = []
    for spans in lists.to_pylist():
        cells = [tuple(None if c is None else (c, a) for c, a in zip(x["costs"], x["audits"], strict=True)) for x in spans]
        edges = sum(illegal_pairs(a["last"] + b["first"]) for a, b in zip(spans, spans[1:]))
        out.append(packed(chart(cells), spans[0]["first"], spans[-1]["last"], edges + sum(x["illegal"] for x in spans)))
    return pa.array(out, CELL_TYPE)


CELL_TYPE = pa.struct(
    [("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64())]
)


class Rebuild:
    """Task code over conversations in order: each begins with a row of rank -1 that carries its edits, then come its rows.

    Rows stream through; of a conversation only its audit and a running hash are held. After its rows comes
    one with null pos that has the hash of the repaired conversation.
    """

    def __init__(self, schema: pa.Schema) -> None:
        self.schema = schema

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    if r["rank"] < 0:
                        out += self.closed()
                        self.begin(r)
                    else:
                        out += self.edited(r)
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, self.schema)
                    out = []
        out += self.closed()
        if out:
            yield pa.RecordBatch.from_pylist(out, self.schema)

    audit: str | None = None

    def begin(self, r: dict) -> None:
        self.conv, self.audit, self.system = r["conv"], r["role"], r["text"] == "SA"
        self.at = self.n = 0
        self.sha = hashlib.sha256()

    def emit(self, edit: str, role: str, text: str) -> dict:
        self.sha.update((("\n" if self.n else "") + f"{role}:{text}").encode())
        self.n += 1
        return {"conv": self.conv, "pos": self.n - 1, "role": role, "text": text, "edit": edit}

    def legal(self) -> str:
        """The role that u or a must have at this place: both are told by what stands before."""
        return ROLES["ua"[(self.n - self.system) % 2]]

    def inserted(self) -> list[dict]:
        out = []
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            out.append(self.emit("I", self.legal(), ""))
            self.at += 1
        return out

    def edited(self, r: dict) -> list[dict]:
        out, edit = self.inserted(), self.audit[self.at]
        self.at += 1
        if edit != "D":
            out.append(self.emit(edit, r["role"] if edit == "K" else self.legal(), r["text"]))
        return out

    def closed(self) -> list[dict]:
        if self.audit is None:
            return []
        out = self.inserted()
        return [*out, {"conv": self.conv, "repaired_sha256": self.sha.hexdigest()}]


class Repair(NamedTuple):
    """summary: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, a row for each conversation;
    rows: conv_id, pos, role, text, edit (K, R or I), the repaired conversations."""

    summary: DataFrame
    rows: DataFrame


def damaged(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with planted faults by crc32 of ``conv_id:turn`` modulo 20; nulls in role, text and the hashed key are one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    own = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(key) % 20).alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return own.where("hit <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("hit")).drop("hit")


def faulted(said: DataFrame) -> DataFrame:
    """``(conv, rank, turn, symbol)`` of rows ``(conv, rank, turn, role, text)``: the role's initial and the row's first fault.

    Whether a role and text were seen earlier comes from the least rank of their SHA-256 in the conversation; it is pre-aggregated,
    so that a row that is repeated any number of times makes no large group.
    """
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    truncated = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    initial = F.substring("role", 1, 1)
    own = said.select("conv", "rank", "turn", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("i"), blank.alias("b"), truncated.alias("t"), content.alias("c"))
    own = staged(own, "faults")
    firsts = own.where("not b").groupBy("conv", "c").agg(F.min("rank").alias("seen"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select(F.col("conv").alias("conv2"), F.col("c").alias("c2"), "seen")
    joined = own.join(firsts, F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("c") == F.col("c2")), "left")
    fault = F.when(F.col("b"), "b").when(F.col("rank") > F.col("seen"), "d").when(F.col("t"), "t").otherwise("-")
    return joined.select("conv", "rank", "turn", F.concat("i", fault).alias("symbol"))


def parse_table(rows: DataFrame) -> DataFrame:
    """``(conv, p)``, p the cell of each whole conversation, from ``(conv, rank, symbol)``: parts of PART rows, then rounds over PART spans."""
    symbols = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "symbol"))), lambda x: x["symbol"]), "")
    parts = rows.groupBy("conv", F.expr(f"rank div {PART}").alias("part")).agg(symbols.alias("symbols"))
    parse, combine = F.arrow_udf(parse_parts, f"struct<{schema_of(CELL)}>"), F.arrow_udf(combine_parts, f"struct<{schema_of(CELL)}>")
    cells = staged(parts.select("conv", "part", parse("symbols").alias("p")), "cells")
    while not cells.where("part > 0").isEmpty():
        spans = F.transform(F.array_sort(F.collect_list(F.struct("part", "p"))), lambda x: x["p"])
        cells = cells.groupBy("conv", F.expr(f"part div {PART}").alias("part")).agg(spans.alias("spans"))
        cells = staged(cells.select("conv", "part", combine("spans").alias("p")), "cells")
    return cells.select("conv", "p")


def schema_of(columns: str) -> str:
    return ", ".join(":".join(c.split(" ", 1)) for c in columns.split(", "))


def least(p: Column) -> Column:
    """Struct of cost, audit and nonterminal: the least accepted derivation of a cell."""
    options = [F.struct(F.get(p["costs"], F.lit(_AT[x])).alias("cost"), F.get(p["audits"], F.lit(_AT[x])).alias("audit"), F.lit(x).alias("kind")) for x in ACCEPTED]
    return F.array_min(F.filter(F.array(*options), lambda x: x["cost"].isNotNull()))


def repair(turns: DataFrame) -> Repair:
    """The cheapest legal form of each conversation of ``turns(conv_id, turn, role, text)``, and what was wrong with it.

    Role initials must give ``(s?(ua)+)?``. A row is kept (0), gets another role (2) or is deleted (3), empty rows are
    inserted (2), a truncated row that stays costs 1 more. Of equal costs the audit that is least in ASCII is taken; it
    tells all roles. A row has one fault at most: blank, duplicate (role and text seen earlier; both must go), truncated.

    Rows are ordered by turn (nulls first), role and text. Null role or text is one space, and a role whose initial is not s, u or
    a (the empty one too) can't be kept. gaps counts turn numbers missing between the least and the greatest, nulls left
    aside; rows with null conv_id form one conversation. Repeated rows are duplicates. Other columns are ignored; an
    empty table gives an empty result. A conversation may have any length: parts of PART rows are parsed apart.
    """
    spark, kind = turns.sparkSession, dict(turns.dtypes)["conv_id"]
    own = turns.select(F.col("conv_id").alias("conv"), "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    said = staged(ranked(own, "conv", ["turn", "role", "text"]).select("conv", "rank", "turn", "role", "text"), "said")
    rows = staged(faulted(said), "symbols")
    cells = parse_table(rows).select("conv", least(F.col("p")).alias("best"), F.col("p.illegal").alias("illegal"))
    cells = staged(cells.select("conv", "illegal", "best.*"), "parsed")

    fault = F.substring("symbol", 2, 1)
    by_turn = rows.groupBy("conv", "turn").agg(*[F.count(F.when(fault == f, 1)).alias(n) for f, n in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))])
    counts = by_turn.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")],
    )

    edits = cells.select("conv", F.lit(-1).cast("long").alias("rank"), F.col("audit").alias("role"), F.col("kind").alias("text"))
    form = f"conv {kind}, pos long, role string, text string, edit string, repaired_sha256 string"
    schema = to_arrow_schema(spark.createDataFrame([], form).schema)
    stream = said.select("conv", F.col("rank").cast("long").alias("rank"), "role", "text").unionByName(edits)
    rebuilt = stream.repartition("conv").sortWithinPartitions("conv", "rank").mapInArrow(Rebuild(schema), form)
    rebuilt = staged(rebuilt, "rebuilt")

    closed = rebuilt.where("pos is null").select("conv", "repaired_sha256")
    one = cells.select(F.col("conv").alias("conv_id"), "illegal", "cost", "audit")
    whole = one.join(counts, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")
    whole = whole.join(closed, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")
    summary = whole.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return Repair(summary, rebuilt.where("pos is not null").select(F.col("conv").alias("conv_id"), "pos", "role", "text", "edit"))


EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def damage_and_repair(turns: DataFrame) -> DataFrame:
    """The repair of damaged conversations, a row for each that ``turns`` has: one that lost all its rows has zeros and an empty audit."""
    mended = staged(repair(damaged(turns)).summary, "mended").withColumnRenamed("conv_id", "conv")
    every = turns.select("conv_id").distinct().join(mended, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    zeros = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return every.drop("conv").fillna(zeros | {"audit": "", "repaired_sha256": EMPTY_SHA}, [*zeros, "audit", "repaired_sha256"])
