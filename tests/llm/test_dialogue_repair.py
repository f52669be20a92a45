"""Operator 13 against an independent search, an all-splits chart, and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from variantlink.llm import dialogue_repair as dr
from variantlink.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = {"u": "user", "a": "assistant"}
EMPTY = hashlib.sha256(b"").hexdigest()
#: Which initials may follow what stands before: nothing, s, u, a.
FOLLOW = {"": "su", "s": "u", "u": "a", "a": "u"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(hit, text)
        out += [(conv, turn, "user" if hit == 4 else role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        said = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append("b" if not said else "d" if (role, text) in seen else "-" if said[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def plain(rows):
    """Least cost and audit by a search over rows and last initials, left to right."""
    rows, found = ordered(rows), {"": (0, "", ())}
    bad = faults(rows)

    def insert(found):
        for _ in range(4):
            for last, (cost, audit, out) in list(found.items()):
                for x in set(FOLLOW[last]) & set("ua"):
                    new = (cost + 2, audit + "I", (*out, (NAMES[x], "")))
                    if x not in found or new[:2] < found[x][:2]:
                        found[x] = new
        return found

    found = insert(found)
    for (_, _, role, text), fault in zip(rows, bad, strict=True):
        options = []
        for last, (cost, audit, out) in found.items():
            options.append((last, (cost + 3, audit + "D", out)))
            if fault in "t-":
                more = fault == "t"
                if role[:1] and role[:1] in FOLLOW[last]:
                    options.append((role[:1], (cost + more, audit + "K", (*out, (role, text)))))
                options += [(x, (cost + 2 + more, audit + "R", (*out, (NAMES[x], text)))) for x in set(FOLLOW[last]) & set("ua")]
        found = {}
        for last, new in options:
            if last not in found or new[:2] < found[last][:2]:
                found[last] = new
        found = insert(found)
    cost, audit, out = min((found[x] for x in ("", "a") if x in found), key=lambda v: v[:2])
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": bad.count("b"), "duplicate": bad.count("d"), "truncated": bad.count("t"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }, list(out)


def by_conversation(rows):
    out: dict = {}
    for r in rows:
        out.setdefault(r[0], []).append(tuple(r))
    return out


def odd_rows(seed=5):
    rng = random.Random(seed)
    texts = [None, "", " \t", "hi.", "yo", "what? ", "ok", "a!", "b.\n", "c.\xa0", "d "]
    rows = [(rng.choice([1, 2, 3, 4, None]), rng.choice([None, *range(30)]), rng.choice(["user", "assistant", "system", None, "", "tool", "upset", "User"]), rng.choice(texts)) for _ in range(90)]
    return rows + [(9, k, rng.choice(["user", "assistant", "system"]), f"turn {k // 2} {rng.choice('.x')}") for k in range(9000)] + rows[:7]


def check(summary, convs):
    got = {r["conv_id"]: r.asDict() for r in summary.collect()}
    assert set(got) == set(convs)
    for conv, rows in convs.items():
        want = plain(rows)[0] if rows else dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0) | {"audit": "", "repaired_sha256": EMPTY}
        assert got[conv] == {"conv_id": conv} | want


def test_query_like_a_plain_search(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    check(queries.op13_conversation_repair(spark, "/root/testdata/sf0.01"), {c: damage(own) for c, own in by_conversation(rows).items()})


def test_odd_and_long_conversations(spark):
    """Nulls, blanks, ties, repeated rows, foreign roles, and a conversation of many parts."""
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    check(dr.damage_and_repair(df), {c: damage(own) for c, own in by_conversation(rows).items()})
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    from pyspark.sql import functions as F

    clashing = df.withColumns({c: F.lit(f"own {c}") for c in ("conv", "rank", "part", "symbol", "c", "b", "t", "i", "p", "cost", "audit", "pos", "edit", "hit")})
    found = dr.repair(clashing)
    convs = by_conversation(spaced)
    check(found.summary, convs)
    texts = by_conversation(found.rows.select("conv_id", "pos", "role", "text", "edit").collect())
    for conv, own in convs.items():
        want, out = plain(own)
        again = sorted(texts.get(conv, []), key=lambda r: r[1])
        assert [(r[2], r[3]) for r in again] == out and [r[1] for r in again] == list(range(len(out)))
        assert Counter(r[4] for r in again) == Counter(x for x in want["audit"] if x != "D")


def test_all_rows_dropped_and_empty_tables(spark):
    lost = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = dr.damage_and_repair(spark.createDataFrame([(lost, 0, "user", "hi.")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(lost, 0, 0, 0, 0, 0, 0, "", EMPTY)]
    none = spark.createDataFrame([], SCHEMA)
    assert dr.damage_and_repair(none).count() == 0
    assert dr.repair(none).summary.count() == 0 and dr.repair(none).rows.count() == 0


def every_split(symbols: str) -> dr.Cell:
    """The chart over all splits of all spans."""
    leaves = [dr.leaf(symbols[k : k + 2]) for k in range(0, len(symbols), 2)]
    cells = {(k, k + 1): c for k, c in enumerate(leaves)}
    for length in range(2, len(leaves) + 1):
        for i in range(len(leaves) - length + 1):
            options = [dr.combined(cells[i, k], cells[k, i + length]) for k in range(i + 1, i + length)]
            cells[i, i + length] = tuple(min((o[x] for o in options if o[x]), default=None) for x in range(len(dr.NONTERMINALS)))
    return cells[0, len(leaves)]


@pytest.mark.parametrize("length", range(1, 13))
def test_one_split_of_a_span_is_enough(length):
    rng = random.Random(length)
    for _ in range(40):
        symbols = "".join(rng.choice("suax") + rng.choice("--tbd") for _ in range(length))
        assert dr.parsed(symbols) == every_split(symbols)


def test_grammar_gives_exactly_the_legal_strings():
    """CNF derivations without edits: which strings of initials each nonterminal gives."""
    legal = re.compile("(s?(ua)+)?")
    base = {"s": "S", "u": "UU", "a": "AA"}
    for length in range(1, 7):
        for x in map("".join, itertools.product("sua", repeat=length)):
            cell = dr.chart([dr.cell(**{base[c]: (0, c)}) for c in x])
            accepted = any(cell[dr.NONTERMINALS.index(n)] for n in dr.ACCEPTED)
            assert accepted == bool(legal.fullmatch(x)), x
