"""Document fingerprints: weighted SimHash, and permuted block tables that link them (operator 11)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import components, staged, text_of

#: Words in a shingle, hash seed, bits of a fingerprint, differing bits that still link.
WORDS, SEED, WIDTH, RADIUS = 5, 11, 64, 3
#: Blocks of bits; a table for every choice of all blocks but RADIUS.
BLOCKS = 6
#: Members from which a bucket is split by bits outside its key.
HOT = 64
#: A weight of one in votes, so that votes are whole numbers and sums exact in any order.
UNIT = 1024


def shingle_hashes(text: str, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """Hashes of all word shingles, A-Z in lower case; fewer words make one shingle, none make none."""
    import xxhash

    parts = text.encode().lower().split()  # bytes: A-Z and 0x20, 0x09-0x0D alone
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), seed)] if parts else [], "<u8")
    whole, sizes = b" ".join(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    spans = zip((ends - sizes)[: 1 - words].tolist(), ends[words - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(whole[i:j], seed) for i, j in spans], "<u8")


def fingerprint(text: str) -> int:
    """Signed 64-bit SimHash: each distinct shingle votes on every bit with the weight 1 + ln(times found).

    A bit is set if more weight votes for it than against it. A text without words has fingerprint 0.
    """
    terms, times = np.unique(shingle_hashes(text), return_counts=True)
    weights = np.rint(UNIT * (1 + np.log(times))).astype(np.int64)
    votes = np.zeros(WIDTH, np.int64)
    for at in range(0, len(terms), 8192):
        bits = np.unpackbits(terms[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += weights[at : at + 8192] @ bits
    return int(np.packbits(2 * votes > weights.sum(), bitorder="little").view("<i8")[0])


def edited(text: str, following: str) -> str:
    """The text whose last half (rounded down, in code points) is replaced by the first as many of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "n_chars long, fp long, edited_sha256 string, edited_fp long, next_fp long"


class Neighbours:
    """Task code over one partition in order: each document with its edited text, which needs the next document alone.

    The last document of a partition waits for the first of the next one: both go out as edges, with their texts.
    """

    def __init__(self, schema: pa.Schema) -> None:
        self.schema = schema

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, out = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for own, cell in zip(batch.column(0), batch.column(1), strict=True):
                text = cell.as_py()
                print_ = fingerprint(text)
                if last is None:
                    out.append({"part": part, "head": text, "fp": print_})
                else:
                    out.append(self.row(*last, text, print_))
                last = (own.as_py(), text, print_)
                if len(out) >= 512:
                    yield pa.RecordBatch.from_pylist(out, self.schema)
                    out = []
        if last is not None:
            out.append({"id": last[0], "part": part, "tail": last[1], "n_chars": len(last[1]), "fp": last[2]})
            yield pa.RecordBatch.from_pylist(out, self.schema)

    @staticmethod
    def row(own, text: str, print_: int, following: str, next_print: int) -> dict:
        new = edited(text, following)
        sha = hashlib.sha256(new.encode()).hexdigest()
        changed = print_ if new == text else fingerprint(new)
        return {"id": own, "n_chars": len(text), "fp": print_, "edited_sha256": sha, "edited_fp": changed, "next_fp": next_print}


def edit_edges(tails: pa.Array, heads: pa.Array) -> pa.Array:
    new = [edited(a.as_py(), b.as_py()) for a, b in zip(tails, heads, strict=True)]
    return pa.array(
        [{"edited_sha256": hashlib.sha256(x.encode()).hexdigest(), "edited_fp": fingerprint(x)} for x in new],
        pa.struct([("edited_sha256", pa.string()), ("edited_fp", pa.int64())]),
    )


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, …RESULT)`` for every row: one range exchange of the texts in order of id, then a pass over each partition.

    Two texts at most of each partition, its first and its last, are read again to close the seams.
    """
    kind, spark = dict(docs.dtypes)[id_col], docs.sparkSession
    own = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    order = ["id", F.xxhash64("t")]
    ordered = own.repartitionByRange(*order).sortWithinPartitions(*order)
    form = f"id {kind}, {RESULT}, part int, head string, tail string"
    schema = to_arrow_schema(spark.createDataFrame([], form).schema)
    seen = staged(ordered.mapInArrow(Neighbours(schema), form), "neighbours")
    columns = ["id", *[c.split()[0] for c in RESULT.split(", ")]]
    inner = seen.where("part is null").select(*columns)
    # one row for each partition that has documents: which one follows, the first after the last
    following = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    parts = seen.where("head is not null").select("part", following.alias("following"))
    heads = seen.where("head is not null").select(F.col("part").alias("following"), F.col("head"), F.col("fp").alias("next_fp"))
    tails = seen.where("tail is not null").drop("head", "next_fp", "edited_sha256", "edited_fp")
    edit = F.arrow_udf(edit_edges, "edited_sha256 string, edited_fp long")
    seams = tails.join(parts, "part").join(heads, "following").withColumn("e", edit("tail", "head"))
    return inner.unionByName(seams.select("id", "n_chars", "fp", "e.edited_sha256", "e.edited_fp", "next_fp"))


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def mask_of(blocks: list[list[int]]) -> int:
    x = sum(1 << bit for own in blocks for bit in own)
    return x - (1 << WIDTH) if x >> (WIDTH - 1) else x


def block_tables(radius: int = RADIUS, blocks: int = BLOCKS) -> list[tuple[int, list[int]]]:
    """For each table the mask of the blocks that lead it, and radius + 1 masks that deal out all other bits.

    Fingerprints within the radius differ in ``radius`` blocks at most, so all others are equal in one of the tables.
    """
    if not radius < blocks <= WIDTH:
        raise ValueError("more blocks than differing bits are needed")
    cut = [[bit for bit in range(WIDTH) if bit * blocks // WIDTH == k] for k in range(blocks)]
    out = []
    for lead in combinations(cut, blocks - radius):
        rest = [bit for own in cut if own not in lead for bit in own]
        out.append((mask_of(list(lead)), [mask_of([rest[k :: radius + 1]]) for k in range(radius + 1)]))
    return out


def linked(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, hot: int = HOT) -> DataFrame:
    """``(node, root)`` over distinct fingerprints ``prints(fp)`` that link at ``radius`` or fewer bits; unlinked ones don't appear.

    A bucket holds the fingerprints whose leading blocks are equal in one table. Each member is first held against
    the bucket's least member: one row per member, which joins most of a large group of near copies. Only buckets that
    still hold several components are paired, those above ``hot`` members after a split by further bits, of
    which linked members share one part. No link is missed, whatever the sizes.
    """
    tables = block_tables(radius, blocks)
    prints = staged(prints.select("fp"), "prints")
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m, _ in tables])).alias("c", "k"))
    centres = keyed.groupBy("c", "k").agg(F.min("fp").alias("centre"), F.count("*").alias("n")).where("n > 1")
    members = staged(keyed.join(staged(centres, "centres"), ["c", "k"]), "members")
    star = members.where((F.col("fp") != F.col("centre")) & (differing(F.col("fp"), F.col("centre")) <= radius))
    near = staged(components(star.select(F.col("fp").alias("u"), F.col("centre").alias("v"))), "near")
    rooted = members.join(near.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = staged(rooted.select("c", "k", "n", "fp", "root"), "rooted")
    mixed = rooted.groupBy("c", "k").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("c", "k")
    parts = F.array(*[F.lit(m) for _, own in tables for m in own])
    dealt = F.transform(
        F.sequence(F.lit(0), F.lit(radius)),
        lambda s: F.struct(s.alias("s"), F.col("fp").bitwiseAND(F.get(parts, F.col("c") * (radius + 1) + s)).alias("sk")),
    )
    whole = F.array(F.struct(F.lit(-1).alias("s"), F.lit(0).cast("long").alias("sk")))
    cells = rooted.join(staged(mixed, "mixed"), ["c", "k"], "left_semi")
    cells = staged(cells.select("c", "k", "fp", "root", F.inline(F.when(F.col("n") > hot, dealt).otherwise(whole))), "cells")
    a, b = cells.alias("a"), cells.alias("b")
    same = reduce(Column.__and__, [F.col(f"a.{x}") == F.col(f"b.{x}") for x in ("c", "k", "s", "sk")])
    pairs = a.join(b, same & (F.col("a.fp") < F.col("b.fp")) & (F.col("a.root") != F.col("b.root")))
    pairs = pairs.where(differing(F.col("a.fp"), F.col("b.fp")) <= radius)
    over = components(pairs.select(F.col("a.root").alias("u"), F.col("b.root").alias("v"))).withColumnsRenamed({"node": "over", "root": "top"})
    over = staged(over, "over")
    alone = over.select(F.col("over").alias("node"), F.col("over").alias("root")).join(near, "node", "left_anti")
    return near.union(alone).join(over, F.col("root") == F.col("over"), "left").select("node", F.coalesce("top", "root").alias("root"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits: 1 for equal fingerprints, about a half for unrelated texts."""
    return 1 - differing(a, b) / float(WIDTH)


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next, component_id.

    fp is the text's fingerprint, edited_fp that of the text whose last half is replaced by the beginning of the next
    document (ascending id, then a hash of the text; the first after the last). component_id is the smallest id
    reachable over fingerprints of the table that differ in ``radius`` or fewer bits.

    Null text counts as empty, with fingerprint 0 like every text without words. Null ids come first; a null id becomes
    a component_id only where its component holds no other. Repeated rows follow each other and give a row each.
    A table of one row follows itself; an empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    own = staged(with_next(docs, id_col, text_col), "own")
    prints = staged(own.groupBy("fp").agg(F.min("id").alias("low")), "lows")
    roots = linked(prints, radius).withColumnRenamed("node", "fp")
    rooted = prints.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of_print = staged(rooted.join(lows, "root").select("fp", "component_id"), "components")
    return own.join(of_print, "fp").select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        "fp",
        "edited_fp",
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "component_id",
    )
