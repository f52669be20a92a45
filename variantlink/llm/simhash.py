"""SimHash near-duplicates by pivot distance tables (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, staged, text_of

#: Words in a shingle, hash seed, differing bits that still link.
WORDS, SEED, BITS = 3, 42, 3
#: Reference fingerprints: zero and one for every two bits. The difference of a fingerprint's distances to zero and
#: to such a block's reference tells how many of the block's bits it has (0, 1 or 2).
BLOCKS = 32
#: Further references, pseudo-random, whose distances discard pairs.
FAR = 8
#: Members from which a cell is split by the counts of further blocks.
HOT = 64


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_mask(blocks: list[int]) -> int:
    """The places of the blocks' counts in a pivot code."""
    return signed(sum(3 << 2 * j for j in blocks))


def grouped(groups: int) -> list[list[int]]:
    return [[j for j in range(BLOCKS) if j * groups // BLOCKS == g] for g in range(groups)]


def groups_for(n: int) -> int:
    """Groups of blocks, of which all but BITS make a key: so many that n random fingerprints seldom share one, six at least.

    Two random fingerprints have equal counts in a block with probability 3/8. More groups make longer
    keys but more cells a fingerprint (20 for six groups, 56 for eight).
    """
    for groups in range(2 * BITS, 16):
        least = sum(sorted(map(len, grouped(groups)))[: groups - BITS])
        if n * 0.375**least <= 0.25:
            return groups
    return 16


def masks_of(groups: int) -> list[tuple[int, list[int]]]:
    """For each choice of all groups but BITS: the mask of its blocks, and BITS + 1 masks that deal out the other blocks."""
    out = []
    for own in combinations(grouped(groups), groups - BITS):
        inside = [j for blocks in own for j in blocks]
        rest = [j for j in range(BLOCKS) if j not in inside]
        out.append((block_mask(inside), [block_mask(rest[k :: BITS + 1]) for k in range(BITS + 1)]))
    return out


def fingerprint(text: str) -> int:
    """Signed 64-bit SimHash of word shingles, repeats included; 0 for a text without words."""
    import xxhash

    words = text.encode().lower().split()  # bytes: A-Z and 0x20, 0x09-0x0D alone
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) < WORDS:
        hashes = [xxhash.xxh64_intdigest(whole, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        digest = xxhash.xxh64_intdigest
        first, last = (ends - sizes)[: 1 - WORDS].tolist(), ends[WORDS - 1 :].tolist()
        hashes = [digest(whole[i:j], SEED) for i, j in zip(first, last, strict=True)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        octets = np.array(hashes[at : at + 65536], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = pa.array([fingerprint(x.as_py() or "") for x in batch.column(2)], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prints], ["id", "h", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, h, fp)`` for every row, h a hash of the text; null text counts as a text without words."""
    kind, text = dict(docs.dtypes)[id_col], text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("t")).mapInArrow(
        fingerprinted, f"id {kind}, h long, fp long"
    )


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def far_of(fp: Column) -> Column:
    """A fingerprint's distances to the pseudo-random references, a byte each."""
    far = [F.shiftleft(differing(fp, F.xxhash64(F.lit(f"pivot {k}"))).cast("long"), 8 * k) for k in range(FAR)]
    return reduce(Column.bitwiseOR, far)


def pivot_table(prints: DataFrame) -> DataFrame:
    """``prints(fp, …)`` with its Hamming distances to all reference fingerprints, packed in two numbers.

    code holds the block counts that the distances to zero and to the block references tell, two
    bits each; far the distances to the FAR pseudo-random references, a byte each.
    """
    fp = F.col("fp")
    zero = differing(fp, F.lit(0).cast("long"))
    blocks = [differing(fp, F.lit(signed(3 << 2 * j))) for j in range(BLOCKS)]
    counts = [F.shiftleft(F.shiftright(zero - d + 2, 1).cast("long"), 2 * j) for j, d in enumerate(blocks)]
    return prints.withColumn("code", reduce(Column.bitwiseOR, counts)).withColumn("far", far_of(fp))


def close(a: Column, b: Column) -> Column:
    """Whether two rows of packed distances differ by BITS at most in every coordinate; linked fingerprints do."""
    at = [(F.shiftright(a, 8 * k).bitwiseAND(F.lit(255)), F.shiftright(b, 8 * k).bitwiseAND(F.lit(255))) for k in range(FAR)]
    return reduce(Column.__and__, [F.abs(x - y) <= BITS for x, y in at])


def cells_of(table: DataFrame, masks: list[tuple[int, list[int]]]) -> DataFrame:
    """``table`` with a row for each of a fingerprint's cells (c, k): its block counts in all groups but BITS.

    A differing bit changes one block's count at most, so fingerprints with at most BITS differing
    bits have equal counts in all other groups: they share a cell.
    """
    keys = F.array(*[F.col("code").bitwiseAND(F.lit(m)) for m, _ in masks])
    return table.select("*", F.posexplode(keys).alias("c", "k"))


def split_cells(cells: DataFrame, masks: list[tuple[int, list[int]]], hot: int = HOT) -> DataFrame:
    """``cells(c, k, n, code, …)`` with sub-keys (s, sk): cells of more than ``hot`` members are split by further pivots.

    The blocks outside a cell's key are dealt into BITS + 1 parts; linked members have equal
    counts in one of them at least.
    """
    parts = F.array(*[F.lit(m) for _, own in masks for m in own])
    at = F.sequence(F.lit(0), F.lit(BITS))
    dealt = F.transform(at, lambda s: F.struct(s.alias("s"), F.col("code").bitwiseAND(F.get(parts, F.col("c") * (BITS + 1) + s)).alias("sk")))
    whole = F.array(F.struct(F.lit(-1).alias("s"), F.lit(0).cast("long").alias("sk")))
    return cells.select("*", F.inline(F.when(F.col("n") > hot, dealt).otherwise(whole)))


def candidates(cells: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of one cell (c, k, s, sk) without a common root."""
    a, b = cells.alias("a"), cells.alias("b")
    same = reduce(Column.__and__, [F.col(f"a.{x}") == F.col(f"b.{x}") for x in ("c", "k", "s", "sk")])
    return a.join(b, same & (F.col("a.fp") < F.col("b.fp")) & (F.col("a.root") != F.col("b.root")))


def linked_components(prints: DataFrame, groups: int | None = None, hot: int = HOT) -> DataFrame:
    """``(node, root)`` over distinct fingerprints ``prints(fp)`` that link at BITS or fewer bits.

    The join key is made of pivot distances (cells_of): no linked pair is missed, whatever ``groups``,
    which goes by the number of fingerprints unless given. First each cell's members are held against its
    least member; those links cost one row per member and join most of any large group. Then
    the pairs of a cell that no link joins yet are taken. Pairs whose distances to the further
    references differ by more than BITS in any coordinate are discarded, survivors verified.
    """
    table = staged(pivot_table(prints), "pivots")
    masks = masks_of(groups or groups_for(table.count()))
    keyed = cells_of(table, masks).select("fp", "c", "k")
    centres = keyed.groupBy("c", "k").agg(F.min("fp").alias("centre"), F.count("*").alias("n")).where("n > 1")
    # few fingerprints share a cell: their distances are taken again where they are, not moved with every cell
    members = staged(pivot_table(keyed.join(staged(centres, "centres"), ["c", "k"])), "members")
    star = members.where((F.col("fp") != F.col("centre")) & close(F.col("far"), far_of(F.col("centre"))))
    star = star.where(differing(F.col("fp"), F.col("centre")) <= BITS).select(F.col("fp").alias("u"), F.col("centre").alias("v"))
    near = staged(components(star), "near")
    rooted = members.drop("centre").join(near.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # a cell whose members have one root has nothing left to find
    rooted = staged(rooted, "rooted")
    mixed = rooted.groupBy("c", "k").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a < _b").select("c", "k")
    cells = staged(split_cells(rooted.join(staged(mixed, "mixed"), ["c", "k"], "left_semi"), masks, hot), "cells")
    pairs = candidates(cells).where(close(F.col("a.far"), F.col("b.far"))).where(differing(F.col("a.fp"), F.col("b.fp")) <= BITS)
    over = components(pairs.select(F.col("a.root").alias("u"), F.col("b.root").alias("v"))).withColumnsRenamed({"node": "over", "root": "top"})
    alone = over.select(F.col("over").alias("node"), F.col("over").alias("root")).join(near, "node", "left_anti")
    return near.union(alone).join(over, F.col("root") == F.col("over"), "left").select("node", F.coalesce("top", "root").alias("root"))


def labelled(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, h, fp, component_id)`` for every row."""
    own = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    prints = staged(own.groupBy("fp").agg(F.min("id").alias("low")), "prints")
    roots = linked_components(prints.select("fp")).withColumnRenamed("node", "fp")
    rooted = prints.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return own.join(staged(rooted.join(lows, "root").select("fp", "component_id"), "components"), "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of BITS or fewer differing bits. Null and
    empty texts have fingerprint zero, linked like any other. Repeated rows give repeated results;
    a null id becomes a component_id only where its component holds no other. An empty table
    gives an empty result.
    """
    return labelled(docs, id_col, text_col).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is their component's smallest, with all their columns.

    A row is known by its id and text, so another text under the same id is judged by itself.
    Repeated rows of a kept document all stay.
    """
    found = staged(labelled(docs, id_col, text_col), "near-verdict")
    gone = found.where(~F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias("vl_id"), F.col("h").alias("vl_hash")).distinct()
    same = docs[id_col].eqNullSafe(F.col("vl_id")) & (F.xxhash64(text_of(text_col)) == F.col("vl_hash"))
    return docs.join(gone, same, "left_anti")
