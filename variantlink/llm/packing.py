"""Sequence packing by minimum bin slack (operator 8)."""

from __future__ import annotations

import base64
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import driver_file, staged, with_rank

CAPACITY, END_ID = 2048, 1
#: The added token of the vocabulary, which the library finds in texts by itself, and its id.
ADDED = {"<|endoftext|>": 50256}
#: Matches the same pieces as public_tokenizers.PATTERN; possessive, so that it never backtracks.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(2)
def encoder(data: bytes):
    """Encoder of a rank file whose ids are those of the byte-level BPE with the same vocabulary.

    An added token's own string in a text is that token; what stands before and behind it is encoded apart.
    """
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    own = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=ADDED)
    return lambda text: own.encode(text, allowed_special="all") if any(x in text for x in ADDED) else own.encode_ordinary(text)


class Cutter:
    """Task code: encodes texts, cuts them at CAPACITY, numbers the pieces of each length in the task."""

    def __init__(self, data, with_ids: bool) -> None:
        self.data, self.with_ids = data, with_ids

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode, seen = TaskContext.get().partitionId(), encoder(self.data.value), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                yield self.cut(batch.slice(at, 512), part, encode, seen)

    def cut(self, batch, part, encode, seen) -> pa.RecordBatch:
        row, start, length, crc, total, local, ids = [], [], [], [], [], [], []
        for k, cell in enumerate(batch.column(1)):
            own = np.array([*encode(cell.as_py() or ""), END_ID], "<u4")
            for i in range(0, len(own), CAPACITY):
                piece = own[i : i + CAPACITY]
                row.append(k)
                start.append(i)
                length.append(len(piece))
                crc.append(zlib.crc32(piece.tobytes()))
                total.append(len(own))
                local.append(seen[len(piece)])
                seen[len(piece)] += 1
                if self.with_ids:
                    ids.append(piece.astype("<i4"))
        columns = {
            batch.schema.names[0]: batch.column(0).take(pa.array(row, pa.int64())),
            "start": pa.array(start, pa.int64()),
            "length": pa.array(length, pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()),
            "doc_tokens": pa.array(total, pa.int64()),
            "part": pa.array([part] * len(row), pa.int32()),
            "local": pa.array(local, pa.int64()),
        }
        if self.with_ids:
            columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([*columns.values()], [*columns])


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Multiset of lengths from ``counts`` whose sum comes closest to ``capacity`` from below.

    Bit s of ``reach`` tells that sum s can be made; counts are split into powers of two, and the
    choice is read back from the sets before each step.
    """
    reach, steps, full = 1, [], (1 << (capacity + 1)) - 1
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        left, times = min(counts[length], capacity // length), 1
        while left and not reach >> capacity:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= (reach << length * times) & full
            left, times = left - times, times * 2
    want, chosen = reach.bit_length() - 1, Counter()
    for length, times, before in reversed(steps):
        if not before >> want & 1:
            chosen[length] += times
            want -= length * times
    return dict(chosen)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """``(lengths of a sequence, how many such sequences)`` until all pieces are placed.

    The longest length left opens a sequence and minimum slack fills it; the same filling is then
    used as often as the counts allow. Work depends on the number of lengths, not of pieces.
    """
    left, out = {k: v for k, v in counts.items() if v}, []
    while left:
        top = max(left)
        own = {k: v - (k == top) for k, v in left.items() if v > (k == top)}
        filling = Counter(fullest(own, capacity - top)) + Counter({top: 1})
        times = min(left[k] // n for k, n in filling.items())
        out.append((dict(filling), times))
        left = {k: v - filling.get(k, 0) * times for k, v in left.items() if v > filling.get(k, 0) * times}
    return out


def slots(patterns: list[tuple[dict[int, int], int]]) -> tuple[list[tuple[int, list[tuple[int, int, int, int]]]], int]:
    """(length, its slots in order of rank) for the lengths of a plan, and the number of its sequences.

    A slot (first, n, sequence, offset) takes the pieces of its length from rank ``first`` on: n in each
    sequence from ``sequence`` on, from ``offset`` on, until the next slot's first rank.
    """
    used, found, sequence = Counter(), defaultdict(list), 0
    for filling, times in patterns:
        offset = 0
        for length, n in sorted(filling.items(), reverse=True):
            found[length].append((used[length], n, sequence, offset))
            used[length] += n * times
            offset += length * n
        sequence += times
    return [*found.items()], sequence


def pack(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Each text is encoded once and END_ID appended; its tokens are cut at CAPACITY. Whole windows
    are sequences of their own. The remainders, less than CAPACITY each, are packed by minimum bin
    slack over their length counts: CAPACITY - 1 numbers at most, whatever the size of the corpus,
    so the driver plans with bounded data and broadcasts the plan. Pieces find their place by their rank among equal
    lengths, without Python, as token ids are what weighs; the rank comes from counts per task and length, so a frequent length has no hot task.

    Null and empty texts give one piece of one token. Repeated rows are packed each. Null ids are
    kept. An empty table gives an empty result.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, part int, local long"
    pieces = staged(
        docs.select(id_col, docs[text_col].cast("string").alias("_text")).mapInArrow(
            Cutter(driver_file(docs.sparkSession, ranks_path), with_ids), schema + ", ids array<int>" * with_ids
        ),
        "pieces",
    )
    counts = {r["length"]: r["n"] for r in pieces.where(F.col("length") < CAPACITY).groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranked = with_rank(pieces, ["length"], "part", "local", "rank").drop("part", "local")
    found, whole = slots(plan(counts))
    kinds = "length long, slots array<struct<first:bigint,n:bigint,sequence:bigint,offset:bigint>>"
    placed = ranked.join(F.broadcast(docs.sparkSession.createDataFrame(found, kinds)), "length", "left")
    slot = F.element_at(F.filter("slots", lambda x: x["first"] <= F.col("rank")), -1)
    turn = F.col("rank") - F.col("slot.first")
    sequence = F.when(F.col("slot").isNull(), F.col("rank") + whole).otherwise(F.col("slot.sequence") + F.floor(turn / F.col("slot.n")))
    offset = F.when(F.col("slot").isNull(), 0).otherwise(F.col("slot.offset") + turn % F.col("slot.n") * F.col("length"))
    columns = [id_col, "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    # whole windows follow the filled sequences
    return placed.withColumn("slot", slot).select(*columns, sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))
