"""Byte-level BPE encoding and decoding by two-tier lookup (operator 5)."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import driver_file

#: Pre-tokens that a task remembers before it starts afresh.
REMEMBERED = 300_000
STEP, SPREAD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
WRAP = (1 << 64) - 1


def hashed(keys: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


class PerfectHash:
    """Minimal perfect hash: n keys to n slots by one displacement for each bucket of about four keys.

    Larger buckets search a displacement that sends all their keys to free slots; a bucket of one
    key names its slot outright, as a negative displacement. Slots hold the keys, so a lookup of
    any other key is told apart.
    """

    def __init__(self, keys: list[bytes]) -> None:
        n = len(keys)
        self.buckets, hashes = max(1, n // 4), hashed(keys)
        order = np.argsort(hashes % np.uint64(self.buckets), kind="stable").tolist()
        members: dict[int, list[int]] = {}
        for k in order:
            members.setdefault(int(hashes[k]) % self.buckets, []).append(k)
        self.shift = np.zeros(self.buckets, np.int64)
        slots: list[int | None] = [None] * n
        singles = []
        for bucket, own in sorted(members.items(), key=lambda x: -len(x[1])):
            if len(own) == 1:
                singles.append((bucket, own[0]))
                continue
            values, d = [int(hashes[k]) for k in own], 1
            while True:
                at = [(((h ^ d * STEP & WRAP) * SPREAD & WRAP) >> 32) % n for h in values]
                if len(set(at)) == len(at) and all(slots[x] is None for x in at):
                    break
                d += 1
            self.shift[bucket] = d
            for slot, k in zip(at, own, strict=True):
                slots[slot] = k
        free = (x for x, k in enumerate(slots) if k is None)
        for bucket, k in singles:
            slot = next(free)
            slots[slot], self.shift[bucket] = k, -slot - 1
        self.slots = np.array(slots, np.int64)
        self.keys = [keys[k] for k in slots]

    def find(self, words: list[bytes]) -> list[int | None]:
        """Index of each word among the keys, or None."""
        if not words or not self.keys:
            return [None] * len(words)
        h = hashed(words)
        d = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        with np.errstate(over="ignore"):
            mixed = (h ^ d.astype(np.uint64) * np.uint64(STEP)) * np.uint64(SPREAD)
        slot = np.where(d < 0, -d - 1, (mixed >> np.uint64(32)).astype(np.int64) % len(self.keys)).tolist()
        index = self.slots[slot].tolist()
        return [k if self.keys[s] == w else None for s, k, w in zip(slot, index, words, strict=True)]


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: the lowest-ranked adjacent pair merges first, the leftmost of equals.

    Parts are linked by their ends: the part at i reaches to end[i], where the next one starts.
    """
    n = len(word)
    end, before = [i + 1 for i in range(n)], [i - 1 for i in range(n + 1)]
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, mid, stop = heappop(heap)
        if end[i] != mid or end[mid] != stop:
            continue  # one of the two parts has merged since
        end[i], end[mid] = stop, 0
        before[stop] = i
        if stop < n and (r := ranks.get(word[i : end[stop]])) is not None:
            heappush(heap, (r, i, stop, end[stop]))
        if (left := before[i]) >= 0 and (r := ranks.get(word[left:stop])) is not None:
            heappush(heap, (r, left, i, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return ids


class Codec:
    """Ranks with both tiers and a bounded memory of pre-tokens."""

    def __init__(self, data: bytes, pattern: str) -> None:
        import regex

        pairs = [line.split() for line in data.splitlines() if line]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tokens = {v: k for k, v in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.memory: dict[str, bytes] = {}

    @cached_property
    def whole(self) -> PerfectHash:
        return PerfectHash(list(self.ranks))

    @cached_property
    def ids(self) -> list[int]:
        return list(self.ranks.values())

    def learn(self, words: set[str]) -> None:
        new = list(words)
        raw = [x.encode() for x in new]
        for text, word, k in zip(new, raw, self.whole.find(raw), strict=True):
            ids = [self.ids[k]] if k is not None else merged(word, self.ranks)
            self.memory[text] = np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        words = self.split(text)
        if new := set(words).difference(self.memory):
            if len(self.memory) > REMEMBERED:
                self.memory.clear()
                new = set(words)
            self.learn(new)
        return b"".join(map(self.memory.__getitem__, words))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


codec = lru_cache(2)(Codec)


class Step:
    """Task code: column 1 of each batch through the codec."""

    def __init__(self, data, pattern: str, back: bool) -> None:
        self.data, self.pattern, self.back = data, pattern, back

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(self.data.value, self.pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                if self.back:
                    out = pa.array([own.decode(x.as_py() or b"") for x in batch.column(1)], pa.binary())
                else:
                    out = pa.array([own.encode(x.as_py() or "") for x in batch.column(1)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, "decoded" if self.back else "ids"]).select(
                    [batch.schema.names[0], "ids", *["decoded"] * self.back]
                )


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)`` for every row: token ids as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is looked up whole by a minimal perfect hash; if it isn't in the
    vocabulary its bytes are merged. No shuffle. Null and empty texts give no ids; strings of
    special tokens are ordinary text; repeated rows are encoded each.
    """
    kind = dict(docs.dtypes)[id_col]
    data = driver_file(docs.sparkSession, ranks_path)
    return docs.select(id_col, docs[text_col].cast("string").alias("_text")).mapInArrow(
        Step(data, pattern, False), f"`{id_col}` {kind}, ids binary"
    )


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, ids, decoded)``: the bytes that the ids stand for; null ids count as none."""
    kind = dict(encoded.dtypes)[id_col]
    data = driver_file(encoded.sparkSession, ranks_path)
    return encoded.select(id_col, "ids").mapInArrow(Step(data, pattern, True), f"`{id_col}` {kind}, ids binary, decoded binary")
