"""Operator 11 against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from variantlink.llm import fingerprints as fp
from variantlink.llm import queries

ALL = (1 << 64) - 1


def apart(a: int, b: int) -> int:
    return ((a ^ b) & ALL).bit_count()


def roots(prints: list[int], radius: int) -> dict[int, int]:
    """Least reachable fingerprint of each, over all pairs."""
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if apart(a, b) <= radius and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


def plain(rows):
    """(id, n_chars, sha of the edited text, fp, edited fp, fp of the next) of rows in order."""
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        new = "".join([*text[: len(text) - half], *following[:half]])
        yield i, len(text), hashlib.sha256(new.encode()).hexdigest(), fp.fingerprint(text), fp.fingerprint(new), fp.fingerprint(following)


def test_query_like_brute_force(spark):
    got = {r["doc_id"]: r for r in queries.op11_fingerprints(spark, "/root/testdata/sf0.001").collect()}
    rows = sorted((r[0], r[1] or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    want = list(plain(rows))
    low: dict[int, int] = {}
    root = roots(sorted({w[3] for w in want}), 3)
    for w in want:
        low.setdefault(root[w[3]], w[0])
    assert len(got) == len(want)
    for i, n, sha, own, changed, after in want:
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        assert (r["fingerprint"], r["edited_fingerprint"]) == (f"{own & ALL:016x}", f"{changed & ALL:016x}")
        assert (r["near_edited"], r["near_next"]) == (1 - apart(own, changed) / 64, 1 - apart(own, after) / 64)
        assert r["component_id"] == low[root[own]]


def test_edited_texts_are_nearer_than_others(spark):
    rows = queries.op11_fingerprints(spark, "/root/testdata/sf0.01").where("n_chars > 200").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.95 * len(rows)


def test_weights_and_signs():
    assert fp.fingerprint("") == fp.fingerprint(" \n") == 0
    text = "one two three four five six seven"
    assert fp.fingerprint(text) == fp.fingerprint(text.upper().replace(" ", "\n"))
    terms = [b"a b c d e", b"b c d e f"]
    import math

    import xxhash

    words = "a b c d e " * 3 + "f"
    counts: dict[bytes, int] = {}
    parts = words.encode().split()
    for k in range(len(parts) - 4):
        t = b" ".join(parts[k : k + 5])
        counts[t] = counts.get(t, 0) + 1
    assert set(terms) <= set(counts)
    votes = [0] * 64
    for t, n in counts.items():
        h = xxhash.xxh64_intdigest(t, fp.SEED)
        for bit in range(64):
            votes[bit] += round(1024 * (1 + math.log(n))) * (1 if h >> bit & 1 else -1)
    assert fp.fingerprint(words) & ALL == sum(1 << bit for bit in range(64) if votes[bit] > 0)


@pytest.mark.parametrize(("radius", "blocks", "hot"), [(3, 6, 64), (3, 6, 2), (2, 4, 2), (5, 8, 4), (0, 1, 64)])
def test_block_tables_lose_no_link(spark, radius, blocks, hot):
    """Chains, dense groups and far fingerprints; small ``hot`` splits buckets."""
    rng = random.Random(radius * 100 + hot)
    prints = {0, -1, 1}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(12):
            for bit in rng.sample(range(64), rng.randrange(0, radius + 2)):
                x ^= 1 << bit
            prints.add(x - (1 << 64) if x >> 63 else x)
    want = roots(sorted(prints), radius)
    found = {r["node"]: r["root"] for r in fp.linked(spark.createDataFrame([(p,) for p in prints], "fp long"), radius, blocks, hot).collect()}
    assert {p: found.get(p, p) for p in prints} == want


def test_odd_rows(odd_docs, no_docs):
    rows = [(r[0], r[1] or "") for r in odd_docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("x")).orderBy(F.col("doc_id").asc_nulls_first(), "x").collect()]
    found = fp.document_fingerprints(odd_docs)
    got = sorted((tuple(r) for r in found.select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp").collect()), key=repr)
    assert got == sorted((w[:5] for w in plain(rows)), key=repr)
    same = {r["doc_id"]: r["component_id"] for r in found.where("doc_id is not null").collect()}
    assert same[1] == same[2] == 1 and same[4] == same[5] == same[6] == 4 and same[7] == same[8] == 7
    assert fp.document_fingerprints(no_docs).count() == 0


def test_one_row_follows_itself(spark):
    one = spark.createDataFrame([(3, "a b c d")], "doc_id long, text string")
    r = fp.document_fingerprints(one).first()
    assert r["edited_sha256"] == hashlib.sha256(b"a b a b").hexdigest() and r["near_next"] == 1.0


def test_results_do_not_depend_on_partitions(spark, documents):
    def rows(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        return sorted(map(repr, fp.document_fingerprints(documents.repartition(n)).collect()))

    first, second = rows(3), rows(11)
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert first == second
