"""The pipeline against the stages done by hand on one machine."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from variantlink.llm import common, pii, queries, simhash

from .test_operators import brute_components, counts, held_together, luhn, plain_verdict, texts_of

DIR = "/root/testdata/sf0.001"


def base_failed(text):
    n = counts(text)
    return n[0] < 50 or 100 * n[4] > 50 * n[0]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = common.staged(stage(spark, docs, DIR), name)
        out.append((name, docs))
    return dict(out)


def test_stages(spark, stages):
    assert [*stages] == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    before = spark.read.parquet(f"{DIR}/documents.parquet")
    for name in [*stages][:-1]:
        assert stages[name].columns == before.columns
    good = dict(texts_of(stages["quality"]))
    assert good == {i: t for i, t in texts_of(before) if plain_verdict(t or "")[2]}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    judged = [(labels[i], i in good) for i, t in texts_of(before) if i in labels and not base_failed(t or "")]
    clean, junk = ([kept for label, kept in judged if label == k] for k in (1, 0))
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) < len(junk)
    by_text = defaultdict(list)
    for i, t in good.items():
        by_text[t].append(i)
    unique = {max(x): t for t, x in by_text.items()}
    assert dict(texts_of(stages["exact_dedup"])) == unique
    one_each = {i for i, _, low in brute_components([*unique.items()]) if i == low}
    assert dict(texts_of(stages["near_dedup"])) == {i: unique[i] for i in one_each}
    private = stages["pii"].collect()
    assert {r["doc_id"] for r in private} == one_each
    for r in private:
        old = unique[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
        for x in re.findall(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|\b[2-6]\d{15}\b|\b[0-9a-f]{40}\b|\b\d+\.\d+\.\d+\.\d+\b", old):
            assert (x in r["text"]) == (bool(re.fullmatch(r"\d{16}", x)) and not luhn(x))
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = lambda x: t.encode(x, add_special_tokens=False).ids
    assert held_together(stages["packing"].collect(), encode, texts_of(stages["pii"])) > 0.97


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, DIR).select(*columns).collect())) == sorted(map(tuple, stages["packing"].select(*columns).collect()))
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in queries.ORACLES


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs.select("doc_id", "text", "lang", "source", "n_chars"), no_docs):
        left = {}
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, DIR)
            if name != "packing":
                assert out.schema.names == docs.schema.names
            left[name] = [(r["doc_id"], None if name == "packing" else r["text"]) for r in out.collect()]
        before = texts_of(docs)
        assert left["quality"] == [(i, t) for i, t in before if plain_verdict(t or "")[2]]
        whole = Counter(t or "" for _, t in left["exact_dedup"])
        assert set(whole.values()) <= {1} and set(whole) == {t or "" for _, t in before}
        want = Counter(i for (i, _, low), n in brute_components(before).items() for _ in range(n) if i == low)
        assert Counter(i for i, _ in left["near_dedup"]) == want
        assert Counter((i, t is None) for i, t in left["pii"]) == Counter((i, t is None) for i, t in before)
        assert {i for i, _ in left["packing"]} == {i for i, _ in before} and len(left["packing"]) >= len(before)
    assert pii.replaced(odd_docs, "k").columns == odd_docs.columns
    assert simhash.keep_one_each(no_docs).count() == 0
