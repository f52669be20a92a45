"""Operator 12 against a plain form, and its round trip."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from variantlink.llm import fim, queries


def plain(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(df):
    got = df.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(r["doc_id"], r["text"])
        assert r["back"] == r["text"]
    return got


def test_documents_like_the_plain_form(documents):
    got = check(fim.transform(documents))
    assert len(got) == documents.count() and {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_odd_rows_and_seams(spark, odd_docs, no_docs):
    assert len(check(fim.transform(odd_docs))) == odd_docs.count()
    assert fim.transform(no_docs).count() == 0
    rng = random.Random(3)
    seams = ["".join(rng.choice(["<", ">", "P", "S", "M", "a", " ", "\n", "é", "🙂"]) for _ in range(rng.randrange(40))) for _ in range(600)]
    got = check(fim.transform(spark.createDataFrame(list(enumerate(seams)), "doc_id long, text string")))
    assert sum(r["form"] == "plain" for r in got) < len(got) / 2


def test_query_gives_digests(spark):
    rows = {r["doc_id"]: r for r in queries.op12_fill_in_middle(spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        n, form, p, m, out = plain(r["doc_id"], r["text"] or "")
        got = rows[r["doc_id"]]
        shas = [hashlib.sha256(x.encode()).hexdigest() for x in (out, r["text"] or "")]
        assert (got["n"], got["form"], got["prefix_chars"], got["middle_chars"], got["output_sha256"], got["restored_sha256"]) == (n, form, p, m, *shas)


@pytest.mark.parametrize("window", [1, 2, 3, 7, 1000])
def test_windows_join_without_loss(window):
    rng = random.Random(window)
    units = regex.compile(fim.UNITS)
    for _ in range(300):
        text = "".join(rng.choice("abZ. é\n") for _ in range(rng.randrange(30)))
        assert fim.unit_ends(text, units, window) == [m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]


def test_text_longer_than_a_window():
    text = "ab, " * 200_000
    assert len(fim.unit_ends(text, regex.compile(fim.UNITS))) == 600_000
