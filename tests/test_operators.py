"""Operators on edge cases and against naive forms."""

from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from variantlink.functions import columns as C
from variantlink.functions import filters
from variantlink.operators import aggregates, joins, layout, windows
from variantlink.plans import variant_disease
from variantlink.sources import io
from variantlink.sources.shared import new_path


def rows(df):
    return Counter(map(tuple, df.collect()))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# joins


@pytest.mark.parametrize("width", [None, 7, 1000])
def test_band_join_like_the_plain_join(spark, width):
    rng = random.Random(1)
    left = spark.createDataFrame([(i, rng.choice("ab") if i % 9 else None, rng.randrange(-500, 500)) for i in range(300)], "l long, k string, p long")
    right = spark.createDataFrame([(i, rng.choice("ab"), rng.randrange(-500, 500) if i % 7 else None) for i in range(120)], "r long, k string, q long")
    plain = left.join(right, "k").where("abs(p - q) <= 25").select("l", "r", F.abs(F.col("p") - F.col("q")))
    assert rows(joins.band_join(left, right, ["k"], "p", "q", 25, width).select("l", "r", "d")) == rows(plain)


def test_band_join_edges(spark):
    left = spark.createDataFrame([("1", 1000.0), ("1", 0.25), ("2", 1000.0)], "k string, p double")
    right = spark.createDataFrame([("1", 1500.0), ("1", 1500.5), ("1", 1000.0), ("1", -499.75)], "k string, q double")
    assert rows(joins.band_join(left, right, ["k"], "p", "q", 500).select("p", "q", "d")) == Counter([(1000.0, 1500.0, 500.0), (1000.0, 1000.0, 0.0), (0.25, -499.75, 500.0)])


@pytest.mark.parametrize("width", [1, 13, 10_000])
def test_interval_join_like_exploding_every_base(spark, width):
    rng = random.Random(2)
    spans = [(i, rng.choice("ab"), s := rng.randrange(0, 900), s + rng.randrange(-3, 40)) for i in range(150)]
    intervals = spark.createDataFrame(spans, "i long, k string, s long, e long")
    points = spark.createDataFrame([(i, rng.choice("ab"), rng.randrange(0, 950)) for i in range(400)], "v long, k string, p long")
    bases = intervals.where("s <= e").withColumn("p", F.explode(F.sequence("s", "e")))
    assert rows(joins.interval_join(intervals, points, ["k"], "s", "e", "p", width).select("i", "v")) == rows(points.join(bases, ["k", "p"]).select("i", "v"))


def test_nearest_takes_the_smallest_id_of_ties(spark):
    left = spark.createDataFrame([("v1", "1", 100), ("v2", "1", 900), ("v3", "2", 100)], "v string, k string, p long")
    right = spark.createDataFrame([("g2", "1", 110, True), ("g1", "1", 90, False), ("g3", "1", 95, None)], "g string, k string, q long, coding boolean")
    got = joins.nearest_by(left, right, ["k"], "p", "q", 20, "g", {"any": None, "coding": F.col("coding")})
    assert rows(got.select("v", "any", "any_distance", "coding", "coding_distance")) == Counter(
        [("v1", "g3", 5, "g2", 10), ("v2", None, None, None, None), ("v3", None, None, None, None)]
    )


@pytest.mark.parametrize(("width", "most"), [(None, 10**6), (7, 10**6), (50, 3), (5000, 10)])
def test_nearest_like_brute_force(spark, width, most):
    """Ties, repeated and null rows, empty bins, dense bins that are split."""
    rng = random.Random(6)
    left = [(i % 190, rng.choice("ab") if i % 17 else None, rng.choice([rng.randrange(2000), 777, -5, None]), rng.choice([None, "T"])) for i in range(300)]
    right = [(f"g{i:02}", rng.choice("ab") if i % 7 else None, rng.randrange(200) * 10 if i % 9 else None, rng.choice([True, False, False, None])) for i in range(60)]
    got = joins.nearest_by(
        spark.createDataFrame(left, "v long, k string, p long, _at string"), spark.createDataFrame(right, "g string, k string, q long, coding boolean"),
        ["k"], "p", "q", 300, "g", {"any": None, "coding": F.col("coding")}, width, most,
    )
    want = Counter()
    for v, k, p, a in left:
        near = [(abs(p - q), g, c) for g, kk, q, c in right if kk == k and q is not None and abs(p - q) <= 300] if k and p is not None else []
        x, y = min(near, default=(None, None), key=lambda r: r[:2])[:2], min((r for r in near if r[2]), default=(None, None), key=lambda r: r[:2])[:2]
        want[v, k, p, a, *x, *y] += 1
    assert rows(got.select("v", "k", "p", "_at", "any_distance", "any", "coding_distance", "coding")) == want


def test_nearest_makes_no_pairs(spark):
    left = spark.range(500).select("id", F.lit("a").alias("k"), F.col("id").alias("p"))
    right = spark.range(400).select(F.col("id").alias("g"), F.lit("a").alias("k"), (F.col("id") % 20).alias("q"))
    got = joins.nearest_by(left, right, ["k"], "p", "q", 100, "g", {"any": None, "odd": F.col("g") % 2 == 1})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 500 and "Inner" not in plan and "Expand" not in plan
    assert got.where("p = 19").first()["any"] == 19 and got.where("p = 30").first()["odd"] == 19


def test_nearest_of_nothing(spark):
    left = spark.createDataFrame([(1, "a", 5)], "v long, k string, p long")
    right = spark.createDataFrame([], "g string, k string, q long")
    assert tuple(joins.nearest_by(left, right, ["k"], "p", "q", 9, "g", {"any": None}).first()) == (1, "a", 5, None, None)
    assert joins.nearest_by(left.limit(0), left.select(F.lit("g").alias("g"), "k", F.col("p").alias("q")), ["k"], "p", "q", 9, "g", {"any": None}).count() == 0


def test_band_join_splits_dense_bins(spark):
    """Nine tenths of the rows lie at one position: no share holds many more than the stated number, and no pair is lost or doubled."""
    left = spark.range(20_000).select(F.col("id").alias("l"), F.lit("a").alias("k"), F.when(F.col("id") % 10 > 0, 500).otherwise(F.col("id") % 5000).alias("p"))
    right = spark.createDataFrame([(i, "a", i * 100) for i in range(50)], "r long, k string, q long")
    plain = left.join(right, "k").where("abs(p - q) <= 100").select("l", "r", F.abs(F.col("p") - F.col("q")))
    got = joins.band_join(left, right, ["k"], "p", "q", 100, most=1000)
    assert rows(got.select("l", "r", "d")) == rows(plain)
    binned = left.withColumn("_bin", F.expr("p div 100"))
    dense = joins._shares(binned, ["k"], 1000)
    shares = [r["count"] for r in joins._dealt(binned, ["k", "_bin"], dense).groupBy("k", "_bin", "_share").count().collect()]
    assert max(shares) < 1200 and sum(shares) == 20_000


def test_intervals_of_any_length_take_two_bins_at_most(spark):
    spans = [(k, "a", s, s + length) for k, (s, length) in enumerate((s, n) for n in [0, 1, 2, 9, 10, 11, 19, 20, 21, 1279, 1280, 1281, 10**6, 240 * 10**6] for s in (0, 7, -13, 10**7))]
    intervals = spark.createDataFrame(spans, "i long, k string, s long, e long")
    copies = joins.interval_bins(intervals, "s", "e", 10).groupBy("i").count().collect()
    assert len(copies) == len(spans) and max(r["count"] for r in copies) <= 2
    points = spark.createDataFrame([(p, "a", p) for p in [-14, -13, -1, 0, 5, 7, 8, 9, 10, 17, 27, 28, 1286, 1287, 10**6, 10**7, 10**7 + 20, 24 * 10**7]], "v long, k string, p long")
    want = Counter((i, p) for i, _, s, e in spans for (p,) in points.select("p").collect() if s <= p <= e)
    assert rows(joins.interval_join(intervals, points, ["k"], "s", "e", "p", 10).select("i", "p")) == want
    assert joins.interval_join(intervals.limit(0), points, ["k"], "s", "e", "p", 10).count() == 0


def test_null_or_match(spark):
    df = spark.createDataFrame([(1, None, "1"), (2, "g1", "1"), (3, "g1", "2"), (4, "zz", "1")], "i long, g string, c string")
    ref = spark.createDataFrame([("g1", "1"), ("g1", "1")], "gene string, chr string")
    assert sorted(r["i"] for r in joins.null_or_match_join(df, ref, {"g": "gene", "c": "chr"}, "g").collect()) == [1, 2]


def test_composite_key_and_defaults(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k long, s string")
    b = spark.createDataFrame([(1, "x", 5)], "k2 long, s2 string, n long")
    assert joins.join_composite_key(a, b, {"k": "k2", "s": "s2"}).columns == ["k", "s", "n"]
    c = b.select(F.col("k2").alias("k"), F.array(F.lit("t")).alias("tags"))
    assert rows(joins.left_join_defaults(a, c, ["k"], {"tags": []}).select("s", F.size("tags"))) == Counter([("x", 1), ("y", 0)])


# windows


@pytest.mark.parametrize("skew_safe", [False, True])
def test_percentile_edges(spark, skew_safe):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", None), ("a", 3.0), ("b", 7.0), (None, 1.0), (None, 2.0)], "g string, x double")
    got = rows(windows.percentile_by(df, ["g"], "x", "q", skew_safe=skew_safe))
    assert got == Counter([("a", 1.0, 0.3), ("a", 1.0, 0.3), ("a", None, None), ("a", 3.0, 1.0), ("b", 7.0, 0.0), (None, 1.0, 0.0), (None, 2.0, 1.0)])


def test_skew_safe_percentile_like_the_window(spark):
    rng = random.Random(3)
    data = [(rng.choice("aaaab"), rng.choice([None, float(rng.randrange(40)), rng.random() * 100])) for _ in range(4000)]
    df = spark.createDataFrame(data, "g string, x double")
    plain, safe = (windows.percentile_by(df, ["g"], "x", "q", digits=6, skew_safe=s) for s in (False, True))
    assert rows(plain) == rows(safe)
    assert windows.percentile_by(df.limit(0), ["g"], "x", "q", skew_safe=True).count() == 0


@pytest.mark.parametrize("slices", [1, 2, 7, 64])
def test_skew_safe_percentile_of_scores_that_fill_slices(spark, slices):
    """A third of the rows has one score, others are null, NaN, infinite or of both signs of zero; some groups are small, one is all null."""
    special = [1.0, None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 2.0, 2.0, 2.0]
    data = [(k, "a" if k % 9 else f"b{k % 5}", special[k % 10] if k % 3 else float(k * 37 % 1000)) for k in range(6000)] + [(-k, "none", None) for k in range(1500)]
    df = spark.createDataFrame(data, "i long, g string, x double")
    found = Counter(map(repr, map(tuple, windows.percentile_by(df, ["g"], "x", "q", digits=6, slices=slices).collect())))
    assert found == Counter(map(repr, map(tuple, windows.percentile_by(df, ["g"], "x", "q", digits=6, skew_safe=False).collect())))


@pytest.mark.parametrize("kind", ["long", "int", "decimal(12,3)", "date"])
def test_skew_safe_percentile_of_other_types(spark, kind):
    x = F.expr("date_add(date'2020-01-01', cast(id * 7 % 90 as int))") if kind == "date" else (F.col("id") * 7 % 90).cast(kind)
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("g"), (F.col("id") % 2).alias("h"), x.alias("x"))
    safe, plain = (windows.percentile_by(df, ["g", "h"], "x", "q", digits=4, skew_safe=s, slices=8) for s in (True, False))
    assert rows(safe) == rows(plain)


def test_skew_safe_percentile_moves_rows_once(spark):
    from variantlink.sources.shared import staged

    df = staged(spark.range(20_000).select("id", F.lit("a").alias("g"), (F.col("id") % 977).cast("double").alias("x"), F.lit("wide").alias("w")), "scores")
    plan = windows.percentile_by(df, ["g"], "x", "q")._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
    # the rows once; besides them slice counts, aggregated before they move
    assert sum("_salt" in line for line in moved) == 1 and not any("rangepartitioning" in line for line in moved)
    assert len(moved) <= 1 + 2, moved


def test_conditional_distinct_like_brute_force(spark):
    rng = random.Random(8)
    data = [(rng.choice("aab") if k % 13 else None, rng.choice([None, *range(30)]), rng.choice([None, 0.0, 0.5, 2.0]), rng.choice([None, 1, 2, 3]), k) for k in range(900)]
    df = spark.createDataFrame(data, "g string, k long, x double, p long, i long")
    counts = {"all": None, "big": F.col("x") > 1, "any": F.col("x") > 0}
    found = aggregates.conditional_distinct(df, ["g"], F.col("k"), counts, {"p": F.col("p"), "i": F.col("i"), "x": F.col("x")})
    want = Counter()
    for g in {r[0] for r in data}:
        own = [r for r in data if r[0] == g]
        first = min(own, key=lambda r: (r[3] is None, r[3] or 0, r[4]))
        keys = [{r[1] for r in own if r[1] is not None and test(r[2])} for test in (lambda x: True, lambda x: x is not None and x > 1, lambda x: x is not None and x > 0)]
        want[(g, first[3], first[4], first[2], *map(len, keys))] += 1
    assert rows(found) == want
    assert aggregates.conditional_distinct(df.limit(0), ["g"], F.col("k"), counts).count() == 0
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


def read_share(path, column, value):
    """The share of row groups whose least and most value of ``column`` don't rule ``value`` out."""
    hit = total = 0
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total, hit = total + 1, hit + (stats.min <= value <= stats.max)
    return hit / total


def test_one_layout_for_two_readers(spark):
    """Of 64 files either reader needs few; a table sorted by study alone serves one of them only."""
    rng = random.Random(8)
    hot = lambda: rng.choice([7, rng.randrange(500), rng.randrange(500)])  # noqa: E731  (a third of the rows in one study)
    made = spark.createDataFrame([(f"S{hot():03}", rng.choice("1234"), rng.randrange(10**6), i) for i in range(40_000)], "study_id string, tag_chrom string, tag_pos long, _key long")
    paths = {}
    for name, df in (
        ("each", variant_disease.for_two_readers(made, 64)),
        ("study", made.repartitionByRange(64, "study_id", "tag_chrom", "tag_pos").sortWithinPartitions("study_id")),
    ):
        paths[name] = new_path(spark, name).removeprefix("file:")
        df.write.parquet(paths[name])
    cold = f"S{321:03}"
    assert read_share(paths["each"], "study_id", cold) <= 0.25 and read_share(paths["each"], "tag_chrom", "2") <= 0.5
    one_chrom = made.select("study_id", F.lit("1").alias("tag_chrom"), "tag_pos", "_key")
    path = new_path(spark, "one").removeprefix("file:")
    variant_disease.for_two_readers(one_chrom, 64).write.parquet(path)
    assert read_share(path, "tag_pos", 500_000) <= 0.25 and read_share(path, "study_id", cold) <= 0.25
    assert read_share(paths["study"], "tag_pos", 500_000) > 0.6
    assert rows(spark.read.parquet(paths["each"]).select(*made.columns)) == rows(made)


def test_layout_by_each_odd(spark):
    made = spark.createDataFrame([(None, None, 1), ("a", None, 2), (None, 5, 3), ("a", 5, 4), ("a", 5, 4)], "s string, p long, i long")
    assert rows(layout.cluster_by_each(made, [["s"], ["p"]])) == rows(made)
    assert layout.cluster_by_each(made.limit(0), [["s"], ["p"]]).count() == 0
    assert rows(layout.cluster_by_each(made.limit(1), [["s", "p"]], bits=1)) == rows(made.limit(1))
    edges = [F.lit(v) for v in (2, 4, 6)]
    assert [r[0] for r in spark.range(8).select(layout.bin_of(F.col("id"), edges)).collect()] == [0, 0, 1, 1, 2, 2, 3, 3]


def test_band_join_tasks_go_by_pairs(spark):
    """A few rows of one partition that make many pairs are dealt out, and give the same pairs."""
    left = spark.range(400).coalesce(1).select(F.lit("a").alias("k"), F.col("id").alias("l"), (F.col("id") % 7).cast("double").alias("p"))
    right = spark.range(300).coalesce(1).select(F.lit("a").alias("k"), F.col("id").alias("r"), (F.col("id") % 5).cast("double").alias("q"))
    found = joins.band_join(left, right, ["k"], "p", "q", 10, pairs=10_000)
    assert found.count() == 120_000 == found.select("l", "r").distinct().count()
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 60_000, sizes


def test_a_large_group_is_sliced_where_the_plain_window_is_asked_for(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), F.col("id"), F.when(F.col("id") % 11 > 0, (F.col("id") * 7 % 1000).cast("double")).alias("x"))
    plain, sliced = (windows.percentile_by(df, ["g"], "x", "q", digits=6, skew_safe=False, large=n) for n in (1500, 1499))
    assert rows(plain) == rows(sliced)
    assert ["_slice" in df._jdf.queryExecution().executedPlan().toString() for df in (plain, sliced)] == [False, True]


@pytest.mark.parametrize("digits", [1, 2])
def test_percentile_by_cuts_like_the_window(spark, digits):
    """Ties, nulls, NaN and infinities, null groups, groups of one and two rows: the same values, and no row is written or moved by itself."""
    rng = random.Random(21)
    made = [(rng.choice(["a", "a", "b", None]), rng.choice([None, 0.25, 1e300, float("inf"), float("nan"), -1.0, *[rng.gauss(0, 1) for _ in range(4)]]), k) for k in range(4000)]
    made += [("one", 1.0, -1), ("two", 1.0, -2), ("two", 2.0, -3), ("none", None, -4), ("none", None, -5)]
    made += [("even", float(k), 10_000 + k) for k in range(2001)] + [("few", float(k % 3), 20_000 + k) for k in range(3000)]
    df = spark.createDataFrame(made, "g string, x double, k long").repartition(5)
    want = Counter(map(repr, map(tuple, windows.percentile_by(df, ["g"], "x", "q", digits=digits, skew_safe=False).collect())))
    for large in (0, 10**6):
        found = windows.percentile_by_cuts(df, ["g"], "x", "q", digits=digits, large=large)
        assert Counter(map(repr, map(tuple, found.collect()))) == want
    plan = windows.percentile_by_cuts(df, ["g"], "x", "q", large=0)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("hashpartitioning") == 0
    assert windows.percentile_by_cuts(df.limit(0), ["g"], "x", "q", large=0).count() == 0
