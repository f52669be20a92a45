"""Helpers shared by the text operators: staged tables, ranks over hot groups, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import remove, staged


def driver_file(spark: SparkSession, path: str):
    """A tokenizer's file (a few MB at most), read by the driver and broadcast: executors need no such path."""
    with open(path, "rb") as f:
        data = f.read()
    if len(data) > 64 << 20:
        raise ValueError(f"{path}: too large for a vocabulary")
    return spark.sparkContext.broadcast(data)


def text_of(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_rank(df: DataFrame, group: list[str], part: str, local: str, out: str) -> DataFrame:
    """0-based rank in ``group`` from a rank ``local`` in (``part``, ``group``), both frozen in a staged table.

    One row per (part, group) is windowed, never the rows of a group, so that a group may hold
    any share of the table.
    """
    sizes = df.groupBy(*group, part).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*group, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return df.join(bases, [*group, part]).withColumn(out, F.col("_base") + F.col(local)).drop("_base")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(u, v)``: ``(node, root)``, root the smallest node reached.

    Alternating large-star and small-star steps; each is a map-side combined minimum per node and
    a join with that minimum. Every step is written to the shared folder. Nodes without an edge
    to another node don't appear. Every round shortens the paths to the roots until nothing changes.
    """
    spark = edges.sparkSession
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    mark, old = None, []
    while True:
        own: list[str] = []
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large", own)
        large = both.where("v > u").join(lows, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "large-star", own)
        lows = staged(large.groupBy("u").agg(F.min("v").alias("m")), "small", own)
        hops = large.join(lows, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last: list[str] = []
        now = staged(hops.union(lows.select("u", F.col("m").alias("v"))).distinct(), "small-star", last)
        remove(spark, [*old, *own])
        old = last
        seen = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if mark == (seen["n"], seen["x"]):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (seen["n"], seen["x"])
