"""Exact deduplication by content-defined chunk recipes (operator 1)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_of

#: A chunk ends at the first of these marks after LEAST characters, or at MOST characters.
LEAST, MOST, MARKS = 512, 4096, r"[\n.!?;:。！？]"
CHUNK = rf"(?s).{{{LEAST - 1},{MOST - 1}}}?{MARKS}|.{{1,{MOST}}}"


def chunks_of(text: Column) -> Column:
    """Content-defined chunks of a text; joined they give the text again."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_hash: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, n_chunks.

    Texts move through one shuffle, as chunks that are pre-aggregated on each side: it finds hashes
    that stand for more than one chunk. Such chunks get an ordinal beside their hash, so that an
    identifier stands for one chunk content, whatever the hash. Documents are then grouped by their
    ordered identifier lists alone; texts don't move.

    Null text counts as empty; empty texts form one group. Of a group the largest id stays (null
    only if no other is there). Rows repeated with id and text count in group_size and get the same
    verdict. Extra columns are ignored; an empty table gives an empty result.
    """
    src = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    recipes = staged(
        src.select("id", F.sha2("t", 256).alias("sha"), F.transform(chunks_of(F.col("t")), lambda x: chunk_hash(x)).alias("recipe")),
        "recipes",
    )
    chunk = src.select("id", F.sha2("t", 256).alias("sha"), F.posexplode(chunks_of(F.col("t"))).alias("pos", "chunk"))
    contents = (
        src.select(F.explode(chunks_of(F.col("t"))).alias("chunk"))
        .select(chunk_hash(F.col("chunk")).alias("h"), "chunk")
        .groupBy("h", "chunk")
        .agg(F.count("*").alias("n"))
    )
    shared = staged(contents.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "shared-hashes")
    if shared.isEmpty():
        recipes = recipes.withColumn("ordinals", F.array().cast("array<struct<pos:int,n:int>>"))
    else:
        numbered = contents.join(shared, "h").select(
            "h", "chunk", F.row_number().over(Window.partitionBy("h").orderBy("chunk")).alias("n")
        )
        told = (
            chunk.withColumn("h", chunk_hash(F.col("chunk")))
            .join(numbered, ["h", "chunk"])
            .groupBy("id", "sha")
            .agg(F.array_sort(F.collect_set(F.struct("pos", "n"))).alias("ordinals"))
        )
        recipes = staged(
            recipes.alias("a")
            .join(told.alias("b"), F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.sha") == F.col("b.sha")), "left")
            .select("a.*", F.coalesce("ordinals", F.array()).alias("ordinals")),
            "recipes-told",
        )
    groups = staged(
        recipes.groupBy("recipe", "ordinals")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1"),
        "groups",
    )
    kept_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return (
        recipes.join(groups, ["recipe", "ordinals"], "left")
        .select("id", kept_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "sha", "recipe")
        .select(
            F.col("id").alias(id_col),
            "keep_id",
            "group_size",
            F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("sha").alias("text_sha256"),
            F.size("recipe").alias("n_chunks"),
        )
    )


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that exact_dedup keeps, with all their columns; of repeated rows one stays."""
    verdict = staged(exact_dedup(docs, id_col, text_col), "exact-verdict")
    gone = verdict.where("not kept").select(F.col(id_col).alias("vl_id"), F.col("text_sha256").alias("vl_sha")).distinct()
    twice = staged(verdict.where("kept").groupBy(id_col).count().where("count > 1").select(F.col(id_col).alias("vl_id")), "twice")
    sha = F.sha2(text_of(text_col), 256)
    rest = docs.join(gone, docs[id_col].eqNullSafe(F.col("vl_id")) & (sha == F.col("vl_sha")), "left_anti")
    if twice.isEmpty():
        return rest
    again = docs[id_col].eqNullSafe(F.col("vl_id"))
    return rest.join(twice, again, "left_anti").unionByName(rest.join(twice, again, "left_semi").dropDuplicates([id_col, text_col]))
