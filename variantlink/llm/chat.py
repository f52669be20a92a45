"""Chat formatting by multi-party perspective rotation (operator 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Turns in one part of a rendering, so that no row holds a conversation of any length.
PART = 64
SYSTEM, UNKNOWN = "system", "unknown"


def ranked(turns: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``turns`` with a 0-based rank in ``group``, from range partitions and their sizes.

    A group may hold any share of the rows: what is windowed has one row per range partition.
    """
    placed = staged(turns.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_m", F.monotonically_increasing_id()), "turns")
    placed = placed.withColumn("_part", F.shiftright("_m", 33)).withColumn("_at", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    placed = placed.join(bases, "_part").withColumn("_global", F.col("_base") + F.col("_at"))
    first = placed.groupBy(group).agg(F.min("_global").alias("_first")).withColumnRenamed(group, "_group")
    joined = placed.join(staged(first, "first-turns"), F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("rank", F.col("_global") - F.col("_first")).drop("_m", "_part", "_at", "_base", "_global", "_first", "_group")


def escaped(text: Column) -> Column:
    """A text in which no marker can begin: ``<|`` becomes ``<\\|``, and one more stroke is added where some are there."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def name_of(role: Column) -> Column:
    """A role as it stands in a marker: on one line, without a bare ``|``."""
    for old, new in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("|", "\\|")):
        role = F.replace(role, F.lit(old), F.lit(new))
    return role


def perspectives(turns: DataFrame) -> DataFrame:
    """One row per conversation, participant and part of PART turns: text and mask.

    For every participant (each role but "system") the dialogue is rendered with that speaker as
    assistant and all others as users by name; system turns stay system turns. mask lists the
    character ranges "start:end" of the speaker's own words in the part's text, the only ones to
    learn from; an own turn's closing mark belongs to its range. Parts follow each other in order
    and their texts joined give the whole rendering; a part's mask is then moved by the lengths of the parts before it.
    Markers in texts and roles are escaped, so that nobody forges a turn; the participant column
    holds the role as it is.

    Turns are ordered by turn, role and text; null turns come first, null text is empty, null or
    empty role is "unknown", rows with null conv_id form one conversation. Repeated rows are
    repeated turns. A conversation of system turns alone has no participant and no row. Other
    columns are ignored; an empty table gives an empty result.
    """
    own = turns.select(
        "conv_id",
        "turn",
        F.when(F.length("role") > 0, F.col("role")).otherwise(UNKNOWN).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    said = ranked(own, "conv_id", ["turn", "role", "text"]).select("conv_id", "rank", "role", "text")
    people = own.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("participant")).distinct()
    shown = said.join(staged(people, "participants"), F.col("conv_id").eqNullSafe(F.col("c")))
    mine = F.col("role") == F.col("participant")
    head = (
        F.when(mine, "<|assistant|>\n").when(F.col("role") == SYSTEM, "<|system|>\n").otherwise(F.concat(F.lit("<|user name="), name_of(F.col("role")), F.lit("|>\n")))
    )
    piece = F.struct(F.col("rank"), head.alias("head"), F.concat(escaped(F.col("text")), F.lit("<|end|>\n")).alias("body"), mine.alias("mine"))
    parts = shown.groupBy("conv_id", "participant", F.expr(f"rank div {PART}").alias("part")).agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def add(acc, p):
        begin = acc["at"] + F.char_length(p["head"])
        end = begin + F.char_length(p["body"])
        span = F.concat(begin.cast("string"), F.lit(":"), (end - 1).cast("string"))
        return F.struct(end.alias("at"), F.when(p["mine"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return parts.select(
        "conv_id",
        "participant",
        "part",
        F.size("pieces").cast("long").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
        F.array_join(F.aggregate("pieces", start, add)["spans"], ",").alias("mask"),
    )
