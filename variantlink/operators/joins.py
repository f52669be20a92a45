"""Joins: by distance, by interval, by optional key, of evidence from two sides."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import staged


def join_composite_key(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str = "inner") -> DataFrame:
    """Join on differently named keys ``{left: right}``; the right keys are dropped."""
    condition = reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in keys.items()])
    joined = left.join(right, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[right[b] for b in keys.values()])


def left_join_defaults(left: DataFrame, right: DataFrame, on: Sequence[str], defaults: dict) -> DataFrame:
    """Left join with values in place of nulls in the named columns; arrays as lists."""

    def value(v) -> Column:
        return F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)

    joined = left.join(right, [*on], "left")
    kinds = dict(joined.dtypes)
    return joined.withColumns({c: F.coalesce(F.col(c), value(v).cast(kinds[c])) for c, v in defaults.items()})


def semi_join(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on), [*on], "left_semi")


def full_outer_evidence(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of either side, matched where both have the key."""
    return left.join(right, [*on], "full")


def null_or_match_join(df: DataFrame, ref: DataFrame, on: dict[str, str], optional: str) -> DataFrame:
    """Rows whose ``optional`` column is null or whose keys ``{column: ref column}`` are all in ``ref``.

    A union of the null rows and a semi join: the null rows, which may be most of the table, are
    never shuffled, and ``ref`` may hold a key twice without multiplying rows.
    """
    condition = reduce(lambda a, b: a & b, [df[a] == ref[b] for a, b in on.items()])
    matched = df.where(df[optional].isNotNull()).join(ref, condition, "left_semi")
    return df.where(F.col(optional).isNull()).unionByName(matched)


#: Rows of one bin from which it is split.
DENSE = 1_000_000
#: Pairs that one task of a distance join is to look at.
PAIRS = 4_000_000
#: Rows of a table that are few enough to be sent to every task.
FEW = 100_000


def _bin(value: Column, width: float | Column, slack: float = 0.0) -> Column:
    return F.floor(value / width + slack).cast("long")


def _histogram(placed: DataFrame, near: DataFrame, on: Sequence[str]) -> DataFrame:
    """``(on, _bin, _n, _pairs)``: left rows and pairs of each bin that has any."""
    rows, others = (df.groupBy(*on, "_bin").agg(F.count("*").alias(n)) for df, n in ((placed, "_n"), (near, "_m")))
    return staged(rows.join(others, [*on, "_bin"]).select(*on, "_bin", "_n", (F.col("_n") * F.col("_m")).alias("_pairs")), "bins")


def _shares(binned: DataFrame, on: Sequence[str], most: int, pairs: int | None = None) -> DataFrame | None:
    """``(on, _bin, _shares)`` of the bins with more than ``most`` rows; None if there are none. With ``pairs``, ``binned`` is their histogram,
    and so are bins with more than ``pairs`` pairs."""
    if pairs is None:
        binned = binned.groupBy(*on, "_bin").agg(F.count("*").alias("_n")).withColumn("_pairs", F.lit(0))
    shares = F.greatest(F.ceil(F.col("_n") / most), F.ceil(F.least(F.col("_pairs") / (pairs or 1), "_n"))).cast("int")
    dense = staged(binned.select(*on, "_bin", shares.alias("_shares")).where("_shares > 1"), "dense")
    n = dense.count()
    return None if n == 0 else F.broadcast(dense) if n <= FEW else dense


def _dealt(binned: DataFrame, keys: Sequence[str], dense: DataFrame | None) -> DataFrame:
    """Rows with ``_share``: those of a dense bin are dealt out by a hash, so that no share holds many more than the stated number."""
    if dense is None:
        return binned.withColumn("_share", F.lit(0))
    row = F.xxhash64(*[f.name for f in binned.schema if "map<" not in f.dataType.simpleString()])
    share = F.when(F.col("_shares") > 1, F.pmod(row, F.col("_shares")).cast("int")).otherwise(0)
    return binned.join(dense, [*keys], "left").withColumn("_share", share).drop("_shares")


def _copied(binned: DataFrame, keys: Sequence[str], dense: DataFrame | None) -> DataFrame:
    """Rows once for each share of their bin."""
    if dense is None:
        return binned.withColumn("_share", F.lit(0))
    every = F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1)
    return binned.join(dense, [*keys], "left").withColumn("_share", F.explode(every)).drop("_shares")


def band_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_pos: str,
    right_pos: str,
    max_distance: float,
    bin_width: float | None = None,
    distance_col: str = "d",
    most: int = DENSE,
    pairs: int = PAIRS,
) -> DataFrame:
    """Pairs with equal ``on`` columns whose positions are at most ``max_distance`` apart.

    An equi-join on (on, bin): each left row lies in one bin, each right row is copied into the
    bins that its band touches (three at the default width), so a pair meets once. Bins split a
    key that most rows share; a bin of more than ``most`` left rows is split in turn: its left rows are dealt out,
    its right rows copied to every share, even if all lie at one position; so is a bin of more than ``pairs`` pairs. Tasks are as many as
    the counted pairs ask for: few rows in one small file may make any number of pairs. Make ``right`` the smaller side. Null keys
    and positions match nothing.
    """
    width, keys = float(bin_width or max(max_distance, 1)), [*on, "_bin"]
    reach = F.col(right_pos)
    bins = F.sequence(_bin(reach - max_distance, width, -1e-9), _bin(reach + max_distance, width, 1e-9))
    near = right.where(F.col(right_pos).isNotNull()).withColumn("_bin", F.explode(bins))
    placed = left.withColumn("_bin", _bin(F.col(left_pos), width))
    bins = _histogram(placed, near, on)
    dense = _shares(bins, on, most, pairs)
    dealt = _dealt(placed, keys, dense)
    tasks = math.ceil((bins.agg(F.sum(F.col("_pairs").cast("double"))).first()[0] or 0) / pairs)
    if tasks > 1:
        dealt = dealt.repartition(tasks, *keys, "_share")
    joined = dealt.join(_copied(near, keys, dense), [*keys, "_share"]).drop("_bin", "_share")
    return joined.withColumn(distance_col, F.abs(F.col(left_pos) - F.col(right_pos))).where(F.col(distance_col) <= max_distance)


def interval_bins(intervals: DataFrame, start: str, end: str, bin_width: int) -> DataFrame:
    """A row for each bin of an interval, with ``_level`` and ``_bin``: two at most, whatever its length.

    Bins of level n are 2**n times ``bin_width`` wide, and an interval goes to the first level whose bins are not shorter than itself.
    """
    length = F.col(end) - F.col(start)
    level = F.greatest(F.lit(0), F.ceil(F.log2(length / bin_width)).cast("int"))
    width = F.lit(float(bin_width)) * F.pow(F.lit(2.0), F.col("_level"))
    placed = intervals.where(F.col(start) <= F.col(end)).withColumn("_level", level)
    return placed.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), width), _bin(F.col(end), width))))


def interval_join(
    intervals: DataFrame, points: DataFrame, on: Sequence[str], start: str, end: str, pos: str, bin_width: int
) -> DataFrame:
    """A row for each interval ``[start, end]`` and point inside it with equal ``on`` columns.

    An interval lies in two bins at most of the level of its length (interval_bins), a point is looked up in one bin of each
    level that has intervals, so a pair meets once. Intervals that end before they start hold nothing, null ends neither.
    ``bin_width`` is the width of the narrowest bins: take a short interval's length.
    """
    spread = interval_bins(intervals, start, end, bin_width)
    levels = sorted(r["_level"] for r in spread.select("_level").distinct().collect())  # as many as doublings of the longest interval
    at = [F.struct(F.lit(n).alias("_level"), _bin(F.col(pos), float(bin_width) * 2.0**n).alias("_bin")) for n in levels]
    found = points.select("*", F.inline(F.array(*at).cast("array<struct<_level:int,_bin:bigint>>")))
    joined = found.join(spread, [*on, "_level", "_bin"])
    return joined.where(F.col(pos).between(F.col(start), F.col(end))).drop("_level", "_bin")


def nearest_by(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_pos: str,
    right_pos: str,
    max_distance: float,
    right_id: str,
    groups: dict[str, Column | None],
    bin_width: float | None = None,
    most: int = DENSE,
) -> DataFrame:
    """``left`` with the nearest right id, and its distance, in each group of right rows.

    ``groups`` maps an output name to a condition on right rows (None: all). Ties go to the smallest id; rows without a
    near enough id, with a null position or a null ``on`` column get nulls.

    A sweep without pairs: both sides stand one under another in bins of ``on`` and position, sorted, and each left row
    takes the last right position before it and the next one after it, all groups in one pass. What lies outside its
    bin comes from a table with one row a bin, which carries the last and the next position over any number of empty bins.
    A bin of more than ``most`` left rows is split: its left rows are dealt out, its right rows stand in every share.
    """
    width, keys = float(bin_width or max(max_distance, 1)), [*on, "_bin"]
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*on, right_pos)])
    ids = [F.min(F.col(right_id) if test is None else F.when(test, F.col(right_id))).alias(f"_id_{g}") for g, test in groups.items()]
    marks = right.where(known).groupBy(*on, F.col(right_pos).alias("_at")).agg(*ids).withColumn("_bin", _bin(F.col("_at"), width))
    hits = {g: F.when(F.col(f"_id_{g}").isNotNull(), F.struct(F.col("_at"), F.col(f"_id_{g}").alias("_id"))) for g in groups}
    marks = staged(marks.select(*keys, "_at", *[h.alias(f"_hit_{g}") for g, h in hits.items()]), "marks")

    # rows that can have nothing near are dealt out by a hash, to shares where no right row stands
    lost = ~reduce(Column.__and__, [F.col(c).isNotNull() for c in (*on, left_pos)])
    own = left.select(*on, F.col(left_pos).alias("_at"), lost.alias("_lost"), F.struct("*").alias("_row"))
    own = own.withColumn("_bin", F.when(F.col("_lost"), F.pmod(F.xxhash64("_row"), F.lit(997))).otherwise(_bin(F.col("_at"), width)))
    sizes = own.where("not _lost").groupBy(*keys).agg(F.count("*").alias("_n"))
    edges = marks.groupBy(*keys).agg(*[f(f"_hit_{g}").alias(f"_{end}_{g}") for g in groups for end, f in (("first", F.min), ("last", F.max))])
    forth, back = (Window.partitionBy(*on).orderBy(c).rowsBetween(Window.unboundedPreceding, -1) for c in (F.col("_bin").asc(), F.col("_bin").desc()))
    carried = {f"_{end}_{g}": F.last(f"_{end}_{g}", ignorenulls=True).over(w) for g in groups for end, w in (("last", forth), ("first", back))}
    bins = staged(sizes.join(edges, keys, "full").select(*keys, "_n", *[c.alias(n) for n, c in carried.items()]).where("_n is not null"), "bins")

    dense = bins.where(F.col("_n") > most).select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_shares"))
    dense = None if (n := dense.count()) == 0 else F.broadcast(dense) if n <= FEW else dense
    outside = [
        bins.where(F.col(c).isNotNull()).select(*keys, F.col(f"{c}._at").alias("_at"), F.col(c).alias(f"_hit_{g}")) for g in groups for c in (f"_last_{g}", f"_first_{g}")
    ]
    stand = union_evidence(marks.join(bins.select(*keys), keys, "left_semi"), *outside)
    rows = _dealt(own, keys, dense).withColumn("_share", F.when(F.col("_lost"), -1).otherwise(F.col("_share")))
    swept = rows.unionByName(_copied(stand, keys, dense), allowMissingColumns=True)
    sweep = Window.partitionBy(*keys, "_share")
    before, after = sweep.orderBy(F.col("_at").asc()), sweep.orderBy(F.col("_at").desc())
    sides = {f"_{side}_{g}": F.last(f"_hit_{g}", ignorenulls=True).over(w) for side, w in (("before", before), ("after", after)) for g in groups}
    found = swept.withColumns(sides).where(F.col("_row").isNotNull())
    nearest = {}
    for g in groups:
        both = F.transform(F.array(f"_before_{g}", f"_after_{g}"), lambda x: F.struct(F.abs(F.col("_at") - x["_at"]).alias("d"), x["_id"].alias("id")))
        nearest[f"_nearest_{g}"] = F.array_min(F.filter(both, lambda x: x["d"] <= max_distance))
    found = found.withColumns(nearest).select("_row", *nearest)
    return found.select("_row.*", *[c for g in groups for c in (F.col(f"_nearest_{g}.d").alias(f"{g}_distance"), F.col(f"_nearest_{g}.id").alias(g))])


def union_evidence(*tables: DataFrame, array_defaults: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Tables with different feature columns one under another; missing features are null, or [] if named."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    kinds = dict(whole.dtypes)
    whole = whole.withColumns({c: F.coalesce(F.col(c), F.array().cast(kinds[c])) for c in array_defaults})
    return whole if columns is None else whole.select(*columns)
