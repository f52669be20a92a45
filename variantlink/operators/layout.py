"""Sorting and clustering of outputs."""

from __future__ import annotations

import bisect
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import staged

#: Rows sampled for each bin of a dimension: the bound of what the driver reads.
SAMPLED = 50


def global_sort(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total order; only for outputs whose order readers rely on."""
    return df.orderBy(*columns)


def cluster_by_position(df: DataFrame, chr_col: str, pos_col: str, partitions: int | None = None) -> DataFrame:
    """Range-partitioned and sorted within files, so that readers skip row groups by position."""
    dealt = df.repartitionByRange(chr_col, pos_col) if partitions is None else df.repartitionByRange(partitions, chr_col, pos_col)
    return dealt.sortWithinPartitions(chr_col, pos_col)


def sort_within(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sorted in each partition, as by start position or id, without a shuffle."""
    return df.sortWithinPartitions(*columns)


def bin_of(value: Column, edges: Sequence[Column]) -> Column:
    """How many of the rising ``edges`` are no greater than ``value``, by halving; a null value is above all."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        half = (low + high) // 2
        return F.when(value < edges[half], among(low, half)).otherwise(among(half + 1, high))

    return among(0, len(edges))


def cluster_by_each(df: DataFrame, dimensions: Sequence[Sequence[str]], bits: int = 6, partitions: int | None = None) -> DataFrame:
    """Files and row groups that are narrow in every dimension, so that readers by any one of them skip most.

    A dimension is a list of columns, compared in order (study; chromosome and position). Each is cut into 2**bits bins of like
    size; the bins' bits, interleaved, are the key by which rows are range-partitioned and sorted, in one exchange. The bins' edges
    come from a sample of SAMPLED * 2**bits rows in expectation, which decides the layout alone: no row depends on it. Null values
    count as greatest; a value that is more frequent than a bin fills several, and the other dimensions divide its rows.
    """
    df = staged(df, "layout")  # counted, sampled and written
    share = min(1.0, SAMPLED * 2**bits / max(df.count(), 1))
    wanted = list(dict.fromkeys(c for d in dimensions for c in d))
    sample = df.select(*wanted).sample(share, seed=1).collect()
    key = F.lit(0)
    for d, columns in enumerate(dimensions):
        seen = sorted(tuple(r[c] for c in columns) for r in sample if all(r[c] is not None for c in columns))
        cuts = [seen[k * len(seen) // 2**bits] for k in range(1, 2**bits)] if seen else []
        cuts = [c for i, c in enumerate(cuts) if bisect.bisect_left(cuts, c) == i]
        types = [df.schema[c].dataType for c in columns]
        edges = [F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(cut, types, columns, strict=True)]) for cut in cuts]
        missing = F.greatest(*[F.col(c).isNull().cast("int") for c in columns], F.lit(0)) == 1
        place = F.when(missing, 2**bits - 1).otherwise(bin_of(F.struct(*columns), edges))
        for b in range(bits):
            bit = F.shiftright(place, b).bitwiseAND(F.lit(1))
            key = key + F.shiftleft(bit, b * len(dimensions) + len(dimensions) - 1 - d)
    name = next(x for x in (f"_key{i or ''}" for i in range(len(df.columns) + 1)) if x.lower() not in {c.lower() for c in df.columns})
    keyed = df.withColumn(name, key)
    order = [name, *wanted]
    dealt = keyed.repartitionByRange(*order) if partitions is None else keyed.repartitionByRange(partitions, *order)
    return dealt.sortWithinPartitions(*order).drop(name)
