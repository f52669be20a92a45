"""Column expressions and projections. All are built-in functions: they stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

LARGEST, SMALLEST = 1.7976931348623157e308, 5e-324


def project_alias(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Project ``(path, alias)`` pairs; paths may reach into structs."""
    return df.select([F.col(path).alias(alias) for path, alias in pairs])


def rename_with(df: DataFrame, columns: Sequence[str], f: Callable[[str], str]) -> DataFrame:
    return df.withColumnsRenamed({c: f(c) for c in columns})


def with_labels(df: DataFrame, **labels: str) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in labels.items()})


def flatten_structs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Struct fields as top-level columns at the end, their parents dropped."""
    return df.select("*", *[f"{c}.*" for c in columns]).drop(*columns)


def compose_key(*columns: str | Column) -> Column:
    """Values joined by ``_``; nulls are skipped."""
    return F.concat_ws("_", *columns)


def split_key(df: DataFrame, column: str, into: dict[str, str], prefix: str = "") -> DataFrame:
    """Parts of a ``_`` key as typed columns; a part that is missing or can't be cast is null."""
    if not 2 <= len(into) <= 4:
        raise ValueError("a key has two to four parts")
    parts = F.split(F.col(column), "_")
    return df.withColumns({prefix + name: F.get(parts, F.lit(i)).try_cast(kind) for i, (name, kind) in enumerate(into.items())})


def pos_segment(position: Column, width: float = 1_000_000) -> Column:
    return (position / width).cast("long")


def category_ordinal(value: Column, categories: Sequence[str]) -> Column:
    """1-based place in ``categories``; 0 for anything else, null too."""
    places = F.create_map(*[F.lit(x) for i, c in enumerate(categories, 1) for x in (c, i)])
    return F.coalesce(F.try_element_at(places, value), F.lit(0))


def path_tokens(path: Column, token: str, n: int = 2) -> Column:
    """First ``n`` non-empty segments after the last ``token``, lower-cased; without it those of the whole path."""
    tail = F.element_at(F.split(path, _quoted(token)), -1)
    return F.transform(F.slice(F.filter(F.split(tail, "/"), lambda x: x != ""), 1, n), F.lower)


def _quoted(token: str) -> str:
    return r"\Q" + token + r"\E"


def zip_delimited(codes: Column, labels: Column, delimiter: str = ";") -> Column:
    """Pairs of two delimited strings; the shorter is padded, pairs without a code are dropped."""
    pairs = F.arrays_zip(F.split(codes, _quoted(delimiter)).alias("a"), F.split(labels, _quoted(delimiter)).alias("b"))
    filled = F.transform(pairs, lambda p: F.array(F.coalesce(p["a"], F.lit("")), F.coalesce(p["b"], F.lit(""))))
    return F.filter(filled, lambda p: F.get(p, F.lit(0)) != "")


def explode_structs(df: DataFrame, column: str, fields: Sequence[str]) -> DataFrame:
    """A row for each struct of an array, with its fields as columns; empty and null arrays give none."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(column).alias("_one")).select(*rest, *[F.col(f"_one.{f}").alias(f) for f in fields])


def conform_schema(df: DataFrame, schema: StructType, not_null: Sequence[str] = ()) -> DataFrame:
    """Exactly the schema's columns, order and types; a null in a ``not_null`` column fails the query."""

    def column(name: str, kind) -> Column:
        value = F.col(name).cast(kind)
        if name not in not_null:
            return value.alias(name)
        return F.when(value.isNull(), F.raise_error(F.lit(f"null in {name}")).cast(kind)).otherwise(value).alias(name)

    return df.select(*[column(f.name, f.dataType) for f in schema])


def blank_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.when(F.length(c) > 0, F.col(c)) for c in columns})


def clean_arrays(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Array columns without blank and null elements; a null array becomes empty."""
    empty = F.array().cast("array<string>")
    return df.withColumns({c: F.filter(F.coalesce(F.col(c), empty), lambda x: F.length(x) > 0) for c in columns})


def id_prefix(value: Column) -> Column:
    """Leading ASCII letters of an id; empty if it begins otherwise."""
    return F.regexp_extract(value, "^([a-zA-Z]+)(.*)", 1)


def clamped_pow10(mantissa: Column, exponent: Column) -> Column:
    """mantissa · 10^exponent kept within the positive doubles; a null part gives null."""
    value = mantissa * F.pow(F.lit(10.0), exponent)
    return (
        F.when(value == float("inf"), F.lit(LARGEST))
        .when(value == float("-inf"), F.lit(-LARGEST))
        .when(value == 0.0, F.lit(SMALLEST))
        .otherwise(value)
    )


def neg_log10(p: Column) -> Column:
    """-log10, with the smallest positive double in place of zero."""
    return -F.log10(F.when(p == 0.0, F.lit(SMALLEST)).otherwise(p))


def inverse_distance(d: Column) -> Column:
    return F.when(d > 0, F.lit(1.0) / d).otherwise(F.lit(1.0))


def accession_tail(path: Column) -> Column:
    """Last segment of a path; slashes at its end don't count."""
    return F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)


def stringify_arrays(df: DataFrame, quote_strings: bool = False) -> DataFrame:
    """Array columns as ``[a,b]`` (strings as ``['a','b']`` if asked) for text formats; null stays null."""

    def text(field) -> Column:
        strings = isinstance(field.dataType.elementType, StringType)
        values = F.transform(field.name, lambda x: x.cast("string"))
        if strings and quote_strings:
            values = F.transform(values, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
        return F.concat(F.lit("["), F.array_join(values, ","), F.lit("]"))

    return df.withColumns({f.name: text(f) for f in df.schema if isinstance(f.dataType, ArrayType)})
