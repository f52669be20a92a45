"""Scans with declared schemas, and sinks."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions.columns import stringify_arrays


def scan_parquet(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """Parquet files, folders or globs; the schema comes from the files unless declared."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def scan_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines (compressed or not) with a declared schema: no inference pass."""
    return spark.read.schema(schema).json(path)


def scan_tsv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", header=header)


def scan_tsv_lookup(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A lookup table: malformed rows are dropped, white space around values is trimmed."""
    options = {"mode": "DROPMALFORMED", "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    return spark.read.schema(schema).options(**options).csv(path, sep="\t", header=True)


def scan_declared(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
    """Output of an earlier step, in whichever format it was written."""
    return spark.read.schema(schema).format(fmt).load(path)


def file_path() -> Column:
    """The file that a scanned row comes from."""
    return F.col("_metadata.file_path")


def inline_rows(spark: SparkSession, rows: dict, key: str, value: str, kind: str = "double") -> DataFrame:
    """A configuration mapping as a table; its size is that of the driver's literal."""
    return spark.createDataFrame([*rows.items()], f"{key} string, {value} {kind}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", max_records: int | None = None, mode: str = "error") -> None:
    """Write in a configured format, with a bounded number of records for each file if asked."""
    writer = df.write.mode(mode).format(fmt)
    if max_records is not None:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.save(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    write_table(df, path, "json", mode=mode)


def export_tsv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Tab-separated with a header; array columns become text."""
    arrays = any(isinstance(f.dataType, ArrayType) for f in df.schema)
    (stringify_arrays(df) if arrays else df).write.mode(mode).csv(path, sep="\t", header=True)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, ordered: bool = True) -> None:
    """Parquet files dealt into ``buckets`` by a hash of ``keys`` and sorted by them, one file a bucket; refuses a path that exists.

    ``ordered=False`` writes rows in the order in which they come: what a join on ``keys`` makes, many rows a key, needs no sort of its own.
    """
    spark, name = df.sparkSession, f"vl_{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        raise ValueError(f"{path} exists")
    # only a catalog table's writer makes buckets; the files stay when its entry goes
    writer = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).option("path", path)
    if ordered:
        writer.sortBy(*keys).saveAsTable(name)
    else:
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(buckets)):  # without it rows are sorted by their bucket
            writer.saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def scan_bucketed(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int, ordered: bool = True) -> DataFrame:
    """What write_bucketed wrote, as a catalog table: joins on ``keys`` need no exchange of it."""
    name = f"vl_{hashlib.sha256(path.encode()).hexdigest()[:32]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    own = ", ".join(f"`{k}`" for k in keys)
    order = f"SORTED BY ({own}) " if ordered else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({own}) {order}INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """In this block the session's ``key`` is ``value``."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def joined_in_buckets(spark: SparkSession):
    """In this block a join on more columns than the buckets' keeps their partitioning, instead of dealing rows anew by all columns."""
    return setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


#: Bytes of files that Spark may send to every task by their size alone.
FILES = 1 << 18


@contextmanager
def broadcast_by_rows(spark: SparkSession) -> Iterator[None]:
    """In this block tables that are sent to every task pass through the driver in bounded size.

    Spark compares the session's limit with compressed files, whose rows take 10 to 30 times the room once they are hashed, and a join chain
    holds several at a time. So files count up to FILES alone; rows that an exchange has measured count up to the session's limit.
    """
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    measured = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    with setting(spark, measured, spark.conf.get(measured, None) or str(limit)), setting(spark, "spark.sql.autoBroadcastJoinThreshold", str(min(limit, FILES))):
        yield
