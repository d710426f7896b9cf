"""Bounds and row counts of stored series from Parquet footers.

Parquet writes the smallest and largest value and the row count of every row group into a
file's footer. Spark's version-2 Parquet source answers ``min``, ``max`` and ``count`` from
there (aggregate push-down): no row of the table is read, and a scan costs one footer a file.
Grouping works by partition columns, which is how the family tables keep their series.

Footers are read by the columns' positions, so every file must hold the columns in the order
of the table's schema, as all files of one Spark table do. A file without statistics, or with
a row group that holds no date at all, makes Spark raise (the loads store no row without one).
Text and decimals have no exact bounds in footers and are refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keys import require_columns
from tidemark.plans.tables import ident, partition_columns

# Types whose bounds a footer states exactly; timestamps are stored as microseconds.
_STAMPS = (T.TimestampType, T.TimestampNTZType)
_EXACT = (T.DateType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, *_STAMPS)


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own: how Parquet is read is a session setting."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session


def _from_stored(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return origin + F.make_dt_interval(secs=(value / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)"))
    return value


def footer_bounds(spark: SparkSession, path: str, date_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, earliest, latest, n_rows, n_dated`` of the Parquet files under ``path``, in the
    type of ``date_col``; ``keys`` are partition columns. ``n_dated`` counts rows with a date."""
    keys = list(keys)
    session = _footer_session(spark)
    found = spark.read.parquet(path)
    require_columns(found, [date_col, *keys], "footer_bounds")
    kind = found.schema[date_col].dataType
    if not isinstance(kind, _EXACT):
        raise ValueError(f"footer_bounds: {date_col} is {kind.simpleString()}, whose bounds footers do not state")
    # The whole schema in its own order: a shorter one would shift the footers' columns.
    stored = T.StructType(
        [T.StructField(f.name, T.LongType() if f.name == date_col and isinstance(kind, _STAMPS) else f.dataType) for f in found.schema]
    )
    bounds = (
        session.read.schema(stored)
        .parquet(path)
        .groupBy(*keys)
        .agg(
            F.min(date_col).alias("__lo"),
            F.max(date_col).alias("__hi"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(date_col).alias("n_dated"),
        )
    )
    return bounds.select(
        *keys,
        _from_stored(F.col("__lo"), kind).alias("earliest"),
        _from_stored(F.col("__hi"), kind).alias("latest"),
        "n_rows",
        "n_dated",
    )


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {ident(table)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def table_bounds(spark: SparkSession, table: str, date_col: str) -> DataFrame:
    """``footer_bounds`` of a managed Parquet table, one row per partition value."""
    return footer_bounds(spark, table_location(spark, table), date_col, partition_columns(spark, table))
