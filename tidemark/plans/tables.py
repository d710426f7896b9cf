"""Catalog tables: exists, create, append, create-or-append, staged replace, comments,
listing (SURVEY K1-K8, K11, Q5, Q19).

Writes are Spark writes of lazy plans; nothing passes through the driver. A replace is
staged (write new, then swap) so a failed write never loses the table, and the comment of
the old table is carried over. Every write first finishes what an interrupted swap left
behind (``recover``); rows that only one of the two copies holds are kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

STAGED_SUFFIX = "__staged"
# Table properties of a swap: its kind is set on the staged table once that is complete; the
# id is the same on the live table that is being replaced.
SWAP_KIND = "tidemark.swap"
SWAP_ID = "tidemark.swap_id"


def ident(name: str) -> str:
    """A table name as a quoted identifier, part by part."""
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in name.split("."))


def qualify(name: str, database: str | None = None) -> str:
    return f"{database}.{name}" if database and "." not in name else name


def table_exists(spark: SparkSession, name: str, database: str | None = None) -> bool:
    """Case-insensitive existence check in ``database`` (or the current one) (K5, K6)."""
    return spark.catalog.tableExists(qualify(name, database))


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str], fmt: str):
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def create_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    comment: str | None = None,
) -> None:
    """Create a managed table; raises if it exists (K1)."""
    recover(df.sparkSession, name)
    _writer(df, "errorifexists", partition_by, fmt).saveAsTable(name)
    if comment:
        set_table_comment(df.sparkSession, name, comment)


def append_table(df: DataFrame, name: str) -> None:
    """Append to a managed table (K2, U5). Columns are matched by name; the table's own
    partitioning is repeated, as Spark requires."""
    spark = df.sparkSession
    recover(spark, name)
    parts = partition_columns(spark, name)
    fmt = _table_format(spark, name)
    _writer(df, "append", parts, fmt).saveAsTable(name)


def _table_format(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {ident(name)}").where("col_name = 'Provider'").collect()
    return rows[0]["data_type"] if rows else "parquet"


def upsert_series_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    comment: str | None = None,
) -> str:
    """Append when the table exists, else create it (K3). Returns ``"appended"``/``"created"``."""
    spark = df.sparkSession
    recover(spark, name)
    if table_exists(spark, name):
        append_table(df, name)
        return "appended"
    create_table(df, name, partition_by, fmt, comment)
    return "created"


def get_table_comment(spark: SparkSession, name: str) -> str | None:
    return spark.catalog.getTable(name).description


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def set_table_comment(spark: SparkSession, name: str, text: str) -> None:
    """``COMMENT ON TABLE`` with quotes escaped (K7)."""
    spark.sql(f"COMMENT ON TABLE {ident(name)} IS {_quote(text)}")


def set_column_comment(spark: SparkSession, name: str, column: str, text: str) -> None:
    """Column description."""
    spark.sql(f"ALTER TABLE {ident(name)} ALTER COLUMN {ident(column)} COMMENT {_quote(text)}")


def list_tables(spark: SparkSession, database: str = "default") -> DataFrame:
    """``SHOW TABLES`` of a database as a DataFrame (K8)."""
    return spark.sql(f"SHOW TABLES IN {ident(database)}")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {ident(name)}").collect()}


def _set_properties(spark: SparkSession, name: str, **values: str) -> None:
    listed = ", ".join(f"{_quote(k)} = {_quote(v)}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {ident(name)} SET TBLPROPERTIES ({listed})")


def stage_table(df: DataFrame, name: str, kind: str, parts: Sequence[str], fmt: str) -> str:
    """Write ``df`` as the staged copy of ``name`` and mark it complete."""
    spark = df.sparkSession
    staged, swap = name + STAGED_SUFFIX, uuid.uuid4().hex
    _writer(df, "errorifexists", parts, fmt).saveAsTable(staged)
    _set_properties(spark, name, **{SWAP_ID: swap})
    _set_properties(spark, staged, **{SWAP_KIND: kind, SWAP_ID: swap})
    return staged


def recover(spark: SparkSession, name: str) -> None:
    """Finish or undo a swap of ``name`` that was interrupted, without losing a row.

    * No live table: the staged copy is all there is and takes its name.
    * The staged copy is not marked complete, or it was to replace this very live table:
      the live table still holds everything, and the copy goes.
    * Otherwise either copy may hold rows of its own (a swap of partitions stopped half
      way, or rows loaded since): rows that only the staged copy holds are appended to the
      live table before the copy goes. Whole-row copies this leaves are removed by the next
      dedupe.
    """
    staged = name + STAGED_SUFFIX
    if not table_exists(spark, staged):
        return
    if not table_exists(spark, name):
        _rename(spark, staged, name, partition_columns(spark, staged))
        return
    mark, live = _properties(spark, staged), _properties(spark, name)
    replaces_live = mark.get(SWAP_KIND) == "replace" and mark.get(SWAP_ID) == live.get(SWAP_ID)
    if SWAP_KIND in mark and not replaces_live:
        columns = spark.table(name).columns
        only_staged = spark.table(staged).select(columns).exceptAll(spark.table(name)).distinct()
        parts, fmt = partition_columns(spark, name), _table_format(spark, name)
        _writer(only_staged, "append", parts, fmt).saveAsTable(name)
        spark.catalog.refreshTable(name)
    spark.sql(f"DROP TABLE {ident(staged)}")


def replace_table(
    spark: SparkSession,
    name: str,
    transform: Callable[[DataFrame], DataFrame],
) -> None:
    """Rewrite a table from a plan over itself (K4, Q5).

    The new content is written in full to ``<name>__staged`` first; only then is the old
    table dropped and the staged one renamed. Spark refuses to overwrite a table the same
    plan reads, and drop-then-write (the reference's order) loses the table if the write
    fails. The written staged table also cuts the lineage. Partitioning, format and table
    comment are kept.
    """
    recover(spark, name)
    parts = partition_columns(spark, name)
    fmt = _table_format(spark, name)
    comment = get_table_comment(spark, name)
    staged = stage_table(transform(spark.table(name)), name, "replace", parts, fmt)
    if comment:
        set_table_comment(spark, staged, comment)
    spark.sql(f"DROP TABLE {ident(name)}")
    _rename(spark, staged, name, parts)


def _rename(spark: SparkSession, old: str, new: str, partitioned: Sequence[str]) -> None:
    """Rename a managed table; a partitioned one has its partitions re-registered at the
    moved location (the rename moves the folder but not the partition entries)."""
    spark.sql(f"ALTER TABLE {ident(old)} RENAME TO {ident(new)}")
    spark.sql(
        f"ALTER TABLE {ident(new)} UNSET TBLPROPERTIES IF EXISTS ({_quote(SWAP_KIND)}, {_quote(SWAP_ID)})"
    )
    if partitioned:
        spark.catalog.recoverPartitions(new)
    spark.catalog.refreshTable(new)
