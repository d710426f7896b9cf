"""Incremental load of landed payloads into long per-family tables.

One table per payload family holds every series, partitioned by ``series_id``; one view
per series carries the reference's table name. A load reads the landed files once:

    landed files -> classify (checkpointed) -> parse/shape -> after high-water mark
                                            -> dedupe -> append

Bad payloads, and files with rejected records (no valid date, no object, another number of
fields than the header), go to a quarantine table, once per version of a file (path and
modification time), and do not stop the others; the rejected records go to a table of their
own, with their place and text. Replaying the same files appends nothing: rows without a date are rejected, rows at
or before a series' mark are dropped, and whole-row copies within a batch are collapsed.
Marks and stored days are kept in the table's ledger (``tidemark.plans.ledger``).
Re-fetched days fill gaps below the mark with ``mode="backfill"``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import NUMERIC_TEXT
from tidemark.operators.incremental import after_high_water_mark, apply_backfill
from tidemark.operators.keys import null_safe_join
from tidemark.operators.rows import dedupe_rows, row_copies
from tidemark.plans.ledger import Ledger
from tidemark.plans.tables import (
    STAGED_SUFFIX,
    _quote,
    _table_format,
    append_table,
    create_table,
    ident,
    partition_columns,
    recover,
    replace_table,
    stage_table,
    table_exists,
)
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.landing import (
    REJECT_COLS,
    classify_payloads,
    parse_bars,
    parse_indicator,
    parse_keyed_series,
    parse_table_dump,
    read_landed,
    shape_bars,
    split_quarantine,
)

QUARANTINE_TABLE = "payload_quarantine"
REJECT_TABLE = "payload_rejects"


@dataclass(frozen=True)
class Family:
    """How one payload family is parsed and where it is stored."""

    name: str
    table: str
    date_col: str
    parse: Callable[[DataFrame], DataFrame]
    expect: str | None = None
    comment: str | None = None


# A family's parse keeps the file columns, and rejected records as rows without a date.
FILE_COLS = ["series_id", "fetch_name", "file_path", "modified_at"]


def _bars(classified: DataFrame) -> DataFrame:
    return shape_bars(parse_bars(classified, rejects=True), keep=[*FILE_COLS, *REJECT_COLS])


def _keyed(classified: DataFrame) -> DataFrame:
    rows = parse_keyed_series(classified, rejects=True)
    return rows.withColumn("date", F.col("date").try_cast("timestamp_ntz"))


def _indicator(classified: DataFrame) -> DataFrame:
    return parse_indicator(classified, rejects=True)


def _dump(classified: DataFrame) -> DataFrame:
    return parse_table_dump(classified, rejects=True)


FAMILIES = {
    f.name: f
    for f in (
        Family("bars", "crypto_bars", "date_period_start", _bars, "array", "Daily bars, one partition per series"),
        Family("daily_ohlcv", "daily_bars", "date", _keyed, "object", "Daily prices as landed, one partition per series"),
        Family("indicator", "indicators", "date", _indicator, None, "Indicator values, one partition per series"),
        Family("table_dump", "table_dumps", "date", _dump, "csv", "Table dumps as landed, one partition per series"),
    )
}


def sort_for_write(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Shape the rows for a partitioned write.

    ``rebalance`` on the partition keys lets AQE size the write tasks: small ones are
    merged (few files per series folder) and a skewed series is split over several tasks
    instead of one. Rows are then ordered by series and date inside each task; there is no
    global sort.
    """
    return df.hint("rebalance", *keys).sortWithinPartitions(*keys, date_col)


def load_increment(
    increment: DataFrame,
    table: str,
    date_col: str,
    keys: Sequence[str] = ("series_id",),
    partition_by: Sequence[str] = ("series_id",),
    comment: str | None = None,
    dedupe: bool = True,
    partition_values: DataFrame | None = None,
    mode: str = "increment",
    load_id: str | None = None,
) -> dict:
    """Append the rows of ``increment`` newer than each series' mark; create on first load.

    With ``mode="backfill"`` the rows of days the table does not hold yet are appended
    instead, also below the mark (S9). Rows without a date are rejected. What an
    interrupted rewrite of the table left behind is recovered first.

    Marks and stored days come from the table's ledger, so the table itself is not read. The
    new rows are staged in the shared folder first and appended from there; a load that was
    interrupted is finished by the next one, and a load repeated under the ``load_id`` of a
    closed one writes nothing and returns the same metrics (see ``ledger``).
    ``partition_values`` is an optional cheap frame holding the series of every increment row
    (for landed files: the series id from the file path); a backfill lists the stored days of
    these only.

    Returns ``{"action", "rows", "min_date", "max_date"}``, collected by an ``Observation``
    while the rows are staged (no pass of its own, A12).
    """
    if mode not in ("increment", "backfill"):
        raise ValueError("mode must be 'increment' or 'backfill'")
    spark = increment.sparkSession
    keys = list(keys)
    ledger = Ledger(spark, table, date_col, keys)
    swapped = table_exists(spark, table + STAGED_SUFFIX)
    recover(spark, table)
    ledger.ensure(recounted=swapped)
    done = ledger.closed_load(load_id)
    if done is not None:
        return done
    exists = table_exists(spark, table)
    new = increment.where(F.col(date_col).isNotNull())
    if exists:
        new = new_rows(new, ledger, mode, partition_values)
    if dedupe:
        new = dedupe_rows(new)
    obs = Observation(f"load_{table}")
    new = new.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.min(date_col).alias("min_date"),
        F.max(date_col).alias("max_date"),
    )
    staged, path = ledger.stage(new)
    metrics = {"action": "appended" if exists else "created", **obs.get}

    def append(rows: DataFrame) -> None:
        rows = sort_for_write(rows, keys, date_col)
        if exists:
            append_table(rows, table)
        else:
            create_table(rows, table, partition_by=partition_by, comment=comment)

    if not exists and not metrics["rows"]:
        append(staged)  # an empty table is a table
        ledger.ensure()
    ledger.write(staged, path, metrics, append, load_id)
    return metrics


def new_rows(
    increment: DataFrame, ledger: Ledger, mode: str = "increment", partition_values: DataFrame | None = None
) -> DataFrame:
    """The rows of ``increment`` that the table does not hold yet, by its ledger alone: the
    table itself is not read. ``"increment"`` keeps rows after their series' mark,
    ``"backfill"`` rows of days that are not stored."""
    if mode == "backfill":
        series = partition_values if partition_values is not None else increment
        return apply_backfill(ledger.days(series), increment, ledger.date_col, ledger.keys)
    marks = ledger.marks().select(*ledger.keys, F.col("last_at").alias(ledger.date_col))
    return after_high_water_mark(increment, marks, ledger.date_col, ledger.keys)


def _append_unknown(rows: DataFrame, table: str, comment: str) -> None:
    """Append rows about files, but for versions of files that the table knows already."""
    spark = rows.sparkSession
    if not table_exists(spark, table):
        create_table(rows, table, comment=comment)
        return
    if "modified_at" not in spark.table(table).columns:  # a table written before it was kept
        spark.sql(f"ALTER TABLE {ident(table)} ADD COLUMNS (modified_at TIMESTAMP)")
    known = spark.table(table).select("family", "file_path", "modified_at").distinct()
    known = known.toDF("__family", "__path", "__modified")
    same = (
        (F.col("family") == F.col("__family"))
        & (F.col("file_path") == F.col("__path"))
        & (F.col("__modified").isNull() | (F.col("__modified") == F.col("modified_at")))
    )
    append_table(rows.join(known, same, "left_anti"), table)


def quarantine(bad: DataFrame, family: str) -> None:
    """Append quarantined payload files with their class and message, each version of a file
    once."""
    about = ["series_id", "fetch_name", "file_path", "payload_class", "message", "modified_at"]
    _append_unknown(
        bad.select(F.lit(family).alias("family"), *about),
        QUARANTINE_TABLE,
        "Landed files that are bad or hold rejected records",
    )


def store_rejects(rows: DataFrame, family: str, date_col: str) -> None:
    """Append the rejected ones of parsed ``rows`` with their file, place and text, those of
    each version of a file once."""
    rejects = rows.where(F.col(date_col).isNull() & F.col("record_no").isNotNull())
    about = ["series_id", "fetch_name", "file_path", *REJECT_COLS, "modified_at"]
    _append_unknown(
        rejects.select(F.lit(family).alias("family"), *about), REJECT_TABLE, "Records of landed files that were rejected"
    )


def load_batch(landed: DataFrame, family: str, mode: str = "increment", load_id: str | None = None) -> dict:
    """Load one batch of landed files (rows of ``read_landed``) into the family's table; with
    the ``load_id`` of a load that was completed, nothing is read or written again.

    The files are read and classified once, into the checkpoint folder; the quarantine, the
    pruning of the stored table and the rows all read that.
    """
    fam = FAMILIES[family]
    spark = landed.sparkSession
    if table_exists(spark, fam.table):
        done = Ledger(spark, fam.table, fam.date_col).closed_load(load_id)
        if done is not None:
            return done
    ensure_checkpoint_dir(spark)
    if "modified_at" not in landed.columns:
        landed = landed.withColumn("modified_at", F.lit(None).cast("timestamp"))
    classified = classify_payloads(landed, expect=fam.expect).checkpoint()
    _, bad = split_quarantine(classified)
    rows = fam.parse(classified)
    rejected = (
        rows.groupBy(*FILE_COLS)
        .agg(F.count_if(F.col(fam.date_col).isNull()).alias("bad"), F.count(F.lit(1)).alias("all"))
        .where("bad > 0")
        .select(
            *FILE_COLS,
            F.lit("rejected").alias("payload_class"),
            F.format_string("%d of %d records rejected", "bad", "all").alias("message"),
        )
        .checkpoint()
    )
    if not rejected.isEmpty():  # only files with rejects are parsed once more
        faulty = null_safe_join(classified, rejected.select("file_path"), ["file_path"], "left_semi")
        store_rejects(fam.parse(faulty), family, fam.date_col)
    quarantine(bad.select(rejected.columns).unionByName(rejected), family)
    return load_increment(
        rows.drop("fetch_name", "file_path", "modified_at", *REJECT_COLS),
        fam.table,
        fam.date_col,
        partition_values=classified.select("series_id"),
        comment=fam.comment,
        mode=mode,
        load_id=load_id,
    )


def load_landed(spark: SparkSession, path: str, family: str, mode: str = "increment") -> dict:
    """Load every landed file of ``family`` under ``path`` into the family's table."""
    return load_batch(read_landed(spark, path), family, mode)


def dedupe_table(spark: SparkSession, table: str) -> int:
    """Remove whole-row copies from a stored table; returns how many were removed.

    One aggregate job finds the surplus copies per partition value, in the series written since
    the table was last found clean (its ledger knows them; copies are whole rows, so they lie in
    one series). Nothing is written when
    there are none (as in the reference). A table partitioned by one column has only its
    dirty partitions rewritten: their deduplicated rows are staged in a table first, then
    swapped in by a dynamic partition overwrite; the clean partitions are not touched. Any
    other table is replaced whole through ``replace_table``. What an earlier, interrupted
    rewrite left behind is recovered first, keeping every row.
    """
    swapped = table_exists(spark, table + STAGED_SUFFIX)
    recover(spark, table)
    ledger = Ledger.of(spark, table)
    if ledger is not None:
        ledger.ensure(recounted=swapped)
    parts = partition_columns(spark, table)
    part = parts[0] if len(parts) == 1 else None
    df = suspects(spark, table)
    if df is None:
        return 0
    copies = row_copies(df).where(F.col("__copies") > 1)
    ensure_checkpoint_dir(spark)
    by = [F.col(part).alias("__part")] if part else []
    dirty = copies.groupBy(*by).agg(F.sum(F.col("__copies") - 1).alias("surplus")).checkpoint()
    surplus = int(dirty.agg(F.sum("surplus")).first()[0] or 0)
    if surplus:
        rewritten, opened = None, 0
        if ledger is not None:
            by_part = part is not None and ledger.keys == [part]
            rewritten = dirty.select(F.col("__part").alias(part)) if by_part else ledger.marks().select(*ledger.keys)
            rewritten = rewritten.checkpoint()
            opened = ledger.begin_rewrite(rewritten)
        if part is None:
            replace_table(spark, table, dedupe_rows)
        else:
            touched = df.join(dirty.select("__part"), F.col(part).eqNullSafe(F.col("__part")), "left_semi")
            staged = stage_table(dedupe_rows(touched), table, "partitions", (), _table_format(spark, table))
            _swap_partitions(spark, table, staged)
        if ledger is not None:
            ledger.end_rewrite(opened, rewritten)
    if ledger is not None:
        ledger.mark_clean()
    return surplus


def suspects(spark: SparkSession, table: str) -> DataFrame | None:
    """The stored rows that may have copies: with a ledger, those of the series written since
    the table was last found clean (null if there are none), else all."""
    ledger = Ledger.of(spark, table)
    written = ledger.written_since_clean() if ledger is not None else None
    if written is None:
        return spark.table(table)
    return None if written.isEmpty() else ledger.stored(written)


def _swap_partitions(spark: SparkSession, table: str, staged: str) -> None:
    """Overwrite the staged rows' partitions, in a session of its own: the overwrite mode is
    a session setting."""
    cols = ", ".join(ident(c) for c in spark.table(table).columns)
    session = spark.newSession()
    session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    session.sql(f"INSERT OVERWRITE TABLE {ident(table)} SELECT {cols} FROM {ident(staged)}")
    session.sql(f"DROP TABLE {ident(staged)}")
    spark.catalog.refreshTable(table)


# A field of the long dump table, typed as ``to_numeric`` does (regex guard, then cast).
def _typed_sql(expr: str) -> str:
    """SQL text of ``to_numeric`` over ``expr`` (regex guard, then cast)."""
    pattern = NUMERIC_TEXT.replace("\\", "\\\\")
    return f"CASE WHEN {expr} RLIKE '{pattern}' THEN try_cast({expr} AS DOUBLE) END"


# Text label columns of the daily-bar family, typed in the per-series views.
_TEXT_LABEL_TABLES = {"daily_bars"}


def create_series_views(
    spark: SparkSession,
    table: str,
    series_ids: Sequence[str] | None = None,
    comments: dict[str, str] | None = None,
) -> list[str]:
    """One view per series named by its ``series_id`` (characters that a table name may not
    have become ``_``), reading its partition (D1).

    The ids come from the catalogue (a fixed, small list) unless given. The view's filter on
    the partition column prunes the scan to that series' folder. For the long table-dump
    table the view turns ``vals`` back into one column per field; the field names per series
    are read as metadata (one distinct over the fields of these series, a handful of rows
    each). ``comments`` are the views' comments by series id.
    """
    if series_ids is None:
        from tidemark.sources.catalog import _catalog_rows

        family = {f.table: f.name for f in FAMILIES.values()}.get(table)
        series_ids = [r[0] for r in _catalog_rows() if r[1] == family]
    cols = [c for c in spark.table(table).columns if c != "series_id"]
    fields: dict[str, list[str]] = {}
    if "vals" in cols:
        pairs = (
            spark.table(table)
            .where(F.col("series_id").isin(list(series_ids)))
            .select("series_id", F.explode("vals.field").alias("field"))
            .distinct()
            .collect()
        )
        for r in pairs:
            fields.setdefault(r.series_id, []).append(r.field)
    types = dict(spark.table(table).dtypes)
    names = {sid: re.sub(r"[^A-Za-z0-9_]", "_", sid) for sid in series_ids}
    if len({n.lower() for n in names.values()}) < len(names):
        raise ValueError(f"series ids that make the same view name among {sorted(names)}")
    for sid in series_ids:
        if "vals" in cols:
            exprs = [f"`{c}`" for c in cols if c != "vals"] + [
                f"{_typed_sql(f'map_from_entries(vals)[{_quote(f)}]')} AS `{f}`"
                for f in sorted(fields.get(sid, []))
            ]
        elif table in _TEXT_LABEL_TABLES:
            # The raw table keeps the provider's text; the view types the labels.
            exprs = [
                f"{_typed_sql(f'`{c}`')} AS `{c}`" if types[c] == "string" else f"`{c}`" for c in cols
            ]
        else:
            exprs = [f"`{c}`" for c in cols]
        comment = f" COMMENT {_quote(comments[sid])}" if comments and comments.get(sid) else ""
        spark.sql(
            f"CREATE OR REPLACE VIEW {ident(names[sid])}{comment} AS SELECT {', '.join(exprs)} "
            f"FROM {ident(table)} WHERE series_id = {_quote(sid)}"
        )
    return list(series_ids)
