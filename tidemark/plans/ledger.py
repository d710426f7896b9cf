"""What a family table holds, kept beside it: days, row counts, marks, loads.

A load needs the last date of every series it touches, a backfill the days that are stored,
a report the gaps, a dedupe the partitions written since the last one. All of it could be
scanned from the table; the ledger keeps it instead, in a small table ``<table>__ledger`` that
grows by a few rows a load, whatever the table's size:

* ``open``: a series that a load is about to write, with the folder of the staged rows;
* ``days``: a stretch of days a load wrote (first and last day, rows, largest date value);
* ``reset``: the same, counted anew from the table; earlier rows of the series don't count;
* ``close``: the load is complete (with its metrics, and its id where it has one);
* ``clean``: the table had no whole-row copies at this point.

Rows of a load count only once it is closed. A load that was opened and never closed was
interrupted: ``recover`` appends what its staged rows hold and the table does not, counts the
series it touched anew (reading their partitions only), and closes it. So each load is written
exactly once, and a load repeated under the id of a closed one is recognised.

Stretches of days that touch are merged when read; gaps are the spaces between them. After
``COMPACT_AFTER`` loads the ledger is rewritten as one ``reset`` row per stretch.

Rows that other code writes to or removes from the table are not noticed: ``rebuild`` counts
the whole table anew. One writer a table at a time, as for the table itself.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.dates import as_date
from tidemark.operators.keys import null_safe_join, pack_series, series_cols, unpack_series
from tidemark.plans.tables import append_table, create_table, ident, replace_table, table_exists
from tidemark.session import ensure_checkpoint_dir

LEDGER_SUFFIX = "__ledger"
COMPACT_AFTER = 64


def _as_json(metrics: dict) -> str:
    """Metrics as text; dates keep their type's name so that they come back as they were."""
    return json.dumps({k: [type(v).__name__, v.isoformat()] if isinstance(v, dt.date) else v for k, v in metrics.items()})


def _from_json(text: str) -> dict:
    kinds = {"date": dt.date, "datetime": dt.datetime}
    return {k: kinds[v[0]].fromisoformat(v[1]) if isinstance(v, list) else v for k, v in json.loads(text).items()}


class Ledger:
    """The ledger of ``table``, whose series are the columns ``keys``."""

    def __init__(self, spark: SparkSession, table: str, date_col: str, keys: Sequence[str] = ("series_id",)):
        self.spark, self.table, self.date_col, self.keys = spark, table, date_col, list(keys)
        self.name = table + LEDGER_SUFFIX

    @classmethod
    def of(cls, spark: SparkSession, table: str) -> Ledger | None:
        """The ledger that is kept for ``table``, if there is one."""
        name = table + LEDGER_SUFFIX
        row = spark.table(name).select("date_col").first() if table_exists(spark, name) else None
        if row is None:
            return None
        columns = spark.table(name).columns
        return cls(spark, table, row[0], columns[: columns.index("seq")])

    # --- reading ------------------------------------------------------------------------------

    @property
    def exists(self) -> bool:
        return table_exists(self.spark, self.name)

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _counted(self) -> DataFrame:
        """The ``days`` and ``reset`` rows that count, with the series packed."""
        log = self.rows()
        closed = log.where("kind = 'close'").select("seq").distinct()
        held = log.where("kind in ('days', 'reset')").join(closed, "seq", "left_semi")
        held = held.select(*pack_series(self.keys), "seq", "kind", "from_date", "to_date", "n_rows", "last_at")
        every = Window.partitionBy(*series_cols(self.keys))
        since = F.max(F.when(F.col("kind") == "reset", F.col("seq"))).over(every)
        held = held.withColumn("__since", F.coalesce(since, F.lit(0)))
        return held.where(F.col("seq") >= F.col("__since")).where("from_date is not null")

    def marks(self) -> DataFrame:
        """``keys, min_date, max_date, n_rows, last_at`` of every stored series (A1, A2, A4);
        ``last_at`` is the largest date value in the column's own type."""
        marks = self._counted().groupBy(*series_cols(self.keys)).agg(
            F.min("from_date").alias("min_date"),
            F.max("to_date").alias("max_date"),
            F.sum("n_rows").alias("n_rows"),
            F.max("last_at").alias("last_at"),
        )
        return unpack_series(marks, self.keys)

    def stretches(self) -> DataFrame:
        """``keys, from_date, to_date, n_rows, last_at``: the stored days as stretches without
        a gap. A window partition holds the stretches of one series."""
        ks = series_cols(self.keys)
        order = Window.partitionBy(*ks).orderBy("from_date", "to_date")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        reached = F.max("to_date").over(before)
        begins = (reached.isNull() | (F.datediff("from_date", reached) > 1)).cast("int")
        rows = self._counted().withColumn("__begins", begins)
        rows = rows.withColumn("__island", F.sum("__begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        merged = rows.groupBy(*ks, "__island").agg(
            F.min("from_date").alias("from_date"),
            F.max("to_date").alias("to_date"),
            F.sum("n_rows").alias("n_rows"),
            F.max("last_at").alias("last_at"),
        )
        return unpack_series(merged.drop("__island"), self.keys)

    def gaps(self) -> DataFrame:
        """``keys, gap_start, gap_end, n_days``: the spaces between stored stretches."""
        ks = series_cols(self.keys)
        ahead = Window.partitionBy(*ks).orderBy("from_date")
        held = self.stretches().select(*pack_series(self.keys), "from_date", "to_date")
        linked = held.withColumn("__next", F.lead("from_date").over(ahead)).where("__next is not null")
        gaps = linked.select(
            *ks,
            F.date_add("to_date", 1).alias("gap_start"),
            F.date_sub("__next", 1).alias("gap_end"),
            (F.datediff("__next", "to_date") - 1).alias("n_days"),
        )
        return unpack_series(gaps, self.keys)

    def days(self, series: DataFrame | None = None) -> DataFrame:
        """``keys, <date column>`` of every stored day, of the given series only."""
        held = self.stretches()
        if series is not None:
            held = null_safe_join(held, series.select(*self.keys).distinct(), self.keys, "left_semi") if self.keys else held
        return held.select(*self.keys, F.explode_outer(F.sequence("from_date", "to_date")).alias(self.date_col))

    def closed_load(self, load_id: str | None) -> dict | None:
        """The metrics of the closed load with this id."""
        if load_id is None or not self.exists:
            return None
        row = self.rows().where((F.col("kind") == "close") & (F.col("load_id") == load_id)).select("metrics").first()
        return _from_json(row[0]) if row else None

    def written_since_clean(self) -> DataFrame | None:
        """The series written since the table was last found clean; null if it never was."""
        log = self.rows()
        clean = log.where("kind = 'clean'").agg(F.max("seq")).first()[0]
        if clean is None:
            return None
        return self.written_since(clean)

    def written_since(self, seq: int) -> DataFrame:
        """The series written after the given point of the ledger."""
        touched = self.rows().where((F.col("seq") > seq) & F.col("kind").isin("open", "days", "reset"))
        return touched.select(*self.keys).distinct()

    def last_seq(self) -> int:
        return (self.rows().agg(F.max("seq")).first()[0] or 0) if self.exists else 0

    # --- writing ------------------------------------------------------------------------------

    def _entries(self, frame: DataFrame, kind: str, seq: int, **values: Column | str | None) -> DataFrame:
        own = self.spark.table(self.table).schema if table_exists(self.spark, self.table) else frame.schema
        types = {k: (frame if k in frame.columns else self.spark.table(self.table)).schema[k].dataType for k in self.keys}
        columns = {
            "seq": "bigint", "load_id": "string", "kind": "string", "from_date": "date", "to_date": "date",
            "n_rows": "bigint", "last_at": own[self.date_col].dataType.simpleString(), "staged": "string", "metrics": "string",
            "date_col": "string",
        }
        given: dict[str, Column | str | int | None] = {"seq": seq, "kind": kind, "date_col": self.date_col, **values}
        lit = lambda v: v if isinstance(v, Column) else F.lit(v)
        return frame.select(
            *[(F.col(k) if k in frame.columns else F.lit(None)).cast(types[k]).alias(k) for k in self.keys],
            *[lit(given.get(c)).cast(t).alias(c) for c, t in columns.items()],
        )

    def _write(self, entries: DataFrame) -> None:
        entries = entries.hint("rebalance")  # few files: small tasks are merged
        if self.exists:
            append_table(entries, self.name)
        else:
            create_table(entries, self.name, comment=f"What {self.table} holds; kept by its loads")

    def _next_seq(self) -> int:
        return self.last_seq() + 1

    def _one(self) -> DataFrame:
        return self.spark.range(1).select(F.lit(None).cast("date").alias("__none"))

    def _close(self, seq: int, load_id: str | None = None, metrics: dict | None = None) -> None:
        self._write(self._entries(self._one(), "close", seq, load_id=load_id, metrics=_as_json(metrics or {})))

    def _stretches_of(self, rows: DataFrame) -> DataFrame:
        """The stretches of days in ``rows``, reduced to days first (no hot key)."""
        ks = series_cols(self.keys)
        day = as_date(rows, self.date_col)
        daily = (
            rows.where(day.isNotNull())
            .groupBy(*pack_series(self.keys), day.alias("__day"))
            .agg(F.count(F.lit(1)).alias("__n"), F.max(self.date_col).alias("__at"))
        )
        order = Window.partitionBy(*ks).orderBy("__day")
        island = F.date_sub("__day", F.row_number().over(order)).alias("__island")
        merged = daily.select("*", island).groupBy(*ks, "__island").agg(
            F.min("__day").alias("__from"), F.max("__day").alias("__to"), F.sum("__n").alias("__rows"), F.max("__at").alias("__last")
        )
        return unpack_series(merged.drop("__island"), self.keys)

    def _days_entries(self, rows: DataFrame, kind: str, seq: int) -> DataFrame:
        return self._entries(
            self._stretches_of(rows), kind, seq,
            from_date=F.col("__from"), to_date=F.col("__to"), n_rows=F.col("__rows"), last_at=F.col("__last"),
        )

    def stored(self, series: DataFrame | None) -> DataFrame:
        """The table's rows, of the given series only: a string partition column is joined by
        plain equality, so that the scan reads no other partition (dynamic pruning)."""
        self.spark.catalog.refreshTable(self.table)
        stored = self.spark.table(self.table)
        if series is None or not self.keys:
            return stored
        if len(self.keys) > 1 or dict(stored.dtypes)[self.keys[0]] != "string":
            return null_safe_join(stored, series, self.keys, "left_semi")
        key = self.keys[0]
        # True for every value there is; the planner prunes only by a filtered side.
        named = series.where(F.col(key) >= "").select(F.col(key).alias("__part")).distinct()
        unnamed = series.agg(F.coalesce(F.bool_or(F.col(key).isNull()), F.lit(False))).scalar()
        held = stored.join(named, F.col(key) == F.col("__part"), "left_semi")
        return held.unionByName(stored.where(F.col(key).isNull() & unnamed))

    def _reset(self, series: DataFrame) -> None:
        """Count the given series anew from the table, also if nothing of one is stored."""
        seq = self._next_seq()
        entries = self._days_entries(self.stored(series), "reset", seq)
        self._write(entries.unionByName(self._entries(series.distinct(), "reset", seq)))
        self._close(seq)

    def rebuild(self) -> None:
        """Count the whole table anew (one scan of the date and key columns)."""
        seq = self._next_seq()
        entries = self._days_entries(self.stored(None), "reset", seq)
        if self.exists:  # also the series of which nothing is stored any more
            known = self.rows().where("kind in ('days', 'reset')").select(*self.keys).distinct()
            entries = entries.unionByName(self._entries(known, "reset", seq))
        self._write(entries)
        self._close(seq)

    def ensure(self, recounted: bool = False) -> None:
        """Bring the ledger up to date before a load: none is kept of a table that is gone, an
        existing table without one (or, with ``recounted``, changed by other code) is counted,
        and interrupted loads are finished."""
        self.recover()
        if table_exists(self.spark, self.table) and (recounted or not self.exists):
            self.rebuild()

    # --- loads --------------------------------------------------------------------------------

    def stage(self, new: DataFrame) -> tuple[DataFrame, str]:
        """``new`` written to the shared folder: what the load appends, and can append again."""
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/tidemark-load-{uuid.uuid4().hex}"
        new.write.parquet(path)
        return self.spark.read.schema(new.schema).parquet(path), path

    def write(self, staged: DataFrame, path: str, metrics: dict, append, load_id: str | None = None) -> None:
        """Open the load, append the staged rows by ``append(frame)``, and close it."""
        seq = self._next_seq()
        if not metrics["rows"]:
            if load_id is not None:
                self._close(seq, load_id, metrics)
            return
        touched = staged.groupBy(*self.keys).agg(F.max(self.date_col).alias(self.date_col))
        self._write(self._entries(touched, "open", seq, load_id=load_id, staged=path, metrics=_as_json(metrics)))
        append(staged)
        self._write(self._days_entries(staged, "days", seq))
        self._close(seq, load_id, metrics)
        self.discard(path)
        if self.rows().where("kind = 'close'").count() % COMPACT_AFTER == 0:
            self.compact()

    def begin_rewrite(self, series: DataFrame) -> int:
        """Open a rewrite of the given series in place; ``end_rewrite`` counts them anew."""
        seq = self._next_seq()
        self._write(self._entries(series, "open", seq))
        return seq

    def end_rewrite(self, seq: int, series: DataFrame) -> None:
        self._reset(series)
        self._close(seq)

    def mark_clean(self) -> None:
        self._write(self._entries(self._one(), "clean", self._next_seq()))

    def discard(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def interrupted(self) -> list:
        """(seq, load id, staged folder, metrics) of the loads opened and never closed."""
        log = self.rows()
        closed = log.where("kind = 'close'").select("seq").distinct()
        open_ = log.where("kind = 'open'").join(closed, "seq", "left_anti")
        return open_.select("seq", "load_id", "staged", "metrics").distinct().orderBy("seq").collect()

    def recover(self) -> None:
        """Finish the loads that were interrupted. A load that was to create the table and did
        not get to is simply repeated by its caller."""
        if not self.exists:
            return
        if not table_exists(self.spark, self.table):
            for load in self.interrupted():
                if load.staged:
                    self.discard(load.staged)
            self.spark.sql(f"DROP TABLE {ident(self.name)}")
            return
        for load in self.interrupted():
            here = (F.col("seq") == load.seq) & (F.col("kind") == "open")
            touched = self.rows().where(here).select(*self.keys).distinct()
            staged = self._staged(load.staged)
            if staged is not None:
                held = self.stored(touched).select(*staged.columns)
                append_table(staged.exceptAll(held), self.table)
            self._reset(touched)
            self._close(load.seq, load.load_id, _from_json(load.metrics) if load.metrics else None)
            if load.staged:
                self.discard(load.staged)

    def _staged(self, path: str | None) -> DataFrame | None:
        try:
            return self.spark.read.parquet(path) if path else None
        except AnalysisException:
            return None

    def compact(self) -> None:
        """Rewrite the ledger: one ``reset`` row per stretch; closed loads stay known, and so
        do the series written since the table was last clean."""
        seq = self._next_seq()
        held = self.stretches().select(
            *self.keys, F.col("from_date").alias("__from"), F.col("to_date").alias("__to"),
            F.col("n_rows").alias("__rows"), F.col("last_at").alias("__last"),
        )
        entries = self._entries(
            held, "reset", seq, from_date=F.col("__from"), to_date=F.col("__to"), n_rows=F.col("__rows"), last_at=F.col("__last")
        ).unionByName(self._entries(self._one(), "close", seq))
        written = self.written_since_clean()
        if written is not None:
            for frame, kind, at in ((self._one(), "clean", seq), (written, "open", seq + 1), (self._one(), "close", seq + 1)):
                entries = entries.unionByName(self._entries(frame, kind, at))

        def rewritten(log: DataFrame) -> DataFrame:
            kept = log.where("kind = 'close' and load_id is not null")
            return kept.unionByName(entries.select(*log.columns))

        replace_table(self.spark, self.name, rewritten)
