"""Incremental loading behind a per-series high-water mark.

All functions plan over every series at once. Joins against per-series marks are keyed by
the series columns; the marks side has one row per series, so AQE measures it after its
aggregate and broadcasts it when small. When it is not small, the sort-merge join that
remains is split on skewed series by AQE's skew-join handling, so a series holding a third
of an increment does not land in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import date_text
from tidemark.operators.dates import as_date
from tidemark.operators.keys import (
    null_safe_join,
    pack_series,
    require_columns,
    series_cols,
)

# Fixed value: first date asked for on a first load (project configuration).
DEFAULT_START_DATE = dt.date(2020, 11, 1)


def _date_lit(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def after_high_water_mark(
    increment: DataFrame,
    table: DataFrame,
    date_col: str,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``increment`` strictly after their series' largest ``date_col`` in ``table``.

    A series absent from ``table`` keeps all its rows (first load). Idempotent: applying it
    twice gives the same rows (F1). Without keys the mark is a scalar subquery, not a join.
    The marks side has one row per series: AQE broadcasts it once measured small; beyond
    that the sort-merge join keys are the marks' own partitioning, and AQE splits the
    increment's partitions of a hot series over several tasks.
    """
    keys = list(keys)
    require_columns(increment, [date_col, *keys], "after_high_water_mark (increment)")
    require_columns(table, [date_col, *keys], "after_high_water_mark (table)")
    if not keys:
        mark = table.select(F.max(date_col)).scalar()
        # An empty table has no mark: everything is new (first load), as in the keyed case.
        return increment.where(mark.isNull() | (F.col(date_col) > mark))
    ks = series_cols(keys)
    marks = table.groupBy(*pack_series(keys)).agg(F.max(date_col).alias("__hwm"))
    probe = increment.select("*", *pack_series(keys))
    joined = probe.join(marks, on=ks, how="left")
    return joined.where(
        F.col("__hwm").isNull() | (F.col(date_col) > F.col("__hwm"))
    ).select(*increment.columns)


def ingest_plan(
    table: DataFrame,
    date_col: str,
    keys: Sequence[str],
    run_date: dt.date | str,
    series: DataFrame | None = None,
    start_date: dt.date | str | None = DEFAULT_START_DATE,
) -> DataFrame:
    """Fetch window per series: ``keys, last_date, next_start, end_date, due``.

    ``next_start`` is the day after the stored maximum, or ``start_date`` for a series
    listed in ``series`` but not yet stored (``start_date`` may also be a column name of
    ``series``). ``due`` is ``next_start < end_date``: nothing is asked for on the day the
    window would start (today's bar is not final), nor after it. A series never loaded and
    without a start date (the macro family, Q9) is due with ``next_start`` NULL: its first
    fetch takes the whole history.
    """
    keys = list(keys)
    last = table.groupBy(*keys).agg(F.max(as_date(table, date_col)).alias("last_date"))
    start_is_col = isinstance(start_date, str) and series is not None and start_date in series.columns
    if series is not None:
        extra = [start_date] if start_is_col else []
        last = null_safe_join(series.select(*keys, *extra).dropDuplicates(keys), last, keys, "left")
    if start_is_col:
        first = F.col(start_date).cast("date")
    elif start_date is None:
        first = F.lit(None).cast("date")
    else:
        first = _date_lit(start_date)
    end = _date_lit(run_date)
    next_start = F.coalesce(F.date_add("last_date", 1), first)
    return last.select(
        *keys,
        "last_date",
        next_start.alias("next_start"),
        end.alias("end_date"),
        # Never loaded and no start date: the whole history is asked for (due, open start).
        F.coalesce(next_start < end, F.col("last_date").isNull()).alias("due"),
    )


def gate_by_weekday(
    df: DataFrame,
    date_col: str | Column,
    group_col: str,
    schedule: DataFrame,
) -> DataFrame:
    """Add ``weekday`` (Monday = 0) and ``due``: the weekday is one of the group's days.

    ``schedule`` is ``grp, dow ARRAY<INT>``, one row per group, joined without a hint: the
    planner knows its size. A row with no group is due every day; a group absent from the
    schedule is never due.
    """
    day = F.col(date_col) if isinstance(date_col, str) else date_col
    sched = schedule.select(F.col("grp").alias("__grp"), F.col("dow").alias("__dow"))
    wd = F.weekday(day)
    joined = df.join(sched, df[group_col] == F.col("__grp"), "left")
    due = F.when(F.col(group_col).isNull(), F.lit(True)).otherwise(
        F.coalesce(F.array_contains(F.col("__dow"), wd), F.lit(False))
    )
    return joined.select(*[df[c] for c in df.columns], wd.alias("weekday"), due.alias("due")).drop(
        "__grp", "__dow"
    )


def due_sources(catalog: DataFrame, schedule: DataFrame, run_date: dt.date | str) -> DataFrame:
    """Catalogue rows to fetch on ``run_date`` (F5, J1): grouped series on their weekdays,
    ungrouped series every day."""
    gated = gate_by_weekday(catalog.withColumn("__run", _date_lit(run_date)), "__run", "grp", schedule)
    return gated.where("due").drop("__run", "weekday", "due")


def backfill_plan(missing: DataFrame, keys: Sequence[str], date_col: str = "missing_date") -> DataFrame:
    """One request per missing day, start = end = that day: ``keys, start_date, end_date``."""
    day = date_text(F.col(date_col))
    return missing.select(*keys, day.alias("start_date"), day.alias("end_date"))


# Fixed value: points a provider's short answer holds (its "compact" output size).
RANGE_DAYS = 100


def backfill_ranges(gaps: DataFrame, keys: Sequence[str] = (), max_days: int = RANGE_DAYS) -> DataFrame:
    """Requests for gaps in ranges of at most ``max_days`` days: ``keys, start_date, end_date,
    n_days`` (S9), dates as text.

    ``gaps`` has ``gap_start`` and ``gap_end`` (both included), as ``date_gaps`` or a ledger's
    gaps give them. Every missing day lies in exactly one range; the ranges of a gap are full
    but for the last. One request per range instead of one per day: a gap is cut by arithmetic,
    its days are never listed.
    """
    if max_days < 1:
        raise ValueError("max_days must be 1 or more")
    keys = list(keys)
    require_columns(gaps, ["gap_start", "gap_end", *keys], "backfill_ranges")
    last = F.floor(F.datediff("gap_end", "gap_start") / max_days).cast("int")
    cut = gaps.where(F.col("gap_start") <= F.col("gap_end")).select(
        *keys, "gap_start", "gap_end", F.explode_outer(F.sequence(F.lit(0), last)).alias("__part")
    )
    start = F.date_add("gap_start", F.col("__part") * max_days)
    end = F.least(F.date_add(start, max_days - 1), F.col("gap_end"))
    return cut.select(
        *keys,
        date_text(start).alias("start_date"),
        date_text(end).alias("end_date"),
        (F.datediff(end, start) + 1).alias("n_days"),
    )


def apply_backfill(
    table: DataFrame,
    landed: DataFrame,
    date_col: str,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``landed`` whose ``(keys, date)`` the table does not hold yet.

    Left anti join on ``(keys, date)``: both sides are keyed by the date too, so the shuffle
    has no hot key even when one series dominates.
    """
    keys = list(keys)
    ks = series_cols(keys)
    have = (
        table.select(*pack_series(keys), as_date(table, date_col).alias("__d"))
        .where(F.col("__d").isNotNull())
        .distinct()
    )
    probe = landed.select("*", *pack_series(keys), as_date(landed, date_col).alias("__d"))
    return probe.join(have, on=[*ks, "__d"], how="left_anti").select(*landed.columns)
