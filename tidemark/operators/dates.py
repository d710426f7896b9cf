"""Calendar checks over many series at once.

Every function takes ``keys`` (the series columns, empty for a single series) and a date
column, and returns lazy DataFrames. Plans are shaped for skew: the first shuffle is always
on ``(keys, date)`` after a map-side partial aggregate, so a series holding a third of all
rows is spread over many tasks and collapsed to one row per date before anything is keyed
by the series alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keys import pack_series, require_columns, series_cols, unpack_series

# Calendar days generated per task-sized chunk before the round-robin spread.
CALENDAR_CHUNK_DAYS = 64


def as_date(df: DataFrame, date_col: str) -> Column:
    """The date column as DATE: timestamps are truncated, text that is no date is NULL."""
    require_columns(df, [date_col], "as_date")
    dtype = dict(df.dtypes)[date_col]
    c = F.col(date_col)
    if dtype == "date":
        return c
    if dtype.startswith("timestamp"):
        return F.to_date(c)
    return c.cast("string").try_cast("date")


def date_bounds(df: DataFrame, date_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Earliest and latest date per series: ``keys, earliest, latest``."""
    keys = list(keys)
    d = as_date(df, date_col)
    return df.groupBy(*keys).agg(F.min(d).alias("earliest"), F.max(d).alias("latest"))


def calendar(
    bounds: DataFrame,
    keys: Sequence[str],
    lo: str = "earliest",
    hi: str = "latest",
    weekdays_only: bool = False,
    spread: int | None = None,
) -> DataFrame:
    """Every day from ``lo`` to ``hi`` per series: ``keys, date``.

    Ranges are first cut into chunks of ``CALENDAR_CHUNK_DAYS`` and the chunks dealt round
    robin over ``spread`` tasks (a fixed number, so AQE keeps it), so neither a long range
    nor many series make one task generate the whole calendar. Rows with a NULL bound
    produce nothing.
    """
    keys = list(keys)
    n = CALENDAR_CHUNK_DAYS
    chunks = bounds.where(F.col(lo).isNotNull() & F.col(hi).isNotNull()).select(
        *keys,
        F.col(lo).alias("__lo"),
        F.col(hi).alias("__hi"),
        F.explode_outer(
            F.sequence(F.lit(0), F.floor(F.datediff(F.col(hi), F.col(lo)) / n).cast("int"))
        ).alias("__chunk"),
    )
    if spread:
        chunks = chunks.repartition(spread)
    start = F.date_add(F.col("__lo"), F.col("__chunk") * n)
    stop = F.least(F.date_add(start, n - 1), F.col("__hi"))
    # Outer: a plain explode makes the optimizer compute each sequence a second time for an
    # inferred size filter. The sequences here are never empty.
    days = chunks.select(*keys, F.explode_outer(F.sequence(start, stop)).alias("date"))
    if weekdays_only:
        days = days.where(F.weekday("date") < 5)
    return days


def missing_dates(
    df: DataFrame,
    date_col: str,
    keys: Sequence[str] = (),
    weekdays_only: bool = False,
    spread: int | None = None,
    method: str = "gaps",
) -> DataFrame:
    """Days between a series' first and last date that have no row: ``keys, missing_date``.

    Both methods start from the distinct ``(series, date)`` set (map-side partial aggregate,
    one shuffle on both columns), so a series holding a third of all rows is collapsed to one
    row per day before anything is keyed by the series alone.

    * ``"gaps"`` (default): one window per series over its distinct days looks one day
      ahead and every gap emits the days it skips. A window partition holds at most one row
      per calendar day (without keys all days are one partition, in one task); only missing
      days are generated.
    * ``"calendar"``: the calendar from each series' bounds minus the observed days by a
      left anti join on ``(series, date)``. The series is a struct of the keys, so the join
      keys are the distinct's own partitioning (a sort-merge join shuffles only the
      calendar) and the bounds reuse the distinct's exchange (one scan of the input).
    """
    keys = list(keys)
    require_columns(df, [date_col, *keys], "missing_dates")
    ks = series_cols(keys)
    seen = (
        df.select(*pack_series(keys), as_date(df, date_col).alias("date"))
        .where(F.col("date").isNotNull())
        .distinct()
    )
    if method == "gaps":
        ahead = Window.partitionBy(*ks).orderBy("date")
        linked = seen.select(*ks, "date", F.lead("date").over(ahead).alias("__next"))
        days = linked.where(F.datediff("__next", "date") > 1).select(
            *ks, F.explode_outer(F.sequence(F.date_add("date", 1), F.date_sub("__next", 1))).alias("date")
        )
        if weekdays_only:
            days = days.where(F.weekday("date") < 5)
        return unpack_series(days, keys).withColumnRenamed("date", "missing_date")
    if method != "calendar":
        raise ValueError("method must be 'gaps' or 'calendar'")
    if spread is None:
        spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # The day count keeps the optimizer from folding the distinct into the bounds
    # aggregate, so both branches read the same distinct exchange (one scan of the input).
    bounds = (
        seen.groupBy(*ks)
        .agg(F.min("date").alias("earliest"), F.max("date").alias("latest"), F.count(F.lit(1)).alias("n_days"))
        .where(F.col("n_days") > 0)
    )
    days = calendar(bounds, ks, weekdays_only=weekdays_only, spread=spread)
    missing = days.join(seen, on=[*ks, "date"], how="left_anti")
    return unpack_series(missing, keys).withColumnRenamed("date", "missing_date")


def date_gaps(df: DataFrame, date_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Stretches of missing days as intervals: ``keys, gap_start, gap_end, n_days``.

    The same look-ahead window as ``missing_dates``, but a gap stays one row however long it
    is, so a series with decades missing costs no more than one with a day missing.
    """
    keys = list(keys)
    require_columns(df, [date_col, *keys], "date_gaps")
    ks = series_cols(keys)
    seen = (
        df.select(*pack_series(keys), as_date(df, date_col).alias("date"))
        .where(F.col("date").isNotNull())
        .distinct()
    )
    ahead = Window.partitionBy(*ks).orderBy("date")
    linked = seen.select(*ks, "date", F.lead("date").over(ahead).alias("__next"))
    gaps = linked.where(F.datediff("__next", "date") > 1).select(
        *ks,
        F.date_add("date", 1).alias("gap_start"),
        F.date_sub("__next", 1).alias("gap_end"),
        (F.datediff("__next", "date") - 1).alias("n_days"),
    )
    return unpack_series(gaps, keys)


def duplicate_dates(df: DataFrame, date_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Dates carried by more than one row: ``keys, date, n_rows``.

    One shuffle on ``(keys, date)`` after a map-side count, so a hot series or a hot date
    is pre-counted in every map task.
    """
    keys = list(keys)
    return (
        df.select(*keys, as_date(df, date_col).alias("date"))
        .where(F.col("date").isNotNull())
        .groupBy(*keys, "date")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


class DateReport(NamedTuple):
    bounds: DataFrame
    missing: DataFrame
    duplicated: DataFrame


class DateCheckError(ValueError):
    pass


def analyze_dates(
    df: DataFrame,
    date_col: str,
    keys: Sequence[str] = (),
    weekdays_only: bool = False,
    on_violation: str = "report",
    ordered: bool = False,
) -> DateReport:
    """Earliest, latest, missing and duplicated dates per series.

    ``on_violation="report"`` (the default, as the reference only prints) returns lazy
    frames. ``"raise"`` checkpoints the missing and duplicated reports, then raises with at
    most ten examples of each when either is not empty.
    An empty input gives empty frames and no error. With ``ordered`` the reports are sorted by
    series and date (T2): a range shuffle of the reports, not of the input.
    """
    if on_violation not in ("report", "raise"):
        raise ValueError("on_violation must be 'report' or 'raise'")
    keys = list(keys)
    report = DateReport(
        bounds=date_bounds(df, date_col, keys),
        missing=missing_dates(df, date_col, keys, weekdays_only=weekdays_only),
        duplicated=duplicate_dates(df, date_col, keys),
    )
    if on_violation == "raise":
        # The reports are small; write them once to the reliable checkpoint folder so the
        # checks and the caller's later reads do not recompute the plan, and an executor
        # lost afterwards costs nothing.
        from tidemark.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(df.sparkSession)
        report = DateReport(
            bounds=report.bounds,
            missing=report.missing.checkpoint(eager=True),
            duplicated=report.duplicated.checkpoint(eager=True),
        )
    if ordered:
        report = DateReport(
            bounds=report.bounds.orderBy(*keys) if keys else report.bounds,
            missing=report.missing.orderBy(*keys, "missing_date"),
            duplicated=report.duplicated.orderBy(*keys, "date"),
        )
    if on_violation == "raise":
        problems = []
        if not report.missing.isEmpty():
            sample = report.missing.orderBy(*keys, "missing_date").limit(10).collect()
            problems.append(f"missing dates, first 10 of {report.missing.count()}: {[tuple(r) for r in sample]}")
        if not report.duplicated.isEmpty():
            sample = report.duplicated.orderBy(*keys, "date").limit(10).collect()
            problems.append(f"duplicated dates, first 10 of {report.duplicated.count()}: {[tuple(r) for r in sample]}")
        if problems:
            raise DateCheckError("; ".join(problems))
    return report
