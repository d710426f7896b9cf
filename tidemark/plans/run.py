"""One scheduled run over the landing folder.

``daily_run`` is what the reference's ingestion notebooks do together, for every family and
series at once: which series are due today (for the fetcher, outside the library), the
incremental load of every family with landed files (quarantining bad payloads), and one
integrity report per series: the reconciliation profile with the number of missing and
duplicated days. The report is lazy; each part is one aggregate plan keyed by series, and
the parts are joined on the series id after being reduced to one row per series.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.dates import as_date
from tidemark.operators.incremental import backfill_ranges, due_sources
from tidemark.operators.keys import null_safe_join, pack_series, series_cols, unpack_series
from tidemark.operators.rows import profile_series, row_copies
from tidemark.plans.ledger import Ledger
from tidemark.plans.load import FAMILIES, create_series_views
from tidemark.plans.tables import table_exists
from tidemark.sources.catalog import schedule, source_catalog, with_comments
from tidemark.streaming.landing_stream import start_landing_stream


@dataclass
class RunResult:
    due: DataFrame
    loads: dict[str, dict]
    report: DataFrame | None
    backfill: DataFrame | None  # family, series_id, start_date, end_date, n_days


def series_report(
    df: DataFrame, date_col: str, keys: Sequence[str], known_missing: int | DataFrame = 0
) -> DataFrame:
    """``keys, <profile columns>, n_missing_days, n_duplicate_dates``: the profile of every
    series with its number of missing and duplicated days.

    Everything derives from the whole-row aggregate of the profile (its exchange is shared,
    so the input is read once): the rows per ``(series, day)`` give the duplicated days, and
    one look-ahead window over a series' days (at most one row per calendar day) sums the
    gaps, so the missing days are counted without being generated.
    """
    keys = list(keys)
    ks = series_cols(keys)
    profile = profile_series(df, date_col, keys, known_missing=known_missing)
    copies = row_copies(df)
    day = as_date(copies, date_col)
    # No filter on the day here: it would be pushed below the whole-row aggregate and the
    # two branches would no longer share it. A NULL day sorts first, its gap is NULL and
    # it is not counted as a duplicated day.
    daily = copies.groupBy(*pack_series(keys), day.alias("date")).agg(F.sum("__copies").alias("__n"))
    ahead = Window.partitionBy(*ks).orderBy("date")
    gaps = daily.select(
        *ks,
        (F.datediff(F.lead("date").over(ahead), F.col("date")) - 1).alias("__gap"),
        (F.col("date").isNotNull() & (F.col("__n") > 1)).alias("__dup"),
    )
    stats = gaps.groupBy(*ks).agg(
        F.coalesce(F.sum(F.when(F.col("__gap") > 0, F.col("__gap"))), F.lit(0)).cast("bigint").alias("n_missing_days"),
        F.count_if("__dup").cast("bigint").alias("n_duplicate_dates"),
    )
    if not keys:  # one series: the two counts are scalar subqueries, not a join
        return profile.select(
            *profile.columns,
            F.coalesce(stats.select("n_missing_days").scalar(), F.lit(0)).alias("n_missing_days"),
            F.coalesce(stats.select("n_duplicate_dates").scalar(), F.lit(0)).alias("n_duplicate_dates"),
        )
    joined = null_safe_join(profile, unpack_series(stats, keys), keys, "left")
    return joined.select(
        *profile.columns,
        F.coalesce("n_missing_days", F.lit(0)).alias("n_missing_days"),
        F.coalesce("n_duplicate_dates", F.lit(0)).alias("n_duplicate_dates"),
    )


def integrity_report(spark: SparkSession, family: str) -> DataFrame:
    """``family, series_id, <series_report columns>`` for one family table; known missing
    days come from the catalogue."""
    fam = FAMILIES[family]
    known = source_catalog(spark).select("series_id", "known_missing")
    report = series_report(spark.table(fam.table), fam.date_col, ["series_id"], known)
    return report.select(F.lit(family).alias("family"), *report.columns)


# Folder below the landing root in which re-fetched files land, by family and series.
BACKFILL = "backfill"
SPARSE_INTERVALS = ("weekly", "monthly", "quarterly", "semiannual", "annual", "yearly")


def _ledger(spark: SparkSession, family: str) -> Ledger:
    fam = FAMILIES[family]
    ledger = Ledger(spark, fam.table, fam.date_col)
    ledger.ensure()
    return ledger


def backfill_requests(spark: SparkSession, family: str) -> DataFrame:
    """``family, series_id, start_date, end_date, n_days``: what to fetch again for one family,
    in ranges (S9). Gaps come from the ledger; the table is not read. Series whose catalogue
    entry states a longer interval than a day have gaps by nature and are left out."""
    sparse = source_catalog(spark).where(F.lower("interval").isin(*SPARSE_INTERVALS)).select("series_id")
    gaps = null_safe_join(_ledger(spark, family).gaps(), sparse, ["series_id"], "left_anti")
    requests = backfill_ranges(gaps, ["series_id"])
    return requests.select(F.lit(family).alias("family"), *requests.columns)


def daily_run(
    spark: SparkSession,
    landing_root: str,
    run_date: dt.date | str,
    progress_root: str | None = None,
) -> RunResult:
    """Load ``<landing_root>/<family>/<series_id>/<file>`` for every family, then report.

    Each family runs as a stream over its folder until nothing new is left: the stream's
    progress, kept under ``progress_root`` (``<landing_root>/_progress`` unless given),
    remembers the files loaded before, so a later run reads new files only. Files under
    ``<landing_root>/backfill/<family>/<series_id>/`` are loaded after them and fill days below
    the marks; the result's ``backfill`` lists the requests that would fill the gaps that are
    left. Every series loaded gets its view, with the catalogue's comment.
    """
    root = landing_root.rstrip("/")
    progress = (progress_root or f"{root}/_progress").rstrip("/")
    catalog = source_catalog(spark)
    due = due_sources(catalog, schedule(spark), run_date)
    comments = {r["series_id"]: r["comment"] for r in with_comments(catalog).select("series_id", "comment").collect()}
    loads: dict[str, dict] = {}
    for family, fam in FAMILIES.items():
        before = _ledger(spark, family).last_seq() if table_exists(spark, fam.table) else 0
        batches: list[dict] = []
        landed = False
        for folder, mode in ((family, "increment"), (f"{BACKFILL}/{family}", "backfill")):
            path = f"{root}/{folder}/*/*"
            try:
                spark.read.text(path, wholetext=True)
            except AnalysisException:  # nothing landed here
                continue
            landed = True
            start_landing_stream(
                spark, path, family, f"{progress}/{folder}", on_load=batches.append, mode=mode
            ).awaitTermination()
        if not landed:
            continue
        loads[family] = {
            "action": batches[0]["action"] if batches else "none",
            "rows": sum(b["rows"] for b in batches),
        }
        if batches and table_exists(spark, fam.table):
            spark.catalog.refreshTable(fam.table)
            # Views of the series written in this run: names, from the ledger.
            written = _ledger(spark, family).written_since(before)
            ids = [r[0] for r in written.where("series_id is not null").collect()]
            create_series_views(spark, fam.table, ids, comments)
    report = backfill = None
    for family in FAMILIES:
        if table_exists(spark, FAMILIES[family].table):
            part = integrity_report(spark, family)
            report = part if report is None else report.unionByName(part, allowMissingColumns=True)
            requests = backfill_requests(spark, family)
            backfill = requests if backfill is None else backfill.unionByName(requests)
    return RunResult(due=due, loads=loads, report=report, backfill=backfill)
