"""tidemark: Spark-native loading and integrity checks for daily market and economic series.

Every operator is a lazy DataFrame plan over many series at once (``keys=[...]``); see the
README for the map from the reference's capabilities to functions here.
"""

from tidemark.functions.columns import (
    apply_types,
    clean_column_names,
    split_datetime,
    time_of_day,
    to_numeric,
    to_utc_ntz,
)
from tidemark.operators.checks import check_not_null, check_unique, column_test_report
from tidemark.operators.dates import analyze_dates, date_bounds, duplicate_dates, missing_dates
from tidemark.operators.incremental import (
    after_high_water_mark,
    apply_backfill,
    backfill_plan,
    due_sources,
    gate_by_weekday,
    ingest_plan,
)
from tidemark.operators.rows import dedupe_rows, duplicate_row_count, profile_series
from tidemark.operators.fill import fill_daily
from tidemark.plans.load import create_series_views, dedupe_table, load_increment, load_landed
from tidemark.plans.run import daily_run, series_report
from tidemark.sources.catalog import schedule, source_catalog
from tidemark.sources.landing import (
    classify_payloads,
    parse_bars,
    parse_indicator,
    parse_keyed_series,
    parse_table_dump,
    read_landed,
    shape_bars,
)

__all__ = [
    "classify_payloads",
    "create_series_views",
    "daily_run",
    "dedupe_table",
    "fill_daily",
    "load_increment",
    "load_landed",
    "parse_bars",
    "parse_indicator",
    "parse_keyed_series",
    "parse_table_dump",
    "read_landed",
    "schedule",
    "series_report",
    "shape_bars",
    "source_catalog",
    "after_high_water_mark",
    "analyze_dates",
    "apply_backfill",
    "apply_types",
    "backfill_plan",
    "check_not_null",
    "check_unique",
    "clean_column_names",
    "column_test_report",
    "date_bounds",
    "dedupe_rows",
    "due_sources",
    "duplicate_dates",
    "duplicate_row_count",
    "gate_by_weekday",
    "ingest_plan",
    "missing_dates",
    "profile_series",
    "split_datetime",
    "time_of_day",
    "to_numeric",
    "to_utc_ntz",
]
