"""Whole-row copies and per-series reconciliation.

"Unique" always means distinct over the whole row, NULL equal to NULL and NaN equal to NaN
(Spark normalises both in grouping keys), which is what a full-row dedupe keeps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dates import as_date
from tidemark.operators.keys import null_safe_join, require_columns

_COPIES = "__copies"


def row_copies(df: DataFrame) -> DataFrame:
    """One row per distinct whole row with its number of copies.

    Grouping on every column shuffles on the hash of the whole row after a map-side count,
    so identical copies are collapsed in the map task that reads them and no single key
    value concentrates the work.
    """
    if _COPIES in df.columns:
        raise ValueError(f"column name {_COPIES!r} is reserved")
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(_COPIES))


def dedupe_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep one row of each group of identical rows (U2) or of each ``subset`` value.

    Whole-row copies are identical, so which one is kept does not matter. For ``subset``
    the other columns come from an arbitrary row of the group, as ``dropDuplicates`` does.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def duplicate_row_count(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, n_rows, n_unique_rows, n_duplicate_rows``.

    ``n_duplicate_rows`` counts the surplus copies, i.e. rows a dedupe would remove.
    """
    keys = list(keys)
    agg = row_copies(df).groupBy(*keys).agg(
        F.coalesce(F.sum(_COPIES), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).cast("bigint").alias("n_unique_rows"),
    )
    return agg.withColumn("n_duplicate_rows", F.col("n_rows") - F.col("n_unique_rows"))


def profile_series(
    df: DataFrame,
    date_col: str,
    keys: Sequence[str] = (),
    known_missing: int | DataFrame = 0,
) -> DataFrame:
    """Reconciliation of every series in one job (A1-A5).

    Columns: ``keys, min_date, max_date, n_rows, n_unique_rows, calendar_days, span_ref,
    known_missing, expected_rows, row_count_error, next_start``.

    ``span_ref`` is the reference's day count (difference + 2) that its expected row count is
    based on; ``calendar_days`` is the true inclusive count (difference + 1). ``known_missing``
    is a constant, or a DataFrame ``keys, known_missing`` (a small catalogue; a series absent
    from it counts 0).
    """
    keys = list(keys)
    require_columns(df, [date_col, *keys], "profile_series")
    copies = row_copies(df)
    d = as_date(copies, date_col)
    prof = copies.groupBy(*keys).agg(
        F.min(d).alias("min_date"),
        F.max(d).alias("max_date"),
        F.coalesce(F.sum(_COPIES), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).cast("bigint").alias("n_unique_rows"),
    )
    if isinstance(known_missing, DataFrame):
        if not keys:
            raise ValueError("a known_missing table needs keys")
        prof = null_safe_join(prof, known_missing.select(*keys, "known_missing"), keys, "left")
        km = F.coalesce(F.col("known_missing"), F.lit(0)).cast("bigint")
    else:
        km = F.lit(int(known_missing)).cast("bigint")
    diff = F.datediff("max_date", "min_date").cast("bigint")
    return prof.select(
        *keys,
        "min_date",
        "max_date",
        "n_rows",
        "n_unique_rows",
        (diff + 1).alias("calendar_days"),
        (diff + 2).alias("span_ref"),
        km.alias("known_missing"),
        (diff + 2 - km).alias("expected_rows"),
        (diff + 2 - km - F.col("n_unique_rows")).alias("row_count_error"),
        F.date_add("max_date", 1).alias("next_start"),
    )
