"""Series of different grain aligned on the days of a target series.

A feature is known on a day by its last value at least ``lag`` days before: a monthly series
holds its value until the next one, a daily one with lag 1 gives the value of the day before,
and no feature ever sees the day it is to explain. The reference only states the intent; the
semantics are ours.

Plan: every series is reduced to one value a day first. Each feature's days, shifted by its
lag, and the target's days are put below each other, collapsed to one row per series and day,
and one window per series carries the last value of every feature forward. There is no join
and no range condition; a window partition holds at most one row per calendar day and feature.
Features that hold for all target series (``shared``) are aligned once on the target's
distinct days and joined by the day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.fill import daily_values
from tidemark.operators.keys import require_columns, series_cols, unpack_series


@dataclass(frozen=True)
class Source:
    """A series to align: its rows, columns, reduction to a day's value, and lags in days."""

    rows: DataFrame
    date_col: str
    value_col: str
    agg: str = "last"
    lags: tuple[int, ...] = (1,)


def feature_names(features: Mapping[str, Source]) -> list[str]:
    return [f"{name}_lag{lag}" for name, source in features.items() for lag in source.lags]


def _carried(days: DataFrame, features: Mapping[str, Source], keys: Sequence[str]) -> DataFrame:
    """``days`` (series, date, ...) with the features known on each of them."""
    ks = series_cols(keys)
    names = feature_names(features)
    if not names:
        return days
    values = [c for c in days.columns if c not in (*ks, "date")]
    parts = [days.select(*ks, "date", *values, *[F.lit(None).cast("double").alias(n) for n in names], F.lit(True).alias("__asked"))]
    for name, source in features.items():
        daily = daily_values(source.rows, source.date_col, source.value_col, keys, source.agg)
        daily = daily.where(F.col("value").isNotNull())
        for lag in source.lags:
            own = f"{name}_lag{lag}"
            parts.append(
                daily.select(
                    *ks,
                    F.date_add("date", lag).alias("date"),
                    *[F.lit(None).cast(days.schema[v].dataType).alias(v) for v in values],
                    *[(F.col("value") if n == own else F.lit(None).cast("double")).alias(n) for n in names],
                    F.lit(None).cast("boolean").alias("__asked"),
                )
            )
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    merged = stacked.groupBy(*ks, "date").agg(*[F.max(c).alias(c) for c in (*values, *names, "__asked")])
    so_far = Window.partitionBy(*ks).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = [F.last(n, ignorenulls=True).over(so_far).alias(n) for n in names]
    return merged.select(*ks, "date", *values, *known, "__asked").where("__asked").drop("__asked")


def align_features(
    target: Source,
    features: Mapping[str, Source],
    keys: Sequence[str] = (),
    shared: Mapping[str, Source] | None = None,
) -> DataFrame:
    """``keys, date, target, <feature>_lag<n>...`` for every day the target has a value.

    ``features`` have the key columns and are aligned series by series; ``shared`` have none.
    The target may be a feature of itself (its own past). A feature without a value early
    enough is NULL; a lag below one day would leak the day itself and is refused. NULL keys
    are a series like any other; values that are NULL count as absent.
    """
    keys, shared = list(keys), dict(shared or {})
    for name, source in [*features.items(), *shared.items()]:
        if not source.lags or min(source.lags) < 1:
            raise ValueError(f"align_features: {name} needs lags of one day or more")
        require_columns(source.rows, [source.date_col, source.value_col, *(keys if name in features else [])], f"align_features ({name})")
    names = [*feature_names(features), *feature_names(shared)]
    if len({n.lower() for n in [*names, "date", "target", *keys]}) < len(names) + 2 + len(keys):
        raise ValueError(f"align_features: names clash among {names}")
    require_columns(target.rows, [target.date_col, target.value_col, *keys], "align_features (target)")
    days = daily_values(target.rows, target.date_col, target.value_col, keys, target.agg)
    days = days.where(F.col("value").isNotNull()).withColumnRenamed("value", "target")
    aligned = unpack_series(_carried(days, features, keys), keys)
    if shared:
        known = _carried(days.select("date").distinct(), shared, ())
        aligned = aligned.join(known, "date", "left")
    return aligned.select(*keys, "date", "target", *names)
