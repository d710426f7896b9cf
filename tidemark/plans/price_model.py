"""A linear model of a series on its aligned features, judged on later days.

The rows come from ``align_features``. The split is by time: the model learns from the earlier
share of the days and is judged on the later ones only, next to the plain forecast that
repeats the target's last known value. Rows with a NULL feature or target are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dates import as_date
from tidemark.operators.keys import require_columns


def time_split(rows: DataFrame, date_col: str = "date", held_out: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(earlier, later): the last ``held_out`` share of the distinct days is later. Every day is
    on one side whole, whatever its number of rows. The cut is a scalar subquery over the
    distinct days; rows without a date are on neither side."""
    if not 0 < held_out < 1:
        raise ValueError("held_out must lie between 0 and 1")
    day = F.unix_date(as_date(rows, date_col))
    days = rows.where(day.isNotNull()).select(day.alias("__day")).distinct()
    cut = days.agg(F.expr(f"percentile_disc({1 - held_out}) within group (order by __day)")).scalar()
    return rows.where(day <= cut), rows.where(day > cut)


@dataclass(frozen=True)
class PriceModel:
    """A fitted pipeline, the features it reads and its errors on the later days."""

    pipeline: PipelineModel
    features: list[str]
    metrics: dict[str, float | int | None]

    @property
    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.features, self.pipeline.stages[-1].coefficients.toArray().tolist(), strict=True))

    @property
    def intercept(self) -> float:
        return float(self.pipeline.stages[-1].intercept)

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prediction``; rows with a NULL feature are left out."""
        return self.pipeline.transform(rows).drop("__features")


def _errors(judged: DataFrame, target: str, naive: str | None) -> dict[str, float | int | None]:
    """Root mean squared and mean absolute error, R squared, and the plain forecast's error,
    in one aggregate."""
    gap = F.col(target) - F.col("prediction")
    spread = F.var_pop(target)
    plain = F.sqrt(F.avg((F.col(target) - F.col(naive)) ** 2)) if naive else F.lit(None).cast("double")
    return judged.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
        F.when(spread > 0, 1 - F.avg(gap * gap) / spread).alias("r2"),
        plain.alias("naive_rmse"),
    ).first().asDict()


def fit_price_model(
    rows: DataFrame,
    features: Sequence[str],
    target: str = "target",
    date_col: str = "date",
    held_out: float = 0.2,
    regularisation: float = 0.0,
    naive: str | None = None,
) -> PriceModel:
    """Fit on the earlier days and judge on the later ones. ``naive`` names the feature that is
    the plain forecast (the target's own last value). Training is one pass per solver step over
    the rows; what reaches the driver is the features' Gram matrix."""
    features = list(features)
    require_columns(rows, [target, date_col, *features], "fit_price_model")
    whole = rows.dropna(subset=[target, *features])
    earlier, later = time_split(whole, date_col, held_out)
    if earlier.isEmpty() or later.isEmpty():
        raise ValueError("fit_price_model: no complete rows on one side of the split")
    steps = [
        VectorAssembler(inputCols=features, outputCol="__features", handleInvalid="skip"),
        LinearRegression(featuresCol="__features", labelCol=target, regParam=regularisation),
    ]
    pipeline = Pipeline(stages=steps).fit(earlier)
    metrics = _errors(pipeline.transform(later), target, naive)
    return PriceModel(pipeline, features, metrics)
