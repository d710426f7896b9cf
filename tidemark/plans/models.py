"""Small SQL models materialised as views or tables, with column tests (SURVEY K9-K11,
P11, P12, F3, T3, U1, A10, A11, §3.4).

A model is a name, a SQL text or a DataFrame builder, a materialisation, descriptions and
column tests. ``run_models`` builds them in list order (the order stands in for ``ref``
dependencies) and returns one test report. Spark parses and plans the SQL; there is no
template compiler.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.checks import column_test_report
from tidemark.plans.tables import (
    _quote,
    ident,
    replace_table,
    set_column_comment,
    set_table_comment,
    table_exists,
)


@dataclass
class Model:
    name: str
    sql: str | None = None
    build: Callable[[SparkSession], DataFrame] | None = None
    materialized: str = "view"
    description: str | None = None
    column_descriptions: dict[str, str] = field(default_factory=dict)
    tests: Sequence[tuple[str, str]] = ()

    def frame(self, spark: SparkSession) -> DataFrame:
        if self.sql is not None:
            return spark.sql(self.sql)
        if self.build is not None:
            return self.build(spark)
        raise ValueError(f"model {self.name!r} has neither sql nor build")


def materialize(spark: SparkSession, model: Model) -> DataFrame:
    """Build one model as a view or a table and return it as a DataFrame.

    A SQL view is a permanent ``CREATE OR REPLACE VIEW`` when its SQL only reads catalog
    objects, else a temporary view; a DataFrame-built view is a temporary view. A table is
    created, or replaced through a staged write when it exists.
    """
    if model.materialized == "view":
        if model.sql is None or not _permanent_view(spark, model):
            model.frame(spark).createOrReplaceTempView(model.name)
    elif model.materialized == "table":
        if table_exists(spark, model.name):
            replace_table(spark, model.name, lambda _old: model.frame(spark))
        else:
            model.frame(spark).write.mode("errorifexists").saveAsTable(model.name)
        if model.description:
            set_table_comment(spark, model.name, model.description)
        for col, text in model.column_descriptions.items():
            set_column_comment(spark, model.name, col, text)
    else:
        raise ValueError(f"unknown materialization {model.materialized!r}")
    return spark.table(model.name)


def _permanent_view(spark: SparkSession, model: Model) -> bool:
    """Create the view with its own and its columns' descriptions (K11); False if its SQL
    reads a temporary object, which a permanent view may not. Any other fault is raised."""
    columns = ", ".join(
        ident(c) + (f" COMMENT {_quote(model.column_descriptions[c])}" if c in model.column_descriptions else "")
        for c in spark.sql(model.sql).columns
    )
    comment = f" COMMENT {_quote(model.description)}" if model.description else ""
    try:
        spark.sql(f"CREATE OR REPLACE VIEW {ident(model.name)} ({columns}){comment} AS {model.sql}")
    except AnalysisException as fault:
        if fault.getCondition() != "INVALID_TEMP_OBJ_REFERENCE":
            raise
        return False
    return True


def run_models(spark: SparkSession, models: Sequence[Model]) -> DataFrame | None:
    """Materialise ``models`` in order, then report their column tests (one lazy frame)."""
    reports = []
    for m in models:
        df = materialize(spark, m)
        if m.tests:
            reports.append(column_test_report(df, m.tests, model=m.name))
    if not reports:
        return None
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def _first_model(spark: SparkSession) -> DataFrame:
    """Two rows of ``id``: 1 and null."""
    return spark.createDataFrame([(1,), (None,)], "id int")


def _first_model_named(spark: SparkSession) -> DataFrame:
    return _first_model(spark).where("id is not null")


# The three starter models and their tests.
SECOND_MODEL_SQL = "select * from my_first_dbt_model where id = 1"
SIMPLE_MODEL_SQL = "select * from btc_usd_daily_price limit 100"
# Deterministic form of the smoke model: the same 100-row sample with a total order.
SIMPLE_MODEL_ORDERED_SQL = (
    "select * from btc_usd_daily_price order by date_period_start, time_period_start limit 100"
)


def reference_models(ordered_simple: bool = True, named_ids_only: bool = False) -> list[Model]:
    """The starter models; ``named_ids_only`` leaves out rows without an id."""
    return [
        Model(
            "my_first_dbt_model",
            build=_first_model_named if named_ids_only else _first_model,
            materialized="table",
            description="A starter dbt model",
            column_descriptions={"id": "The primary key for this table"},
            tests=[("id", "unique"), ("id", "not_null")],
        ),
        Model(
            "my_second_dbt_model",
            sql=SECOND_MODEL_SQL,
            materialized="view",
            description="A starter dbt model",
            column_descriptions={"id": "The primary key for this table"},
            tests=[("id", "unique"), ("id", "not_null")],
        ),
        Model(
            "simple",
            sql=SIMPLE_MODEL_ORDERED_SQL if ordered_simple else SIMPLE_MODEL_SQL,
            materialized="view",
            description="just a smoke test",
            tests=[("date_open", "unique"), ("date_open", "not_null")],
        ),
    ]
