"""Column tests of the SQL models.

A test passes when it finds no failing value or row. Each test is one aggregate plan; a
report over several tests is their ``unionByName``, so every test is a separate branch of
one job and nothing is collected unless the caller asks for it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, column: str | Sequence[str]) -> DataFrame:
    """Values seen more than once: ``<column(s)>, n_rows``. NULLs are not tested (A10)."""
    cols = [column] if isinstance(column, str) else list(column)
    not_null = F.lit(True)
    for c in cols:
        not_null = not_null & F.col(c).isNotNull()
    return (
        df.where(not_null)
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def count_not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """One row ``n_failing``: the number of rows a not_null test rejects."""
    return df.select(
        F.count_if(F.col(column).isNull()).cast("bigint").alias("n_failing")
    )


def column_test_report(
    df: DataFrame, tests: Iterable[tuple[str, str]], model: str = ""
) -> DataFrame:
    """``model, column_name, test, n_failing, passed`` for ``(column, test)`` pairs.

    ``test`` is ``unique`` (number of values seen more than once) or ``not_null`` (number
    of NULL rows). However many columns are tested, the table is read twice at most: all
    not_null tests are one global aggregate, and all unique tests are one grouping-sets
    aggregate (one scan, one shuffle, partial counts on the map side).
    """
    tests = list(tests)
    for _, test in tests:
        if test not in ("unique", "not_null"):
            raise ValueError(f"unknown column test {test!r}")
    if not tests:
        raise ValueError("no tests given")
    nn_cols = list(dict.fromkeys(c for c, t in tests if t == "not_null"))
    uq_cols = list(dict.fromkeys(c for c, t in tests if t == "unique"))
    parts = []
    if nn_cols:
        nn = df.select(
            *[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"n{i}") for i, c in enumerate(nn_cols)]
        )
        parts.append((nn, [(c, "not_null", f"n{i}") for i, c in enumerate(nn_cols)]))
    if uq_cols:
        width = len(uq_cols)
        grouped = df.groupingSets([[c] for c in uq_cols], *uq_cols).agg(
            F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__g")
        )
        # grouping_id has a 1 bit for every column not in the set, leftmost column highest.
        gid = {c: (1 << width) - 1 - (1 << (width - 1 - i)) for i, c in enumerate(uq_cols)}
        uq = grouped.agg(
            *[
                F.count_if((F.col("__g") == gid[c]) & F.col(c).isNotNull() & (F.col("__n") > 1))
                .cast("bigint")
                .alias(f"u{i}")
                for i, c in enumerate(uq_cols)
            ]
        )
        parts.append((uq, [(c, "unique", f"u{i}") for i, c in enumerate(uq_cols)]))
    # Each one-row frame becomes one row per test.
    rows = None
    for frame, names in parts:
        long = frame.unpivot([], [a for _, _, a in names], "__var", "n_failing")
        label = F.create_map(*[x for c, t, a in names for x in (F.lit(a), F.array(F.lit(c), F.lit(t)))])
        long = long.select(
            F.lit(model).alias("model"),
            label[F.col("__var")][0].alias("column_name"),
            label[F.col("__var")][1].alias("test"),
            F.col("n_failing").cast("bigint").alias("n_failing"),
            (F.col("n_failing") == 0).alias("passed"),
        )
        rows = long if rows is None else rows.unionByName(long)
    return rows
