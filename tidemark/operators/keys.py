"""Joins on series keys where a NULL key is a series like any other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` with NULL equal to NULL; the output has the key columns once.

    ``<=>`` is still an equi-join key for Spark's planner (hash and sort-merge joins apply),
    and the right keys are renamed first so a self-join cannot resolve ambiguously.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("null_safe_join needs at least one key")
    renamed = {k: f"__rk_{i}" for i, k in enumerate(keys)}
    r = right.select(
        *[F.col(k).alias(renamed[k]) for k in keys],
        *[c for c in right.columns if c not in renamed],
    )
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[renamed[k]]) for k in keys])
    out = left.join(r, cond, how)
    if how in ("left_anti", "leftanti", "anti", "left_semi", "leftsemi", "semi"):
        return out
    return out.drop(*renamed.values())


SERIES = "__series"


def pack_series(keys: Sequence[str]) -> list:
    """Columns standing for the series: one struct of the key columns (empty for one series).

    Struct equality treats NULL fields as equal, so a plain equi-join or grouping on the
    struct keeps NULL series ids together while the join keys stay the very columns the
    preceding aggregate was partitioned on (no extra shuffle before a sort-merge join).
    """
    keys = list(keys)
    return [F.struct(*keys).alias(SERIES)] if keys else []


def series_cols(keys: Sequence[str]) -> list[str]:
    return [SERIES] if list(keys) else []


def unpack_series(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    if not keys:
        return df
    rest = [c for c in df.columns if c != SERIES]
    return df.select(*[F.col(SERIES)[k].alias(k) for k in keys], *rest)


def require_columns(df: DataFrame, columns: Sequence[str], where: str) -> None:
    """Raise before planning when a named column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{where}: no column(s) {missing} in {df.columns}")
