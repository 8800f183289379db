"""Point, range and list look-ups over one table, composed from optional conditions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def point(df: DataFrame, column: str, value: object) -> DataFrame:
    """The rows whose column has the value; a null value finds none."""
    return df.filter(F.col(column) == F.lit(value))


def by_keys(df: DataFrame, column: str, probes: DataFrame, probe: str) -> DataFrame:
    """The rows whose column is among the probes: the point look-up for many keys at once."""
    return df.join(probes.select(F.col(probe).alias(column)).dropna().distinct(), column, "left_semi")


def listed(
    df: DataFrame, equal: Mapping[str, object | None] | None = None, least: Mapping[str, object | None] | None = None, between: Mapping[str, tuple[Column, Column]] | None = None,
    order: Sequence[Column] = (), limit: int | None = None,
) -> DataFrame:
    """Rows under optional conditions: those given as None are left out, so that one look-up
    serves with any of its filters. The conditions reach the scan."""
    for column, value in (equal or {}).items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    for column, value in (least or {}).items():
        if value is not None:
            df = df.filter(F.col(column) >= value)
    for column, (low, high) in (between or {}).items():
        df = df.filter(F.col(column).between(low, high))
    df = df.orderBy(*order) if order else df
    return df if limit is None else df.limit(limit)


def flagged(df: DataFrame, column: str, only: bool) -> DataFrame:
    """All rows, or with `only` those whose flag is set."""
    return df.filter(F.lit(not only) | F.coalesce(F.col(column), F.lit(False)))
