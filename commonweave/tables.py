"""Reading the tables of a data folder, and the one-row-per-record rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table `name` of the data folder, as a lazy scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key: the greatest by `order` (nulls are least).

    Written as max_by over a struct, so that rows are combined before the
    shuffle and a hot key never gathers in one task, as a window would.
    Ties are broken by the whole row, so the result does not depend on order.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.xxhash64(*rest).alias("_h"))
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)
