"""Checks of tables and of decisions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def missing_tables(spark: SparkSession, required: list[str]) -> list[str]:
    """Required tables or views that the catalog lacks."""
    present = {t.name for t in spark.catalog.listTables()}
    return sorted(set(required) - present)


def short_tables(tables: Mapping[str, DataFrame], least: Mapping[str, int]) -> dict[str, int]:
    """Row counts of the tables that have fewer rows than they should."""
    counts = {name: tables[name].count() for name in least}
    return {name: n for name, n in counts.items() if n < least[name]}


def coverage(items: DataFrame, key: str, covered: DataFrame, covered_key: str) -> DataFrame:
    """(total, with_any, share): how many items appear in another table."""
    seen = covered.select(F.col(covered_key).alias(key)).dropna().distinct().withColumn("_in", F.lit(1))
    return items.select(key).distinct().join(seen, key, "left").agg(F.count("*").alias("total"), F.count("_in").alias("with_any")).withColumn("share", F.coalesce(F.try_divide("with_any", "total"), F.lit(0.0)))


def stuck_rows(raw: DataFrame, as_of: F.Column, minutes: int) -> DataFrame:
    """Rows still pending after so many minutes."""
    return raw.filter((F.col("status") == "pending") & (F.col("ingested_at") < as_of - F.make_interval(mins=F.lit(minutes))))


def confidence_histogram(df: DataFrame, column: str) -> DataFrame:
    """(bucket, n): ten buckets of a tenth and one for exactly 1.0, empty ones included."""
    v = F.col(column)
    bucket = F.when(v >= 1.0, 10).otherwise(F.floor(F.least(v, F.lit(0.9999)) * 10)).cast("int")
    found = df.filter(v.isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    return df.sparkSession.range(11).select(F.col("id").cast("int").alias("bucket")).join(found, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def confusion(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """(tp, fp, tn, fn, accuracy) of two 0/1 columns."""
    p, a = F.col(predicted) == 1, F.col(actual) == 1
    count = lambda c: F.count(F.when(c, 1))
    return df.agg(count(p & a).alias("tp"), count(p & ~a).alias("fp"), count(~p & ~a).alias("tn"), count(~p & a).alias("fn")).withColumn(
        "accuracy", F.coalesce(F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")), F.lit(0.0))
    )


def relevance_buckets(df: DataFrame, column: str, group: str) -> DataFrame:
    """(group, none, low, medium, high): rows by quarter-like classes of a score: 0, below 0.4, below 0.7, from there on."""
    v = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
    n = lambda c: F.count(F.when(c, 1))
    return df.groupBy(group).agg(n(v <= 0).alias("none"), n((v > 0) & (v < 0.4)).alias("low"), n((v >= 0.4) & (v < 0.7)).alias("medium"), n(v >= 0.7).alias("high"))


def most_wrong(df: DataFrame, key: str, confidence: str, right: str, n: int = 3) -> DataFrame:
    """The n rows judged wrong with most confidence."""
    return df.filter(~F.col(right)).orderBy(F.desc_nulls_last(confidence), key).limit(n)


def stage_counters(df: DataFrame, group: str, stages: Mapping[str, F.Column]) -> DataFrame:
    """(group, seen, one column for each stage): how many rows a pipeline saw and brought through each stage, in one pass."""
    return df.groupBy(group).agg(F.count("*").alias("seen"), *[F.count(F.when(ok, 1)).alias(name) for name, ok in stages.items()])


def schema_hash(df: DataFrame) -> str:
    """A hash of a schema, to notice drift."""
    import hashlib

    return hashlib.sha256(df.schema.json().encode()).hexdigest()
