"""The engine's frames over the tables of a data folder: one row for each record,
the latest where a record was seen again; and the same rule in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import latest_rows, table

#: The time as of which every query holds; nothing reads the clock.
AS_OF = "2026-05-30 00:00:00"

_ORDER = {
    "person": ("id", "last_observed_at"), "community_event": ("id", "updated_at"), "communication": ("id", "ingested_at"), "person_platform_identity": ("id", "observed_at"),
    "github_profile": ("id", "fetched_at"), "raw_reddit_item": ("thing_id", "fetched_at"),
}


def as_of() -> Column:
    """AS_OF as a column, in UTC."""
    return F.to_timestamp(F.lit(AS_OF))


def records(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None, derived: dict[str, Column] | None = None) -> DataFrame:
    """One row for each record of the table, with only the columns named: the choice
    of rows shuffles what is read, so texts are left out where they are not needed.
    What is only derived from a text is derived before that, so the text stays behind."""
    key, order = _ORDER[name]
    df = table(spark, folder, name).withColumns(derived or {})
    if columns is None:
        return latest_rows(df, [key], [F.col(order)])
    wanted = list(dict.fromkeys([key, *columns, *(derived or {})]))
    slim = df.select(*dict.fromkeys([*wanted, order]))
    return latest_rows(slim, [key], [F.col(order)]).select(*wanted)


def attendance(spark: SparkSession, folder: str) -> DataFrame:
    """Who took part in what: line items as attendance of a supplier at an order."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("person_id"), F.col("l_orderkey").cast("string").alias("event_id"),
        F.when(F.col("l_returnflag") == "A", "organizer").when(F.col("l_returnflag") == "R", "co_organizer").otherwise("attendee").alias("role"),
        F.col("l_shipdate").cast("timestamp").alias("attended_at"), F.lit(None).cast("timestamp").alias("registered_at"),
    )


def hosts(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as persons who take part in events."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("canonical_name"), F.col("n_name").alias("location_city"), F.lit(None).cast("string").alias("location_country"),
        F.when(F.col("s_acctbal") > 8000, "ambassador").otherwise("engaged").alias("lifecycle_stage"), F.col("s_acctbal").cast("double").alias("activity_score"),
        (F.col("s_acctbal") >= 0).alias("is_active"), F.lit("1995-01-01 00:00:00").cast("timestamp").alias("last_observed_at"),
    )


def gatherings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as events."""
    return table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderdate").cast("timestamp").alias("starts_at"), F.col("o_orderstatus").alias("status"), F.lit(None).cast("string").alias("venue_city"), F.lit(None).cast("string").alias("venue_country"))


def latest_sql(name: str) -> str:
    """The rows of records() in SQL."""
    key, order = _ORDER[name]
    return f"(SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order} DESC NULLS LAST) = 1)"


SQL_AS_OF = f"TIMESTAMPTZ '{AS_OF}+00'"
SQL_ATTENDANCE = (
    "(SELECT CAST(l_suppkey AS VARCHAR) AS person_id, CAST(l_orderkey AS VARCHAR) AS event_id, CASE l_returnflag WHEN 'A' THEN 'organizer' WHEN 'R' THEN 'co_organizer' ELSE 'attendee' END AS role, "
    "CAST(l_shipdate AS TIMESTAMP) AS attended_at FROM lineitem)"
)
SQL_HOSTS = (
    "(SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS canonical_name, n_name AS location_city, CASE WHEN s_acctbal > 8000 THEN 'ambassador' ELSE 'engaged' END AS lifecycle_stage, "
    "CAST(s_acctbal AS DOUBLE) AS activity_score, s_acctbal >= 0 AS is_active FROM supplier JOIN nation ON s_nationkey = n_nationkey)"
)
