"""Further queries: champions, conversions, zero-filled counts, links and differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..tables import table
from .frames import SQL_AS_OF, as_of, latest_sql, records

#: Decisions counted even where none was made.
METHODS = ("explicit_link", "heuristic_match", "human_verified", "self_reported", "embedding_match")


def champions_by_company(spark: SparkSession, folder: str) -> DataFrame:
    """Companies with two leading or very active persons or more, and their talk."""
    person = records(spark, folder, "person", ["employer_company_id", "lifecycle_stage", "activity_score", "is_active"])
    leads = person.filter("is_active and (lifecycle_stage in ('ambassador', 'event_host') or activity_score >= 50)").select("id", "employer_company_id")
    talk = records(spark, folder, "communication", ["author_person_id"]).groupBy(F.col("author_person_id").alias("id")).agg(F.count("*").alias("n"))
    company = table(spark, folder, "company").select(F.col("id").alias("employer_company_id"), "canonical_name")
    out = leads.join(talk, "id", "left").groupBy("employer_company_id").agg(F.count_distinct("id").alias("champions"), F.coalesce(F.sum("n"), F.lit(0)).alias("talk")).filter("champions >= 2")
    return out.join(company, "employer_company_id")


def program_conversions(spark: SparkSession, folder: str) -> DataFrame:
    """Customers by their first order of each priority, those of two priorities or more: first dates pivoted by hand."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderpriority", "o_orderdate")
    first = lambda p: F.datediff(F.min(F.when(F.col("o_orderpriority") == p, F.col("o_orderdate"))), F.lit("1990-01-01").cast("date")).cast("long")
    out = orders.groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("kinds"), first("1-URGENT").alias("urgent"), first("2-HIGH").alias("high"))
    return out.filter("kinds >= 2")


def action_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Resolution methods with their counts, methods without any included."""
    found = records(spark, folder, "person_platform_identity", ["resolution_method"]).groupBy(F.col("resolution_method").alias("method")).agg(F.count("*").alias("n"))
    return spark.createDataFrame([(m,) for m in METHODS], "method string").join(found, "method", "left").select("method", F.coalesce("n", F.lit(0)).alias("n"))


def best_identity(spark: SparkSession, folder: str) -> DataFrame:
    """The three accounts of most confidence of each person, in order, as one text."""
    ids = records(spark, folder, "person_platform_identity", ["person_id", "platform", "resolution_confidence"])
    top = ids.withColumn("k", F.row_number().over(Window.partitionBy("person_id").orderBy(F.desc_nulls_last("resolution_confidence"), "id"))).filter("k <= 3")
    return top.groupBy("person_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "platform"))), lambda x: x["platform"]), ">").alias("platforms"))


def missing_handles(spark: SparkSession, folder: str) -> DataFrame:
    """Authors of the forum that no account names: a set difference of handles."""
    authors = records(spark, folder, "raw_reddit_item", ["author"]).select(X.normalize_handle("author").alias("handle")).filter("handle not in ('', '[deleted]')")
    return authors.distinct().join(table(spark, folder, "person_platform_identity").filter("platform = 'reddit'").select(X.normalize_handle("handle").alias("handle")).distinct(), "handle", "left_anti")


def external_links(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts behind the profile links of identities: host and handle."""
    ids = records(spark, folder, "person_platform_identity", ["profile_url"]).filter("profile_url is not null")
    return ids.select("id", X.url_host("profile_url").alias("host"), F.lower(X.first_path_segment("profile_url")).alias("handle"))


def ingestion_delay(spark: SparkSession, folder: str) -> DataFrame:
    """Whole days between posting and ingesting by platform: average, longest, and late ones."""
    said = records(spark, folder, "communication", ["source_platform", "posted_at", "ingested_at"])
    days = F.floor((F.unix_micros("ingested_at") - F.unix_micros("posted_at")) / 86_400_000_000)
    return said.withColumn("d", days).groupBy("source_platform").agg(F.max("d").alias("longest"), F.count(F.when(F.col("d") > 30, 1)).alias("late"), F.count("*").alias("n"))


def hashed_mails(spark: SparkSession, folder: str) -> DataFrame:
    """Persons by the hash of their address, without the address."""
    person = records(spark, folder, "person", ["primary_email"]).filter("primary_email is not null")
    return person.select("id", F.sha2(X.normalize_email("primary_email"), 256).alias("mail_hash"))


def upcoming_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events that are yet to come or running, by format and program, with their registrations."""
    event = records(spark, folder, "community_event", ["starts_at", "ends_at", "event_format", "program_type", "registered_count"])
    ahead = event.filter(F.coalesce("ends_at", "starts_at") >= as_of())
    return ahead.groupBy(F.coalesce("event_format", F.lit("unknown")).alias("event_format"), F.coalesce("program_type", F.lit("unknown")).alias("program_type")).agg(F.count("*").alias("n"), F.coalesce(F.sum("registered_count"), F.lit(0)).alias("registered"))


_P, _C, _I, _E, _R = (latest_sql(t) for t in ("person", "communication", "person_platform_identity", "community_event", "raw_reddit_item"))
QUERIES = {f.__name__: f for f in (champions_by_company, program_conversions, action_counts, best_identity, missing_handles, external_links, ingestion_delay, hashed_mails, upcoming_events)}
SQL = {
    "champions_by_company": f"WITH t AS (SELECT author_person_id AS id, count(*) AS n FROM {_C} GROUP BY 1) SELECT p.employer_company_id, count(DISTINCT p.id) AS champions, CAST(coalesce(sum(t.n), 0) AS BIGINT) AS talk, any_value(c.canonical_name) AS canonical_name FROM {_P} p JOIN company c ON c.id = p.employer_company_id LEFT JOIN t ON t.id = p.id "
    "WHERE p.is_active AND (p.lifecycle_stage IN ('ambassador', 'event_host') OR p.activity_score >= 50) GROUP BY 1 HAVING count(DISTINCT p.id) >= 2",
    "program_conversions": "SELECT o_custkey, count(DISTINCT o_orderpriority) AS kinds, date_diff('day', DATE '1990-01-01', CAST(min(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END) AS DATE)) AS urgent, date_diff('day', DATE '1990-01-01', CAST(min(CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderdate END) AS DATE)) AS high FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) >= 2",
    "action_counts": f"SELECT m.method, count(i.id) AS n FROM (SELECT unnest({list(METHODS)}) AS method) m LEFT JOIN {_I} i ON i.resolution_method = m.method GROUP BY 1",
    "best_identity": f"SELECT person_id, string_agg(platform, '>' ORDER BY k) AS platforms FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY resolution_confidence DESC NULLS LAST, id) AS k FROM {_I}) WHERE k <= 3 GROUP BY 1",
    "missing_handles": f"SELECT DISTINCT regexp_replace(lower(trim(author)), '^@', '') AS handle FROM {_R} WHERE regexp_replace(lower(trim(author)), '^@', '') NOT IN ('', '[deleted]') EXCEPT SELECT regexp_replace(lower(trim(handle)), '^@', '') FROM person_platform_identity WHERE platform = 'reddit'",
    "external_links": f"SELECT id, regexp_replace(lower(regexp_extract(profile_url, '^[a-z]+://([^/:?#]+)', 1)), '^www\\.', '') AS host, lower(nullif(regexp_extract(profile_url, '^[a-z]+://[^/]+/+([^/?#]+)', 1), '')) AS handle FROM {_I} WHERE profile_url IS NOT NULL",
    "ingestion_delay": f"SELECT source_platform, max(d) AS longest, count(*) FILTER (WHERE d > 30) AS late, count(*) AS n FROM (SELECT source_platform, CAST(floor((epoch_us(ingested_at) - epoch_us(posted_at)) / 86400000000) AS BIGINT) AS d FROM {_C}) GROUP BY 1",
    "hashed_mails": f"SELECT id, sha256(lower(trim(primary_email))) AS mail_hash FROM {_P} WHERE primary_email IS NOT NULL",
    "upcoming_events": f"SELECT coalesce(event_format, 'unknown') AS event_format, coalesce(program_type, 'unknown') AS program_type, count(*) AS n, CAST(coalesce(sum(registered_count), 0) AS BIGINT) AS registered FROM {_E} WHERE coalesce(ends_at, starts_at) >= {SQL_AS_OF} GROUP BY 1, 2",
}
