"""Queries of the rollup views and of what is read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import views
from ..tables import table
from .frames import SQL_AS_OF, SQL_ATTENDANCE, SQL_HOSTS, as_of, attendance, gatherings, hosts, latest_sql, records


def _city_signal(spark: SparkSession, folder: str) -> DataFrame:
    person = records(spark, folder, "person", ["canonical_name", "location_city", "location_country", "lifecycle_stage", "activity_score", "is_active"])
    event = records(spark, folder, "community_event", ["venue_city", "venue_country", "starts_at"])
    said = records(spark, folder, "communication", ["author_person_id", "posted_at", "is_about_cursor"])
    return views.city_signal(person, event, said, table(spark, folder, "city_coordinates"), as_of())


def city_signal(spark: SparkSession, folder: str) -> DataFrame:
    """The city view, its arrays and decimals in comparable form."""
    return _city_signal(spark, folder).withColumn("ambassador_names", F.array_join("ambassador_names", "|")).withColumn("avg_activity_score", F.col("avg_activity_score").cast("double"))


def plottable_cities(spark: SparkSession, folder: str) -> DataFrame:
    """Cities with coordinates that have events or leading people, most people first."""
    busy = _city_signal(spark, folder).dropna(subset=["latitude", "longitude"]).filter("total_event_count > 0 or ambassador_count > 0")
    return busy.select("location_city", F.coalesce("location_country", F.lit("")).alias("location_country"), "total_known_people", "total_event_count").orderBy(F.desc("total_known_people"), "location_city", "location_country").limit(50)


def underserved_cities(spark: SparkSession, folder: str) -> DataFrame:
    """Cities with people and talk but no recent event and nobody leading."""
    gap = _city_signal(spark, folder).filter("total_known_people >= 2 and event_count_last_180d = 0 and ambassador_count = 0")
    return gap.select("location_city", F.coalesce("location_country", F.lit("")).alias("location_country"), "total_known_people", "recent_mentions", F.col("avg_activity_score").cast("double").alias("avg_activity_score"))


def city_signal_joined(spark: SparkSession, folder: str) -> DataFrame:
    """The older, joined form of the city view over suppliers as persons and orders as events."""
    said = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.pmod(F.col("o_custkey"), F.lit(97)).cast("string").alias("author_person_id"), F.col("o_orderdate").cast("timestamp").alias("posted_at"), (F.col("o_orderpriority") < "3").alias("is_about_cursor"))
    out = views.city_signal_joined(hosts(spark, folder), attendance(spark, folder), gatherings(spark, folder), said, F.lit("1998-08-02 00:00:00").cast("timestamp"))
    return out.drop("location_country")


def events_with_organizers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as events with their organizers among the suppliers."""
    out = views.events_with_organizers(gatherings(spark, folder), attendance(spark, folder), hosts(spark, folder), table(spark, folder, "city_coordinates"))
    told = F.transform("organizers", lambda o: F.concat_ws(":", o["person_id"], o["name"], o["role"]))
    return out.select("id", F.size("organizers").alias("n_organizers"), F.array_join(told, "|").alias("organizers"), "organizer_names_csv")


def event_places(spark: SparkSession, folder: str) -> DataFrame:
    """Community events with the coordinates of their city."""
    event = records(spark, folder, "community_event", ["title", "program_type", "status", "venue_city", "venue_country", "registered_count", "attended_count"])
    return views.with_coordinates(event, table(spark, folder, "city_coordinates"), "venue_city", "venue_country")


def person_activity(spark: SparkSession, folder: str) -> DataFrame:
    """The activity view of persons by what they said; without attendance or artifacts in these tables."""
    person = records(spark, folder, "person", ["canonical_name", "location_city", "location_country", "lifecycle_stage", "activity_score", "is_active", "last_observed_at"])
    said = records(spark, folder, "communication", ["author_person_id", "posted_at"])
    made = records(spark, folder, "community_event", ["host_company_id", "created_at"]).select("id", F.col("host_company_id").alias("creator_person_id"), "created_at")
    none = attendance(spark, folder)
    out = views.person_activity(person, none, said, made, as_of())
    return out.select("person_id", "event_count", "communication_count", "artifact_count", F.unix_micros("last_activity_at").alias("last_us"), F.col("recency_score").cast("double").alias("recency_score"))


def host_activity(spark: SparkSession, folder: str) -> DataFrame:
    """The activity view of suppliers by attendance."""
    none = table(spark, folder, "orders").limit(0).select(F.lit("").alias("author_person_id"), F.col("o_orderdate").cast("timestamp").alias("posted_at"))
    made = none.select(F.lit("").alias("creator_person_id"), F.col("posted_at").alias("created_at"))
    out = views.person_activity(hosts(spark, folder), attendance(spark, folder), none, made, F.lit("1998-12-31 00:00:00").cast("timestamp"))
    return out.select("person_id", "event_count", "organizer_event_count", F.unix_micros("last_activity_at").alias("last_us"), F.col("recency_score").cast("double").alias("recency_score"))


def organizer_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Who could organize in the most frequent city and country."""
    person = records(spark, folder, "person", ["location_city", "location_country", "activity_score", "is_active", "lifecycle_stage"])
    place = person.dropna(subset=["location_city", "location_country"]).groupBy("location_city", "location_country").count().orderBy(F.desc("count"), "location_city", "location_country").first()
    city, country = (place["location_city"], place["location_country"]) if place else ("", "")
    out = views.organizer_candidates(
        person, records(spark, folder, "communication", ["author_person_id", "posted_at", "is_about_cursor"]), records(spark, folder, "person_platform_identity", ["person_id", "follower_count"]), city, country, as_of()
    )
    return out.withColumn("score", F.round("score", 6))


_LEADS = "lifecycle_stage IN ('ambassador', 'regional_lead')"
_CITY = f"""
ev AS (SELECT venue_city AS c, venue_country AS l, count(DISTINCT id) AS n, count(DISTINCT CASE WHEN starts_at > {SQL_AS_OF} - INTERVAL 180 DAY THEN id END) AS n180
  FROM {latest_sql("community_event")} WHERE venue_city IS NOT NULL GROUP BY 1, 2),
pe AS (SELECT location_city AS c, location_country AS l, count(DISTINCT id) AS n, count(DISTINCT CASE WHEN {_LEADS} THEN id END) AS lead,
  (2 * CAST(sum(activity_score) * 100 AS BIGINT) + count(activity_score)) // (2 * count(activity_score)) / CAST(100.0 AS DOUBLE) AS score, list_sort(array_agg(DISTINCT canonical_name) FILTER (WHERE {_LEADS} AND canonical_name IS NOT NULL)) AS names
  FROM {latest_sql("person")} WHERE location_city IS NOT NULL AND is_active GROUP BY 1, 2),
co AS (SELECT p.location_city AS c, p.location_country AS l, count(DISTINCT m.id) AS n, count(DISTINCT CASE WHEN m.posted_at > {SQL_AS_OF} - INTERVAL 90 DAY AND m.is_about_cursor THEN m.id END) AS n90
  FROM {latest_sql("person")} p JOIN {latest_sql("communication")} m ON m.author_person_id = p.id WHERE p.location_city IS NOT NULL GROUP BY 1, 2),
ac AS (SELECT c, l FROM ev UNION SELECT c, l FROM pe),
city AS (SELECT ac.c AS location_city, ac.l AS location_country, CAST(coalesce(pe.n, 0) AS BIGINT) AS total_known_people, CAST(coalesce(pe.lead, 0) AS BIGINT) AS ambassador_count,
  CAST(coalesce(ev.n180, 0) AS BIGINT) AS event_count_last_180d, CAST(coalesce(ev.n, 0) AS BIGINT) AS total_event_count, CAST(coalesce(pe.score, 0) AS DOUBLE) AS avg_activity_score,
  CAST(coalesce(co.n90, 0) AS BIGINT) AS recent_mentions, CAST(coalesce(co.n, 0) AS BIGINT) AS total_communication_count, coalesce(array_to_string(pe.names, '|'), '') AS ambassador_names, cc.latitude, cc.longitude
  FROM ac LEFT JOIN pe ON pe.c = ac.c AND pe.l IS NOT DISTINCT FROM ac.l LEFT JOIN ev ON ev.c = ac.c AND ev.l IS NOT DISTINCT FROM ac.l
  LEFT JOIN co ON co.c = ac.c AND co.l IS NOT DISTINCT FROM ac.l LEFT JOIN city_coordinates cc ON lower(cc.city) = lower(ac.c) AND lower(cc.country) = lower(coalesce(ac.l, '')))
"""

QUERIES = {
    "city_signal": city_signal, "plottable_cities": plottable_cities, "underserved_cities": underserved_cities, "city_signal_joined": city_signal_joined,
    "events_with_organizers": events_with_organizers, "event_places": event_places, "person_activity": person_activity, "host_activity": host_activity, "organizer_candidates": organizer_candidates,
}
SQL = {
    "city_signal": f"WITH {_CITY} SELECT * FROM city",
    "plottable_cities": f"WITH {_CITY} SELECT location_city, coalesce(location_country, '') AS location_country, total_known_people, total_event_count FROM city WHERE latitude IS NOT NULL AND longitude IS NOT NULL "
    "AND (total_event_count > 0 OR ambassador_count > 0) ORDER BY total_known_people DESC, location_city, location_country LIMIT 50",
    "underserved_cities": f"WITH {_CITY} SELECT location_city, coalesce(location_country, '') AS location_country, total_known_people, recent_mentions, avg_activity_score FROM city "
    "WHERE total_known_people >= 2 AND event_count_last_180d = 0 AND ambassador_count = 0",
    "city_signal_joined": f"""WITH said AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey % 97 AS VARCHAR) AS author, o_orderdate AS posted_at, o_orderpriority < '3' AS about FROM orders)
SELECT p.location_city, count(DISTINCT p.id) AS total_known_people, count(DISTINCT CASE WHEN p.{_LEADS} THEN p.id END) AS ambassador_count,
  coalesce((SELECT count(DISTINCT o_orderkey) FROM {SQL_HOSTS} q JOIN {SQL_ATTENDANCE} a ON a.person_id = q.id JOIN orders ON CAST(o_orderkey AS VARCHAR) = a.event_id AND o_orderdate > TIMESTAMP '1998-08-02' - INTERVAL 180 DAY WHERE q.location_city = p.location_city), 0) AS event_count_last_180d,
  coalesce((SELECT count(DISTINCT s.id) FROM {SQL_HOSTS} q JOIN said s ON s.author = q.id AND s.posted_at > TIMESTAMP '1998-08-02' - INTERVAL 90 DAY AND s.about WHERE q.location_city = p.location_city), 0) AS recent_mentions
FROM {SQL_HOSTS} p GROUP BY p.location_city""",
    "events_with_organizers": f"""WITH o AS (SELECT a.event_id, count(*) AS n, string_agg(p.canonical_name, ', ' ORDER BY CASE a.role WHEN 'organizer' THEN 0 ELSE 1 END, p.canonical_name) AS names, string_agg(concat_ws(':', p.id, p.canonical_name, a.role), '|' ORDER BY CASE a.role WHEN 'organizer' THEN 0 ELSE 1 END, p.canonical_name) AS told
  FROM {SQL_ATTENDANCE} a JOIN {SQL_HOSTS} p ON p.id = a.person_id WHERE a.role IN ('organizer', 'co_organizer') GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(coalesce(o.n, 0) AS INTEGER) AS n_organizers, coalesce(o.told, '') AS organizers, coalesce(o.names, '') AS organizer_names_csv FROM orders LEFT JOIN o ON o.event_id = CAST(o_orderkey AS VARCHAR)""",
    "event_places": f"SELECT e.id, title, program_type, status, venue_city, venue_country, registered_count, attended_count, latitude, longitude FROM {latest_sql('community_event')} e "
    "LEFT JOIN city_coordinates cc ON lower(cc.city) = lower(e.venue_city) AND lower(cc.country) = lower(coalesce(e.venue_country, ''))",
    "person_activity": f"""WITH c AS (SELECT author_person_id AS id, count(*) AS n, max(posted_at) AS at FROM {latest_sql("communication")} WHERE author_person_id IS NOT NULL GROUP BY 1),
x AS (SELECT p.id, coalesce(c.n, 0) AS n, greatest(c.at, p.last_observed_at) AS last FROM {latest_sql("person")} p LEFT JOIN c ON c.id = p.id WHERE p.is_active)
SELECT id AS person_id, CAST(0 AS BIGINT) AS event_count, n AS communication_count, CAST(0 AS BIGINT) AS artifact_count, epoch_us(last) AS last_us,
  round(CAST(1.0 AS DOUBLE) / greatest(1.0, (epoch_us({SQL_AS_OF}) - epoch_us(last)) / 86400000000.0), 4) AS recency_score FROM x""",
    "host_activity": f"""WITH e AS (SELECT person_id, count(DISTINCT event_id) AS n, count(DISTINCT CASE WHEN role IN ('organizer', 'co_organizer') THEN event_id END) AS o, max(attended_at) AS at FROM {SQL_ATTENDANCE} GROUP BY 1),
x AS (SELECT p.id, coalesce(e.n, 0) AS n, coalesce(e.o, 0) AS o, greatest(e.at, TIMESTAMP '1995-01-01') AS last FROM {SQL_HOSTS} p LEFT JOIN e ON e.person_id = p.id WHERE p.is_active)
SELECT id AS person_id, n AS event_count, o AS organizer_event_count, epoch_us(last) AS last_us,
  round(CAST(1.0 AS DOUBLE) / greatest(1.0, (epoch_us(TIMESTAMP '1998-12-31') - epoch_us(last)) / 86400000000.0), 4) AS recency_score FROM x""",
    "organizer_candidates": f"""WITH p AS (SELECT * FROM {latest_sql("person")}),
place AS (SELECT location_city, location_country FROM p WHERE location_city IS NOT NULL AND location_country IS NOT NULL GROUP BY 1, 2 ORDER BY count(*) DESC, 1, 2 LIMIT 1),
here AS (SELECT p.* FROM p JOIN place USING (location_city, location_country) WHERE is_active AND (lifecycle_stage IS NULL OR lifecycle_stage NOT IN ('ambassador', 'regional_lead')))
SELECT id AS person_id, round(CAST(0.4 AS DOUBLE) * activity_score + CAST(0.3 AS DOUBLE) * ln(1 + coalesce((SELECT max(follower_count) FROM {latest_sql("person_platform_identity")} i WHERE i.person_id = here.id), 0))
  + CAST(0.3 AS DOUBLE) * (SELECT count(*) FROM {latest_sql("communication")} c WHERE c.author_person_id = here.id AND c.is_about_cursor AND c.posted_at > {SQL_AS_OF} - INTERVAL 90 DAY), 6) AS score
FROM here ORDER BY score DESC NULLS FIRST, person_id LIMIT 20""",
}
