"""Problem 2 over person, community_event and github_profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from ..tables import latest_rows, table
from .places import Hints, map_places

#: Names of countries in several languages and as codes; fixed values.
COUNTRY_NAMES = {
    "austria": "austria osterreich oesterreich at aut",
    "brazil": "brazil brasil br bra",
    "canada": "canada kanada ca can",
    "france": "france frankreich fr fra",
    "germany": "germany deutschland allemagne alemania de ger deu",
    "india": "india bharat in ind",
    "japan": "japan nippon nihon jp jpn",
    "kenya": "kenya ke ken",
    "mexico": "mexico mx mex",
    "poland": "poland polska pl pol",
    "spain": "spain espana spanien es esp",
    "sweden": "sweden sverige schweden se swe",
    "united kingdom": "united_kingdom great_britain britain england scotland wales uk u.k. gb g.b. gbr",
    "united states": "united_states united_states_of_america usa u.s.a. us u.s. america the_united_states the_us the_usa",
}
#: Country of a time zone where each of its places lies; fixed values.
ZONE_COUNTRY = {
    "Europe/Vienna": "austria", "America/Sao_Paulo": "brazil", "America/Toronto": "canada", "Europe/Paris": "france", "Europe/Berlin": "germany",
    "Asia/Kolkata": "india", "Asia/Tokyo": "japan", "Africa/Nairobi": "kenya", "America/Mexico_City": "mexico", "Europe/Warsaw": "poland",
    "Europe/Madrid": "spain", "Europe/Stockholm": "sweden", "Europe/London": "united kingdom", "America/Chicago": "united states",
    "America/New_York": "united states", "America/Los_Angeles": "united states", "America/Denver": "united states",
}


def place_hints() -> Hints:
    """What this project knows of countries and time zones beside city_coordinates."""
    return Hints({word.replace("_", " "): land for land, words in COUNTRY_NAMES.items() for word in words.split()}, ZONE_COUNTRY)


def place_entries(spark: SparkSession, folder: str) -> DataFrame:
    """city_coordinates as (entry_id, name, country, other)."""
    return table(spark, folder, "city_coordinates").select(F.col("city_id").cast("long").alias("entry_id"), F.col("city").alias("name"), "country", F.col("local_name").alias("other"))


def place_values(spark: SparkSession, folder: str) -> DataFrame:
    """(source_table, record_id, text, country, zone): the place field of the
    latest row of each record."""
    none = F.lit(None).cast("string")
    parts = []
    for name, city, country, zone, seen in (
        ("person", "location_city", "location_country", "location_timezone", "last_observed_at"),
        ("community_event", "venue_city", "venue_country", "timezone", "updated_at"),
        ("github_profile", "location", None, None, "fetched_at"),
    ):
        rows = table(spark, folder, name).filter("id is not null").select(
            F.col("id").cast("string").alias("record_id"), F.col(city).alias("text"),
            (F.col(country) if country else none).alias("country"), (F.col(zone) if zone else none).alias("zone"), F.col(seen).cast("timestamp").alias("seen"),
        )
        # this partitioning serves the choice of rows and is kept for the look-up
        rows = rows.repartition(shuffle_partitions(spark), "record_id")
        rows = latest_rows(rows, ["record_id"], [F.col("seen")])
        parts.append(rows.select(F.lit(name).alias("source_table"), "record_id", "text", "country", "zone"))
    return reduce(DataFrame.unionByName, parts)


def mapped_places(spark: SparkSession, folder: str) -> DataFrame:
    """place_values with the entry that each typed place means, or -1."""
    return map_places(place_values(spark, folder), place_entries(spark, folder), place_hints())


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The entry of city_coordinates that each typed place means, or -1."""
    return mapped_places(spark, folder).select("source_table", "record_id", F.col("entry_id").alias("city_id"))


def p2_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """(place, source_table, n_records) of each typed value, folded to lower case and single blanks, that means no entry."""
    lost = mapped_places(spark, folder).filter("entry_id < 0")
    return lost.groupBy(F.lower(F.trim(F.regexp_replace("text", r"\s+", " "))).alias("place"), "source_table").agg(F.count("*").alias("n_records"))


QUERIES = {"p2_found": p2_found, "p2_unmatched": p2_unmatched}
SQL: dict[str, str] = {}
