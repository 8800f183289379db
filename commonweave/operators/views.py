"""The rollup views: per city, per event and per person. Each is a pure function
of frames and of the time as of which it holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stages whose members speak for a place, and roles that run an event; fixed values.
LEADING_STAGES = ("ambassador", "regional_lead")
RUNNING_ROLES = ("organizer", "co_organizer")


def role_rank(role: str | Column) -> Column:
    """Organizers first, co-organizers second, others last."""
    r = F.col(role) if isinstance(role, str) else role
    return F.when(r == "organizer", 0).when(r == "co_organizer", 1).otherwise(2)


def with_coordinates(df: DataFrame, cities: DataFrame, city: str, country: str) -> DataFrame:
    """latitude and longitude of a city and country, joined regardless of case. The
    reference list is left to the size check of the optimizer, not forced to be broadcast."""
    where = cities.select(F.lower("city").alias("_city"), F.lower("country").alias("_land"), "latitude", "longitude")
    return df.join(where, (F.lower(city) == F.col("_city")) & (F.lower(F.coalesce(country, F.lit(""))) == F.col("_land")), "left").drop("_city", "_land")


def city_signal(person: DataFrame, event: DataFrame, communication: DataFrame, cities: DataFrame, as_of: Column) -> DataFrame:
    """People, events and talk of each city that has either people or events.

    Every input is aggregated by city before anything is joined, so the joins are
    between rollups; counts are of distinct ids. Only active persons count as
    people, while the talk of all authors counts.
    """
    leads = F.col("lifecycle_stage").isin(*LEADING_STAGES)
    events = event.filter("venue_city is not null").groupBy(F.col("venue_city").alias("city"), F.col("venue_country").alias("country")).agg(
        F.count_distinct("id").alias("total_event_count"),
        F.count_distinct(F.when(F.col("starts_at") > as_of - F.expr("INTERVAL 180 DAYS"), F.col("id"))).alias("event_count_last_180d"),
    )
    people = person.filter("location_city is not null and is_active").groupBy(F.col("location_city").alias("city"), F.col("location_country").alias("country")).agg(
        F.count_distinct("id").alias("total_known_people"), F.count_distinct(F.when(leads, F.col("id"))).alias("ambassador_count"),
        F.avg("activity_score").cast("decimal(6,2)").alias("avg_activity_score"), F.array_sort(F.collect_set(F.when(leads, F.col("canonical_name")))).alias("ambassador_names"),
    )
    recent = (F.col("posted_at") > as_of - F.expr("INTERVAL 90 DAYS")) & F.col("is_about_cursor")
    authored = communication.groupBy(F.col("author_person_id").alias("id")).agg(F.count_distinct("id").alias("n"), F.count_distinct(F.when(recent, F.col("id"))).alias("n_recent"))
    talk = person.filter("location_city is not null").select("id", F.col("location_city").alias("city"), F.col("location_country").alias("country")).join(authored, "id")
    talk = talk.groupBy("city", "country").agg(F.sum("n_recent").alias("recent_mentions"), F.sum("n").alias("total_communication_count"))
    places = events.select("city", "country").unionByName(people.select("city", "country")).distinct()

    def tied(df: DataFrame) -> tuple[DataFrame, Column]:
        renamed = df.withColumnsRenamed({"city": "_c", "country": "_l"})
        return renamed, (places["city"] == renamed["_c"]) & places["country"].eqNullSafe(renamed["_l"])

    out = places
    for part in (people, events, talk):
        right, on = tied(part)
        out = out.join(right, on, "left").drop("_c", "_l")
    out = with_coordinates(out, cities, "city", "country")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(
        F.col("city").alias("location_city"), F.col("country").alias("location_country"), zero("total_known_people"), zero("ambassador_count"), zero("event_count_last_180d"),
        zero("total_event_count"), F.coalesce("avg_activity_score", F.lit(0)).cast("decimal(6,2)").alias("avg_activity_score"), zero("recent_mentions"), zero("total_communication_count"),
        F.coalesce("ambassador_names", F.array().cast("array<string>")).alias("ambassador_names"), "latitude", "longitude",
    )


def city_signal_joined(person: DataFrame, person_event: DataFrame, event: DataFrame, communication: DataFrame, as_of: Column) -> DataFrame:
    """The older form of the city view: persons, attendance, events of the last 180
    days and talk joined outright, with distinct counts. To keep one person's events
    from multiplying their talk, each is counted by person first; the counts agree
    because an event or communication of several persons of a city is told apart by id."""
    base = person.filter("location_city is not null").select("id", F.col("location_city").alias("city"), F.col("location_country").alias("country"), "lifecycle_stage", "activity_score")
    recent = event.filter(F.col("starts_at") > as_of - F.expr("INTERVAL 180 DAYS")).select(F.col("id").alias("event_id"))
    gone = base.select("id", "city", "country").join(person_event.select(F.col("person_id").alias("id"), "event_id"), "id").join(recent, "event_id")
    events = gone.groupBy("city", "country").agg(F.count_distinct("event_id").alias("event_count_last_180d"))
    people = base.groupBy("city", "country").agg(F.count_distinct("id").alias("total_known_people"), F.count_distinct(F.when(F.col("lifecycle_stage").isin(*LEADING_STAGES), F.col("id"))).alias("ambassador_count"))
    said = communication.filter((F.col("posted_at") > as_of - F.expr("INTERVAL 90 DAYS")) & F.col("is_about_cursor")).select(F.col("author_person_id").alias("id"), F.col("id").alias("said_id"))
    talk = base.select("id", "city", "country").join(said, "id").groupBy("city", "country").agg(F.count_distinct("said_id").alias("recent_mentions"))
    out = people
    for part, name in ((events, "event_count_last_180d"), (talk, "recent_mentions")):
        right = part.withColumnsRenamed({"city": "_c", "country": "_l"})
        out = out.join(right, (out["city"] == right["_c"]) & out["country"].eqNullSafe(right["_l"]), "left").drop("_c", "_l").withColumn(name, F.coalesce(name, F.lit(0)))
    return out.withColumnsRenamed({"city": "location_city", "country": "location_country"})


def events_with_organizers(event: DataFrame, person_event: DataFrame, person: DataFrame, cities: DataFrame) -> DataFrame:
    """Each event with its coordinates, its organizers as an array of structs ordered
    by role and name, and their names as one text. The organizers are gathered once
    by event and serve both columns."""
    running = person_event.filter(F.col("role").isin(*RUNNING_ROLES)).join(person.select(F.col("id").alias("person_id"), "canonical_name"), "person_id")
    gathered = running.groupBy("event_id").agg(
        F.array_sort(F.collect_list(F.struct(role_rank("role").alias("rank"), F.col("canonical_name").alias("name"), "person_id", "role"))).alias("_o")
    )
    out = with_coordinates(event.join(gathered, event["id"] == gathered["event_id"], "left").drop("event_id"), cities, "venue_city", "venue_country")
    plain = F.transform(F.coalesce("_o", F.array().cast("array<struct<rank:int,name:string,person_id:string,role:string>>")), lambda o: F.struct(o["person_id"].alias("person_id"), o["name"].alias("name"), o["role"].alias("role")))
    return out.withColumn("organizers", plain).withColumn("organizer_names_csv", F.array_join(F.transform("organizers", lambda o: o["name"]), ", ")).drop("_o")


def person_activity(person: DataFrame, person_event: DataFrame, communication: DataFrame, artifact: DataFrame, as_of: Column) -> DataFrame:
    """Events, communications and artifacts of each active person, when they were last
    active, and a recency score of 1 / max(1, days since). Each input is aggregated by
    person first; greatest() passes over missing times."""
    events = person_event.groupBy("person_id").agg(
        F.count_distinct("event_id").alias("event_count"), F.count_distinct(F.when(F.col("role").isin(*RUNNING_ROLES), F.col("event_id"))).alias("organizer_event_count"),
        F.max(F.coalesce("attended_at", "registered_at")).alias("e_at"),
    )
    said = communication.filter("author_person_id is not null").groupBy(F.col("author_person_id").alias("person_id")).agg(F.count("*").alias("communication_count"), F.max("posted_at").alias("c_at"))
    made = artifact.filter("creator_person_id is not null").groupBy(F.col("creator_person_id").alias("person_id")).agg(F.count("*").alias("artifact_count"), F.max("created_at").alias("a_at"))
    out = person.filter("is_active").withColumnRenamed("id", "person_id")
    for part in (events, said, made):
        out = out.join(part, "person_id", "left")
    last = F.greatest("e_at", "c_at", "a_at", "last_observed_at")
    days = (F.unix_micros(as_of) - F.unix_micros(last)) / 86_400_000_000.0
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("event_count", "organizer_event_count", "communication_count", "artifact_count")]
    return out.select(
        "person_id", "canonical_name", "location_city", "location_country", "lifecycle_stage", "activity_score", *counts, last.alias("last_activity_at"),
        (1.0 / F.greatest(F.lit(1.0), days)).cast("decimal(6,4)").alias("recency_score"),
    )


def organizer_candidates(person: DataFrame, communication: DataFrame, identity: DataFrame, city: str, country: str, as_of: Column, n: int = 20) -> DataFrame:
    """(person_id, score) of the n active persons of a place, none of the leading
    stages, by activity, audience and recent talk. Talk and audience are aggregated
    only for the persons of the place."""
    local = person.filter((F.col("location_city") == city) & (F.col("location_country") == country) & F.col("is_active") & (F.col("lifecycle_stage").isNull() | ~F.col("lifecycle_stage").isin(*LEADING_STAGES)))
    local = local.select(F.col("id").alias("person_id"), "activity_score")
    recent = communication.filter(F.col("is_about_cursor") & (F.col("posted_at") > as_of - F.expr("INTERVAL 90 DAYS"))).join(local.select(F.col("person_id").alias("author_person_id")), "author_person_id", "left_semi")
    talk = recent.groupBy(F.col("author_person_id").alias("person_id")).agg(F.count("*").alias("posts"))
    heard = identity.join(local.select("person_id"), "person_id", "left_semi").groupBy("person_id").agg(F.max("follower_count").alias("audience"))
    score = 0.4 * F.col("activity_score").cast("double") + 0.3 * F.log1p(F.coalesce("audience", F.lit(0)).cast("double")) + 0.3 * F.coalesce("posts", F.lit(0))
    scored = local.join(talk, "person_id", "left").join(heard, "person_id", "left").select("person_id", score.alias("score"))
    return scored.orderBy(F.desc_nulls_first("score"), "person_id").limit(n)
