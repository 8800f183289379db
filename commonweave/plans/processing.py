"""Queries of the scalar functions, sources, writes, resolution, quality and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import jsonx
from ..functions import text as X
from ..functions.similarity import vector_of, vector_text
from ..operators import graph, quality, records as R, resolve as I, scoring
from ..sources import raw, sinks
from ..session import cut, ensure_checkpoint_dir
from ..streaming import ingest
from ..tables import latest_rows, table
from .frames import SQL_AS_OF, as_of, latest_sql, records

#: Words of the relevance query: what counts as a mention, and where and beside which words it counts more.
WORD, PRIMARY, SECONDARY = "agent", ("programming",), ("webdev", "learnprogramming", "localllama", "machinelearning")
BOOSTS = {"editor": 0.15, "ai": 0.1, "coding": 0.1, "plan": 0.1, "mode": 0.05, "prompt": 0.1}
NEGATIVES = {"sql": 0.1, "travel": 0.1, "insurance": 0.1, "mouse": 0.05}


def scalar_text(spark: SparkSession, folder: str) -> DataFrame:
    """Names, addresses, handles and links in normalized form."""
    person = records(spark, folder, "person", ["canonical_name", "primary_email", "location_city", "location_country"])
    return person.select(
        "id", X.normalize_name("canonical_name").alias("name"), X.name_core("canonical_name").alias("core"), X.email_domain("primary_email").alias("domain"), X.place_label("location_city", "location_country").alias("place"),
        X.short_hash(X.normalize_email("primary_email")).alias("email_hash"), X.encode_component("location_city").alias("encoded"),
    )


def handle_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Handles that a name suggests, joined to the handles that exist."""
    person = records(spark, folder, "person", ["canonical_name"]).filter("canonical_name is not null")
    variants = person.select(F.col("id").alias("person_id"), F.explode(X.handle_variants("canonical_name")).alias("variant"))
    ids = records(spark, folder, "person_platform_identity", ["handle", "platform"]).select(F.col("id").alias("identity_id"), "platform", F.regexp_replace(X.normalize_handle("handle"), "[^a-z0-9]", "").alias("variant"))
    return variants.join(ids, "variant").groupBy("platform").agg(F.count_distinct("identity_id").alias("identities"), F.count_distinct("person_id").alias("persons"))


def text_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Snippet lengths, tokens and mentions of each text."""
    words = X.word_tokens("content_text")
    derived = {
        "n_tokens": F.size(words), "n_words": F.size(F.array_distinct(words)), "cut": F.length(F.substring("content_text", 1, 80)), "host": X.url_host("content_url"),
        "is_redacted": X.redacted("content_text").isNull(), "is_text": F.col("content_text").isNotNull(),
    }
    return records(spark, folder, "communication", [], derived).filter("is_text").drop("is_text")


def text_relevance(spark: SparkSession, folder: str) -> DataFrame:
    """How relevant each forum item is, and the communities by share of relevant items."""
    items = table(spark, folder, "raw_reddit_item").withColumn("t", F.concat_ws(" ", "title", "selftext", "body"))
    items = items.select("thing_id", "fetched_at", scoring.text_relevance("t", "subreddit", WORD, PRIMARY, SECONDARY, BOOSTS, NEGATIVES).alias("relevance"))
    scored = latest_rows(items, ["thing_id"], [F.col("fetched_at")])
    return scored.filter("relevance > 0").select("thing_id", "relevance")


def relevance_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Texts by tenth of their relevance score, empty tenths included."""
    return quality.confidence_histogram(records(spark, folder, "communication", ["cursor_relevance_score"]), "cursor_relevance_score")


def resolution_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Confident resolutions against verified ones: counts of agreement."""
    ids = records(spark, folder, "person_platform_identity", ["resolution_confidence", "resolution_method"])
    return quality.confusion(ids.select((F.col("resolution_confidence") >= 0.92).cast("int").alias("p"), F.col("resolution_method").isin("human_verified", "explicit_link").cast("int").alias("a")), "p", "a").withColumn("accuracy", F.round("accuracy", 6))


def identity_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Persons with an account."""
    return quality.coverage(records(spark, folder, "person", []), "id", table(spark, folder, "person_platform_identity"), "person_id").withColumn("share", F.round("share", 6))


def unknown_employers(spark: SparkSession, folder: str) -> DataFrame:
    """Employers that persons name and the company table lacks, with their persons."""
    person = records(spark, folder, "person", ["employer_company_id"])
    return R.orphans(person, "employer_company_id", table(spark, folder, "company"), "id").groupBy("employer_company_id").agg(F.count("*").alias("n"))


def _merged_into(spark: SparkSession, folder: str) -> DataFrame:
    """(old_id, new_id): each merged person and the least of its group."""
    group = table(spark, folder, "person_merge").select("group_id", "person_id").dropna().distinct()
    least = group.groupBy("group_id").agg(F.min("person_id").alias("new_id"))
    return group.join(least, "group_id").filter("person_id <> new_id").select(F.col("person_id").alias("old_id"), "new_id")


def merged_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts with persons replaced by the least person of their merge group: writes of a merge, counted."""
    merged = _merged_into(spark, folder)
    moved = R.repoint(records(spark, folder, "person_platform_identity", ["person_id", "platform", "handle"]), "person_id", merged)
    return moved.groupBy("person_id").agg(F.count("*").alias("n"), F.count_distinct("platform").alias("platforms"))


def merged_persons(spark: SparkSession, folder: str) -> DataFrame:
    """Persons after the merge: who stays active."""
    merged = _merged_into(spark, folder)
    return R.merge_persons(records(spark, folder, "person", ["is_active"]), merged).select("id", "is_active", "merged_into")


def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Write-once: the earliest row of each forum thing into an empty store."""
    rows = table(spark, folder, "raw_reddit_item").select("thing_id", "score", "fetched_at")
    return R.insert_once(rows.limit(0), rows, ["thing_id"], "fetched_at").select("thing_id", "score", F.unix_micros("fetched_at").alias("at"))


def latest_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Latest-wins: the rows of 2025 on top of those before."""
    rows = table(spark, folder, "communication").select("id", "engagement_likes", "ingested_at")
    split = F.lit("2025-06-01 00:00:00").cast("timestamp")
    old = R.upsert(rows.limit(0), rows.filter(F.col("ingested_at") < split), ["id"], "ingested_at")
    return R.upsert(old, rows.filter(F.col("ingested_at") >= split), ["id"], "ingested_at").select("id", "engagement_likes")


def interaction_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges of replies and mentions between forum authors, their strength by different records."""
    items = records(spark, folder, "raw_reddit_item", ["parent_id", "author", "created_utc"], {"handles": X.mentioned_handles("body", "author")})
    plain = items.select(F.lower("thing_id").alias("item"), F.lower(F.regexp_replace("parent_id", r"[\s\"]", "")).alias("parent"), F.when(~F.col("author").isin("[deleted]", ""), F.lower("author")).alias("author"), F.timestamp_seconds("created_utc").alias("seen_at"), "handles")
    replies = graph.reply_edges(plain, "item", "parent", "author")
    known = plain.filter("author is not null").select(F.col("author").alias("handle"), F.col("author").alias("person")).distinct()
    said = plain.filter("author is not null and size(handles) > 0").select("author", F.col("item").alias("record_id"), "seen_at", "handles")
    edges = R.edges_from_observations(replies.unionByName(graph.mention_edges(said, known)))
    return edges.select("src", "dst", "edge_type", "strength")


def forum_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Forum items written as nested listings and read back by the listing parser, then normalized."""
    rows = records(spark, folder, "raw_reddit_item", ["kind", "subreddit", "title", "selftext", "author", "author_fullname", "parent_id", "link_id", "body", "created_utc", "score", "num_comments", "permalink"])
    data = F.struct(F.substring("thing_id", 4, 99).alias("id"), *[c for c in rows.columns if c not in ("thing_id", "kind")])
    page = F.to_json(F.struct(F.lit("Listing").alias("kind"), F.struct(F.array(F.struct("kind", data.alias("data"))).alias("children")).alias("data")))
    things = raw.forum_communications(raw.forum_things(rows.select(page.alias("payload"))))
    return things.select("source_record_id", F.length("content_text").alias("size"), F.col("author_handle_raw").isNull().alias("no_author"), "engagement_likes", F.unix_micros("posted_at").alias("at"))


def news_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Talk of the news site written as search pages, stories and comments, and read back."""
    said = records(spark, folder, "communication", ["source_platform", "source_record_id", "author_handle_raw", "content_text", "content_url", "engagement_likes", "posted_at"]).filter("source_platform = 'hackernews'")
    story = F.coalesce(F.col("engagement_likes") % 2, F.lit(0)) == 1
    hit = F.struct(
        F.col("id").alias("objectID"), F.col("author_handle_raw").alias("author"), F.col("engagement_likes").alias("points"), F.when(~story, F.col("content_text")).alias("comment_text"), F.when(story, F.lit("Title")).alias("title"),
        F.when(story, F.col("content_text")).alias("story_text"), F.when(story, F.col("content_url")).alias("url"), F.unix_seconds("posted_at").alias("created_at_i"), F.array(F.concat(F.lit("author_"), "author_handle_raw"), F.when(story, "story").otherwise("comment")).alias("_tags"),
    )
    page = F.to_json(F.struct(F.array(hit).alias("hits"), F.lit(0).alias("page"), F.lit(1).alias("nbPages")))
    back = raw.news_communications(raw.news_hits(said.select(page.alias("payload"))))
    return back.select("source_record_id", "item_type", F.length("content_text").alias("size"), "content_url", F.coalesce("engagement_likes", F.lit(0)).alias("points"), F.size("topic_tags").alias("n_tags"))


def thread_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Comments written as replies to replies, three deep, and flattened again: each with its own fields."""
    rows = records(spark, folder, "raw_reddit_item", ["kind", "subreddit", "author", "parent_id", "link_id", "body", "created_utc", "score", "permalink"]).filter("kind = 't1'")
    fields = [c for c in rows.columns if c not in ("thing_id", "kind", "author", "body")]

    def comment(level: int, replies: Column | None) -> Column:
        own = [F.concat(F.substring("thing_id", 4, 99), F.lit(f"-{level}")).alias("id"), F.lit("writer").alias("author"), F.lit("text").alias("body"), *[F.coalesce(c, F.lit("0")).alias(c) if c in ("parent_id", "link_id", "permalink", "subreddit") else F.coalesce(c, F.lit(0)).alias(c) for c in fields]]
        return F.struct(F.lit("t1").alias("kind"), F.struct(*own, *([replies.alias("replies")] if replies is not None else [])).alias("data"))

    nested = comment(2, None)
    for level in (1, 0):
        inner = F.struct(F.lit("Listing").alias("kind"), F.struct(F.array(nested).alias("children")).alias("data"))
        nested = comment(level, inner)
    page = F.to_json(F.struct(F.lit("Listing").alias("kind"), F.struct(F.array(nested).alias("children")).alias("data")))
    return raw.forum_things(rows.select(page.alias("payload"))).select("id", "score", "subreddit")


def account_identities(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts that profiles name."""
    return raw.profile_identities(records(spark, folder, "github_profile", ["login", "bio", "blog", "twitter_username"])).groupBy("platform").agg(F.count("*").alias("n"), F.count_distinct("handle").alias("handles"))


def json_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of JSON payloads by type of event, and how many payloads differ."""
    events = table(spark, folder, "events").select("event_type", "props")
    return events.groupBy("event_type").agg(F.sum(jsonx.first_number(F.col("props"), "missing", "k")).cast("long").alias("total"), F.count_distinct(jsonx.payload_hash(F.col("props"))).alias("payloads"))


def vector_text_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors written as text and read back: their sizes and sums."""
    v = table(spark, folder, "embeddings").select("vec_id", vector_of(vector_text(F.col("embedding"))).alias("v"))
    return v.select("vec_id", F.size("v").alias("size"), F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double")), 4).alias("total"))


def map_features(spark: SparkSession, folder: str) -> DataFrame:
    """Places with coordinates as GeoJSON points."""
    return sinks.geo_features(table(spark, folder, "city_coordinates").select("city_id", "city", "longitude", "latitude"), "longitude", "latitude").select(F.get_json_object("feature", "$.properties.city_id").cast("long").alias("city_id"), F.get_json_object("feature", "$.geometry.coordinates[1]").cast("double").alias("latitude"))


def quarantined_events(spark: SparkSession, folder: str) -> DataFrame:
    """Community events that break a rule, with the rules."""
    event = records(spark, folder, "community_event", ["title", "starts_at", "ends_at", "venue_city", "registered_count", "attended_count"])
    rules = {"has_city": F.length(F.trim("venue_city")) > 0, "has_title": F.length(F.trim("title")) > 0, "has_start": F.col("starts_at").isNotNull(), "ends_after_start": F.col("ends_at").isNull() | (F.col("ends_at") >= F.col("starts_at")), "attended_within": F.col("attended_count").isNull() | F.col("registered_count").isNull() | (F.col("attended_count") <= F.col("registered_count"))}
    return R.split_valid(event, rules)[1].select("id", F.array_join("broken_rules", ",").alias("broken"))


def signal_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Persons inactive for 180 days, and talk that still counts after 90."""
    person = records(spark, folder, "person", ["last_observed_at", "lifecycle_stage"])
    return person.groupBy(F.coalesce("lifecycle_stage", F.lit("none")).alias("stage")).agg(F.count(F.when(scoring.inactive(F.col("last_observed_at"), as_of()), 1)).alias("inactive"), F.count(F.when(scoring.still_holds(F.col("last_observed_at"), 90, as_of()), 1)).alias("fresh"))


def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Events by day and type, in batch form."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.windowed_counts(events, "ts", "event_type", "value", "1 day", "2 days").select(F.unix_micros("window_start").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))


def event_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of users, ended by 30 minutes of silence."""
    s = table(spark, folder, "events").groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return s.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


def event_stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The same windows as a stream over the file, run to its end: complete up to the watermark and beyond it."""
    events = table(spark, folder, "events")
    stream = ingest.windowed_counts(spark.readStream.schema(events.schema).parquet(f"{folder}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type", "value", "1 day", "2 days")
    place = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    return ingest.run_to_table(stream, place, "complete").select(F.unix_micros("window_start").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))


def latest_event_state(spark: SparkSession, folder: str) -> DataFrame:
    """The last event of each user, of an append-only log."""
    return ingest.latest_state(table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts").select("user_id", "event_id", "event_type")


def person_resolution(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles as incoming records resolved against active persons: actions by count."""
    none_a, none_s = F.array().cast("array<string>"), F.lit(None).cast("string")
    person = records(spark, folder, "person", ["canonical_name", "names_seen", "emails_seen", "primary_email", "location_city", "location_country", "location_timezone", "employer_company_id", "is_active"]).filter("is_active")
    ids = records(spark, folder, "person_platform_identity", ["person_id", "platform", "handle"]).filter("handle is not null").groupBy(F.col("person_id").alias("id")).agg(F.collect_set(F.concat_ws(":", "platform", "handle")).alias("accounts"))
    stored = I.prepare(person.join(ids, "id", "left").select(
        "id", F.array_compact(F.concat(F.array("canonical_name"), F.coalesce("names_seen", none_a))).alias("names"), F.array_compact(F.concat(F.coalesce("emails_seen", none_a), F.array("primary_email"))).alias("emails"),
        F.col("location_city").alias("city"), F.col("location_country").alias("country"), F.col("location_timezone").alias("timezone"), F.col("employer_company_id").alias("employer"), "accounts",
        none_s.alias("github"), none_s.alias("twitter"), none_s.alias("linkedin"), none_a.alias("event_ids"), none_a.alias("connected_ids")), "id")
    profile = records(spark, folder, "github_profile", ["login", "name", "email", "location", "twitter_username"])
    incoming = I.prepare(profile.select(
        F.col("id").cast("string").alias("id"), F.array_compact(F.array("name")).alias("names"), F.array_compact(F.array("email")).alias("emails"), F.split("location", ",")[0].alias("city"), none_s.alias("country"), none_s.alias("timezone"),
        none_s.alias("employer"), F.array(F.concat(F.lit("github:"), "login")).alias("accounts"), none_s.alias("github"), F.col("twitter_username").alias("twitter"), none_s.alias("linkedin"), none_a.alias("event_ids"), none_a.alias("connected_ids")), "id")
    return I.resolve(incoming, stored).select("record", "action", "person", "confidence", "n_candidates")


def reconciled_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts of other persons that fit a person's name: a handle variant of one person only
    gives 0.92; else the most alike name core of at least 0.95, 0.85 and twice the surplus, 0.95 at most."""
    person = cut(records(spark, folder, "person", ["canonical_name", "is_active"]).filter("is_active").select(F.col("id").alias("person"), X.name_core("canonical_name").alias("core"), X.handle_variants("canonical_name").alias("variants")).filter("length(core) >= 5"))
    ids = cut(records(spark, folder, "person_platform_identity", ["person_id", "handle"]).select(F.col("id").alias("identity"), "person_id", F.regexp_replace(X.normalize_handle("handle"), "[^a-z0-9]", "").alias("slug")).filter("length(slug) >= 4"))
    variants = person.select("person", F.explode("variants").alias("slug"))
    only = variants.groupBy("slug").agg(F.min("person").alias("person"), F.max("person").alias("last")).filter("person = last").drop("last")
    exact = ids.join(only, "slug").filter("person <> person_id").select("identity", "person", F.lit(0.92).alias("confidence"))
    rest = ids.join(exact.select("identity"), "identity", "left_anti").filter("length(slug) >= 6")
    cores = person.filter("length(core) >= 6").select("person", "core")
    alike = I.alike_words(rest.select(F.col("slug").alias("value")), cores.select(F.col("core").alias("value")), 0.95, whole=True)
    # an account leaves out one person at most, its own, so the two first of a core and of a slug are enough
    two = lambda df, by, *order: df.withColumn("_k", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter("_k <= 2").drop("_k")
    fits = two(alike.withColumnRenamed("a", "slug").join(two(cores.withColumnRenamed("core", "b"), "b", "person"), "b"), "slug", F.desc("s"), "person")
    near = rest.join(fits.select("slug", "person", "s"), "slug").filter("person <> person_id")
    best = near.groupBy("identity").agg(F.min_by(F.struct("person", "s"), F.struct(-F.col("s"), "person")).alias("m"))
    fuzzy = best.select("identity", "m.person", F.least(F.lit(0.95), 0.85 + (F.col("m.s") - 0.95) * 2).alias("confidence"))
    return exact.unionByName(fuzzy).withColumn("confidence", F.round("confidence", 6))


def grouped_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Talk by platform and topic."""
    said = records(spark, folder, "communication", ["source_platform", "topic_tags"]).select("source_platform", F.explode("topic_tags").alias("topic"))
    return said.groupBy("source_platform", "topic").agg(F.count("*").alias("n")).select("source_platform", "topic", "n")


_P, _C, _I, _E, _R, _G = (latest_sql(t) for t in ("person", "communication", "person_platform_identity", "community_event", "raw_reddit_item", "github_profile"))
_MERGED = "(SELECT person_id AS old_id, new_id FROM (SELECT person_id, min(person_id) OVER (PARTITION BY group_id) AS new_id FROM (SELECT DISTINCT group_id, person_id FROM person_merge WHERE group_id IS NOT NULL AND person_id IS NOT NULL)) WHERE person_id <> new_id)"
_T = "lower(concat_ws(' ', title, selftext, body))"
_HAS = lambda w: f"list_contains(regexp_extract_all({_T}, '[a-z0-9_]+'), '{w}')"
_SCORE = " + ".join(["CAST(0.4 AS DOUBLE)", "CASE WHEN lower(subreddit) IN ('programming') THEN 0.4 WHEN lower(subreddit) IN ('webdev', 'learnprogramming', 'localllama', 'machinelearning') THEN 0.2 ELSE 0 END",
    *[f"CASE WHEN {_HAS(w)} THEN CAST({v} AS DOUBLE) ELSE 0 END" for w, v in BOOSTS.items()], *[f"CASE WHEN {_HAS(w)} THEN CAST(-{v} AS DOUBLE) ELSE 0 END" for w, v in NEGATIVES.items()]])
QUERIES = {f.__name__: f for f in (
    scalar_text, handle_candidates, text_measures, text_relevance, relevance_histogram, resolution_quality, identity_coverage, unknown_employers, merged_accounts, merged_persons, first_rows, latest_upsert,
    interaction_edges, forum_round_trip, news_round_trip, thread_round_trip, account_identities, json_numbers, vector_text_round_trip, map_features, quarantined_events, signal_windows, event_windows, event_sessions,
    event_stream_windows, latest_event_state, person_resolution, reconciled_accounts, grouped_sets,
)}
_WINDOWS = "SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2"
_NORM = lambda c: f"trim(regexp_replace(lower(strip_accents({c})), '\\s+', ' ', 'g'))"
_CORE = lambda c: f"regexp_replace(lower(strip_accents({c})), '[^a-z0-9]', '', 'g')"
_DOMAIN = lambda c: f"lower(coalesce(regexp_extract(trim({c}), '^.+@([^@]+)$', 1), ''))"
_SLUG = "regexp_replace(regexp_replace(lower(trim(handle)), '^@', ''), '[^a-z0-9]', '', 'g')"
#: Handles that a name suggests: (id, is_active, core, variant).
_VARIANTS = (
    f"(SELECT id, is_active, core, unnest(list_distinct(list_filter(v, lambda x: length(x) >= 4))) AS variant FROM (SELECT id, is_active, core, list_concat([array_to_string(p, '')], "
    f"CASE WHEN len(p) > 1 THEN [p[1] || p[-1][1], p[1][1] || p[-1], p[-1] || p[1]] ELSE [] END, list_filter([p[1], p[-1]], lambda x: length(x) >= 5)) AS v FROM "
    f"(SELECT id, is_active, {_CORE('canonical_name')} AS core, list_filter(string_split(regexp_replace({_NORM('canonical_name')}, '[^a-z0-9 ]', '', 'g'), ' '), lambda x: x <> '') AS p FROM {_P} WHERE canonical_name IS NOT NULL)))"
)
_FREE = repr(X.FREE_MAIL)
_DOMAINS = lambda c: f"list_filter(list_transform({c}, lambda x: coalesce(regexp_extract(x, '^.+@([^@]+)$', 1), '')), lambda d: d <> '' AND d NOT IN {_FREE})"
_RESOLUTION = f"""WITH r AS (SELECT CAST(id AS VARCHAR) AS record, list_filter([{_NORM('name')}], lambda x: x <> '') AS names, list_filter([lower(trim(email, ' '))], lambda x: contains(x, '@')) AS emails,
  nullif(lower(trim(split_part(location, ',', 1), ' ')), '') AS city, replace(lower(trim('github:' || login, ' ')), ':@', ':') AS acct, nullif(regexp_replace(lower(trim(twitter_username, ' ')), '^@', ''), '') AS tw FROM {_G}),
h AS (SELECT person_id, list(replace(lower(trim(concat_ws(':', platform, handle), ' ')), ':@', ':')) AS accts FROM {_I} WHERE handle IS NOT NULL GROUP BY 1),
p AS (SELECT id AS person, list_distinct(list_filter(list_transform(list_concat([canonical_name], coalesce(names_seen, [])), lambda x: {_NORM('x')}), lambda x: x <> '')) AS names,
  list_distinct(list_filter(list_transform(list_concat(coalesce(emails_seen, []), [primary_email]), lambda x: lower(trim(x, ' '))), lambda x: contains(x, '@'))) AS emails, nullif(lower(trim(location_city, ' ')), '') AS city, coalesce(accts, []) AS accts
  FROM {_P} LEFT JOIN h ON h.person_id = id WHERE is_active),
pa AS (SELECT person, unnest(accts) AS a FROM p), w AS (SELECT record, unnest(string_split(names[1], ' ')) AS w FROM r WHERE city IS NULL AND len(names) > 0), pw AS (SELECT person, unnest(flatten(list_transform(names, lambda n: string_split(n, ' ')))) AS w FROM p),
e AS (SELECT a.record, b.person FROM (SELECT record, unnest(emails) AS e FROM r) a JOIN (SELECT person, unnest(emails) AS e FROM p) b ON a.e = b.e), g AS (SELECT record, person FROM r JOIN pa ON pa.a = r.acct),
c AS (SELECT record, person, min(pr) AS pr FROM (SELECT *, 1 AS pr FROM e UNION ALL SELECT *, 2 FROM g UNION ALL SELECT record, person, 3 FROM r JOIN pa ON pa.a = 'twitter:' || r.tw
  UNION ALL SELECT record, person, 4 FROM r JOIN p ON r.city = p.city WHERE len(r.names) > 0 AND len(p.names) > 0
  UNION ALL SELECT record, person, 4 FROM w JOIN pw ON substr(w.w, 1, 3) = substr(pw.w, 1, 3) WHERE length(w.w) >= 2 AND length(pw.w) >= 2) GROUP BY 1, 2),
j0 AS (SELECT DISTINCT r.names[1] AS x, unnest(p.names) AS y FROM c JOIN r USING (record) JOIN p USING (person) WHERE len(r.names) > 0),
j1 AS (SELECT x, y, string_split(x, '') AS a, string_split(y, '') AS b, greatest(length(x), length(y)) // 2 - 1 AS reach FROM j0),
j2 AS (SELECT *, list_reduce(list_transform(range(1, len(a) + 1), lambda i: [i]), lambda acc, e: list_append(acc, coalesce(list_filter(range(greatest(1, e[1] - reach), least(len(b), e[1] + reach) + 1), lambda j: b[j] = a[e[1]] AND NOT list_contains(acc, j))[1], 0)), CAST([] AS BIGINT[])) AS t FROM j1),
j3 AS (SELECT *, list_transform(list_filter(range(1, len(a) + 1), lambda i: t[i] > 0), lambda i: a[i]) AS fa, list_transform(list_sort(list_filter(t, lambda v: v > 0)), lambda v: b[v]) AS fb FROM j2),
j4 AS (SELECT *, CASE WHEN x = y THEN 1.0 WHEN len(fa) = 0 THEN 0.0 ELSE (len(fa) / len(a) + len(fa) / len(b) + (len(fa) - len(list_filter(range(1, len(fa) + 1), lambda i: fa[i] <> fb[i])) / 2) / len(fa)) / 3 END AS s,
  CASE WHEN a[1] <> b[1] THEN 0 WHEN a[2] IS NULL OR b[2] IS NULL OR a[2] <> b[2] THEN 1 WHEN a[3] IS NULL OR b[3] IS NULL OR a[3] <> b[3] THEN 2 WHEN a[4] IS NULL OR b[4] IS NULL OR a[4] <> b[4] THEN 3 ELSE 4 END AS pre FROM j3),
j AS (SELECT x, y, CASE WHEN s IN (0, 1) THEN s ELSE s + pre * 0.1 * (1 - s) END AS jw FROM j4),
y AS (SELECT c.record, c.person, max(jw) AS lk FROM c JOIN r USING (record) JOIN (SELECT person, unnest(names) AS y FROM p) q USING (person) JOIN j ON j.x = r.names[1] AND j.y = q.y GROUP BY 1, 2),
l AS (SELECT c.record, c.person, pr, r.names AS rn, p.names AS pn, r.emails AS re, p.emails AS pe, r.city AS rc, p.city AS pc, r.tw, p.accts, coalesce(y.lk, 0) AS lk FROM c JOIN r USING (record) JOIN p USING (person) LEFT JOIN y USING (record, person)),
k AS (SELECT *, list_has_any(rn, pn) AS same FROM l WHERE pr < 4 OR (lk >= 0.8 AND (rc IS NULL OR rc = pc)) QUALIFY row_number() OVER (PARTITION BY record ORDER BY pr, lk DESC, person) <= 20),
n AS (SELECT *, CASE WHEN same THEN 1.0 WHEN lk >= 0.85 THEN greatest(0.5, (lk - 0.85) / 0.15) END AS nc FROM k),
s AS (SELECT record, person, list_filter([CASE WHEN same THEN {{'w': 0.4, 'c': 1.0}} WHEN nc IS NOT NULL THEN {{'w': 0.2, 'c': nc}} END, CASE WHEN list_has_any(re, pe) THEN {{'w': 0.95, 'c': 1.0}} END,
  CASE WHEN nc IS NOT NULL AND list_has_any({_DOMAINS('re')}, {_DOMAINS('pe')}) THEN {{'w': 0.6, 'c': nc}} END, CASE WHEN list_contains(accts, 'twitter:' || tw) THEN {{'w': 0.85, 'c': 1.0}} END, CASE WHEN rc = pc THEN {{'w': 0.2, 'c': 1.0}} END], lambda x: x IS NOT NULL) AS ev FROM n),
t AS (SELECT record, person, least(1.0, list_sum(list_transform(ev, lambda x: CAST(x.w * x.c AS DOUBLE))) / list_sum(list_transform(ev, lambda x: CAST(x.w AS DOUBLE))) + CASE WHEN len(ev) >= 2 THEN least(0.15, len(ev) * 0.03) ELSE 0 END) AS score FROM s WHERE len(ev) > 0),
b AS (SELECT record, arg_min(person, (-round(score, 9), person)) AS person, max(score) AS score, count(*) AS n FROM t GROUP BY 1),
x AS (SELECT record, min((pr, person))[2] AS linked FROM (SELECT *, 1 AS pr FROM e UNION ALL SELECT *, 2 FROM g) GROUP BY 1)
SELECT r.record, CASE WHEN linked IS NOT NULL OR score >= 0.85 THEN 'merge' WHEN score >= 0.65 THEN 'human_review' WHEN n > 0 THEN 'skip' ELSE 'create_new' END AS action, coalesce(linked, CASE WHEN score >= 0.65 THEN b.person END) AS person,
  CASE WHEN linked IS NOT NULL THEN 1.0 ELSE floor(coalesce(score, 0) * 100 + 0.5) / 100 END AS confidence, coalesce(n, 0) AS n_candidates FROM r LEFT JOIN b USING (record) LEFT JOIN x USING (record)"""
SQL = {
    "person_resolution": _RESOLUTION,
    "scalar_text": f"SELECT id, {_NORM('canonical_name')} AS name, {_CORE('canonical_name')} AS core, CASE WHEN primary_email IS NOT NULL THEN {_DOMAIN('primary_email')} ELSE '' END AS domain, "
    "CASE WHEN concat_ws(', ', nullif(trim(location_city, ' '), ''), nullif(trim(location_country, ' '), '')) = '' THEN '—' ELSE concat_ws(', ', nullif(trim(location_city, ' '), ''), nullif(trim(location_country, ' '), '')) END AS place, "
    f"substr(sha256(lower(trim(primary_email))), 1, 12) AS email_hash, replace(replace(replace(url_encode(location_city), '+', '%20'), '~', '%7E'), '%2A', '*') AS encoded FROM {_P}",
    "handle_candidates": f"SELECT i.platform, count(DISTINCT i.id) AS identities, count(DISTINCT v.id) AS persons FROM {_VARIANTS} v JOIN (SELECT id, platform, {_SLUG} AS slug FROM {_I}) i ON i.slug = v.variant GROUP BY 1",
    "account_identities": f"""WITH g AS (SELECT login, concat_ws(' ', bio, blog) AS about, twitter_username FROM {_G}),
f AS (SELECT login, 'github' AS platform, login AS h FROM g UNION ALL SELECT login, 'twitter', coalesce(nullif(trim(twitter_username, ' '), ''), nullif(regexp_extract(about, '(?i)(?:twitter|x)\\.com/@?([A-Za-z0-9_]{{2,}})', 1), '')) FROM g
  UNION ALL SELECT login, 'linkedin', nullif(regexp_extract(about, '(?i)linkedin\\.com/in/([A-Za-z0-9_-]+)', 1), '') FROM g),
d AS (SELECT DISTINCT login, platform, regexp_replace(lower(trim(h, ' ')), '^@', '') AS handle FROM f WHERE h IS NOT NULL)
SELECT platform, count(*) AS n, count(DISTINCT handle) AS handles FROM d GROUP BY 1""",
    "reconciled_accounts": f"""WITH i AS (SELECT id AS identity, person_id, {_SLUG} AS slug FROM {_I} WHERE length({_SLUG}) >= 4),
o AS (SELECT variant AS slug, min(id) AS person FROM {_VARIANTS} WHERE is_active AND length(core) >= 5 GROUP BY 1 HAVING count(DISTINCT id) = 1),
e AS (SELECT i.identity, o.person FROM i JOIN o USING (slug) WHERE o.person <> i.person_id),
n AS (SELECT i.identity, p.id AS person, jaro_winkler_similarity(i.slug, p.core) AS s FROM i, (SELECT DISTINCT id, core FROM {_VARIANTS} WHERE is_active AND length(core) >= 6) p
  WHERE length(i.slug) >= 6 AND p.id <> i.person_id AND i.identity NOT IN (SELECT identity FROM e) AND s >= 0.95)
SELECT identity, person, 0.92 AS confidence FROM e UNION ALL SELECT identity, arg_min(person, (-s, person)), round(least(0.95, 0.85 + (max(s) - 0.95) * 2), 6) FROM n GROUP BY 1""",
    "text_measures": f"SELECT id, len(regexp_extract_all(lower(content_text), '[a-z0-9_]+')) AS n_tokens, len(list_distinct(regexp_extract_all(lower(content_text), '[a-z0-9_]+'))) AS n_words, length(substring(content_text, 1, 80)) AS cut, "
    f"nullif(regexp_replace(lower(regexp_extract(content_url, '^[a-z]+://([^/:?#]+)', 1)), '^www\\.', ''), '') AS host, trim(content_text) IN ('[deleted]', '[removed]', '') AS is_redacted FROM {_C} WHERE content_text IS NOT NULL",
    "text_relevance": f"SELECT thing_id, floor(greatest(0, least(1, {_SCORE})) * 1000 + 0.5) / 1000 AS relevance FROM {_R} WHERE regexp_matches(concat_ws(' ', title, selftext, body), '\\b{WORD}\\b', 'i') AND floor(greatest(0, least(1, {_SCORE})) * 1000 + 0.5) > 0",
    "relevance_histogram": f"WITH b AS (SELECT CASE WHEN cursor_relevance_score >= 1 THEN 10 ELSE CAST(floor(least(cursor_relevance_score, 0.9999) * 10) AS INTEGER) END AS bucket FROM {_C} WHERE cursor_relevance_score IS NOT NULL) SELECT CAST(r.range AS INTEGER) AS bucket, count(b.bucket) AS n FROM range(11) r LEFT JOIN b ON b.bucket = r.range GROUP BY 1",
    "resolution_quality": f"SELECT count(*) FILTER (WHERE p AND a) AS tp, count(*) FILTER (WHERE p AND NOT a) AS fp, count(*) FILTER (WHERE NOT p AND NOT a) AS tn, count(*) FILTER (WHERE NOT p AND a) AS fn, round(count(*) FILTER (WHERE p = a) / count(*) FILTER (WHERE p IS NOT NULL AND a IS NOT NULL), 6) AS accuracy FROM (SELECT resolution_confidence >= 0.92 AS p, resolution_method IN ('human_verified', 'explicit_link') AS a FROM {_I})",
    "identity_coverage": "SELECT count(*) AS total, count(i.person_id) AS with_any, round(count(i.person_id) / count(*), 6) AS share FROM (SELECT DISTINCT id FROM person) p LEFT JOIN (SELECT DISTINCT person_id FROM person_platform_identity) i ON i.person_id = p.id",
    "unknown_employers": f"SELECT employer_company_id, count(*) AS n FROM {_P} WHERE employer_company_id IS NOT NULL AND employer_company_id NOT IN (SELECT id FROM company) GROUP BY 1",
    "merged_accounts": f"SELECT coalesce(m.new_id, i.person_id) AS person_id, count(*) AS n, count(DISTINCT platform) AS platforms FROM {_I} i LEFT JOIN {_MERGED} m ON m.old_id = i.person_id GROUP BY 1",
    "merged_persons": f"SELECT p.id, p.is_active AND m.new_id IS NULL AS is_active, m.new_id AS merged_into FROM {_P} p LEFT JOIN {_MERGED} m ON m.old_id = p.id",
    "first_rows": "SELECT thing_id, score, epoch_us(fetched_at) AS \"at\" FROM raw_reddit_item QUALIFY row_number() OVER (PARTITION BY thing_id ORDER BY fetched_at) = 1",
    "latest_upsert": f"SELECT id, engagement_likes FROM {_C}",
    "interaction_edges": f"""WITH i AS (SELECT lower(thing_id) AS item, lower(regexp_replace(parent_id, '[\\s"]', '', 'g')) AS parent, CASE WHEN author NOT IN ('[deleted]', '') THEN lower(author) END AS author, body FROM {_R}),
m AS (SELECT item, author, unnest(list_distinct(regexp_extract_all(lower(body), '(?:^|[^a-z0-9_@/])(?:@|/?u/)([a-z0-9][a-z0-9_-]{{2,}})', 1))) AS h FROM i WHERE author IS NOT NULL AND body IS NOT NULL)
SELECT c.author AS src, p.author AS dst, 'replies_to' AS edge_type, count(DISTINCT c.item) AS strength FROM i c JOIN i p ON p.item = c.parent WHERE c.author <> p.author GROUP BY 1, 2
UNION ALL SELECT m.author, m.h, 'mentions', count(DISTINCT m.item) FROM m WHERE m.h IN (SELECT author FROM i WHERE author IS NOT NULL) AND m.h <> m.author GROUP BY 1, 2""",
    "forum_round_trip": f"""WITH r AS (SELECT *, CASE WHEN trim(selftext) IN ('[deleted]', '[removed]', '') THEN NULL ELSE selftext END AS st, CASE WHEN trim(body) IN ('[deleted]', '[removed]', '') THEN NULL ELSE body END AS bd FROM {_R}
  WHERE coalesce(author, '') <> '' AND coalesce(subreddit, '') <> '' AND created_utc IS NOT NULL AND coalesce(permalink, '') <> '' AND (kind = 't3' AND coalesce(title, '') <> '' OR kind = 't1' AND body IS NOT NULL AND coalesce(parent_id, '') <> '' AND coalesce(link_id, '') <> ''))
SELECT kind || '_' || substr(thing_id, 4) AS source_record_id, length(CASE WHEN kind = 't3' THEN nullif(concat_ws(chr(10) || chr(10), title, st), '') ELSE bd END) AS size, author IN ('[deleted]', '[removed]', '') AS no_author, coalesce(score, 0) AS engagement_likes, CAST(created_utc * 1000000 AS BIGINT) AS "at" FROM r""",
    "news_round_trip": f"""SELECT id AS source_record_id, CASE WHEN story THEN 'story' ELSE 'comment' END AS item_type, length(t) AS size, CASE WHEN story THEN coalesce(content_url, 'https://news.ycombinator.com/item?id=' || id) ELSE 'https://news.ycombinator.com/item?id=' || id END AS content_url,
  coalesce(engagement_likes, 0) AS points, 1 AS n_tags FROM (SELECT *, coalesce(engagement_likes % 2, 0) = 1 AS story, CASE WHEN coalesce(engagement_likes % 2, 0) = 1 THEN concat_ws(chr(10) || chr(10), 'Title', content_text) ELSE content_text END AS t FROM {_C})
  WHERE source_platform = 'hackernews' AND trim(coalesce(author_handle_raw, '')) <> '' AND trim(coalesce(t, '')) NOT IN ('[deleted]', '[dead]')""",
    "thread_round_trip": f"SELECT substr(thing_id, 4) || '-' || k.k AS id, coalesce(score, 0) AS score, coalesce(subreddit, '0') AS subreddit FROM {_R}, (VALUES ('0'), ('1'), ('2')) k(k) WHERE kind = 't1' AND coalesce(parent_id, '0') <> '' AND coalesce(link_id, '0') <> '' AND coalesce(permalink, '0') <> '' AND coalesce(subreddit, '0') <> ''",
    "json_numbers": "SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS DOUBLE)) AS BIGINT) AS total, count(DISTINCT props) AS payloads FROM events GROUP BY 1",
    "vector_text_round_trip": "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS size, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total FROM embeddings",
    "map_features": "SELECT city_id, latitude FROM city_coordinates WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
    "quarantined_events": f"SELECT id, broken FROM (SELECT id, concat_ws(',', CASE WHEN NOT coalesce(length(trim(venue_city)) > 0, false) THEN 'has_city' END, CASE WHEN NOT coalesce(length(trim(title)) > 0, false) THEN 'has_title' END, CASE WHEN starts_at IS NULL THEN 'has_start' END, CASE WHEN NOT coalesce(ends_at IS NULL OR ends_at >= starts_at, false) THEN 'ends_after_start' END, CASE WHEN NOT coalesce(attended_count IS NULL OR registered_count IS NULL OR attended_count <= registered_count, false) THEN 'attended_within' END) AS broken FROM {_E}) WHERE broken <> ''",
    "signal_windows": f"SELECT coalesce(lifecycle_stage, 'none') AS stage, count(*) FILTER (WHERE last_observed_at < {SQL_AS_OF} - INTERVAL 180 DAY) AS inactive, count(*) FILTER (WHERE last_observed_at + INTERVAL 90 DAY > {SQL_AS_OF}) AS fresh FROM {_P} GROUP BY 1",
    "event_windows": _WINDOWS, "event_stream_windows": _WINDOWS,
    "event_sessions": "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g), n AS (SELECT user_id, k, count(*) AS n FROM s GROUP BY 1, 2) SELECT user_id, count(*) AS sessions, max(n) AS longest FROM n GROUP BY 1",
    "latest_event_state": "SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type FROM events GROUP BY 1",
    "grouped_sets": f"SELECT source_platform, topic, count(*) AS n FROM (SELECT source_platform, unnest(topic_tags) AS topic FROM {_C}) GROUP BY 1, 2",
}
