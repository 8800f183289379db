"""Look-ups, lists, logs and checks: the everyday calls, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions import text as X
from ..operators import graph, lookup, quality, records as R, resolve as I
from ..sources import raw
from ..tables import table
from .frames import SQL_AS_OF, SQL_ATTENDANCE, SQL_HOSTS, as_of, attendance, gatherings, hosts, latest_sql, records


def persons_by_id(spark: SparkSession, folder: str) -> DataFrame:
    """The person of each id in person_merge: a point look-up for many keys."""
    return lookup.by_keys(records(spark, folder, "person", ["canonical_name", "is_active"]), "id", table(spark, folder, "person_merge"), "person_id")


def person_of_id(spark: SparkSession, folder: str) -> DataFrame:
    """One person by id: the least there is."""
    least = table(spark, folder, "person").agg(F.min("id").alias("id")).first()["id"]
    return lookup.point(table(spark, folder, "person").select("id", "canonical_name"), "id", least).distinct()


def employees(spark: SparkSession, folder: str) -> DataFrame:
    """Persons of each known employer."""
    person = records(spark, folder, "person", ["employer_company_id"])
    return lookup.by_keys(person, "employer_company_id", table(spark, folder, "company"), "id").select("employer_company_id", "id")


def companies_by_domain(spark: SparkSession, folder: str) -> DataFrame:
    """Companies whose domain a person's first address has, in any case."""
    mail = records(spark, folder, "person", ["primary_email"]).select(X.email_domain("primary_email").alias("domain"), F.col("id").alias("person_id")).filter("domain <> ''")
    company = table(spark, folder, "company").select("id", F.lower("domain").alias("domain"))
    return company.join(mail, "domain").groupBy("id").agg(F.count_distinct("person_id").alias("n_persons"))


def companies_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles by the company of exactly the name that they give."""
    profile = records(spark, folder, "github_profile", ["company"]).select(F.col("id").alias("github_id"), F.col("company").alias("canonical_name"))
    return profile.join(table(spark, folder, "company").select("id", "canonical_name"), "canonical_name").select("github_id", F.col("id").alias("company_id"))


def events_by_place(spark: SparkSession, folder: str) -> DataFrame:
    """Events of each listed city and country, newest first."""
    event = records(spark, folder, "community_event", ["venue_city", "venue_country", "starts_at"])
    places = table(spark, folder, "city_coordinates").select(F.col("city").alias("venue_city"), F.col("country").alias("venue_country")).distinct()
    return event.join(places, ["venue_city", "venue_country"]).select("id", "venue_city", "venue_country", F.unix_micros("starts_at").alias("at")).orderBy("venue_city", "venue_country", F.desc_nulls_last("at"), "id")


def events_by_program(spark: SparkSession, folder: str) -> DataFrame:
    """Events of one program, and completed ones only."""
    event = records(spark, folder, "community_event", ["program_type", "status", "title"])
    return lookup.listed(event, {"program_type": "meetup", "status": "completed", "title": None}, order=[F.col("id")]).select("id", "title")


def event_by_external_id(spark: SparkSession, folder: str) -> DataFrame:
    """The event of each id that the source gives."""
    return records(spark, folder, "community_event", ["luma_event_id", "title"]).filter("luma_event_id is not null").select("luma_event_id", "id", "title")


def talk_by_author(spark: SparkSession, folder: str) -> DataFrame:
    """Talk of each known person since a time."""
    said = records(spark, folder, "communication", ["author_person_id", "posted_at"])
    recent = lookup.listed(said, least={"posted_at": as_of() - F.expr("INTERVAL 365 DAYS")})
    return lookup.by_keys(recent, "author_person_id", table(spark, folder, "person"), "id").select("author_person_id", "id")


def talk_in_window(spark: SparkSession, folder: str) -> DataFrame:
    """Talk of half a year: of one platform, and of all."""
    said = records(spark, folder, "communication", ["source_platform", "posted_at"])
    span = {"posted_at": (as_of() - F.expr("INTERVAL 300 DAYS"), as_of() - F.expr("INTERVAL 120 DAYS"))}
    some = lambda platform: lookup.listed(said, {"source_platform": platform}, between=span).select(F.lit(platform or "all").alias("asked"), "id")
    return some("reddit").unionByName(some(None))


def artifacts_by_creator(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as artifacts: how many of each type an author made."""
    made = table(spark, folder, "documents").filter("author_handle is not null")
    return made.groupBy(X.normalize_handle("author_handle").alias("creator"), F.col("doc_kind").alias("artifact_type")).agg(F.count("*").alias("n"), F.max("doc_id").alias("latest"))


def programs(spark: SparkSession, folder: str) -> DataFrame:
    """Programs by name, those with an event still to come."""
    event = records(spark, folder, "community_event", ["program_type", "status", "attended_count"])
    whole = event.filter("program_type is not null").groupBy("program_type").agg(F.count("*").alias("n_events"), F.coalesce(F.sum("attended_count"), F.lit(0)).alias("attended"), F.bool_or(F.coalesce(F.col("status") == "scheduled", F.lit(False))).alias("active"))
    return lookup.listed(whole, {"active": True}, order=[F.col("program_type")])


def signals_of_entity(spark: SparkSession, folder: str) -> DataFrame:
    """Signals of each entity of one type since a time."""
    signal = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    recent = lookup.listed(signal, {"event_type": "click"}, least={"ts": F.lit("2024-01-10 00:00:00").cast("timestamp")})
    return recent.groupBy("user_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))


def entity_history(spark: SparkSession, folder: str) -> DataFrame:
    """The log of one entity since a time, newest first."""
    log = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return lookup.listed(log, {"user_id": 7}, least={"ts": F.lit("2024-01-05 00:00:00").cast("timestamp")}, order=[F.desc("ts"), F.desc("event_id")]).select("event_id", "event_type", F.unix_micros("ts").alias("at"))


def active_persons_by_place(spark: SparkSession, folder: str) -> DataFrame:
    """Persons under optional conditions on city, country, stage, employer and score: here country and score."""
    person = records(spark, folder, "person", ["location_city", "location_country", "lifecycle_stage", "employer_company_id", "activity_score"])
    found = lookup.listed(person, {"location_city": None, "location_country": "Germany", "lifecycle_stage": None, "employer_company_id": None}, {"activity_score": 0.2}, order=[F.desc("activity_score"), F.col("id")])
    return found.select("id", F.col("activity_score").cast("double").alias("activity_score"))


def flagged_talk(spark: SparkSession, folder: str) -> DataFrame:
    """Talk with the flag as a condition, and without."""
    said = records(spark, folder, "communication", ["is_about_cursor"])
    count = lambda only: lookup.flagged(said, "is_about_cursor", only).agg(F.count("*").alias("n")).select(F.lit(only).alias("only"), "n")
    return count(True).unionByName(count(False))


def persons_by_handle(spark: SparkSession, folder: str) -> DataFrame:
    """Persons with an account whose handle is a profile's login."""
    logins = records(spark, folder, "github_profile", ["login"]).select(X.normalize_handle("login").alias("handle"))
    ids = records(spark, folder, "person_platform_identity", ["person_id", "handle"]).withColumn("handle", X.normalize_handle("handle"))
    return lookup.by_keys(records(spark, folder, "person", ["canonical_name"]), "id", lookup.by_keys(ids, "handle", logins, "handle"), "person_id")


def attendance_with_event(spark: SparkSession, folder: str) -> DataFrame:
    """Attendance by role, with the event where it is open, without it where not: a left join."""
    opened = gatherings(spark, folder).filter("status = 'O'").select(F.col("id").alias("event_id"), "status")
    return attendance(spark, folder).join(opened, "event_id", "left").groupBy("role").agg(F.count("*").alias("n"), F.count("status").alias("n_open"))


def relevance_by_community(spark: SparkSession, folder: str) -> DataFrame:
    """Texts in four classes of relevance by platform."""
    return quality.relevance_buckets(records(spark, folder, "communication", ["source_platform", "cursor_relevance_score"]), "cursor_relevance_score", "source_platform")


def worst_resolutions(spark: SparkSession, folder: str) -> DataFrame:
    """The three most confident resolutions by a method that is not to be trusted."""
    ids = records(spark, folder, "person_platform_identity", ["resolution_confidence", "resolution_method"]).withColumn("right", F.coalesce(F.col("resolution_method") != "heuristic_match", F.lit(True)))
    return quality.most_wrong(ids, "id", "resolution_confidence", "right").select("id", F.col("resolution_confidence").cast("double").alias("confidence"))


def ingest_counters(spark: SparkSession, folder: str) -> DataFrame:
    """What ingest saw of each platform: rows, those with a text, an author, a known author."""
    stages = {"with_text": F.length(F.trim("content_text")) > 0, "with_author": F.col("author_handle_raw").isNotNull(), "resolved": F.col("author_person_id").isNotNull()}
    return quality.stage_counters(table(spark, folder, "communication"), "source_platform", stages)


def verified_handles(spark: SparkSession, folder: str) -> DataFrame:
    """The verified accounts of each person, out of an array of all."""
    ids = records(spark, folder, "person_platform_identity", ["person_id", "platform", "handle", "verified"]).filter("person_id is not null")
    every = ids.groupBy("person_id").agg(F.collect_set(F.struct("platform", X.normalize_handle("handle").alias("handle"), "verified")).alias("accounts"))
    kept = F.array_distinct(F.transform(F.filter("accounts", lambda a: a["verified"]), lambda a: F.concat_ws(":", a["platform"], a["handle"])))
    return every.select("person_id", F.array_join(F.array_sort(kept), " ").alias("handles")).filter("handles <> ''")


def memberships(spark: SparkSession, folder: str) -> DataFrame:
    """How many events each person organized and attended."""
    return graph.membership_edges(attendance(spark, folder)).groupBy("person_id", "edge_type").agg(F.count("*").alias("n"))


def recent_events(spark: SparkSession, folder: str) -> DataFrame:
    """The 12 latest events."""
    event = records(spark, folder, "community_event", ["title", "starts_at"])
    return event.filter("starts_at is not null").orderBy(F.desc("starts_at"), "id").limit(12).select("id", "title", F.unix_micros("starts_at").alias("at"))


def timelines(spark: SparkSession, folder: str) -> DataFrame:
    """The last 5 things of each person: events taken part in, talk and signals in one schema; the
    time of a part taken is that of attending, else of signing up, else of the event, else the epoch."""
    events = gatherings(spark, folder).select(F.col("id").alias("event_id"), "starts_at")
    part = attendance(spark, folder).withColumn("attended_at", F.when(F.col("role") != "attendee", F.col("attended_at"))).join(events, "event_id", "left")
    part = part.select("person_id", F.lit("event").alias("kind"), F.col("event_id").alias("ref"), dates.first_time("attended_at", "registered_at", "starts_at").alias("t")).distinct()
    talk = table(spark, folder, "orders").select(F.col("o_custkey").cast("string").alias("person_id"), F.lit("communication").alias("kind"), F.col("o_orderkey").cast("string").alias("ref"), F.col("o_orderdate").cast("timestamp").alias("t"))
    signal = table(spark, folder, "events").select(F.col("user_id").cast("string").alias("person_id"), F.lit("signal").alias("kind"), F.col("event_id").cast("string").alias("ref"), F.col("ts").cast("timestamp").alias("t"))
    every = part.unionByName(talk).unionByName(signal)
    from pyspark.sql.window import Window

    rank = F.row_number().over(Window.partitionBy("person_id").orderBy(F.desc("t"), "kind", "ref"))
    return every.withColumn("k", rank).filter("k <= 5").select("person_id", "k", "kind", "ref", F.unix_micros("t").alias("at"))


def profile_dates(spark: SparkSession, folder: str) -> DataFrame:
    """When profiles were made, from ISO text, and the day as text."""
    made = dates.tolerant_timestamp("created_at")
    return records(spark, folder, "github_profile", ["created_at"]).select("id", F.unix_micros(made).alias("at"), dates.day(made).alias("day"))


def raw_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Raw items in envelopes, marked by whether they can be normalized, and what is stuck or failed by kind."""
    items = records(spark, folder, "raw_reddit_item", ["kind", "author", "subreddit", "fetched_at"])
    wrapped = raw.envelope(items.withColumn("payload", F.to_json(F.struct("kind", "author", "subreddit"))), "reddit", F.col("thing_id"), F.col("fetched_at"))
    ok = F.length(F.coalesce(F.get_json_object("payload", "$.author"), F.lit(""))) > 0
    marked = raw.mark(wrapped, ok, as_of(), F.lit("no author"))
    return marked.groupBy(F.get_json_object("payload", "$.kind").alias("kind"), "status", F.coalesce("error", F.lit("")).alias("error")).agg(F.count_distinct("source_record_id").alias("n"))


def raw_rows_by_id(spark: SparkSession, folder: str) -> DataFrame:
    """The raw item of each communication that names one."""
    items = records(spark, folder, "raw_reddit_item", ["kind", "subreddit"])
    return lookup.by_keys(items, "thing_id", table(spark, folder, "communication").filter("source_platform = 'reddit'"), "source_record_id")


def stuck_items(spark: SparkSession, folder: str) -> DataFrame:
    """Rows still pending 30 minutes after they came, by platform: those without author stand for pending ones."""
    pending = table(spark, folder, "communication").select("source_platform", "ingested_at", F.when(F.col("author_person_id").isNull(), "pending").otherwise("success").alias("status"))
    return quality.stuck_rows(pending, as_of(), 30).groupBy("source_platform").agg(F.count("*").alias("n"))


def cursors(spark: SparkSession, folder: str) -> DataFrame:
    """Page cursors written and read back, and texts that are none."""
    made = table(spark, folder, "events").select("event_id", dates.encode_cursor(F.col("event_id") % 50, F.unix_seconds(F.col("ts").cast("timestamp"))).alias("c"), "props")
    return made.select("event_id", dates.decode_cursor("c")["page"].alias("page"), dates.decode_cursor("c")["sinceUnix"].alias("since"), dates.decode_cursor("props").isNull().alias("bad"))


def source_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """The accounts to poll on one platform, a given list where there is none."""
    return raw.accounts_to_poll(records(spark, folder, "person_platform_identity", ["platform", "handle"]), "forum", ["nobody"])


def profile_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Each profile with its three longest documents; profiles without any stay."""
    profile = records(spark, folder, "github_profile", ["login"]).select("id", X.normalize_handle("login").alias("handle"))
    docs = table(spark, folder, "documents").filter("author_handle is not null").select(X.normalize_handle("author_handle").alias("handle"), "doc_id", "n_chars")
    return raw.with_top(profile, docs, "handle", F.struct(F.coalesce("n_chars", F.lit(-1)), -F.col("doc_id")), "doc_id", 3).select("id", F.array_join("top", " ").alias("doc_ids"))


def discovered_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Authors found by readmes first, and those that only code brings: a union with an anti join."""
    docs = table(spark, folder, "documents").filter("author_handle is not null").select(F.lower("author_handle").alias("name"), "doc_kind")
    return raw.two_passes(docs.filter("doc_kind = 'readme'").select("name"), docs.filter("doc_kind in ('changelog', 'tutorial')").select("name"), "name")


def event_upserts(spark: SparkSession, folder: str) -> DataFrame:
    """Events by their external id, latest wins, with defaults where values are missing."""
    rows = table(spark, folder, "community_event").filter("luma_event_id is not null").select("luma_event_id", "status", "registered_count", "updated_at")
    kept = R.upsert(rows.limit(0), rows, ["luma_event_id"], "updated_at")
    return R.with_defaults(kept, {"status": F.lit("proposed"), "registered_count": F.lit(0), "source": F.lit("luma")}).select("luma_event_id", "status", "registered_count", "source")


def attendance_upserts(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each person, event and role, the latest."""
    rows = attendance(spark, folder).select("person_id", "event_id", "role", "attended_at")
    return R.upsert(rows.limit(0), rows, ["person_id", "event_id", "role"], "attended_at").groupBy("role").agg(F.count("*").alias("n"), F.max(F.unix_micros("attended_at")).alias("last"))


def names_appended(spark: SparkSession, folder: str) -> DataFrame:
    """The names seen of a person with the canonical one appended, each once, in order."""
    person = records(spark, folder, "person", ["names_seen", "canonical_name"]).filter("canonical_name is not null")
    return person.select("id", F.array_join(R.append_unique(F.col("names_seen"), F.array("canonical_name")), "|").alias("names"))


def merged_figures(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of programs: counts of events by status, later figures over earlier ones."""
    event = records(spark, folder, "community_event", ["program_type", "registered_count", "attended_count"]).filter("program_type is not null")
    whole = event.groupBy("program_type").agg(F.count("*").alias("n"), F.coalesce(F.sum("registered_count"), F.lit(0)).alias("r"), F.coalesce(F.sum("attended_count"), F.lit(0)).alias("a"))
    merged = R.merge_maps(F.create_map(F.lit("events"), F.col("n"), F.lit("people"), F.col("r")), F.create_map(F.lit("people"), F.col("a")))
    return whole.select("program_type", merged["events"].alias("events"), merged["people"].alias("people"))


def new_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Things that were fetched again with another payload than at first."""
    rows = table(spark, folder, "raw_reddit_item").select("thing_id", F.sha2(F.concat_ws("|", "score", "parent_id", "link_id"), 256).alias("payload_hash"), "fetched_at")
    first = rows.groupBy("thing_id").agg(F.min_by("payload_hash", F.struct("fetched_at", "payload_hash")).alias("payload_hash"))
    return R.changed_only(first, rows.select("thing_id", "payload_hash"), ["thing_id"], "payload_hash").select("thing_id").distinct()


def emitted_signals(spark: SparkSession, folder: str) -> DataFrame:
    """Signals with the audit row of each: what both tables get, by kind."""
    said = records(spark, folder, "communication", ["author_person_id", "posted_at"]).filter("author_person_id is not null")
    signal, audit = R.signal_with_audit(said.select(F.col("author_person_id").alias("person_id"), F.lit("spoke").alias("signal_type"), F.col("posted_at").alias("observed_at"), F.col("id").alias("source_record_id")))
    return signal.groupBy(F.lit("signal").alias("kind")).agg(F.count_distinct("id").alias("n")).unionByName(audit.groupBy(F.lit("audit").alias("kind")).agg(F.count_distinct("signal_id").alias("n")))


def table_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Tables with their rows and whether these are enough."""
    least = {"person": 10, "company": 10_000, "community_event": 10, "communication": 100}
    frames = {name: table(spark, folder, name) for name in least}
    short = quality.short_tables(frames, least)
    rows = [(name, name in short, quality.schema_hash(frames[name]) == quality.schema_hash(table(spark, folder, name))) for name in least]
    return spark.createDataFrame(rows, "name string, short boolean, same_schema boolean")


def embedding_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Confidence from likeness of vectors and one further piece of evidence, for neighbours by id."""
    from ..functions.similarity import checked_vector, cosine

    v = table(spark, folder, "embeddings").select("vec_id", checked_vector(F.col("embedding"), 64).alias("v"))
    pairs = v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w")), "vec_id")
    support = F.array(F.struct(F.lit("city_match").alias("kind"), F.lit(0.2).alias("weight"), F.lit(1.0).alias("confidence")))
    scaled = 0.85 + F.greatest(F.lit(0.0), cosine(F.col("v"), F.col("w"))) * 0.15
    return pairs.select("vec_id", F.round(I.tier3_confidence(scaled, support), 6).alias("confidence"))


def one_hop(spark: SparkSession, folder: str) -> DataFrame:
    """The suppliers of each nation as its neighbours: how many, and the first."""
    edges = table(spark, folder, "supplier").select(F.col("s_nationkey").cast("string").alias("src"), F.col("s_name").alias("dst"))
    return graph.neighbours(edges).select("src", F.size("neighbours").alias("n"), F.get("neighbours", F.lit(0)).alias("first"))


def repointed_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges between persons that talk about one event host, after the merge of persons."""
    merged = table(spark, folder, "person_merge").select("group_id", "person_id").dropna().distinct()
    first = merged.groupBy("group_id").agg(F.min("person_id").alias("new_id"))
    moved = merged.join(first, "group_id").filter("person_id <> new_id").select(F.col("person_id").alias("old_id"), "new_id")
    edges = records(spark, folder, "person", ["employer_company_id"]).filter("employer_company_id is not null").select(F.col("id").alias("src"), F.col("employer_company_id").alias("dst"), F.lit("works_at").alias("edge_type"), F.lit(1).cast("long").alias("strength"))
    return R.repoint_edges(edges, moved)


def mail_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Domains of addresses, and whether they say anything of an employer."""
    mails = records(spark, folder, "person", ["emails_seen"]).select("id", F.explode("emails_seen").alias("email")).filter("email is not null")
    domain = X.email_domain("email")
    return mails.groupBy(domain.alias("domain")).agg(F.count("*").alias("n")).select("domain", "n", X.is_free_mail("domain").alias("is_free"))


def excerpts(spark: SparkSession, folder: str) -> DataFrame:
    """Titles as snippets and excerpts, and as slugs."""
    event = records(spark, folder, "community_event", ["title"]).filter("title is not null")
    return event.select("id", X.snippet("title", 12).alias("snippet"), X.excerpt("title", 9).alias("excerpt"), X.slug("title").alias("slug"), X.like_token("title").alias("token"))


def person_count(spark: SparkSession, folder: str) -> DataFrame:
    """How many persons are known."""
    return table(spark, folder, "person").agg(F.count_distinct("id").alias("n"))


def top_posters(spark: SparkSession, folder: str) -> DataFrame:
    """Who wrote most on one platform."""
    said = records(spark, folder, "communication", ["author_person_id", "source_platform"]).filter("source_platform = 'reddit'")
    names = records(spark, folder, "person", ["canonical_name"])
    most = said.groupBy(F.col("author_person_id").alias("id")).agg(F.count("*").alias("comms")).join(names, "id")
    return most.orderBy(F.desc("comms"), "id").limit(10).select("id", "canonical_name", "comms")


def events_of_city(spark: SparkSession, folder: str) -> DataFrame:
    """Events by city as typed, how many of them are over."""
    event = records(spark, folder, "community_event", ["venue_city", "status"]).filter("venue_city is not null")
    return event.groupBy("venue_city").agg(F.count("*").alias("n"), F.count(F.when(F.col("status") == "completed", 1)).alias("completed"))


def mail_links(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles that an address or account ties to a person at once."""
    profiles, persons = _resolvable(spark, folder)
    return I.explicit_links(profiles, persons)


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    """The decision log of the profiles that are tied at once: each with its confidence."""
    profiles, persons = _resolvable(spark, folder)
    linked = I.explicit_links(profiles, persons).select("record", "person", F.lit("merge").alias("action"), F.lit(1.0).alias("confidence"), F.lit("explicit link").alias("reasoning"), F.lit(0).alias("n_candidates"))
    return I.decision_log(linked, as_of()).select("record", "person", "action", "confidence", F.unix_micros("decided_at").alias("at"))


def link_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Evidence and confidence for profiles tied by an address, where the names are equal or one is missing."""
    profiles, persons = _resolvable(spark, folder)
    pairs = I.explicit_links(profiles, persons).filter("`by` = 'email'").select("record", "person", F.lit(1).alias("priority"), F.lit(0.0).alias("likeness"))
    scored = I.signals(pairs, profiles, persons)
    return scored.select("record", "person", F.array_join(F.array_sort(F.transform("signals", lambda x: x["kind"])), ",").alias("kinds"), F.round(I.confidence(F.col("signals")), 6).alias("confidence"))


def created_names(spark: SparkSession, folder: str) -> DataFrame:
    """The name that a person made of each profile would get."""
    profile = records(spark, folder, "github_profile", ["login", "name", "email"])
    return profile.select("id", I.display_name(F.col("name"), F.array("name"), F.when(F.col("id") % 2 == 0, F.col("login")), F.col("email")).alias("name"))


def _resolvable(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    none_a, none_s = F.array().cast("array<string>"), F.lit(None).cast("string")
    bare = dict(github=none_s, twitter=none_s, linkedin=none_s, event_ids=none_a, connected_ids=none_a, timezone=none_s, employer=none_s)
    profile = records(spark, folder, "github_profile", ["login", "name", "email", "location"])
    profile = profile.select(F.col("id").cast("string").alias("id"), F.array_compact(F.array("name")).alias("names"), F.array_compact(F.array("email")).alias("emails"), F.col("location").alias("city"), none_s.alias("country"), F.array(F.concat(F.lit("github:"), "login")).alias("accounts"))
    person = records(spark, folder, "person", ["canonical_name", "emails_seen", "location_city", "location_country", "is_active"]).filter("is_active")
    ids = records(spark, folder, "person_platform_identity", ["person_id", "platform", "handle"]).filter("handle is not null and platform = 'github'")
    ids = ids.groupBy(F.col("person_id").alias("id")).agg(F.collect_set(F.concat_ws(":", "platform", "handle")).alias("accounts"))
    person = person.join(ids, "id", "left").select("id", F.array_compact(F.array("canonical_name")).alias("names"), F.col("emails_seen").alias("emails"), F.col("location_city").alias("city"), F.col("location_country").alias("country"), "accounts")
    return I.prepare(profile.withColumns(bare), "id"), I.prepare(person.withColumns(bare), "id")


QUERIES = {f.__name__: f for f in (
    persons_by_id, person_of_id, employees, companies_by_domain, companies_by_name, events_by_place, events_by_program, event_by_external_id, talk_by_author, talk_in_window, artifacts_by_creator, programs, signals_of_entity,
    entity_history, active_persons_by_place, flagged_talk, persons_by_handle, attendance_with_event, relevance_by_community, worst_resolutions, ingest_counters, verified_handles, memberships, recent_events, timelines,
    profile_dates, raw_envelopes, raw_rows_by_id, stuck_items, cursors, source_accounts, profile_documents, discovered_sources, event_upserts, attendance_upserts, names_appended, merged_figures, new_payloads, emitted_signals,
    table_checks, embedding_evidence, one_hop, repointed_edges, mail_parts, excerpts, person_count, top_posters, events_of_city, mail_links, decisions, link_evidence, created_names,
)}
_P, _C, _I, _E, _R, _G = (latest_sql(t) for t in ("person", "communication", "person_platform_identity", "community_event", "raw_reddit_item", "github_profile"))
_ORDERS = "(SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, CAST(o_orderdate AS TIMESTAMP) AS starts_at, o_custkey FROM orders)"
_H = lambda c: f"regexp_replace(lower(trim({c})), '^@', '')"
_PROFILE = (
    f"(SELECT CAST(id AS VARCHAR) AS record, list_filter([lower(trim(regexp_replace(strip_accents(name), '\\s+', ' ', 'g')))], lambda x: x <> '') AS names, lower(trim(email)) AS email, lower(trim(login)) AS login, nullif(lower(trim(location)), '') AS city FROM {_G})"
)
_PERSON = (
    f"(SELECT id AS person, list_filter([lower(trim(regexp_replace(strip_accents(canonical_name), '\\s+', ' ', 'g')))], lambda x: x <> '') AS names, list_transform(emails_seen, lambda x: lower(trim(x))) AS emails, nullif(lower(trim(location_city)), '') AS city FROM {_P} WHERE is_active)"
)
_LINKS = (
    f"(SELECT record, min(k) AS k FROM (SELECT r.record, (1, p.person) AS k FROM {_PROFILE} r JOIN (SELECT person, unnest(emails) AS email FROM {_PERSON}) p ON p.email = r.email WHERE r.email LIKE '%@%' "
    f"UNION ALL SELECT r.record, (2, i.person_id) FROM {_PROFILE} r JOIN {_I} i ON i.platform = 'github' AND {_H('i.handle')} = regexp_replace(r.login, '^@', '') JOIN {_PERSON} p ON p.person = i.person_id) GROUP BY 1)"
)
SQL = {
    "persons_by_id": f"SELECT id, canonical_name, is_active FROM {_P} WHERE id IN (SELECT person_id FROM person_merge)",
    "person_of_id": "SELECT DISTINCT id, canonical_name FROM person WHERE id = (SELECT min(id) FROM person)",
    "employees": f"SELECT employer_company_id, id FROM {_P} WHERE employer_company_id IN (SELECT id FROM company)",
    "companies_by_domain": f"SELECT c.id, count(DISTINCT p.id) AS n_persons FROM company c JOIN {_P} p ON lower(c.domain) = lower(regexp_extract(trim(p.primary_email), '^.+@([^@]+)$', 1)) GROUP BY 1",
    "companies_by_name": f"SELECT g.id AS github_id, c.id AS company_id FROM {_G} g JOIN company c ON c.canonical_name = g.company",
    "events_by_place": f"SELECT id, venue_city, venue_country, epoch_us(starts_at) AS \"at\" FROM {_E} WHERE (venue_city, venue_country) IN (SELECT (city, country) FROM city_coordinates)",
    "events_by_program": f"SELECT id, title FROM {_E} WHERE program_type = 'meetup' AND status = 'completed'",
    "event_by_external_id": f"SELECT luma_event_id, id, title FROM {_E} WHERE luma_event_id IS NOT NULL",
    "talk_by_author": f"SELECT author_person_id, id FROM {_C} WHERE posted_at >= {SQL_AS_OF} - INTERVAL 365 DAY AND author_person_id IN (SELECT id FROM person)",
    "talk_in_window": f"WITH w AS (SELECT id, source_platform FROM {_C} WHERE posted_at BETWEEN {SQL_AS_OF} - INTERVAL 300 DAY AND {SQL_AS_OF} - INTERVAL 120 DAY) SELECT 'all' AS asked, id FROM w UNION ALL SELECT 'reddit', id FROM w WHERE source_platform = 'reddit'",
    "artifacts_by_creator": f"SELECT {_H('author_handle')} AS creator, doc_kind AS artifact_type, count(*) AS n, max(doc_id) AS latest FROM documents WHERE author_handle IS NOT NULL GROUP BY 1, 2",
    "programs": f"SELECT program_type, count(*) AS n_events, CAST(coalesce(sum(attended_count), 0) AS BIGINT) AS attended, true AS active FROM {_E} WHERE program_type IS NOT NULL GROUP BY 1 HAVING count(*) FILTER (WHERE status = 'scheduled') > 0",
    "signals_of_entity": "SELECT user_id, count(*) AS n, max(event_id) AS last FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-10' GROUP BY 1",
    "entity_history": "SELECT event_id, event_type, epoch_us(ts) AS \"at\" FROM events WHERE user_id = 7 AND ts >= TIMESTAMP '2024-01-05'",
    "active_persons_by_place": f"SELECT id, CAST(activity_score AS DOUBLE) AS activity_score FROM {_P} WHERE location_country = 'Germany' AND activity_score >= 0.2",
    "flagged_talk": f"SELECT true AS only, count(*) FILTER (WHERE is_about_cursor) AS n FROM {_C} UNION ALL SELECT false, count(*) FROM {_C}",
    "persons_by_handle": f"SELECT id, canonical_name FROM {_P} WHERE id IN (SELECT person_id FROM {_I} WHERE {_H('handle')} IN (SELECT {_H('login')} FROM {_G}))",
    "attendance_with_event": f"SELECT a.role, count(*) AS n, count(o.id) AS n_open FROM {SQL_ATTENDANCE} a LEFT JOIN {_ORDERS} o ON o.id = a.event_id AND o.status = 'O' GROUP BY 1",
    "relevance_by_community": f"SELECT source_platform, count(*) FILTER (WHERE v <= 0) AS \"none\", count(*) FILTER (WHERE v > 0 AND v < 0.4) AS low, count(*) FILTER (WHERE v >= 0.4 AND v < 0.7) AS medium, count(*) FILTER (WHERE v >= 0.7) AS high FROM (SELECT source_platform, coalesce(CAST(cursor_relevance_score AS DOUBLE), 0) AS v FROM {_C}) GROUP BY 1",
    "worst_resolutions": f"SELECT id, CAST(resolution_confidence AS DOUBLE) AS confidence FROM {_I} WHERE resolution_method = 'heuristic_match' ORDER BY resolution_confidence DESC NULLS LAST, id LIMIT 3",
    "ingest_counters": "SELECT source_platform, count(*) AS seen, count(*) FILTER (WHERE length(trim(content_text, ' ')) > 0) AS with_text, count(author_handle_raw) AS with_author, count(author_person_id) AS resolved FROM communication GROUP BY 1",
    "verified_handles": f"SELECT person_id, array_to_string(list_sort(array_agg(DISTINCT concat_ws(':', platform, {_H('handle')}))), ' ') AS handles FROM {_I} WHERE verified AND person_id IS NOT NULL GROUP BY 1",
    "memberships": f"SELECT person_id, edge_type, count(*) AS n FROM (SELECT person_id, event_id, CASE WHEN bool_or(role IN ('organizer', 'co_organizer')) THEN 'organized' ELSE 'attended' END AS edge_type FROM {SQL_ATTENDANCE} GROUP BY 1, 2) GROUP BY 1, 2",
    "recent_events": f"SELECT id, title, epoch_us(starts_at) AS \"at\" FROM {_E} WHERE starts_at IS NOT NULL ORDER BY starts_at DESC, id LIMIT 12",
    "timelines": f"WITH u AS (SELECT DISTINCT a.person_id, 'event' AS kind, a.event_id AS ref, coalesce(CASE WHEN a.role <> 'attendee' THEN a.attended_at END, o.starts_at, TIMESTAMP '1970-01-01') AS t FROM {SQL_ATTENDANCE} a LEFT JOIN {_ORDERS} o ON o.id = a.event_id "
    f"UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'communication', id, starts_at FROM {_ORDERS} UNION ALL SELECT CAST(user_id AS VARCHAR), 'signal', CAST(event_id AS VARCHAR), ts FROM events) "
    "SELECT person_id, CAST(row_number() OVER w AS INTEGER) AS k, kind, ref, epoch_us(t) AS \"at\" FROM u WINDOW w AS (PARTITION BY person_id ORDER BY t DESC, kind, ref) QUALIFY k <= 5",
    "profile_dates": f"SELECT id, epoch_us(t) AS \"at\", coalesce(strftime(t, '%Y-%m-%d'), '—') AS day FROM (SELECT id, CASE WHEN regexp_matches(trim(created_at), '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast(trim(created_at) AS TIMESTAMPTZ) END AS t FROM {_G})",
    "raw_envelopes": f"SELECT kind, CASE WHEN coalesce(author, '') <> '' THEN 'success' ELSE 'failed' END AS status, CASE WHEN coalesce(author, '') <> '' THEN '' ELSE 'no author' END AS error, count(*) AS n FROM {_R} GROUP BY 1, 2, 3",
    "raw_rows_by_id": f"SELECT thing_id, kind, subreddit FROM {_R} WHERE thing_id IN (SELECT source_record_id FROM communication WHERE source_platform = 'reddit')",
    "stuck_items": f"SELECT source_platform, count(*) AS n FROM communication WHERE author_person_id IS NULL AND ingested_at < {SQL_AS_OF} - INTERVAL 30 MINUTE GROUP BY 1",
    "cursors": "SELECT event_id, CAST(event_id % 50 AS INTEGER) AS page, CAST(floor(epoch(ts)) AS BIGINT) AS since, true AS bad FROM events",
    "source_accounts": f"SELECT DISTINCT lower(trim(handle)) AS handle FROM {_I} WHERE platform = 'forum' AND trim(coalesce(handle, '')) <> ''",
    "profile_documents": f"SELECT p.id, coalesce(array_to_string(d.ids, ' '), '') AS doc_ids FROM (SELECT id, {_H('login')} AS handle FROM {_G}) p LEFT JOIN (SELECT handle, array_agg(doc_id ORDER BY k) AS ids FROM (SELECT {_H('author_handle')} AS handle, doc_id, row_number() OVER (PARTITION BY {_H('author_handle')} ORDER BY coalesce(n_chars, -1) DESC, doc_id) AS k FROM documents WHERE author_handle IS NOT NULL) WHERE k <= 3 GROUP BY 1) d ON d.handle = p.handle",
    "discovered_sources": "SELECT lower(author_handle) AS name, bool_and(doc_kind <> 'readme') AS second_only FROM documents WHERE author_handle IS NOT NULL AND doc_kind IN ('readme', 'changelog', 'tutorial') GROUP BY 1",
    "event_upserts": "SELECT luma_event_id, coalesce(arg_max(coalesce(status, '-'), updated_at), 'proposed') AS status, coalesce(arg_max(coalesce(registered_count, 0), updated_at), 0) AS registered_count, 'luma' AS source FROM community_event WHERE luma_event_id IS NOT NULL GROUP BY 1",
    "attendance_upserts": f"SELECT role, count(*) AS n, max(epoch_us(t)) AS last FROM (SELECT person_id, event_id, role, max(attended_at) AS t FROM {SQL_ATTENDANCE} GROUP BY 1, 2, 3) GROUP BY 1",
    "names_appended": f"SELECT id, array_to_string(list_filter(l, lambda x, i: x IS NOT NULL AND list_position(l, x) = i), '|') AS names FROM (SELECT id, list_append(coalesce(names_seen, []), canonical_name) AS l FROM {_P} WHERE canonical_name IS NOT NULL)",
    "merged_figures": f"SELECT program_type, count(*) AS events, CAST(coalesce(sum(attended_count), 0) AS BIGINT) AS people FROM {_E} WHERE program_type IS NOT NULL GROUP BY 1",
    "new_payloads": "WITH r AS (SELECT thing_id, sha256(concat_ws('|', score, parent_id, link_id)) AS h, fetched_at FROM raw_reddit_item), f AS (SELECT thing_id, arg_min(h, (fetched_at, h)) AS h FROM r GROUP BY 1) SELECT DISTINCT r.thing_id FROM r JOIN f ON f.thing_id = r.thing_id WHERE r.h <> f.h",
    "emitted_signals": f"SELECT k.kind, count(DISTINCT id) AS n FROM {_C}, (VALUES ('signal'), ('audit')) k(kind) WHERE author_person_id IS NOT NULL GROUP BY 1",
    "table_checks": "SELECT 'person' AS name, count(*) < 10 AS short, true AS same_schema FROM person UNION ALL SELECT 'company', count(*) < 10000, true FROM company UNION ALL SELECT 'community_event', count(*) < 10, true FROM community_event UNION ALL SELECT 'communication', count(*) < 100, true FROM communication",
    "embedding_evidence": "SELECT a.vec_id, round(least(1.0, 0.5 + 0.3 * greatest(0.0, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) + 0.04), 6) AS confidence FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "one_hop": "SELECT CAST(s_nationkey AS VARCHAR) AS src, CAST(count(DISTINCT s_name) AS INTEGER) AS n, min(s_name) AS first FROM supplier GROUP BY 1",
    "repointed_edges": f"WITH m AS (SELECT person_id AS old_id, min(person_id) OVER (PARTITION BY group_id) AS new_id FROM (SELECT DISTINCT group_id, person_id FROM person_merge WHERE group_id IS NOT NULL AND person_id IS NOT NULL)) SELECT coalesce(m.new_id, p.id) AS src, p.employer_company_id AS dst, 'works_at' AS edge_type, count(*) AS strength FROM {_P} p LEFT JOIN m ON m.old_id = p.id WHERE p.employer_company_id IS NOT NULL GROUP BY 1, 2",
    "mail_parts": f"WITH m AS (SELECT unnest(emails_seen) AS email FROM {_P}) SELECT domain, count(*) AS n, domain IN {X.FREE_MAIL!r} AS is_free FROM (SELECT lower(regexp_extract(trim(email), '^.+@([^@]+)$', 1)) AS domain FROM m WHERE email IS NOT NULL) GROUP BY 1",
    "excerpts": f"""SELECT id, CASE WHEN length(s) > 12 THEN substring(s, 1, 11) || '…' ELSE s END AS snippet, CASE WHEN length(title) > 9 THEN rtrim(substring(title, 1, 8), ' ') || '…' ELSE title END AS excerpt,
 regexp_replace(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, trim(regexp_replace(title, '[,()*"`''\\\\:]', '', 'g')) AS token
 FROM (SELECT id, title, replace(trim(regexp_replace(title, '\\s+', ' ', 'g')), '|', '\\|') AS s FROM {_E} WHERE title IS NOT NULL)""",
    "person_count": "SELECT count(DISTINCT id) AS n FROM person",
    "top_posters": f"SELECT p.id, p.canonical_name, count(*) AS comms FROM {_C} c JOIN {_P} p ON p.id = c.author_person_id WHERE c.source_platform = 'reddit' GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10",
    "events_of_city": f"SELECT venue_city, count(*) AS n, count(*) FILTER (WHERE status = 'completed') AS completed FROM {_E} WHERE venue_city IS NOT NULL GROUP BY 1",
    "mail_links": f"SELECT record, k[2] AS person, CASE k[1] WHEN 1 THEN 'email' ELSE 'account' END AS \"by\" FROM {_LINKS}",
    "decisions": f"SELECT record, k[2] AS person, 'merge' AS action, 1.0 AS confidence, epoch_us({SQL_AS_OF}) AS \"at\" FROM {_LINKS}",
    "link_evidence": f"""WITH x AS (SELECT r.record, p.person, list_has_any(r.names, p.names) AS same, r.city = p.city AS city, regexp_extract(r.email, '@([^@]+)$', 1) AS d, list_transform(p.emails, lambda e: regexp_extract(e, '@([^@]+)$', 1)) AS ds
 FROM {_LINKS} l JOIN {_PROFILE} r ON r.record = l.record JOIN {_PERSON} p ON p.person = l.k[2] WHERE l.k[1] = 1),
s AS (SELECT record, person, list_filter([CASE WHEN city THEN 'city_match' END, CASE WHEN same AND d NOT IN {X.FREE_MAIL!r} AND list_contains(ds, d) THEN 'email_domain' END, 'email_exact', CASE WHEN same THEN 'name_exact' END], lambda k: k IS NOT NULL) AS kinds FROM x)
SELECT record, person, array_to_string(kinds, ',') AS kinds, round(least(1.0, 1.0 + CASE WHEN len(kinds) >= 2 THEN least(0.15, len(kinds) * 0.03) ELSE 0 END), 6) AS confidence FROM s""",
    "created_names": f"SELECT id, coalesce(nullif(trim(name), ''), CASE WHEN id % 2 = 0 THEN nullif(trim(login), '') END, nullif(trim(email), ''), 'unknown') AS name FROM {_G}",
}
