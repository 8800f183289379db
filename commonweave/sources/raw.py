"""Raw records as they arrive: JSON text in one column, and the envelope around it."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.jsonx import payload_hash


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(payload) one JSON text for each line below path."""
    return spark.read.text(path).select(F.col("value").alias("payload"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, html) of every file below path, whole."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("url"), F.col("value").alias("html"))


def envelope(df: DataFrame, source: str, key: Column, observed: Column) -> DataFrame:
    """(source_platform, source_record_id, payload, payload_hash, status, fetched_at, normalized_at, error)."""
    return df.select(
        F.lit(source).alias("source_platform"), key.alias("source_record_id"), "payload", payload_hash(F.col("payload")).alias("payload_hash"), F.lit("pending").alias("status"),
        observed.alias("fetched_at"), F.lit(None).cast("timestamp").alias("normalized_at"), F.lit(None).cast("string").alias("error"),
    )


def mark(df: DataFrame, ok: Column, at: Column, error: Column) -> DataFrame:
    """The envelope after normalizing: success, or failed with its error."""
    return df.withColumns({"status": F.when(ok, "success").otherwise("failed"), "normalized_at": at, "error": F.when(~ok, error)})


# -- search hits of a news site -------------------------------------------------------------

HIT = (
    "objectID string, created_at string, created_at_i bigint, title string, url string, author string, points int, story_text string, comment_text string, num_comments int, "
    "story_id bigint, story_title string, story_url string, parent_id bigint, _tags array<string>"
)


def news_hits(pages: DataFrame, since: int | None = None) -> DataFrame:
    """The hits of search pages (payload), points and comments 0 where missing, newer than `since` seconds."""
    page = F.from_json("payload", f"hits array<struct<{HIT.replace(', ', ',').replace(' ', ':')}>>, page int, nbPages int")
    hits = pages.select(F.explode(page["hits"]).alias("h")).select("h.*").fillna(0, ["points", "num_comments"])
    return hits if since is None else hits.filter(F.col("created_at_i") > since)


def news_communications(hits: DataFrame) -> DataFrame:
    """Talk from hits: type by the first telling tag, text by type, a permalink where there is
    no address; hits without author or with deleted text are dropped."""
    kind = F.coalesce(F.get(F.filter("_tags", lambda t: t.isin("story", "comment", "poll")), F.lit(0)), F.when(F.col("comment_text").isNotNull(), "comment").when(F.col("title").isNotNull(), "story").otherwise("unknown"))
    text = F.when(kind == "comment", F.col("comment_text")).otherwise(F.concat_ws("\n\n", "title", "story_text"))
    gone = F.coalesce(F.trim("author"), F.lit("")).isin("") | F.coalesce(F.trim(text), F.lit("")).isin("[deleted]", "[dead]")
    link = F.concat(F.lit("https://news.ycombinator.com/item?id="), "objectID")
    tags = F.filter("_tags", lambda t: ~t.rlike("^(author|story)_"))
    return hits.filter(~gone).select(
        F.lit("hackernews").alias("source_platform"), F.col("objectID").alias("source_record_id"), F.col("author").alias("author_handle_raw"), kind.alias("item_type"), text.alias("content_text"),
        F.when(kind == "comment", link).otherwise(F.coalesce("url", link)).alias("content_url"), F.timestamp_seconds("created_at_i").alias("posted_at"), tags.alias("topic_tags"),
        F.col("points").alias("engagement_likes"), F.col("num_comments").alias("engagement_replies"), F.col("parent_id").cast("string").alias("parent_record_id"),
    )


def authors(communications: DataFrame) -> DataFrame:
    """One person record for each author of a platform."""
    return communications.filter("author_handle_raw is not null").groupBy("source_platform", F.lower(F.trim("author_handle_raw")).alias("handle")).agg(F.min_by("author_handle_raw", "posted_at").alias("canonical_name"), F.min("posted_at").alias("first_observed_at"), F.max("posted_at").alias("last_observed_at"))


# -- listings of a forum --------------------------------------------------------------------

POST_FIELDS = ("id", "subreddit", "title", "author", "created_utc", "permalink")
COMMENT_FIELDS = ("id", "parent_id", "link_id", "subreddit", "author", "body", "created_utc", "permalink")
THING = "id string, kind string, subreddit string, title string, selftext string, author string, author_fullname string, parent_id string, link_id string, body string, created_utc double, score int, num_comments int, permalink string"


def _number(value: object) -> float | None:
    try:
        out = float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return None
    return out if out == out and abs(out) != float("inf") else None


def _thing(kind: str, data: dict) -> tuple | None:
    """A post or comment as a row; None where a field that it needs is missing. A body may be empty, but not null."""
    needed = POST_FIELDS if kind == "t3" else COMMENT_FIELDS
    if any(data.get(f) is None or (data[f] == "" and f != "body") for f in needed) or _number(data["created_utc"]) is None:
        return None
    get = lambda f: None if data.get(f) is None else str(data[f])
    return (
        get("id"), kind, get("subreddit"), get("title"), get("selftext"), get("author"), get("author_fullname"), get("parent_id"), get("link_id"), get("body"), _number(data["created_utc"]),
        int(_number(data.get("score")) or 0), int(_number(data.get("num_comments")) or 0), get("permalink"),
    )


def _walk(listing: object) -> Iterator[tuple]:
    """Posts and comments of a listing, each before its replies; what stands for more of them is passed over."""
    stack = [listing]
    while stack:
        at = stack.pop()
        children = (at.get("data") or {}).get("children") if isinstance(at, dict) else None
        if isinstance(at, dict) and at.get("kind") in ("t1", "t3"):
            data = at.get("data") or {}
            if row := _thing(at["kind"], data):
                yield row
            if isinstance(data.get("replies"), dict):
                stack.append(data["replies"])
        elif isinstance(children, list):
            stack.extend(reversed(children))
        elif isinstance(at, list):
            stack.extend(reversed(at))


def forum_things(pages: DataFrame) -> DataFrame:
    """Posts and comments of listings or threads (payload), nested replies flattened. The nesting
    has no fixed depth, hence no schema, so Python walks it; broken pages give nothing."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text in pdf["payload"]:
                try:
                    rows += list(_walk(json.loads(text)))
                except (TypeError, ValueError, RecursionError):
                    continue
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in THING.split(", ")])

    return pages.select("payload").mapInPandas(parse, THING)


def forum_communications(things: DataFrame) -> DataFrame:
    """Talk from posts and comments; deleted content becomes null."""
    post = F.col("kind") == "t3"
    gone = lambda c: F.when(F.trim(c).isin("[deleted]", "[removed]", ""), F.lit(None)).otherwise(c)
    text = F.when(post, F.nullif(F.concat_ws("\n\n", "title", gone(F.col("selftext"))), F.lit(""))).otherwise(gone(F.col("body")))
    link = F.when(F.col("permalink").startswith("/"), F.concat(F.lit("https://www.reddit.com"), "permalink")).otherwise(F.col("permalink"))
    return things.select(
        F.lit("reddit").alias("source_platform"), F.concat_ws("_", "kind", "id").alias("source_record_id"), F.when(~F.col("author").isin("[deleted]", "[removed]", ""), F.col("author")).alias("author_handle_raw"),
        F.coalesce("author_fullname", F.lower("author")).alias("author_key"), text.alias("content_text"), link.alias("content_url"), F.timestamp_seconds("created_utc").alias("posted_at"),
        F.col("score").alias("engagement_likes"), F.col("num_comments").alias("engagement_replies"), F.coalesce("parent_id", "link_id").alias("parent_record_id"),
    )


# -- profiles and repositories ----------------------------------------------------------------

REPO = (
    "full_name string, owner struct<login:string,id:bigint,type:string>, private boolean, fork boolean, description string, html_url string, language string, stargazers_count int, "
    "topics array<string>, created_at string, readme_base64 string, found_in_code boolean"
)


def repositories(raw: DataFrame, word: str) -> DataFrame:
    """Artifacts from repositories (payload): public ones, one row for each full name, that
    mention the word; the readme is decoded and the best kind of mention decides the relevance."""
    from ..operators.scoring import artifact_type, repository_relevance

    r = raw.select(F.from_json("payload", REPO).alias("r")).select("r.*").filter("full_name is not null and not coalesce(private, false)")
    r = r.groupBy("full_name").agg(F.max_by(F.struct(*[c for c in r.columns if c != "full_name"]), F.struct(F.col("readme_base64").isNotNull(), "stargazers_count")).alias("x")).select("full_name", "x.*")
    readme = F.try_to_binary("readme_base64", F.lit("base64")).cast("string")
    said = lambda c: F.coalesce(c.rlike(rf"(?i)(?<![A-Za-z0-9_]){word}(?![A-Za-z0-9_])"), F.lit(False))
    in_meta = said(F.concat_ws(" ", "full_name", "description", F.concat_ws(" ", "topics")))
    out = r.withColumn("readme", readme).withColumn("relevance", repository_relevance(said(readme), in_meta, F.coalesce("found_in_code", F.lit(False))))
    return out.filter("relevance > 0").select("full_name", F.col("owner.login").alias("owner"), artifact_type(F.col("topics"), F.col("description")).alias("artifact_type"), "description", "html_url", "language", "stargazers_count", "relevance", F.substring("readme", 1, 500).alias("excerpt"))


def profile_identities(profiles: DataFrame) -> DataFrame:
    """(login, platform, handle): accounts of profiles from their fields, biography and blog."""
    about = F.concat_ws(" ", "bio", "blog")
    linkedin = F.nullif(F.regexp_extract(about, r"(?i)linkedin\.com/in/([A-Za-z0-9_-]+)", 1), F.lit(""))
    twitter = F.coalesce(F.nullif(F.trim("twitter_username"), F.lit("")), F.nullif(F.regexp_extract(about, r"(?i)(?:twitter|x)\.com/@?([A-Za-z0-9_]{2,})", 1), F.lit("")))
    found = F.array_compact(F.array(
        F.struct(F.lit("github").alias("platform"), F.col("login").alias("handle")), F.when(twitter.isNotNull(), F.struct(F.lit("twitter").alias("platform"), twitter.alias("handle"))),
        F.when(linkedin.isNotNull(), F.struct(F.lit("linkedin").alias("platform"), linkedin.alias("handle"))),
    ))
    return profiles.select("login", F.explode(found).alias("i")).select("login", "i.platform", F.regexp_replace(F.lower(F.trim("i.handle")), "^@", "").alias("handle")).distinct()


def accounts_to_poll(identities: DataFrame, platform: str, otherwise: list[str]) -> DataFrame:
    """(handle): the accounts of a platform in lower case, each once; a given list where there is none."""
    found = identities.filter(F.col("platform") == platform).select(F.lower(F.trim("handle")).alias("handle")).filter("handle <> ''").distinct()
    return found if found.limit(1).count() else identities.sparkSession.createDataFrame([(h,) for h in otherwise], "handle string")


def with_top(owners: DataFrame, things: DataFrame, on: str, rank: Column, keep: str, n: int) -> DataFrame:
    """owners with `top`: the `keep` values of their n highest-ranked things, best first, none as an empty array."""
    place = F.row_number().over(Window.partitionBy(on).orderBy(F.desc(rank)))
    best = things.withColumn("_k", place).filter(F.col("_k") <= n).groupBy(on).agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", keep))), lambda x: x[keep]).alias("top"))
    return owners.join(best, on, "left").withColumn("top", F.coalesce("top", F.array()))


def two_passes(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """(key, second_only): what two searches found, each once, marked where only the second did."""
    one = first.select(key).dropna().distinct()
    only = second.select(key).dropna().distinct().join(one, key, "left_anti")
    return one.withColumn("second_only", F.lit(False)).unionByName(only.withColumn("second_only", F.lit(True)))


# -- event pages --------------------------------------------------------------------------------

EVENT = (
    "url string, title string, description string, starts_at string, ends_at string, venue_name string, venue_city string, venue_country string, mode string, "
    "organizers array<struct<name:string,url:string>>"
)
#: First path parts of pages that are no events, fixed values.
NAVIGATION = frozenset("discover login signup signin home create pricing about help terms privacy press manage settings communities community calendar event events u p i cdn-cgi".split())


def event_pages(pages: DataFrame) -> DataFrame:
    """Events from pages (url, html), one row for each page that names one: JSON-LD first, then embedded
    page data, then meta tags and what the page shows. Times become timestamps in UTC, text that
    names no time null, as are fields that are missing; the slug is the last part of the address."""
    from ..functions.dates import tolerant_timestamp
    from ..functions.html import html_text, meta_content, visible_count

    read = pages.select("url", "html").filter("html is not null").join(_embedded(pages).withColumnRenamed("url", "_url"), F.col("url").eqNullSafe(F.col("_url")), "left").drop("_url")
    meta = lambda name: F.nullif(F.trim(html_text(meta_content(F.col("html"), name))), F.lit(""))
    title = F.coalesce("title", F.when(meta("og:type").contains("event") | meta("og:title").isNotNull(), meta("og:title")))
    slug = F.regexp_replace(F.substring_index(F.regexp_replace(F.split("url", r"\?")[0], "/+$", ""), "/", -1), "\\s", "")
    return read.select(
        slug.alias("slug"), "url", title.alias("title"), F.coalesce("description", meta("og:description"), meta("description")).alias("description"),
        tolerant_timestamp(F.coalesce("starts_at", meta("event:start_time"))).alias("starts_at"), tolerant_timestamp(F.coalesce("ends_at", meta("event:end_time"))).alias("ends_at"),
        "venue_name", "venue_city", "venue_country", "mode", visible_count(F.col("html"), "(?:attending|going|registered)").alias("registered_count"), meta("og:image").alias("cover_image_url"),
        F.coalesce("organizers", F.array().cast("array<struct<name:string,url:string>>")).alias("organizers"),
    ).filter("title is not null")


def events_to_store(events: DataFrame) -> DataFrame:
    """Events that can be stored, which need a title and a start; of one slug the row with most fields."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in ("description", "ends_at", "venue_name", "venue_city", "venue_country")), F.lit(0))
    whole = events.filter("title is not null and starts_at is not null")
    return whole.groupBy("slug").agg(F.max_by(F.struct(*[c for c in whole.columns if c != "slug"]), F.struct(filled, "url")).alias("e")).select("slug", "e.*")


def profile_handle(url: Column) -> Column:
    """The handle in the address of a profile: behind /u/ or /user/, else the first part of the path."""
    path = F.filter(F.split(F.regexp_replace(F.try_parse_url(url, F.lit("PATH")), "^/+", ""), "/"), lambda p: p != "")
    first = F.lower(F.get(path, F.lit(0)))
    return F.nullif(F.lower(F.regexp_replace(F.when(first.isin("u", "user"), F.get(path, F.lit(1))).otherwise(first), "^@", "")), F.lit(""))


def organizer_persons(events: DataFrame) -> DataFrame:
    """(handle, canonical_name, profile_url, slugs): one person for each organizer, by the handle of the profile or else the name."""
    each = events.select("slug", F.explode("organizers").alias("o")).select("slug", F.trim("o.name").alias("name"), F.col("o.url").alias("url")).filter("name <> ''")
    keyed = each.withColumn("handle", F.coalesce(profile_handle(F.col("url")), F.lower(F.regexp_replace("name", r"\s+", "-"))))
    return keyed.groupBy("handle").agg(F.min("name").alias("canonical_name"), F.min("url").alias("profile_url"), F.array_sort(F.collect_set("slug")).alias("slugs"))


def _embedded(pages: DataFrame) -> DataFrame:
    """What the JSON of each page says of its event; pages without such JSON give no row."""
    from ..functions.html import is_event, json_blocks, visit

    def text(x: object) -> str | None:
        if isinstance(x, dict):
            x = x.get("name")
        return x.strip() or None if isinstance(x, str) else None

    def pick(nodes: list[dict], *keys: str) -> str | None:
        return next((t for n in nodes for k in keys if (t := text(n.get(k)))), None)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for url, html in zip(pdf["url"], pdf["html"]):
                blocks = list(json_blocks(html))
                named = [n for b in blocks for n in visit(b) if is_event(n)]
                data = [n for b in blocks for n in visit(b) if "start_at" in n or "startAt" in n]
                nodes = [*named, *data]
                if not nodes:
                    continue
                places = [p for n in nodes for p in [n.get("location")] if isinstance(p, dict)]
                addresses = [a for p in places for a in [p.get("address")] if isinstance(a, dict)]
                hosts = [h for n in nodes for k in ("organizer", "hosts") for h in (n.get(k) if isinstance(n.get(k), list) else [n.get(k)]) if isinstance(h, dict)]
                seen: dict[str, dict] = {}
                for h in hosts:
                    if name := text(h.get("name")):
                        seen.setdefault(str(h.get("url") or name).lower(), {"name": name, "url": h.get("url")})
                rows.append((
                    url, pick(nodes, "name", "title"), pick(nodes, "description"), pick(nodes, "startDate", "start_at", "startAt"), pick(nodes, "endDate", "end_at", "endAt"), pick(places, "name"),
                    pick(addresses, "addressLocality", "city") or pick(data, "city"), pick(addresses, "addressCountry", "country") or pick(data, "country"), pick(nodes, "eventAttendanceMode"), list(seen.values()),
                ))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in EVENT.split(", ")])

    return pages.select("url", "html").filter("html is not null").mapInPandas(parse, EVENT)


def event_links(pages: DataFrame, host: str) -> DataFrame:
    """(slug): what pages of a community link to on the host, without navigation."""
    from ..functions.html import links

    href = pages.select(F.explode(links(F.col("html"))).alias("href"))
    path = F.when(F.col("href").startswith("/"), F.col("href")).when(F.try_parse_url("href", F.lit("HOST")) == host, F.try_parse_url("href", F.lit("PATH")))
    first = F.get(F.split(F.regexp_replace(path, "^/", ""), "[/?]"), F.lit(0))
    return href.select(F.lower(first).alias("slug")).filter(F.col("slug").rlike("^[a-z0-9][a-z0-9-]{3,}$") & ~F.col("slug").isin(*sorted(NAVIGATION))).distinct()
