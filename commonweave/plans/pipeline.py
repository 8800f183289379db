"""End-to-end runs: raw pages of each source into envelopes, talk, authors as persons, and views."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonx import payload_hash
from ..operators import resolve as I
from ..sources import raw, sinks

#: How the pages of a source become talk.
NORMALIZERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "hackernews": lambda pages: raw.news_communications(raw.news_hits(pages)),
    "reddit": lambda pages: raw.forum_communications(raw.forum_things(pages)),
}
_TALK = ("source_platform", "source_record_id", "author_handle_raw", "content_text", "content_url", "posted_at", "engagement_likes", "engagement_replies", "parent_record_id")


def stored(spark: SparkSession, store: str, name: str) -> DataFrame:
    """The present version of a table of the store."""
    return sinks.read_version(spark, f"{store}/{name}")


def backfill(spark: SparkSession, pages: Mapping[str, DataFrame], store: str) -> dict[str, dict[str, int]]:
    """Run every source and then the tables that need all of them; returns the counters of each source.

    Pages (payload) go into envelopes keyed by their hash, so a page met again is no new row. A
    page that is no JSON fails alone and is kept with its error. Talk is keyed by platform and
    record; its authors are collapsed to persons. Each table is written as a new version, so that a run that is repeated replaces what it wrote."""
    counters, every = {}, []
    for name, source in pages.items():
        once = source.filter("payload is not null").dropDuplicates(["payload"])
        wrapped = raw.envelope(once, name, payload_hash(F.col("payload")), F.current_timestamp())
        ok = F.try_parse_json("payload").isNotNull()
        sinks.write_version(raw.mark(wrapped, ok, F.current_timestamp(), F.lit("no JSON")), f"{store}/raw_{name}")
        kept = stored(spark, store, f"raw_{name}")
        talk = NORMALIZERS[name](kept.filter("status = 'success'").select("payload")).select(*_TALK).dropDuplicates(["source_platform", "source_record_id"])
        sinks.write_version(talk, f"{store}/talk_{name}")
        talk = stored(spark, store, f"talk_{name}")
        seen = kept.agg(F.count("*").alias("pages"), F.count(F.when(F.col("status") == "failed", 1)).alias("failed")).first()
        told = talk.agg(F.count("*").alias("talk"), F.count_distinct(F.lower("author_handle_raw")).alias("authors")).first()
        counters[name] = {"pages": seen["pages"], "failed": seen["failed"], "talk": told["talk"], "authors": told["authors"]}
        every.append(talk)
    if every:
        sinks.refresh({"communication": lambda: reduce(DataFrame.unionByName, every), "person": lambda: persons_of(stored(spark, store, "communication"))}, store)
    return counters


def persons_of(talk: DataFrame) -> DataFrame:
    """Persons for the authors of talk, resolved among themselves by the accounts that they write from."""
    none_a, none_s = F.array().cast("array<string>"), F.lit(None).cast("string")
    account = F.concat_ws(":", "source_platform", "handle")
    found = raw.authors(talk).select(
        account.alias("id"), F.array("canonical_name").alias("names"), none_a.alias("emails"), *[none_s.alias(c) for c in ("city", "country", "timezone", "employer")], F.array(account).alias("accounts"),
        *[none_s.alias(c) for c in ("github", "twitter", "linkedin")], none_a.alias("event_ids"), none_a.alias("connected_ids"),
    )
    records = I.prepare(found, "id")
    everyone = records.select(F.col("key").alias("record"), F.lit("create_new").alias("action"))
    return I.new_persons(everyone, records)
