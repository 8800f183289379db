"""Writes as frames, sources, sinks, guarded SQL and streams."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from commonweave.operators import graph, quality, records as R
from commonweave.operators.scoring import artifact_type, event_format, event_status, text_relevance
from commonweave.plans import adhoc
from commonweave.sources import raw, sinks
from commonweave.streaming import ingest


def test_insert_once_and_upsert(spark):
    old = spark.createDataFrame([("a", 1, 5)], "k string, t int, v int")
    new = spark.createDataFrame([("a", 2, 9), ("b", 2, 1), ("b", 1, 2)], "k string, t int, v int")
    assert sorted(map(tuple, R.insert_once(old, new, ["k"], "t").collect())) == [("a", 1, 5), ("b", 1, 2)]
    assert sorted(map(tuple, R.upsert(old, new, ["k"], "t").collect())) == [("a", 2, 9), ("b", 2, 1)]


def test_patch_repoint_merge_edges(spark):
    person = spark.createDataFrame([("1", "a", True), ("2", None, True)], "id string, city string, is_active boolean")
    assert {r["id"]: r["city"] for r in R.patch(person, spark.createDataFrame([("2", "b"), ("1", None)], "id string, city string"), "id").collect()} == {"1": "a", "2": "b"}
    merged = spark.createDataFrame([("2", "1")], "old_id string, new_id string")
    assert {r["id"]: (r["is_active"], r["merged_into"]) for r in R.merge_persons(person, merged).collect()} == {"1": (True, None), "2": (False, "1")}
    edges = spark.createDataFrame([("1", "2", "x", 3), ("3", "2", "x", 1), ("3", "1", "x", 1)], "src string, dst string, edge_type string, strength int")
    assert [tuple(r) for r in R.repoint_edges(edges, merged).collect()] == [("3", "1", "x", 2)]
    seen = spark.createDataFrame([("1", "2", "x", "r", 1), ("1", "2", "x", "r", 2), ("1", "1", "x", "q", 1)], "src string, dst string, edge_type string, record_id string, seen_at int")
    assert [r["strength"] for r in R.edges_from_observations(seen).collect()] == [1]


def test_hops_and_quality(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    got = {(r["node"], r["depth"]) for r in graph.within_hops(edges, spark.createDataFrame([("a",)], "id string"), 3).collect()}
    assert got == {("b", 1), ("c", 2), ("d", 3)}
    hist = {r["bucket"]: r["n"] for r in quality.confidence_histogram(spark.createDataFrame([(1.0,), (0.95,), (0.0,), (None,)], "c double"), "c").collect()}
    assert hist[10] == 1 and hist[9] == 1 and hist[0] == 1 and sum(hist.values()) == 3 and len(hist) == 11


def test_rules(spark):
    df = spark.createDataFrame([("the agent, an AI editor", "webdev"), ("agents only", "x"), (None, None)], "t string, s string")
    got = [r[0] for r in df.select(text_relevance("t", "s", "agent", ("p",), ("webdev",), {"ai": 0.1, "editor": 0.15}, {"sql": 0.1})).collect()]
    assert got == [0.85, 0.0, 0.0]
    at = dt.datetime(2025, 1, 2)
    row = spark.createDataFrame([(["MCP"], "x", dt.datetime(2025, 1, 1), None, at, "https://schema.org/OnlineEventAttendanceMode", None, "")], "t array<string>, d string, s timestamp, e timestamp, o timestamp, m string, f boolean, h string")
    got = row.select(artifact_type(F.col("t"), F.col("d")), event_status(F.col("s"), F.col("e"), F.col("o")), event_format(F.col("m"), F.col("f"), F.col("h"))).first()
    assert tuple(got) == ("mcp_config", "completed", "virtual")


def test_forum_tree(spark):
    comment = lambda i, p, replies="": {"kind": "t1", "data": {"id": i, "parent_id": p, "link_id": "t3_p", "subreddit": "s", "author": "u", "body": "", "created_utc": "1.5", "permalink": "/x", "replies": replies}}
    post = {"kind": "t3", "data": {"id": "p", "subreddit": "s", "title": "T", "author": "[deleted]", "created_utc": 1, "permalink": "/p", "selftext": "[removed]"}}
    inner = {"data": {"children": [comment("c2", "t1_c1"), {"kind": "more", "data": {}}, {"kind": "t1", "data": {"id": "bad"}}]}}
    thread = [{"data": {"children": [post]}}, {"data": {"children": [comment("c1", "t3_p", inner), comment("c3", "t3_p")]}}]
    things = raw.forum_things(spark.createDataFrame([(json.dumps(thread),), ("broken",), (None,)], "payload string"))
    assert [r["id"] for r in things.collect()] == ["p", "c1", "c2", "c3"]
    talk = {r["source_record_id"]: r for r in raw.forum_communications(things).collect()}
    assert talk["t3_p"]["content_text"] == "T" and talk["t3_p"]["author_handle_raw"] is None and talk["t1_c2"]["content_text"] is None


def test_news_repositories_pages(spark):
    page = {"hits": [{"objectID": "1", "author": "a", "title": "t", "url": "u", "_tags": ["author_a", "story"], "created_at_i": 10}, {"objectID": "2", "author": None, "comment_text": "x", "created_at_i": 20}], "page": 0}
    hits = raw.news_hits(spark.createDataFrame([(json.dumps(page),)], "payload string"))
    talk = raw.news_communications(hits).collect()
    assert [(r["item_type"], r["content_text"], r["content_url"], r["topic_tags"], r["engagement_likes"]) for r in talk] == [("story", "t", "u", ["story"], 0)]
    assert raw.news_hits(spark.createDataFrame([(json.dumps(page),)], "payload string"), since=10).count() == 1
    repos = [{"full_name": "o/r", "owner": {"login": "o"}, "description": "MCP agent kit", "topics": [], "stargazers_count": 1, "readme_base64": "YW4gYWdlbnQ="}, {"full_name": "o/q", "private": True}, {"full_name": "o/z", "description": "agents"}]
    got = raw.repositories(spark.createDataFrame([(json.dumps(r),) for r in repos], "payload string"), "agent").collect()
    assert [(r["full_name"], r["relevance"], r["artifact_type"]) for r in got] == [("o/r", 0.9, "mcp_config")]
    html = '<script type="application/ld+json">{"@graph":[{"@type":"Event","name":"E","startDate":"2025-01-01","location":{"name":"V","address":{"addressLocality":"C"}},"organizer":[{"name":"O","url":"u"},{"name":"O","url":"u"}]}]}</script><a href="/demo-night">x</a><a href="/discover">y</a>'
    pages = spark.createDataFrame([("https://x.example/e1", html), ("u2", "<p>"), ("u3", None)], "url string, html string")
    event = raw.event_pages(pages).collect()
    assert len(event) == 1 and event[0]["title"] == "E" and event[0]["venue_city"] == "C" and len(event[0]["organizers"]) == 1
    assert [r["slug"] for r in raw.event_links(pages, "x.example").collect()] == ["demo-night"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "k int, v string")
    sinks.write_version(df, str(tmp_path / "t"))
    sinks.write_version(df.limit(1), str(tmp_path / "t"))
    assert sinks.read_version(spark, str(tmp_path / "t")).count() == 1
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    assert sinks.markdown_table(df).splitlines()[0] == "| k | v |"


def test_guarded_sql(spark):
    spark.range(10).createOrReplaceTempView("ten")
    assert len(adhoc.run_select(spark, "select * from ten;", max_rows=3).rows) == 3
    assert adhoc.run_select(spark, "```sql\nselect ';' as x\n```").rows[0]["x"] == ";"
    for sql, code in (("", "empty"), ("select 1; select 2", "multiple"), ("drop table ten", "not_select"), ("selectx", "not_select"), ("with a as (select 1) insert into ten select * from a", "syntax"), ("select nope from ten", "unknown_name")):
        with pytest.raises(adhoc.QueryRefused) as e:
            adhoc.run_select(spark, sql)
        assert e.value.code == code
    now = [0.0]
    asker = adhoc.Asker(spark, {"ten": lambda: spark.table("ten")}, clock=lambda: now[0])
    assert not asker.preset("ten").from_cache and asker.preset("ten").from_cache
    now[0] = 301.0
    assert not asker.preset("ten").from_cache and "ten(id bigint)" in adhoc.schema_brief(spark)


def test_timeout(spark):
    with pytest.raises(adhoc.QueryRefused) as e:
        adhoc.run_select(spark, "select count(*) from range(0, 40000000000) where sin(id) > 2", timeout_s=1.0)
    assert e.value.code == "timeout"


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([("a", dt.datetime(2025, 1, 1, 0, 1), "x", 1.0), ("a", dt.datetime(2025, 1, 1, 0, 2), "x", 2.0), ("b", dt.datetime(2025, 1, 1, 2), "y", 3.0)], "k string, t timestamp, g string, v double")
    rows.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.read_stream(spark, str(tmp_path / "in"), rows.schema)
    assert ingest.run_to_table(ingest.once_per_key(stream, ["k"], "t"), str(tmp_path / "once")).count() == 2
    counts = ingest.run_to_table(ingest.windowed_counts(stream, "t", "g", "v", "1 hour", "1 hour"), str(tmp_path / "counts"), "complete")
    assert {(r["g"], r["n"], r["total"]) for r in counts.collect()} == {("x", 2, 3.0), ("y", 1, 3.0)}
    for _ in range(2):
        ingest.ingest_raw(stream, str(tmp_path / "store"), ["k"], "t", str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "store")).count() == 2


def test_statements_reach_only_the_catalog(spark):
    spark.range(3).createOrReplaceTempView("three")
    for sql, code in (
        ("select java_method('java.lang.System', 'getProperty', 'user.name')", "function"), ("select * from three where reflect('java.lang.System', 'getProperty', 'user.name') is null", "function"),
        ("select value from text.`/etc/hostname`", "not_a_table"), ("with x as (select * from parquet.`/tmp`) select * from x", "not_a_table"),
        ("select (select max(value) from csv.`/etc/hostname`) from three", "not_a_table"), ("select * from three where exists (select 1 from json.`/etc/hostname`)", "not_a_table"),
        ("select * from nowhere", "unknown_name"), ("select * fro three", "syntax"),
    ):
        with pytest.raises(adhoc.QueryRefused) as e:
            adhoc.run_select(spark, sql)
        assert e.value.code == code, sql
    assert len(adhoc.run_select(spark, "with x as (select id from three union all select * from range(2)) select * from x join three using (id)").rows) == 5


def test_every_attempt_is_logged(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("three")
    broken = lambda: spark.sql("select raise_error('x') as a from three")
    asker = adhoc.Asker(spark, {"three": lambda: spark.table("three"), "broken": broken}, sink=adhoc.log_folder(spark, str(tmp_path / "log")))
    asker.ask(preset="three"), asker.ask(preset="three")
    for attempt in (lambda: asker.preset("broken"), lambda: asker.preset("none"), lambda: asker.sql("select raise_error('y') from three"), lambda: asker.question("?"), lambda: asker.ask()):
        with pytest.raises(Exception):  # noqa: B017
            attempt()
    outcomes = [e["outcome"] for e in asker.log]
    assert outcomes == ["ok", "cached", "error", "unknown_preset", "error", "no_translator", "empty"]
    assert sorted(r["outcome"] for r in spark.read.json(str(tmp_path / "log")).collect()) == sorted(outcomes)
    failing = adhoc.Asker(spark, {"three": lambda: spark.table("three")}, sink=lambda _: 1 / 0)
    assert len(failing.preset("three").rows) == 3 and failing.log[0]["unsaved"]


def test_event_pages_fall_back_to_what_the_page_says(spark):
    meta = '<meta property="og:title" content="Night &amp; Day"><meta content="2025-03-01T18:30:00+02:00" name="event:start_time"><meta name="description" content="d"> 1,234 people going'
    data = '<script type="application/json">{"a":[{"title":"P","start_at":"soon","city":"Y","hosts":[{"name":"Ann Lee","url":"https://x.example/u/AnnL"}]}]}</script>'
    later = data.replace("soon", "2025-04-02")
    pages = spark.createDataFrame([("https://x.example/night?u=1", meta), ("https://x.example/p/", data), ("https://y.example/p", later), ("https://x.example/none", "<p>nothing</p>")], "url string, html string")
    got = {r["url"]: r for r in raw.event_pages(pages).collect()}
    night = got["https://x.example/night?u=1"]
    assert (night["slug"], night["title"], night["description"], night["registered_count"], str(night["starts_at"])) == ("night", "Night & Day", "d", 1234, "2025-03-01 16:30:00")
    assert got["https://x.example/p/"]["starts_at"] is None and got["https://x.example/p/"]["venue_city"] == "Y" and len(got) == 3
    stored = raw.events_to_store(raw.event_pages(pages)).collect()
    assert sorted((r["slug"], r["title"]) for r in stored) == [("night", "Night & Day"), ("p", "P")]
    people = raw.organizer_persons(raw.event_pages(pages)).collect()
    assert [(r["handle"], r["canonical_name"], r["slugs"]) for r in people] == [("annl", "Ann Lee", ["p"])]


def test_a_whole_run(spark, tmp_path):
    """Pages of two sources are stored once, normalized, resolved and counted; a second run changes nothing."""
    from commonweave.plans import pipeline

    news = json.dumps({"hits": [{"objectID": "1", "author": "ann", "title": "t", "_tags": ["story"], "created_at_i": 10}, {"objectID": "2", "author": "bo", "comment_text": "hi @ann", "created_at_i": 20, "_tags": ["comment"]}, {"objectID": "3", "author": None, "created_at_i": 30}]})
    post = {"kind": "t3", "data": {"id": "p", "subreddit": "s", "title": "T", "author": "cy", "created_utc": 5, "permalink": "/p"}}
    forum = json.dumps({"kind": "Listing", "data": {"children": [post]}})
    pages = {"hackernews": spark.createDataFrame([(news,), ("{broken",)], "payload string"), "reddit": spark.createDataFrame([(forum,)], "payload string")}
    for _ in range(2):
        out = pipeline.backfill(spark, pages, str(tmp_path / "store"))
        assert out == {"hackernews": {"pages": 2, "failed": 1, "talk": 2, "authors": 2}, "reddit": {"pages": 1, "failed": 0, "talk": 1, "authors": 1}}
        talk = pipeline.stored(spark, str(tmp_path / "store"), "communication")
        assert sorted(r["source_record_id"] for r in talk.collect()) == ["1", "2", "t3_p"]
        people = pipeline.stored(spark, str(tmp_path / "store"), "person")
        assert sorted(r["canonical_name"] for r in people.collect()) == ["ann", "bo", "cy"]
    assert {r["status"] for r in pipeline.stored(spark, str(tmp_path / "store"), "raw_hackernews").collect()} == {"success", "failed"}
