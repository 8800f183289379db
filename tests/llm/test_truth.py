"""Surviving values of duplicate groups."""

from __future__ import annotations

import random

import datetime as dt

from commonweave.llm.truth import discover_sources, discover_truth

T1, T2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
SCHEMA = "group_id long, source_id string, field_name string, field_value string, seen_at timestamp, support string"


def run(spark, rows, lists=()):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    return {(r["group_id"], r["field_name"], r["field_value"]) for r in discover_truth(df, lists).collect()}


def test_newest_wins_and_lists_keep_all(spark):
    rows = [(1, "a", "city", "x", T1), (1, "b", "city", "x", T1), (1, "c", "city", "y", T2), (1, "a", "names", "n", None), (1, "b", "names", "m", None), (1, "b", "names", "m", None), (2, "d", "city", "z", None)]
    assert run(spark, rows, ("names",)) == {(1, "city", "y"), (1, "names", "n"), (1, "names", "m"), (2, "city", "z")}


def test_reliable_source_decides_between_equal_dates(spark):
    rows = [(1, s, f, "good", T1) for s in ("a", "b") for f in ("f1", "f2")] + [(1, "c", f, "bad", T1) for f in ("f1", "f2")]
    rows += [(1, "a", "f3", "zz", T1), (1, "c", "f3", "aa", T1)]
    assert (1, "f3", "zz") in run(spark, rows)


def test_ties_nulls_many_and_empty(spark):
    assert run(spark, [(1, "a", "f", "q", T1), (1, "b", "f", "p", T1)]) == {(1, "f", "p")}
    assert run(spark, [(None, "a", "f", "q", T1), (1, None, "f", "q", T1), (1, "a", None, "q", T1), (1, "a", "f", None, T1)]) == set()
    assert run(spark, []) == set()
    assert run(spark, [(1, f"s{i}", "f", f"v{i % 7}", T1) for i in range(500)] + [(1, "new", "f", "last", T2)]) == {(1, "f", "last")}


def test_reliable_sources_outvote_many_that_err_alike(spark, monkeypatch):
    """Two good sources against three that mostly claim one wrong value: far better than the majority."""
    rng = random.Random(8)
    claims, truth, majority = [], {}, {}
    for g in range(300):
        truth[g] = f"v{rng.randrange(9)}"
        wrong = truth[g] + "x"
        said = [truth[g] if rng.random() < (0.95 if s < 2 else 0.35) else wrong for s in range(5)]
        claims += [(g, f"s{s}", "f", v) for s, v in enumerate(said)]
        majority[g] = max(sorted(set(said)), key=said.count)
    df = spark.createDataFrame(claims + claims[:20] + [(0, "s0", "f", None), (None, "s1", "f", "x")], "group_id long, source_id string, field_name string, field_value string")
    right = lambda found: sum(found[g] == v for g, v in truth.items()) / len(truth)
    for few in (10_000, 0):
        monkeypatch.setattr("commonweave.llm.truth.SOURCES", few)
        merged, sources = discover_sources(df)
        found = {r["group_id"]: r["field_value"] for r in merged.collect()}
        assert right(majority) < 0.75 and right(found) > 0.9
        accuracy = {r["source_id"]: r["accuracy"] for r in sources.collect()}
        assert min(accuracy["s0"], accuracy["s1"]) > 0.85 > 0.6 > max(accuracy[f"s{k}"] for k in (2, 3, 4))
    assert discover_sources(df.limit(0))[0].count() == 0
