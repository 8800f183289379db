"""Hierarchies against a walk in plain Python."""

from __future__ import annotations

import random

from commonweave.operators.hierarchy import descendants, hierarchy
from commonweave.plans.threads import comment_links


def walk(parents: dict[str, str | None]) -> dict[str, tuple[str, int]]:
    out = {}
    for node in parents:
        seen, at = [node], node
        while at in parents and parents[at] is not None and parents[at] not in seen:
            at = parents[at]
            seen.append(at)
        looped = at in parents and parents[at] is not None
        out[node] = ("cycle", -1) if looped else (at, len(seen) - 1)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, parent string, path string")


def test_random_forests_with_cycles(spark):
    random.seed(7)
    for size in (1, 40):
        parents = {f"n{i}": random.choice([None, f"n{random.randrange(size)}", f"x{random.randrange(3)}"]) for i in range(size)}
        got = {r["id"]: (r["root_id"], r["depth"]) for r in hierarchy(frame(spark, [(k, v, "clash") for k, v in parents.items()]), "id", "parent").collect()}
        assert got == walk(parents)


def test_deep_chain_paths_and_descendants(spark):
    rows = [(f"n{i}", f"n{i - 1}" if i else "top", "") for i in range(70)]
    found = {r["id"]: r for r in hierarchy(frame(spark, rows), "id", "parent", with_path=True).collect()}
    assert found["n69"]["root_id"] == "top" and found["n69"]["depth"] == 70
    assert found["n2"]["path"] == ["top", "n0", "n1", "n2"]
    below = descendants(frame(spark, rows), "id", "parent")
    assert below.filter("ancestor_id = 'n60'").count() == 9 and below.filter("ancestor_id = 'top'").agg({"distance": "max"}).first()[0] == 70


def test_hot_parent_repeated_rows_nulls_and_empty(spark):
    rows = [(f"c{i}", "hub", "") for i in range(300)] + [("c1", "hub", ""), (None, "hub", ""), ("lone", None, ""), ("self", "self", "")]
    got = {r["id"]: (r["root_id"], r["depth"]) for r in hierarchy(frame(spark, rows), "id", "parent").collect()}
    assert len(got) == 302 and got["c7"] == ("hub", 1) and got["lone"] == ("lone", 0) and got["self"] == ("cycle", -1)
    assert hierarchy(frame(spark, []), "id", "parent").count() == 0


def test_comment_links_latest_row_and_spellings(spark):
    schema = "thing_id string, kind string, parent_id string, link_id string, post_fullname string, fetched_at timestamp, extra int"
    import datetime as dt

    old, new = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    rows = [
        ("t1_a", "t1", "t1_b", "t3_p", "t3_p", old, 1), ("t1_a", "t1", ' "T1_C" ', "t3_p", "t3_p", new, 1), ("t1_d", "t1", "P", "t3_p", "t3_p", old, 1), ("t1_e", "t1", "zz", "t3_p", "t3_p", old, 1),
        ("t1_f", "t1", " ", None, "t3_q", old, 1), ("t1_g", "t1", None, "T3_P", "t3_p", old, 1), ("t3_p", "t3", None, None, "t3_p", old, 1),
    ]
    got = {r["thing_id"]: r["parent"] for r in comment_links(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"t1_a": "t1_c", "t1_d": "t3_p", "t1_e": "t1_zz", "t1_f": "t3_q", "t1_g": "t3_p"}
