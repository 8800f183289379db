"""Identity resolution on literal records."""

from __future__ import annotations

import pytest

from commonweave.operators import resolve as I

SCHEMA = "id string, names array<string>, emails array<string>, city string, country string, timezone string, employer string, accounts array<string>, github string, twitter string, linkedin string, event_ids array<string>, connected_ids array<string>"


def rec(key, names=(), emails=(), city=None, country=None, timezone=None, employer=None, accounts=(), github=None, twitter=None, linkedin=None, events=(), connected=()):
    return (key, list(names), list(emails), city, country, timezone, employer, list(accounts), github, twitter, linkedin, list(events), list(connected))


PERSONS = [
    rec("p1", ["Alice Chen"], ["alice@acme.example"], "Lisbon", "PT", "Europe/Lisbon", "acme", ["github:alicec"]),
    rec("p2", ["Robert Okafor"], [], "Berlin", "DE", "Europe/Berlin", "globex", ["twitter:robo"], connected=["a", "b", "c"], events=["e1", "e2"]),
    rec("p3", ["Maria Lopez"], ["m@gmail.com"], "Madrid", "ES", "Europe/Madrid", None),
]
CASES = {
    "mail": (rec("mail", ["A. C."], ["ALICE@acme.example "]), "merge", "p1"),
    "account": (rec("account", ["x"], [], accounts=["github:@AliceC"]), "merge", "p1"),
    "bio": (rec("bio", ["Robert Okafor"], twitter="@Robo"), "merge", "p2"),
    "context": (rec("context", ["Robert Okafor"], city="berlin", employer="globex"), "merge", "p2"),
    "domain": (rec("domain", ["Alice Chen"], ["a.chen@acme.example"]), "merge", "p1"),
    "stranger": (rec("stranger", ["Yuki Tanaka"], ["y@t.example"]), "create_new", None),
    "first name": (rec("first name", ["Maria Wagner"], city="Vienna"), "create_new", None),
    "free mail": (rec("free mail", ["Jon Smith"], ["j@gmail.com"]), "create_new", None),
    "other city": (rec("other city", ["Robert Okafor"], city="Lagos", country="NG"), "create_new", None),
    "fuzzy alone": (rec("fuzzy alone", ["Robert Okaforr"]), None, None),
}


def frames(spark):
    records = spark.createDataFrame([c[0] for c in CASES.values()], SCHEMA)
    return I.prepare(records, "id"), I.prepare(spark.createDataFrame(PERSONS, SCHEMA), "id")


def test_decisions(spark):
    records, persons = frames(spark)
    got = {r["record"]: r for r in I.resolve(records, persons).collect()}
    assert len(got) == len(CASES)
    wrong = {k: (got[k]["action"], got[k]["person"]) for k, (_, action, person) in CASES.items() if action and (got[k]["action"], got[k]["person"]) != (action, person)}
    assert not wrong
    assert got["mail"]["reasoning"] == "explicit link" and got["context"]["reasoning"].startswith("name_exact")


def test_confidence_formula(spark):
    from pyspark.sql import functions as F

    rows = [([("name_fuzzy", 0.2, 0.5), ("employer_match", 0.3, 1.0), ("city_match", 0.2, 1.0)], 0.6 / 0.7 + 0.09), ([("city_match", 0.2, 1.0)], 1.0), ([("name_fuzzy", 0.2, 0.5), ("city_match", 0.2, 1.0)], 0.81), ([], 0.0)]
    df = spark.createDataFrame([(list(s),) for s, _ in rows], "s array<struct<kind:string,weight:double,confidence:double>>")
    got = [r[0] for r in df.select(I.confidence(F.col("s"))).collect()]
    assert got == pytest.approx([w for _, w in rows])


def test_guard_merge_effects_and_collapse(spark):
    records, persons = frames(spark)
    resolved = I.resolve(records, persons, require_identity_signal=True)
    after = {r["key"]: r for r in I.apply_merges(resolved, records, persons).collect()}
    assert set(after) == {"p1", "p2", "p3"} and "a.chen@acme.example" in after["p1"]["emails"] and after["p1"]["emails"][0] == "alice@acme.example"
    new = I.prepare(spark.createDataFrame([rec("n1", ["A"], ["k@x.example"]), rec("n2", ["B"], ["K@x.example"], accounts=["github:z"]), rec("n3", ["C"], accounts=["github:z"]), rec("n4", ["D"])], SCHEMA), "id")
    assert {r["record"]: r["entity"] for r in I.collapse_new(new).collect()} == {"n1": "n1", "n2": "n1", "n3": "n1", "n4": "n4"}
    assert {(r["record"], r["field"]) for r in I.conflicts(I.resolve(records, persons), records, persons).collect()} == set()


def test_empty(spark):
    records, persons = frames(spark)
    assert I.resolve(records.limit(0), persons).count() == 0
    assert {r["action"] for r in I.resolve(records, persons.limit(0)).collect()} == {"create_new"}
