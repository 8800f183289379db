"""The BK-tree and typed places."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from commonweave.llm.editmetric import BkTree, damerau, fold, levenshtein, skeleton
from commonweave.llm.place_queries import place_hints
from commonweave.llm.places import PlaceList, find_place, map_places

WORD = st.text("abcd", max_size=8)


def plain_levenshtein(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(WORD, WORD, WORD)
def test_metrics(a, b, c):
    assert levenshtein(a, b) == plain_levenshtein(a, b)
    assert damerau(a, b) == damerau(b, a) <= levenshtein(a, b) <= 2 * damerau(a, b)
    assert damerau(a, c) <= damerau(a, b) + damerau(b, c)


def test_tree_equals_scan():
    random.seed(2)
    entries = ["".join(random.choice("abcde") for _ in range(random.randint(3, 9))) for _ in range(300)]
    tree = BkTree(entries)
    for _ in range(60):
        q = "".join(random.choice("abcde") for _ in range(random.randint(3, 9)))
        for r in (0, 1, 2):
            assert tree.within(q, r) == sorted((damerau(q, e), e) for e in set(entries) if damerau(q, e) <= r)
    assert BkTree([]).within("a", 2) == []


def test_folding():
    assert fold("Björkmårsta ŁÓDŹ ß") == "bjorkmarsta lodz ss" and skeleton("Викрам") == skeleton("Vikram")


ENTRIES = [(1, "Baninagar", "India", None), (2, "Baninagar", "Germany", None), (3, "Sankt Larkheim", "Austria", None), (4, "Mount Cobblehaven", "United States", None), (5, "Vogelbüttel", "Germany", "Vogelavo"), (6, None, "Kenya", None)]
TYPED = [
    ("Baninagar", "IN", None, 1), ("baninagar, Deutschland", None, None, 2), ("Baninagar", None, "Asia/Kolkata", 1), ("Larkheim, Sankt", None, None, 3), ("Sankt Lrakhiem", "AT", None, 3), ("mount-cobblehaven us", None, None, 4),
    ("Mt. Cobblehaven", None, None, 4), ("University Hill, Mount Cobblehaven, USA", None, None, 4), ("the Vogelbuettel area", "DE", None, 5), ("12345 VOGELAVO", None, None, 5), ("Mount Cobblehaven | online", None, None, 4),
    ("India", None, None, -1), ("remote", "US", None, -1), ("Kyppenokwe", None, None, -1), ("???", None, None, -1), ("x" * 5000, None, None, -1),
]


def frames(spark):
    entries = spark.createDataFrame(ENTRIES, "entry_id long, name string, country string, other string")
    values = spark.createDataFrame([(i, t, c, z, "own") for i, (t, c, z, _) in enumerate(TYPED)] + [(97, None, "US", None, ""), (98, " \t", None, None, ""), (0, *TYPED[0][:3], "own")], "k int, text string, country string, zone string, name string")
    return values, entries


def test_map_places_broadcast_and_sharded_agree(spark):
    values, entries = frames(spark)
    want = sorted((i, e) for i, (*_, e) in enumerate(TYPED)) + [(0, TYPED[0][3])]
    for limit in (1000, 2):
        got = sorted((r["k"], r["entry_id"]) for r in map_places(values, entries, place_hints(), limit, 7).collect())
        assert got == sorted(want)


def test_shards_merge_by_the_rank_of_one_list(spark):
    """Countries and names of other shards count: named in the text, beside it, or part of a name."""
    entries = spark.createDataFrame([(1, "Roma", "Spain", None), (2, "Rome", "United States", "Roma"), (3, "New Mexico", "Spain", None), (4, "New", "Mexico", None)], "entry_id long, name string, country string, other string")
    typed = ["Roma, USA", "Roma", "Roma Spain", "New Mexico", "Rmoa USA"]
    values = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(typed)], "k int, text string, country string, zone string")
    for limit in (1000, 2, 1):
        got = {r["k"]: (r["entry_id"], r["edits"]) for r in map_places(values, entries, place_hints(), limit).collect()}
        assert [got[i][0] for i in range(4)] == [2, 1, 1, 3], limit
    random.seed(11)
    lands = ["Spain", "Mexico", "United States", "Kenya"]
    part = lambda: "".join(random.choice("abc") for _ in range(random.randint(2, 5)))
    rows = [(i, part() if i % 3 else f"{part()} {random.choice(lands)}", random.choice(lands), part() if i % 4 == 0 else None) for i in range(60)]
    many = spark.createDataFrame(rows, "entry_id long, name string, country string, other string")
    asked = []
    for i in range(300):
        _, name, land, _ = random.choice(rows)
        at = random.randrange(len(name))
        typed = random.choice([name, name[:at] + name[at + 1 :], f"{name}, {random.choice(lands)}", f"{random.choice(lands)} {name}", f"{name} USA", part()]) or "x"
        asked.append((i, typed, random.choice([None, land, "us"]), random.choice([None, "Europe/Madrid", "America/Chicago"])))
    df = spark.createDataFrame(asked, "k int, text string, country string, zone string")
    one = sorted((r["k"], r["entry_id"], r["edits"]) for r in map_places(df, many, place_hints()).collect())
    assert one == sorted((r["k"], r["entry_id"], r["edits"]) for r in map_places(df, many, place_hints(), 9, 50).collect())
    assert sum(e >= 0 for _, e, _ in one) > 200


def test_every_entry_within_the_radius_is_found():
    """Against a scan of the list, readings beyond any fixed length included."""
    long = "san " + "verylongname" * 9
    places = PlaceList.of([(1, long, "Spain", None), (2, "Cobblehaven", "Kenya", None)])
    assert find_place(long.replace("long", "lnog", 1), None, None, places)[::5] == (1, 1)
    assert find_place("Cobelhaven", None, None, places)[0] == damerau("cobelhaven", "cobblehaven") and find_place("Nowhere", None, None, places) is None


def test_empty(spark):
    values, entries = frames(spark)
    assert map_places(values.limit(0), entries).count() == 0
    assert {r["entry_id"] for r in map_places(values, entries.limit(0)).collect()} == {-1}
    assert map_places(values.limit(0), entries, tree_entries=1).count() == 0
