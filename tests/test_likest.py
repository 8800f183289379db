"""The most alike names of a block against a scan of all pairs, and Jaro-Winkler of many pairs at once."""

from __future__ import annotations

import random

import pytest

from commonweave.functions.similarity import jaro_winkler_of, jaro_winkler_pairs
from commonweave.operators import likest


def _word(rng: random.Random, letters: str = "abcde é") -> str:
    return "".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 8, 12, 20, 62, 63, 70])))


def test_many_pairs_at_once_to_the_last_bit():
    rng = random.Random(3)
    a = [_word(rng, "abcdeé\U0001f600") for _ in range(4000)]
    b = ["" if k % 97 == 0 else x if k % 7 == 0 else "".join(rng.sample(x, len(x))) if k % 3 else x[:-1] + "a" for k, x in enumerate(a)]
    assert jaro_winkler_pairs(a, b).tolist() == [jaro_winkler_of(x, y) for x, y in zip(a, b)]
    assert jaro_winkler_pairs([], []).tolist() == []


@pytest.mark.parametrize("split", [False, True])
def test_likest_of_blocks_against_a_scan(spark, monkeypatch, split):
    """Equal names, several names of one record, ties, and blocks cut into parts: no person is lost, none comes that is not among the best."""
    if split:
        for name, value in (("CELL_PAIRS", 60), ("CELL_RIGHT", 9), ("GATHERED", 10), ("BOUNDED", 30), ("BIN_ROWS", 50)):
            monkeypatch.setattr(likest, name, value)
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdeilmnorst ") for _ in range(rng.randint(3, 18))) for _ in range(40)]
    near = lambda w: w[: (i := rng.randrange(len(w)))] + rng.choice("aeio") + w[i + 1 :]
    rows = lambda p, n: [(v, f"{p}{v}{k}", sorted({near(rng.choice(base)) for _ in range(rng.choice([1, 1, 2]))} | ({"ann lee"} if k % 5 == 0 else set()))) for v in "xyz" for k in range(n)]
    left, right = rows("r", 25), rows("p", 60) + [("w", "p", ["ann lee"])]
    schema = "value string, key string, names array<string>"
    found = likest.likest_in_blocks(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), 4, 0.7).collect()
    got: dict[str, set] = {}
    for r in found:
        got.setdefault(r["record"], set()).add((-r["likeness"], r["person"]))
    for value, record, names in left:
        scores = [(-max(jaro_winkler_of(x, y) for x in names for y in others), person) for v, person, others in right if v == value]
        assert sorted(got.get(record, set()))[:4] == sorted(s for s in scores if -s[0] >= 0.7)[:4], record
    assert len(found) <= len(left) * 4 * (7 if split else 1)
    assert likest.likest_in_blocks(spark.createDataFrame([], schema), spark.createDataFrame(right, schema), 4, 0.7).count() == 0
