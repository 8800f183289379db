"""Strings are signed, paired and measured in blocks (radius.py)."""

from __future__ import annotations

import random

import numpy as np

from commonweave.llm.editmetric import damerau
from commonweave.llm.radius import edit_distances, minhash_links, packed, radius_join, shorter_keys, unpacked


def slips(seed: int, letters: str, lengths: range, n: int) -> list[str]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.choice(lengths)))
        out.append(w)
        for _ in range(3):
            i = rng.randrange(max(1, len(w) - 1))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1 : i + 2] + w[i : i + 1] + w[i + 2 :], w[:i] + rng.choice(letters) + w[i + 1 :]])
            w = w or "a"
            out.append(w)
    return sorted(set(out))


def test_distances_of_blocks():
    words = [*slips(1, "abc", range(2, 9), 12), *slips(2, "жщд中文𝒳z", range(5, 12), 8), *slips(3, "abcdefgh", range(30, 40), 4), "ca", "abc"]
    a, b = (np.array([p[k] for p in ((x, y) for x in words for y in words)], dtype=object) for k in (0, 1))
    exact = np.array([damerau(x, y) for x, y in zip(a, b)])
    for radius in (1, 2):
        got = edit_distances(a, b, radius)
        assert ((got <= radius) == (exact <= radius)).all() and (got[exact <= radius] == exact[exact <= radius]).all()


def test_what_is_left_has_one_hash():
    keys = {}
    for place, key in shorter_keys(np.array(["abcd", "abd", "xab", "zz"], dtype=object), 2):
        for p, k in zip(place.tolist(), key.tolist()):
            keys.setdefault(p, set()).add(k)
    assert keys[0] & keys[1] and keys[0] & keys[2] and not keys[0] & keys[3] and len(keys[0]) == 11 and len(keys[3]) == 3


def test_packed_letters():
    letters, ranked, size = unpacked(packed(np.array(["ab", "b" * 24, "c" * 25], dtype=object)))
    assert size.tolist() == [2, 24, 25] and (letters[0] > 0).sum() == 2 and (letters[1] > 0).all() and not letters[2].any() and ranked[0][0] >= ranked[0][1] > 0 == ranked[0][2]


def test_values_are_signed_once_and_none_is_lost(spark):
    """Before, both sides of the join of buckets signed all values."""
    words = [*slips(5, "жщдabc", range(5, 8), 15), *slips(6, "abcdefghklmn", range(24, 30), 4)]
    links = minhash_links(spark.createDataFrame([(t, w) for w in words for t in ("name", "base")], "attr string, value string"))
    assert links._jdf.queryExecution().optimizedPlan().toString().count("sign(") == 1  # noqa: SLF001
    got = {(r["attr"], r["a"], r["b"], r["dist"]) for r in links.filter("dist > 0").collect()}
    assert got <= {(t, a, b, damerau(a, b)) for a in words for b in words if a < b for t in ("name", "base")}
    for low, high, share in ((5, 8, 1.0), (22, 40, 0.9)):
        want = {(t, a, b, damerau(a, b)) for a in words for b in words if a < b and low <= min(len(a), len(b)) <= high and damerau(a, b) <= 2 for t in ("name", "base")}
        assert len(want & got) >= share * len(want) > 0


def test_cells_hold_strings_alone(spark):
    """Before, each copy of a string took its distances to the pivots along."""
    words = [*slips(7, "abcж", range(2, 9), 20), *slips(8, "abcdefgh", range(30, 34), 3)]
    df = spark.createDataFrame([(w,) for w in words], "value string")
    for radius, part_strings in ((1, 50_000), (2, 7)):
        links = radius_join(df, radius, 5, part_strings)
        assert "far" not in links._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
        got = {(r["a"], r["b"], r["dist"]) for r in links.filter("dist > 0").collect()}
        assert got == {(a, b, damerau(a, b)) for a in words for b in words if a < b and damerau(a, b) <= radius}
