"""alike_words against a full scan: words of many lengths with slips at any place."""

from __future__ import annotations

import random

import pytest

from commonweave.functions.similarity import jaro_winkler_of
from commonweave.operators import resolve as I


@pytest.mark.parametrize("least", [0.95, 0.97])
def test_no_alike_word_is_lost(spark, least):
    """Also with slips both within the first and the last three letters and of several letters, with long ends added, and with other letters than a-z."""
    rng = random.Random(11)
    letters = "aaeeiinnrostlmdé9"
    base = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 4, 6, 9, 12, 15, 18, 22, 26, 34, 45, 70]))) for _ in range(220)]

    def slip(w: str) -> str:
        w = list(w)
        for _ in range(rng.randint(1, 4)):
            i = rng.choice([0, rng.randrange(len(w)), len(w) - 1])
            if (kind := rng.randrange(4)) == 0 and len(w) > 1:
                del w[i]
            elif kind == 1:
                w[i] = rng.choice(letters)
            elif kind == 2:
                w.insert(i, rng.choice(letters))
            elif i:
                w[i - 1], w[i] = w[i], w[i - 1]
        return "".join(w) + ("dev9" if rng.random() < 0.1 else "")

    slips = [slip(w) for w in base for _ in range(5)]
    want = {(a, b) for a in set(slips) for b in set(base) if jaro_winkler_of(a, b) >= least}
    frame = lambda words: spark.createDataFrame([(w,) for w in words], "value string")
    got = {(r["a"], r["b"]): r["s"] for r in I.alike_words(frame(slips), frame(base), least).collect()}
    assert set(got) == want and all(s == jaro_winkler_of(a, b) for (a, b), s in got.items())
    assert any(a[:3] != b[:3] and a[-3:] != b[-3:] and sorted(a) != sorted(b) for a, b in want)


def test_whole_swaps_are_those_of_duckdb():
    """Three letters that change places are one swap for DuckDB, whose function the SQL of reconciled_accounts calls, and one and a half otherwise."""
    import duckdb

    from commonweave.functions.similarity import jaro_winkler_pairs

    rng = random.Random(2)
    a = ["".join(rng.choice("abcde") for _ in range(rng.randint(2, 18))) for _ in range(500)]
    b = ["".join(rng.sample(x, len(x))) for x in a]
    want = [duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", [x, y]).fetchone()[0] for x, y in zip(a, b)]
    got = jaro_winkler_pairs(a, b, whole=True)
    near = [k for k in range(len(a)) if want[k] > 0.7]  # below, DuckDB does not raise it for a common beginning
    assert len(near) > 100 and [got[k] for k in near] == pytest.approx([want[k] for k in near])
    assert got.tolist() == [jaro_winkler_of(x, y, whole=True) for x, y in zip(a, b)]
    assert jaro_winkler_pairs(["abcdef"], ["bcadef"], whole=True)[0] > jaro_winkler_of("abcdef", "bcadef")
