"""Jaro and Jaro-Winkler similarity as pandas UDFs, and cosine similarity in the JVM."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jaro(a: str, b: str, whole: bool = False) -> float:
    """The Jaro similarity of two strings; 0 where one is empty, 1 where they are equal. Two moved letters
    make a swap; whole leaves out half a swap, as DuckDB does."""
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    free = [True] * len(b)
    from_a, taken = [], []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                from_a.append(c)
                taken.append(j)
                break
    if not taken:
        return 0.0
    from_b = [b[j] for j in sorted(taken)]
    moved = sum(x != y for x, y in zip(from_a, from_b))
    swaps = moved // 2 if whole else moved / 2
    m = len(taken)
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler_of(a: str, b: str, weight: float = 0.1, prefix: int = 4, whole: bool = False) -> float:
    """Jaro similarity raised for a common beginning of up to `prefix` letters."""
    s = jaro(a, b, whole)
    if s in (0.0, 1.0):
        return s
    n = 0
    for x, y in zip(a[:prefix], b[:prefix]):
        if x != y:
            break
        n += 1
    return s + n * weight * (1 - s)


#: Longest word whose letters have a bit each in a long with one to spare, and pairs compared at a time.
BITS, BATCH = 62, 2_048


def letter_codes(words: list[str]) -> np.ndarray:
    """A row of code points for each word, 0 behind its end."""
    width = max(map(len, words), default=0) or 1
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


def jaro_winkler_pairs(a: list[str], b: list[str], weight: float = 0.1, prefix: int = 4, whole: bool = False) -> np.ndarray:
    """jaro_winkler_of() of many pairs at once, to the last bit: the positions of a letter are bits of a long, and
    each step is taken for all pairs together. Words of more than BITS letters are compared one pair at a time."""
    size = np.array([(len(x), len(y)) for x, y in zip(a, b)], dtype=np.int64).reshape(-1, 2)
    out = np.zeros(len(a))
    for i in np.flatnonzero(size.max(axis=1, initial=0) > BITS):
        out[i] = jaro_winkler_of(a[i], b[i], weight, prefix, whole)
    short = np.flatnonzero((size.max(axis=1, initial=0) <= BITS) & (size.min(axis=1, initial=BITS) > 0))
    short = short[np.argsort(size[short, 0], kind="stable")]
    for k in range(0, len(short), BATCH):
        at = short[k : k + BATCH]
        out[at] = _short_pairs([a[i] for i in at], [b[i] for i in at], size[at, 0], size[at, 1], weight, prefix, whole)
    return out


def _short_pairs(a: list[str], b: list[str], la: np.ndarray, lb: np.ndarray, weight: float, prefix: int, whole: bool) -> np.ndarray:
    n, one = len(a), np.uint64(1)
    rows = np.arange(n)
    ca, cb = letter_codes(a), letter_codes(b)
    seen = np.zeros(int(max(ca.max(), cb.max())) + 1, dtype=bool)
    seen[ca], seen[cb] = True, True
    number = np.cumsum(seen) - 1
    ia, ib = number[ca], number[cb]
    where = np.zeros((n, int(number[-1]) + 1), dtype=np.uint64)  # the positions of each letter in b
    for j in range(cb.shape[1]):
        r = rows[lb > j]
        where[r, ib[r, j]] |= one << np.uint64(j)
    reach = np.maximum(la, lb) // 2 - 1
    free = (one << lb.astype(np.uint64)) - one
    taken_a, taken_b = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    for i in range(ca.shape[1]):
        low, high = np.maximum(i - reach, 0).astype(np.uint64), np.clip(i + reach + 1, 0, lb).astype(np.uint64)
        window = ((one << high) - one) & ~((one << low) - one)
        met = np.where(la > i, where[rows, ia[:, i]] & window & free, np.uint64(0))
        first = met & (~met + one)
        free &= ~first
        taken_b |= first
        taken_a |= (first != 0).astype(np.uint64) << np.uint64(i)
    m = np.bitwise_count(taken_a).astype(np.int64)
    moved = np.zeros(n, dtype=np.int64)
    for _ in range(int(m.max(initial=0))):
        one_a, one_b = taken_a & (~taken_a + one), taken_b & (~taken_b + one)
        place = np.where(one_a == 0, 0, np.bitwise_count(one_a - one))
        moved += (one_a != 0) & ((where[rows, ia[rows, place]] & one_b) == 0)
        taken_a ^= one_a
        taken_b ^= one_b
    full = np.maximum(m, 1)
    s = np.where(m == 0, 0.0, (m / la + m / lb + (m - (moved // 2 if whole else moved / 2)) / full) / 3)
    width, common, alike = min(prefix, ca.shape[1], cb.shape[1]), np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for i in range(width):
        alike &= (ca[:, i] == cb[:, i]) & (la > i) & (lb > i)
        common += alike
    s = np.where((s == 0.0) | (s == 1.0), s, s + common * weight * (1 - s))
    same = (la == lb) & (common == np.minimum(width, la))
    for i in np.flatnonzero(same):
        if a[i] == b[i]:
            s[i] = 1.0
    return s


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity of two columns; null where either is null."""
    known = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    out[known] = jaro_winkler_pairs(list(a[known]), list(b[known]))
    return pd.Series(out, dtype="float64").astype(object).where(known, None) if not known.all() else pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def best_jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """The best Jaro-Winkler similarity over two arrays of strings; 0 where either has none."""
    pairs = [(i, x, y) for i, (p, q) in enumerate(zip(a, b)) for x in (p if p is not None else ()) for y in (q if q is not None else ()) if x and y]
    out = np.zeros(len(a))
    if pairs:
        at, left, right = zip(*pairs)
        np.maximum.at(out, np.array(at), jaro_winkler_pairs(list(left), list(right)))
    return pd.Series(out, dtype="float64")


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays, in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays of one size; null for a zero vector or other sizes."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(F.size(a) == F.size(b), F.try_divide(dot(a, b), norms))


def vector_of(text: Column) -> Column:
    """An array from its text '[a,b]'."""
    return F.from_json(text, "array<float>")


def vector_text(vector: Column) -> Column:
    """The text '[a,b]' of an array."""
    return F.concat(F.lit("["), F.concat_ws(",", vector.cast("array<string>")), F.lit("]"))


def checked_vector(vector: Column, size: int) -> Column:
    """The vector, or an error where it has another size."""
    return F.when(F.size(vector) == size, vector).otherwise(F.raise_error(F.concat(F.lit(f"vector of size {size} expected, got "), F.size(vector).cast("string"))))
