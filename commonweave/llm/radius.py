"""Which distinct strings lie close together: by MinHash bands (approximate
blocking, problem 1) and by metric-space partitioning (exact, problem 5)."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut, shuffle_partitions
from .editmetric import damerau, levenshtein

#: MinHash rows of a band, over the pairs of letters at most WINDOW apart: on names such pairs keep two
#: strings two edits apart at a similarity of 0.5 and more, and strangers below 0.1.
ROWS, WINDOW = 5, 2
#: Bands: a similarity of 0.52 is met with probability 0.92; and for one edit, which leaves 0.7, with 0.94.
BANDS, FEW_BANDS = 65, 15
#: Least length of strings that may differ, and the length up to which letters are left out in place of
#: bands: two edits change too many of a short string's letter pairs for MinHash to find it.
LEAST, SHORT = 5, 8
#: Pivots whose distances sift pairs within a cell, and the sample of strings that they are chosen from.
PIVOTS, PIVOT_SAMPLE = 3, 2_000
#: Strings at home in a cell for each part into which it is split.
PART_STRINGS = 50_000


def _hashes() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 1 << 31, BANDS * ROWS, dtype=np.uint64), rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint64)


#: Odd factors that mix bits, and the factor of a polynomial over letters with its inverse modulo 2^64.
_MIX, _MIX_2, _BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_INVERSE = pow(0x9E3779B97F4A7C15, -1, 1 << 64)
#: Letters that one long holds, five bits each, and the longs of a string. Different letters may share a number, which
#: brings strings nearer and never takes them apart; longer strings are sifted by their lengths alone.
PACKED, WORDS = 12, 2
#: Numbers that one step over a batch holds at once.
STEP = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return (x ^ (x >> np.uint64(27))) * _MIX_2


def _by_length(values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, code points as rows) of the strings of each length."""
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield int(n), at, values[at].astype(f"U{max(n, 1)}").view(np.uint32).reshape(len(at), max(n, 1))[:, :n]


@lru_cache(maxsize=500)
def _left_out(n: int, k: int) -> np.ndarray:
    """The ways to leave out k of n letters, as rows."""
    ways = list(combinations(range(n), k))
    return np.array(ways, dtype=np.int64).reshape(len(ways), k)


def shorter_keys(values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, key): a hash of each string and of what is left of it without up to `radius` letters."""
    for n, at, codes in _by_length(values):
        powers = np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), _BASE)], dtype=np.uint64)[:n]
        sums = np.zeros((len(at), n + 1), dtype=np.uint64)
        np.cumsum(_mixed(codes.astype(np.uint64) + np.uint64(1)) * powers, axis=1, out=sums[:, 1:])
        for k in range(min(radius, n) + 1):
            out = _left_out(n, k)
            rows = max(1, STEP // len(out))
            for low in range(0, len(at), rows):
                part, key = sums[low : low + rows], np.uint64(n - k)
                for m in range(k + 1):  # the letters behind the m-th gap move m places to the left
                    begin = out[:, m - 1] + 1 if m else np.zeros(len(out), dtype=np.int64)
                    end = out[:, m] if m < k else np.full(len(out), n)
                    key = key + (part[:, end] - part[:, begin]) * np.uint64(pow(_INVERSE, m, 1 << 64))
                yield np.repeat(at[low : low + rows], len(out)), _mixed(key).ravel()


def band_keys(values: np.ndarray, n_bands: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, key): a hash of each band, with its number, of the MinHash signatures of the pairs of near letters."""
    a, b = (x[: n_bands * ROWS] for x in _hashes())
    for n, at, codes in _by_length(values):
        padded = np.concatenate([np.full((len(at), 1), ord("^")), codes, np.full((len(at), 1), ord("$"))], axis=1).astype(np.uint64)
        grams = np.concatenate([padded[:, :-k] << np.uint64(32) | padded[:, k:] for k in range(1, WINDOW + 1)], axis=1)
        known, place = np.unique(grams, return_inverse=True)
        place = place.reshape(grams.shape)
        codes_of = np.array([zlib.crc32((chr(int(g) >> 32) + chr(int(g) & 0xFFFFFFFF)).encode()) for g in known], dtype=np.uint64)
        # the values of a gram are worked out once, not for each string that has it
        hashed = ((codes_of[:, None] * a[None, :] + b[None, :]) % np.uint64(4294967291)).astype(np.uint32)
        rows = max(1, STEP // (grams.shape[1] * len(a)))
        for low in range(0, len(at), rows):
            signature = hashed[place[low : low + rows, 0]]
            for k in range(1, grams.shape[1]):
                np.minimum(signature, hashed[place[low : low + rows, k]], out=signature)
            signature = signature.reshape(len(signature), n_bands, ROWS).astype(np.uint64)
            key = _mixed(np.arange(1, n_bands + 1, dtype=np.uint64))[None, :]
            for k in range(ROWS):
                key = _mixed(key ^ signature[:, :, k])
            yield np.repeat(at[low : low + rows], n_bands), key.ravel()


def letter_sets(values: np.ndarray) -> np.ndarray:
    """The letters of each string as bits of a long; different letters may share one, so that it tells at most less."""
    out = np.zeros(len(values), dtype=np.int64)
    for _, at, codes in _by_length(values):
        out[at] = np.bitwise_or.reduce(np.int64(1) << (codes % 63).astype(np.int64), axis=1)
    return out


def packed(values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The longs of each string, its letters as numbers from 1 to 31 in them; of a string that they do not hold, its length below 0."""
    out = np.zeros((WORDS, len(values)), dtype=np.int64)
    for n, at, codes in _by_length(values):
        if n > WORDS * PACKED:
            out[0, at] = -n
            continue
        for k in range(n):
            out[k // PACKED, at] |= (codes[:, k].astype(np.int64) % 31 + 1) << 5 * (k % PACKED)
    return tuple(out)


def sharing(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of places in `keys` that hold one key, some at a time."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first, step = np.arange(len(keys)), 0
    while True:
        step += 1
        first = first[first < len(keys) - step]
        first = first[ranked[first] == ranked[first + step]]
        if not len(first):
            return
        yield order[first], order[first + step]


def near_letters(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Whether two letter sets allow `radius` edits: one takes at most one letter away and brings one."""
    return (np.bitwise_count(a & ~b) <= radius) & (np.bitwise_count(b & ~a) <= radius)


def _levenshtein_rows(a: np.ndarray, b: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
    """levenshtein() of the strings in the rows of two arrays of code points; ends: where those of b end, if not all at the last column."""
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    row = np.repeat(np.arange(len(b) + 1, dtype=np.int16)[:, None], a.shape[1], axis=1)
    for i in range(len(a)):
        above, row = row, np.empty_like(row)
        row[0] = i + 1
        kept = above[:-1] + (a[i] != b)
        np.minimum(kept, above[1:] + 1, out=kept)
        for j in range(len(b)):
            np.minimum(kept[j], row[j] + 1, out=row[j + 1])
    return row[-1] if ends is None else row[ends, np.arange(a.shape[1])]


def edit_distances(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """damerau() of each pair as far as it is at most `radius`, else more than that.

    It lies under levenshtein() only by exchanges, which keep the letters: the letters then differ
    by the other edits alone. Only such pairs are measured one by one.
    """
    out = np.full(len(a), radius + 1, dtype=np.int32)
    lengths = np.fromiter(map(len, b), np.int64, len(b))
    for n, at, codes in _by_length(a):
        fits = np.flatnonzero(np.abs(lengths[at] - n) <= radius)
        for low in range(0, len(fits), STEP // 8):
            some = fits[low : low + STEP // 8]
            others = b[at[some]].astype(f"U{n + radius}").view(np.uint32).reshape(len(some), n + radius)
            out[at[some]] = _levenshtein_rows(codes[some], others, lengths[at[some]])
    for i in np.flatnonzero((out > 1) & (out <= 2 * radius)):
        x, y = a[i], b[i]
        left = Counter(x)
        left.subtract(y)
        if max(sum(v for v in left.values() if v > 0), -sum(v for v in left.values() if v < 0)) <= radius - 1:
            out[i] = damerau(x, y)
    return out


def unpacked(words: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, sorted letters, length) of packed strings; of those not held, no letters."""
    out = np.stack([w >> 5 * k & 31 for w in words for k in range(PACKED)], axis=1).astype(np.int8)
    out[words[0] < 0] = 0
    return out, np.sort(out, axis=1)[:, ::-1], np.where(words[0] < 0, -words[0], (out > 0).sum(axis=1))


def _sift(strings: tuple[np.ndarray, np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of unpacked strings that may lie within `radius` under damerau(): by levenshtein(), of which an
    exchange takes two, and where it is greater than `radius`, by the letters, which exchanges keep."""
    letters, ranked, size = strings
    swap = size[i] > size[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    kept = [(i[size[j] > WORDS * PACKED], j[size[j] > WORDS * PACKED])]
    for n in np.unique(size[i][size[i] <= WORDS * PACKED]):
        some = (size[i] == n) & (size[j] <= WORDS * PACKED)
        p, q = i[some], j[some]
        width = min(n + radius, WORDS * PACKED)
        far = _levenshtein_rows(letters[p, :n], letters[q, :width], size[q])
        doubt = np.flatnonzero((far > radius) & (far <= 2 * radius))
        near = far <= radius
        near[doubt] = _levenshtein_rows(ranked[p[doubt], :n], ranked[q[doubt], :width], size[q[doubt]]) <= 2 * (radius - 1)
        kept.append((p[near], q[near]))
    return np.concatenate([p for p, _ in kept]), np.concatenate([q for _, q in kept])


def _pair_filter(radius: int):
    @F.pandas_udf(T.IntegerType())
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(edit_distances(a.to_numpy(dtype=object), b.to_numpy(dtype=object), radius), dtype="int32")

    #: So marked, it is not moved before the choice of distinct pairs, where it would run on each meeting.
    return distance.asNondeterministic()


def minhash_links(values: DataFrame, radius: int = 2) -> DataFrame:
    """(attr, a, b, dist) for values(attr, value), distinct: pairs a < b of at least
    LEAST letters that meet in a MinHash band of one attribute and lie within
    `radius` under damerau(), and every (a, a) with dist 0. A pair whose shorter
    string has up to SHORT letters meets in what is left of both without up to
    `radius` letters, and none is lost. Only distinct values are blocked, so a
    value that many records share is one row here; null and empty values are left out.
    A bucket holds numbers alone: its own, a hash of each value and its letters. Those that meet are
    paired and sifted by their letters where the bucket lies; then the strings themselves are compared."""
    spark = values.sparkSession
    values = cut(values.filter("value is not null and value <> ''").select("attr", "value").distinct().withColumn("id", F.xxhash64("attr", "value")))
    columns = ["bucket", "id", *(f"w{k}" for k in range(WORDS))]
    n_bands, n = (BANDS if radius > 1 else FEW_BANDS), shuffle_partitions(spark)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, ids = batch.column("value").to_numpy(zero_copy_only=False), batch.column("id").to_numpy()
            names = batch.column("attr").to_pylist()
            seed = {name: _mixed(np.array([zlib.crc32(name.encode())], dtype=np.uint64))[0] for name in set(names)}
            seeds = np.array([seed[name] for name in names], dtype=np.uint64)
            lengths = np.fromiter(map(len, text), np.int64, len(text))
            words = packed(text)
            short, long = np.flatnonzero((lengths >= LEAST) & (lengths <= SHORT + radius)), np.flatnonzero(lengths > SHORT)
            for some, found in ((short, shorter_keys(text[short], radius)), (long, band_keys(text[long], n_bands))):
                for place, key in found:
                    at = some[place]
                    yield pa.RecordBatch.from_arrays([pa.array((key ^ seeds[at]).view(np.int64)), pa.array(ids[at]), *(pa.array(w[at]) for w in words)], names=columns)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, schema=pa.schema([(c, pa.int64()) for c in columns]))
        bucket, ids, *words = (rows.column(c).to_numpy() for c in columns)
        if not len(ids):
            return
        # each value once, so that a pair is one number and is sifted once
        ids, first, own = np.unique(ids, return_index=True, return_inverse=True)
        strings = unpacked(tuple(w[first] for w in words))
        # a letter and its return are two marks, of which an edit takes one away and brings one
        marks = np.zeros(len(ids), dtype=np.int64)
        for k in range(WORDS * PACKED):
            mark = np.where(strings[0][:, k] > 0, np.int64(1) << strings[0][:, k].astype(np.int64) - 1, 0)
            marks |= np.where(marks & mark, mark << 31, mark)
        met = [np.zeros(0, dtype=np.int64)]
        for i, j in sharing(bucket):
            i, j = own[i], own[j]
            near = (i != j) & (np.abs(strings[2][i] - strings[2][j]) <= radius)
            near &= near_letters(marks[i], marks[j], radius) | (strings[2][i] > WORDS * PACKED) | (strings[2][j] > WORDS * PACKED)
            i, j = i[near], j[near]
            met.append(np.minimum(i, j) * len(ids) + np.maximum(i, j))
        met = np.unique(np.concatenate(met))
        for low in range(0, len(met), STEP // 8):
            i, j = _sift(strings, *np.divmod(met[low : low + STEP // 8], len(ids)), radius)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], names=["ia", "ib"])

    signed = values.repartition(n, "id").mapInArrow(sign, ", ".join(f"{c} long" for c in columns))
    met = signed.repartition(n, "bucket").mapInArrow(meet, "ia long, ib long").distinct()
    side = lambda p: values.select(F.col("id").alias(f"i{p}"), F.col("attr").alias(f"attr_{p}"), F.col("value").alias(p))
    both = met.join(side("a"), "ia").join(side("b"), "ib").filter("attr_a = attr_b and a <> b")
    both = both.select(F.col("attr_a").alias("attr"), F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    near = both.withColumn("dist", _pair_filter(radius)("a", "b")).filter(F.col("dist") <= radius)
    same = values.select("attr", F.col("value").alias("a"), F.col("value").alias("b"), F.lit(0).alias("dist"))
    return same.unionByName(near)


def choose_pivots(sample: list[str], n: int) -> list[str]:
    """Strings far from each other, each next one farthest from those before."""
    sample = sorted(set(sample))
    if not sample:
        return []
    pivots, far = [sample[0]], [levenshtein(s, sample[0]) for s in sample]
    while len(pivots) < min(n, len(sample)):
        i = max(range(len(sample)), key=lambda k: (far[k], sample[k]))
        if far[i] == 0:
            break
        pivots.append(sample[i])
        far = [min(f, levenshtein(s, sample[i])) for f, s in zip(far, sample)]
    return pivots


def radius_join(values: DataFrame, radius: int = 1, pivots: int = PIVOTS, part_strings: int = PART_STRINGS) -> DataFrame:
    """(a, b, dist) for values(value), distinct: every pair a < b within `radius`
    under damerau(), and every (a, a) with dist 0.

    The space is cut into rings about the one pivot from which all strings lie at well
    spread distances: the empty string, whose distance to a string is its length. By
    the triangle inequality a partner lies at most `radius` rings away, so a string is at
    home in its own ring and copied into the `radius` rings below, and a pair meets in
    the lower ring of the two. (Cells of nearest pivots were measured: names lie so
    close together that each was copied into half of all cells.) Within a cell only
    strings that agree after leaving out up to `radius` letters are compared, which
    loses no pair, and of these only those whose distances to further pivots, chosen far
    apart, allow it. A cell is split by the hash of what is left, into more parts the
    more strings are at home in the fullest ring, so that no task's part of it grows with the input.
    """
    values = values.filter("value is not null and value <> ''").select("value").distinct()
    values = cut(values)
    sample = [r[0] for r in values.orderBy(F.xxhash64("value"), "value").limit(PIVOT_SAMPLE).collect()]
    chosen = choose_pivots(sample, pivots)
    same = values.select(F.col("value").alias("a"), F.col("value").alias("b"), F.lit(0).alias("dist"))
    if not chosen:
        return same
    fullest = values.groupBy(F.length("value").alias("n")).count().agg(F.max("count")).first()[0]
    parts = 1 + fullest * radius // part_strings

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("value").to_numpy(zero_copy_only=False)
            if parts == 1:
                at, part = np.arange(len(text)), np.zeros(len(text), dtype=np.int64)
            else:
                found = [np.unique(place * parts + (key % np.uint64(parts)).astype(np.int64)) for place, key in shorter_keys(text, radius)]
                at, part = np.divmod(np.unique(np.concatenate([*found, np.zeros(0, dtype=np.int64)])), parts)
            lengths = np.fromiter(map(len, text), np.int64, len(text))[at]
            for down in range(radius + 1):
                kept = lengths - down >= 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("value").take(pa.array(at[kept])), pa.array((lengths - down)[kept], type=pa.int32()), pa.array(part[kept], type=pa.int32())], names=["value", "ring", "part"]
                )

    n = shuffle_partitions(values.sparkSession)
    cells = values.repartition(n, "value").mapInArrow(assign, "value string, ring int, part int").repartition(n, "ring", "part")

    def join_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        ring, part = int(pdf["ring"].iloc[0]), np.uint64(pdf["part"].iloc[0])
        text = pdf["value"].to_numpy(dtype=object)
        letters, home = letter_sets(text), np.fromiter(map(len, text), np.int64, len(text)) == ring

        def keys(at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for place, key in shorter_keys(text[at], radius):
                here = key % np.uint64(parts) == part
                yield at[place[here]], key[here]

        # only strings at home are indexed, which holds a cell's memory to its own share
        indexed = list(keys(np.flatnonzero(home)))
        if not indexed:
            return pd.DataFrame([], columns=["a", "b", "dist"])
        place, key = (np.concatenate(x) for x in zip(*indexed))
        order = np.argsort(key, kind="stable")
        place, key = place[order], key[order]
        far = np.zeros((len(chosen), len(text)), dtype=np.int16)
        for _, at, codes in _by_length(text):
            for k, pivot in enumerate(chosen):
                far[k, at] = _levenshtein_rows(np.broadcast_to(np.array([ord(c) for c in pivot], dtype=np.uint32), (len(at), len(pivot))), codes)
        met = set()
        for at, asked in [*zip([place], [key]), *keys(np.flatnonzero(~home))]:
            low, high = np.searchsorted(key, asked, "left"), np.searchsorted(key, asked, "right")
            some, step = np.arange(len(asked)), 0
            while len(some := some[low[some] + step < high[some]]):
                i, j = place[low[some] + step], at[some]
                # an exchange counts one under damerau() and two in the distances to the pivots
                ok = (i < j) | ~home[j]
                i, j = i[ok], j[ok]
                i, j = (x[near_letters(letters[i], letters[j], radius)] for x in (i, j))
                i, j = (x[(np.abs(far[:, i] - far[:, j]) <= 2 * radius).all(axis=0)] for x in (i, j))
                met.update((i * len(text) + j).tolist())
                step += 1
        i, j = np.divmod(np.array(sorted(met), dtype=np.int64), len(text))
        dist = edit_distances(text[i], text[j], radius)
        found = [(min(text[p], text[q]), max(text[p], text[q]), d) for p, q, d in zip(i, j, dist.tolist()) if d <= radius]
        return pd.DataFrame(found, columns=["a", "b", "dist"])

    near = cells.groupBy("ring", "part").applyInPandas(join_cell, "a string, b string, dist int").distinct()
    return same.unionByName(near)
