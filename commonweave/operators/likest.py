"""The most alike names within blocks, exact under Jaro-Winkler: all names of a block are
compared by a bound on their common letters first, and of the pairs only what can be
among the best is measured. No pair leaves the worker that is not an answer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import jaro_winkler_pairs, letter_codes

#: Pairs of names and right rows of a cell, rows of the cells that one worker holds at a time.
CELL_PAIRS, CELL_RIGHT, BIN_ROWS = 20_000_000, 50_000, 60_000
#: Pairs bounded at a time, and pairs that are gathered before they are measured.
BOUNDED, GATHERED = 1 << 16, 100_000
#: What rounding may take from a bound.
SLACK = 1e-5


class Signed:
    """Words with their letter counts as bits, so that a bound takes a few steps of numpy."""

    def __init__(self, words: list[str]) -> None:
        codes, n = letter_codes(words), len(words)
        self.length = np.array([max(1, len(w)) for w in words], dtype=np.float32)
        valid = np.arange(codes.shape[1])[None, :] < self.length[:, None]
        count, rows = np.zeros((n, 32), dtype=np.uint8), np.arange(n)
        for j in range(codes.shape[1]):
            count[rows, codes[:, j] % 31] += valid[:, j]  # letters in one slot only raise the bound
        slot = np.arange(32, dtype=np.uint64)
        bits = lambda k: ((count >= k).astype(np.uint64) << slot).sum(axis=1, dtype=np.uint64)
        self.few, self.many = bits(1) | bits(2) << np.uint64(32), bits(3) | bits(4) << np.uint64(32)
        self.rest = np.maximum(count.astype(np.int16) - 4, 0).sum(axis=1).astype(np.int16)
        first = np.zeros((n, 4), dtype=np.uint64)
        first[:, : codes.shape[1]] = codes[:, :4] & 0xFFFF
        self.first = (first << np.arange(0, 64, 16, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def bounds(a: Signed, i: slice, b: Signed, j: slice) -> np.ndarray:
    """At least the Jaro-Winkler similarity of each word of a[i] and each of b[j]."""
    common = np.bitwise_count(a.few[i, None] & b.few[j]).astype(np.float32)
    common += np.bitwise_count(a.many[i, None] & b.many[j])
    common += np.minimum(a.rest[i, None], b.rest[j])
    jaro = (common * (1 / a.length[i, None] + 1 / b.length[j]) + 1) / 3
    other = a.first[i, None] ^ b.first[j]
    prefix = np.bitwise_count((other & (~other + np.uint64(1))) - np.uint64(1)) >> 4
    return jaro + prefix * np.float32(0.1) * (1 - jaro)


def likest_of_cells(cells: Iterator[tuple[dict, dict]], most: int, least: float) -> Iterator[tuple[str, str, float]]:
    """(record, person, likeness): in each cell (records by names, persons by names) the `most` persons of the best
    likeness for each record, from `least` on; of equal ones the least."""
    waiting: list[tuple] = []
    size = 0
    for left, right in cells:
        if not left or not right:
            continue
        lefts, rights = list(left.items()), [(names, sorted(keys)[:most]) for names, keys in right.items()]
        words = [list(dict.fromkeys(n for names, _ in side for n in names)) for side in (lefts, rights)]
        place = [{w: k for k, w in enumerate(ws)} for ws in words]
        a, b = Signed(words[0]), Signed(words[1])
        owners = [[(place[s][n], k) for k, (names, _) in enumerate(side) for n in names] for s, side in enumerate((lefts, rights))]
        by_word = [_grouped(np.array([w for w, _ in o]), np.array([k for _, k in o]), len(ws)) for o, ws in zip(owners, words)]
        single = all(len(names) == 1 for names, _ in lefts)
        step = max(1, BOUNDED // len(words[1]))
        for k in range(0, len(words[0]), step):
            u = bounds(a, slice(k, k + step), b, slice(None))
            x, y = np.nonzero(u >= least - SLACK)
            if len(x):
                waiting.append((lefts, rights, words, by_word, x + k, y, u[x, y]))
                size += len(x)
            # what is gathered is measured at the end of a cell, or sooner where each record has one name, which no two steps share
            if size >= GATHERED and single:
                yield from _measure(waiting, most, least)
                waiting, size = [], 0
        if size >= GATHERED:
            yield from _measure(waiting, most, least)
            waiting, size = [], 0
    yield from _measure(waiting, most, least)


def _grouped(word: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owners by word, where those of each word begin, how many they are)."""
    count = np.bincount(word, minlength=n)
    return owner[np.argsort(word, kind="stable")], np.cumsum(count) - count, count


def _measure(waiting: list[tuple], most: int, least: float) -> Iterator[tuple[str, str, float]]:
    if not waiting:
        return
    known, parts, last = [], [], None
    texts: tuple[list[str], list[str]] = ([], [])
    for lefts, rights, words, by_word, x, y, u in waiting:
        if lefts is not last:
            offset, base, last = len(known), (len(texts[0]), len(texts[1])), lefts
            known += [(keys, rights) for _, keys in lefts]
            texts[0].extend(words[0])
            texts[1].extend(words[1])
        (own_a, from_a, n_a), (own_b, from_b, n_b) = by_word
        times = n_a[x] * n_b[y]
        x, y, u = np.repeat(x, times), np.repeat(y, times), np.repeat(u, times)
        k = np.arange(len(x)) - np.repeat(np.cumsum(times) - times, times)
        parts.append((offset + own_a[from_a[x] + k // n_b[y]], own_b[from_b[y] + k % n_b[y]], u, base[0] + x, base[1] + y))
    owner, other, upper, text_a, text_b = (np.concatenate(p) for p in zip(*parts))
    order = np.lexsort((-upper, owner))
    owner, other, upper, text_a, text_b = owner[order], other[order], upper[order], text_a[order], text_b[order]
    start = np.searchsorted(owner, owner)
    early = np.arange(len(owner)) - start < 2 * most
    exact = np.full(len(owner), -1.0)

    def measure(at: np.ndarray) -> None:
        exact[at] = jaro_winkler_pairs([texts[0][k] for k in text_a[at]], [texts[1][k] for k in text_b[at]])

    def best() -> pd.DataFrame:
        found = exact >= least
        return pd.DataFrame({"o": owner[found], "p": other[found], "s": exact[found]}).groupby(["o", "p"], as_index=False)["s"].max().sort_values(["o", "s"], ascending=[True, False], kind="stable")

    measure(np.flatnonzero(early))
    so_far = best()
    bar = np.full(len(known), least)
    nth = so_far[so_far.groupby("o").cumcount() == most - 1]
    bar[nth["o"].to_numpy()] = nth["s"].to_numpy()
    measure(np.flatnonzero(~early & (upper >= bar[owner] - SLACK)))
    every = best()
    nth = every[every.groupby("o").cumcount() == most - 1]
    bar[nth["o"].to_numpy()] = nth["s"].to_numpy()
    every = every[every["s"].to_numpy() >= bar[every["o"].to_numpy()]]
    for o, rows in every.groupby("o"):
        keys, rights = known[o]
        ranked = sorted((-s, person) for p, s in zip(rows["p"], rows["s"]) for person in rights[p][1])[:most]
        for key in keys:
            for s, person in ranked:
                yield key, person, -s


def _cells(pdf: pd.DataFrame) -> Iterator[tuple[dict, dict]]:
    """The cells of a bin, each as its records by names and its persons by names."""
    pdf = pdf.sort_values(["value", "part"], kind="stable")
    left, right, at = {}, {}, None
    for value, part, is_left, key, names in zip(pdf["value"], pdf["part"], pdf["is_left"], pdf["key"], pdf["names"]):
        if (value, part) != at:
            if at is not None:
                yield left, right
            left, right, at = {}, {}, (value, part)
        (left if is_left else right).setdefault(tuple(names), []).append(key)
    if at is not None:
        yield left, right


def likest_in_blocks(left: DataFrame, right: DataFrame, most: int, least: float) -> DataFrame:
    """(record, person, likeness) for left(value, key, names) and right(value, key, names): in each block, or part of a
    large one, the `most` persons of best likeness for each record. A person may come several times, of several parts."""
    compare = lambda cells: likest_of_cells(cells, most, least)
    return in_cells(left, right, compare, ("record", "person", "likeness"))


def alike_of_cells(cells: Iterator[tuple[dict, dict]], least: float, whole: bool) -> Iterator[tuple[str, str, float]]:
    """(a, b, s): in each cell the pairs of single names of Jaro-Winkler similarity `least` and more."""
    texts: tuple[list[str], list[str]] = ([], [])

    def measure() -> Iterator[tuple[str, str, float]]:
        for a, b, s in zip(*texts, jaro_winkler_pairs(*texts, whole=whole).tolist()):
            if s >= least:
                yield a, b, s
        texts[0].clear()
        texts[1].clear()

    for left, right in cells:
        words = [[name for (name,) in side] for side in (left, right)]
        if not words[0] or not words[1]:
            continue
        a, b = Signed(words[0]), Signed(words[1])
        step = max(1, BOUNDED // len(words[1]))
        for k in range(0, len(words[0]), step):
            x, y = np.nonzero(bounds(a, slice(k, k + step), b, slice(None)) >= least - SLACK)
            texts[0].extend(words[0][i] for i in (x + k).tolist())
            texts[1].extend(words[1][j] for j in y.tolist())
            if len(texts[0]) >= GATHERED:
                yield from measure()
    yield from measure()


def in_cells(left: DataFrame, right: DataFrame, compare: Callable[[Iterator[tuple[dict, dict]]], Iterator[tuple]], out: tuple[str, str, str]) -> DataFrame:
    """What compare(cells) yields, two texts and a double, over the blocks of left(value, key, names) and right(value, key, names).
    Blocks are split by the hash of the names, so that a worker's share does not grow with the input."""
    spark, kind = left.sparkSession, left.schema["value"].dataType.simpleString()
    sizes = left.groupBy("value").agg(F.count("*").alias("l")).join(right.groupBy("value").agg(F.count("*").alias("r")), "value")
    parts_r = F.ceil(F.col("r") / CELL_RIGHT)
    parts_l = F.least(F.ceil(F.col("l") * F.least("r", F.lit(CELL_RIGHT)) / CELL_PAIRS), F.col("l"))
    sizes = sizes.withColumn("nl", parts_l.cast("int")).withColumn("nr", parts_r.cast("int"))
    split = F.collect_list(F.when((F.col("nl") > 1) | (F.col("nr") > 1), F.struct("value", "nl", "nr")))
    told = sizes.agg(F.sum(F.col("l") * F.col("nr") + F.col("r") * F.col("nl")).alias("rows"), split.alias("split")).first()
    bins = 1 + (told["rows"] or 0) // BIN_ROWS
    # a block that is split has over a thousand rows, which bounds their number
    large = F.broadcast(spark.createDataFrame([tuple(r) for r in told["split"]], f"value {kind}, nl int, nr int"))

    def placed(side: DataFrame, is_left: bool) -> DataFrame:
        n = side.join(large, "value", "left").select("value", "key", "names", F.coalesce("nl", F.lit(1)).alias("nl"), F.coalesce("nr", F.lit(1)).alias("nr"))
        own, far = ("nl", "nr") if is_left else ("nr", "nl")
        mine = F.pmod(F.xxhash64("names"), F.col(own)).cast("int")
        n = n.withColumn("mine", mine).withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(far) - 1)))
        l, r = ("mine", "theirs") if is_left else ("theirs", "mine")
        n = n.withColumn("part", F.col(l) * F.col("nr") + F.col(r))
        return n.select(F.pmod(F.xxhash64("value", "part"), F.lit(bins)).alias("bin"), "value", "part", F.lit(is_left).alias("is_left"), "key", "names")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(compare(_cells(pdf))), columns=list(out))

    both = placed(left, True).unionByName(placed(right, False))
    return both.groupBy("bin").applyInPandas(run, f"{out[0]} string, {out[1]} string, {out[2]} double")
