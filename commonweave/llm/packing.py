"""Filling containers of fixed capacity (problem 8) by minimum bin slack.

Only lengths matter for a filling, so the plan is made on the histogram of
lengths, which has at most `capacity` entries however many items there are.
For each window (a container opened with the longest length that is left) a
bitset subset-sum over the remaining lengths finds the sum closest to the
capacity, and walking back through its layers gives how many items of each
length make it up. A filling found is used as often as the counts allow, so
the number of windows depends on the capacity and not on the data.
The items then get their places by their rank within their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut

#: Items of one length that one task ranks, on average: they are split into hash groups by their number.
RANK_ITEMS = 100_000
_SHIFT = 40


def fill_window(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many items of each length fill `room` best, each at most counts[length]
    times: the largest reachable sum not above room; longer items are tried first."""
    reach, full = 1, (1 << (room + 1)) - 1
    layers: list[tuple[int, int, int]] = []  # the sums reachable before, the length, how many of it
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length], room // length), 1
        while left > 0:
            take = min(step, left)
            layers.append((reach, length, take))
            reach |= (reach << (take * length)) & full
            left -= take
            step *= 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for before, length, take in reversed(layers):
        if not before >> at & 1:
            at -= take * length
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan_fillings(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: items}) of each filling; together they place every item."""
    counts = {n: c for n, c in histogram.items() if c > 0}
    if any(n <= 0 or n > capacity for n in counts):
        raise ValueError("lengths must lie in 1..capacity")
    out = []
    while counts:
        seed = max(counts)
        counts[seed] -= 1
        if not counts[seed]:
            del counts[seed]
        filling = fill_window(counts, capacity - seed) if counts and seed < capacity else {}
        counts[seed] = counts.get(seed, 0) + 1
        filling[seed] = filling.get(seed, 0) + 1
        times = min(counts[n] // k for n, k in filling.items())
        for n, k in filling.items():
            counts[n] -= times * k
            if not counts[n]:
                del counts[n]
        out.append((times, filling))
    return out


def pack(items: DataFrame, id_col: str, size_col: str, capacity: int = 2048, rank_items: int = RANK_ITEMS) -> DataFrame:
    """(id_col, part, start, size, container_id): a place for each item.

    An item above the capacity is split into parts of the capacity and a rest,
    no other item is; part counts from 0 and start is the offset within the
    item. Items of null, zero or negative size need no place and give no row.
    Repeated rows are items of their own. Containers are numbered from 0.
    However many items have one length, each of their hash groups holds about
    rank_items at most, of which one task finds the ranks.
    """
    cols = items.select(F.col(id_col).alias("_id"), F.col(size_col).cast("long").alias("_n")).filter("_n > 0")
    parts = cols.select(
        "_id", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {capacity}"))).alias("part")
    ).select(
        "_id", F.col("part").cast("int").alias("part"), (F.col("part") * capacity).alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("_n") - F.col("part") * capacity).alias("size"),
    )
    parts = cut(parts)
    groups = 1 + parts.count() // rank_items
    parts = parts.withColumn("_g", F.pmod(F.xxhash64("_id", "part"), F.lit(groups)).cast("int"))
    by_group = parts.groupBy("size", "_g").agg(F.count("*").alias("_c"))
    offset = Window.partitionBy("size").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_group.select("size", "_g", F.coalesce(F.sum("_c").over(offset), F.lit(0)).alias("_from"))
    # at most `capacity` rows reach the driver, however many items there are
    histogram = {int(r["size"]): int(r["n"]) for r in by_group.groupBy("size").agg(F.sum("_c").alias("n")).collect()}
    keys, bases, per, base = [], [], [], 0
    used = dict.fromkeys(histogram, 0)
    for times, filling in plan_fillings(histogram, capacity):
        for n, k in filling.items():
            keys.append((n << _SHIFT) + used[n])
            bases.append(base)
            per.append(k)
            used[n] += times * k
        base += times
    order = np.argsort(np.array(keys, dtype=np.int64)) if keys else np.zeros(0, dtype=np.int64)
    key_at, base_at, per_at = (np.array(x, dtype=np.int64)[order] for x in (keys, bases, per))
    rank = F.row_number().over(Window.partitionBy("size", "_g").orderBy("_id", "part"))
    ranked = parts.withColumn("_r", rank).join(offsets, ["size", "_g"]).select("_id", "part", "start", "size", (F.col("_r") - 1 + F.col("_from")).alias("_rank"))
    id_type = items.schema[id_col].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            key = (pdf["size"].to_numpy(np.int64) << _SHIFT) + pdf["_rank"].to_numpy(np.int64)
            i = np.searchsorted(key_at, key, side="right") - 1
            pdf["container_id"] = base_at[i] + (key - key_at[i]) // per_at[i]
            yield pdf[["_id", "part", "start", "size", "container_id"]]

    placed = ranked.mapInPandas(place, f"_id {id_type}, part int, start long, size long, container_id long")
    return placed.withColumnRenamed("_id", id_col)
