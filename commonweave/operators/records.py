"""Writes as frames: write-once, latest-wins, patches, edges, merges of persons.

Spark tables without a transactional format have no MERGE; each operator returns
the new state of a table, to be written to a new version of its path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import latest_rows


def insert_once(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """old and those rows of new whose key it lacks; of several the earliest by `order` stays."""
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*new.columns), F.struct(order, F.xxhash64(*new.columns))).alias("r")).select("r.*")
    return old.unionByName(first.join(old.select(*keys), list(keys), "left_anti").select(*old.columns))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """old with the rows of new in place of those of the same key; of several the latest by `order` stays."""
    latest = latest_rows(new, list(keys), [F.col(order)])
    return old.join(latest.select(*keys), list(keys), "left_anti").select(*new.columns).unionByName(latest)


def changed_only(old: DataFrame, new: DataFrame, keys: Sequence[str], hash_col: str) -> DataFrame:
    """Rows of new that old does not hold with the same key and payload hash."""
    return new.join(old.select(*keys, hash_col), [*keys, hash_col], "left_anti")


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Missing columns and nulls filled with defaults."""
    return df.withColumns({c: F.coalesce(F.col(c), d) if c in df.columns else d for c, d in defaults.items()})


def patch(old: DataFrame, patches: DataFrame, key: str) -> DataFrame:
    """old with the non-null values of one patch row for each key."""
    given = [c for c in patches.columns if c != key]
    right = patches.select(key, *[F.col(c).alias(f"_{c}") for c in given])
    joined = old.join(right, key, "left")
    return joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c in given else F.col(c) for c in old.columns])


def append_unique(first: Column, second: Column) -> Column:
    """Both arrays, in order, each value once."""
    return F.array_distinct(F.concat(F.coalesce(first, F.array().cast("array<string>")), F.coalesce(second, F.array().cast("array<string>"))))


def merge_maps(first: Column, second: Column) -> Column:
    """Both maps, the second's value where a key is in both."""
    return F.map_concat(F.map_filter(first, lambda k, _: ~F.array_contains(F.map_keys(second), k)), second)


def edges_from_observations(observed: DataFrame) -> DataFrame:
    """(src, dst, edge_type, strength, first_seen, last_seen) from observations
    (src, dst, edge_type, record_id, seen_at): strength is the number of different
    records, so that observing one again does not raise it; self edges are left out."""
    return observed.filter("src <> dst").groupBy("src", "dst", "edge_type").agg(F.count_distinct("record_id").alias("strength"), F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"))


def repoint(df: DataFrame, column: str, merged: DataFrame) -> DataFrame:
    """df with ids of `column` replaced along merged(old_id, new_id)."""
    mapping = merged.select(F.col("old_id").alias(column), F.col("new_id").alias("_to"))
    return df.join(mapping, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to").select(*df.columns)


def merge_persons(person: DataFrame, merged: DataFrame) -> DataFrame:
    """person with the merged rows kept as inactive and naming whom they went into."""
    mapping = merged.select(F.col("old_id").alias("id"), F.col("new_id").alias("merged_into"))
    return person.join(mapping, "id", "left").withColumn("is_active", F.col("is_active") & F.col("merged_into").isNull())


def repoint_edges(edges: DataFrame, merged: DataFrame) -> DataFrame:
    """Edges with both ends replaced, self edges dropped and equal edges added up."""
    moved = repoint(repoint(edges, "src", merged), "dst", merged).filter("src <> dst")
    return moved.groupBy("src", "dst", "edge_type").agg(F.sum("strength").alias("strength"))


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child that name a parent which does not exist."""
    return child.filter(F.col(column).isNotNull()).join(parent.select(F.col(key).alias(column)), column, "left_anti")


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep every rule, quarantined rows with the rules they break)."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    judged = df.withColumn("broken_rules", broken)
    return judged.filter(F.size("broken_rules") == 0).drop("broken_rules"), judged.filter(F.size("broken_rules") > 0)


def signal_with_audit(observed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(signals, audit rows) from observed(person_id, signal_type, observed_at, source_record_id). Both are one
    function of the same rows, with ids of the content, so that writing both again after a failure adds nothing twice."""
    signal = observed.withColumn("id", F.sha2(F.concat_ws("|", "person_id", "signal_type", "source_record_id"), 256))
    return signal, signal.select(F.col("id").alias("signal_id"), F.lit("signal_emitted").alias("action"), F.col("observed_at").alias("at"))
