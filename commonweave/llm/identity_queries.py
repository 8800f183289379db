"""Problems 1 and 5 over person, github_profile and their side tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut
from ..tables import table
from .pairing import LINKED, PRIOR, build_records, candidate_pairs, entities, family_links, fit_on_weak_labels, handle_values, pair_features, reliability, score_pairs, weak_labels
from .radius import minhash_links, radius_join


def known_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """(k_a, k_b) both ways: persons already decided to be one human, each with the least of its group."""
    merged = table(spark, folder, "person_merge").select("group_id", F.concat(F.lit("person:"), "person_id").alias("key")).dropna().distinct()
    first = merged.groupBy("group_id").agg(F.min("key").alias("first"))
    star = merged.join(first, "group_id").filter("key <> first").select("key", "first")
    return star.select(F.col("key").alias("k_a"), F.col("first").alias("k_b")).unionByName(star.select(F.col("first").alias("k_a"), F.col("key").alias("k_b")))


def profile_features(spark: SparkSession, folder: str) -> DataFrame:
    """The features of profiles and persons that MinHash blocking over family names, handles and e-mail names brings together."""
    records, given, alias = build_records(spark, folder)
    values = records.select(F.explode("cores").alias("value")).select(F.lit("name").alias("attr"), "value")
    links = minhash_links(values).unionByName(minhash_links(handle_values(records), 1))
    return cut(pair_features(candidate_pairs(records, links, True, given, alias), records, given, alias))


def match_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """(a, b, probability): profiles ('github:...') and persons ('person:...') with the calibrated
    probability of being one human. A person merged with one that is linked has the probability of that link."""
    features = profile_features(spark, folder)
    scored = cut(score_pairs(features, fit_on_weak_labels(features, known_pairs(spark, folder))))
    merged = table(spark, folder, "person_merge").select("group_id", F.concat(F.lit("person:"), "person_id").alias("b")).dropna().distinct()
    people = table(spark, folder, "person").select(F.concat(F.lit("person:"), "id").alias("b")).distinct()
    groups = scored.filter(F.col("probability") >= LINKED).join(merged, "b").groupBy("a", "group_id").agg(F.max("probability").alias("probability"))
    others = groups.join(merged.join(people, "b", "left_semi"), "group_id").select("a", "b", "probability")
    return scored.unionByName(others).groupBy("a", "b").agg(F.max("probability").alias("probability"))


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.substring("a", 8, 1000).cast("long").alias("github_id"), F.substring("b", 8, 1000).alias("person_id"), "probability")


def p1_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Each candidate match with its confidence."""
    return _ids(match_profiles(spark, folder)).select("github_id", "person_id", F.round("probability", 4).alias("confidence"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The person rows of each profile: those of p1_matches from LINKED on."""
    return _ids(match_profiles(spark, folder)).filter(F.col("probability") >= LINKED).select("github_id", "person_id")


def p1_reliability(spark: SparkSession, folder: str) -> DataFrame:
    """(probability_from, n, mean_probability, share_right, squared_error) of the labels that neither fitted nor calibrated the classifier."""
    persons, _ = weak_labels(profile_features(spark, folder), known_pairs(spark, folder))
    return spark.createDataFrame(reliability(*persons, PRIOR), "probability_from double, n int, mean_probability double, share_right double, squared_error double")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of records of one person or organisation under different spellings."""
    records, given, alias = build_records(spark, folder)
    near = radius_join(handle_values(records).select("value")).select(F.lit("base").alias("attr"), "a", "b")
    features = cut(pair_features(candidate_pairs(records, family_links(records).unionByName(near), False, given, alias), records, given, alias))
    known = known_pairs(spark, folder)
    linked = score_pairs(features, fit_on_weak_labels(features, known)).filter(F.col("probability") >= LINKED).select("a", "b")
    whole = entities(linked.unionByName(known.select(F.least("k_a", "k_b").alias("a"), F.greatest("k_a", "k_b").alias("b")).distinct()))
    named = whole.join(records.select("key", "name"), "key").filter("name is not null")
    other = named.select("entity", F.col("key").alias("key_b"), F.col("name").alias("name_b"))
    pairs = named.select("entity", F.col("key").alias("key_a"), "name").join(other, "entity").filter("key_a < key_b and name <> name_b")
    return pairs.select("key_a", "key_b")


QUERIES = {"p1_found": p1_found, "p1_matches": p1_matches, "p1_reliability": p1_reliability, "p5_found": p5_found}
SQL: dict[str, str] = {}
