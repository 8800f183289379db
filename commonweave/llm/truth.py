"""One surviving record for each group of duplicates (problem 3) by iterative
truth discovery.

Every row of a group is a source that claims values for fields. The support of
a value is the sum of its claims' weights, a weight being the reliability of
the source times the freshness of the claim; the reliability of a source is how
well its claims are supported, field by field. Both are estimated in turn until
the reliabilities stand still. A field with one truth takes the value of highest
support, a list field every value with support.

Reliabilities lie in 1/2..1. The newest claim of a field has freshness 1, and
the n claims of a field share 1/4 among them otherwise, so that older claims
together never outweigh a newer one: they decide between claims of one date.

discover_sources() is the form for sources that speak in many groups, such as
platforms: what a source is worth shows over all its claims, and a few reliable
sources may outvote many that err alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: The least reliability, and the part of the weight that outdated claims share.
LEAST_RELIABILITY, OUTDATED = 0.5, 0.25
#: Sources whose weights are broadcast; more are joined by shuffle. The claims that smoothing adds to each
#: source, half of them right, and the least weight of a vote.
SOURCES, PRIOR_CLAIMS, LEAST_WEIGHT = 10_000, 2.0, 0.05


def discover_truth(claims: DataFrame, list_fields: tuple[str, ...] = (), rounds: int = 8, tolerance: float = 0.01) -> DataFrame:
    """(group_id, field_name, field_value, support) from
    claims(group_id, source_id, field_name, field_value, seen_at).

    Rows with a null in group, source, field or value are no claims; a claim
    made twice counts once, with its latest date; no date counts as earliest.
    Of equal support the least value is taken. An empty table gives an empty
    result. Work is keyed by group, source and value and pre-aggregated, so no
    task holds a whole group.
    """
    named = claims.select("group_id", "source_id", "field_name", "field_value", "seen_at").dropna(subset=["group_id", "source_id", "field_name", "field_value"])
    early = F.lit("0001-01-01 00:00:00").cast("timestamp")
    named = named.groupBy("group_id", "source_id", "field_name", "field_value").agg(F.max(F.coalesce("seen_at", early)).alias("seen_at"))
    named = cut(named)
    spread = named.groupBy("group_id", "field_name").agg(F.max("seen_at").alias("newest"), F.count("*").alias("n"))
    fresh = F.when(F.col("seen_at") == F.col("newest"), 1.0).otherwise(F.lit(OUTDATED) / F.col("n"))
    weighed = cut(named.join(spread, ["group_id", "field_name"]).select("group_id", "source_id", "field_name", "field_value", fresh.alias("fresh")))
    trusted = weighed.withColumn("trust", F.lit(1.0))
    for _ in range(rounds):
        support = trusted.groupBy("group_id", "field_name", "field_value").agg(F.sum(F.col("fresh") * F.col("trust")).alias("support"))
        best = support.groupBy("group_id", "field_name").agg(F.max("support").alias("best"))
        agreed = trusted.join(support, ["group_id", "field_name", "field_value"]).join(best, ["group_id", "field_name"])
        trust = agreed.groupBy("group_id", "source_id").agg((LEAST_RELIABILITY + (1 - LEAST_RELIABILITY) * F.avg(F.col("support") / F.col("best"))).alias("new"))
        after = trusted.join(trust, ["group_id", "source_id"]).select("group_id", "source_id", "field_name", "field_value", "fresh", F.col("new").alias("trust"), F.abs(F.col("new") - F.col("trust")).alias("moved"))
        after = cut(after)
        moved = after.agg(F.max("moved")).first()[0]
        trusted = after.drop("moved")
        if moved is None or moved < tolerance:
            break
    support = trusted.groupBy("group_id", "field_name", "field_value").agg(F.sum(F.col("fresh") * F.col("trust")).alias("support"))
    lists = support.filter(F.col("field_name").isin(list(list_fields)))
    single = support.filter(~F.col("field_name").isin(list(list_fields)))
    won = single.groupBy("group_id", "field_name").agg(F.min_by(F.struct("field_value", "support"), F.struct(-F.round("support", 9), "field_value")).alias("w"))
    won = won.select("group_id", "field_name", F.col("w.field_value").alias("field_value"), F.col("w.support").alias("support"))
    return lists.unionByName(won)


def discover_sources(claims: DataFrame, rounds: int = 20, tolerance: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """((group_id, field_name, field_value, confidence), (source_id, accuracy, n_claims)) from
    claims(group_id, source_id, field_name, field_value).

    The probability of a value follows from the votes for it, a vote weighing the
    log odds that its source is right; the accuracy of a source is the mean
    probability of its claims where another source speaks too. Both are estimated
    in turn, from equal votes on, until the accuracies stand still. Of equally
    probable values the least is taken; a claim made twice counts once, rows with a
    null are no claims, an empty table gives empty results. Votes are added up by
    value and by source before they are shuffled; the weights are a table by source.
    """
    columns = ("group_id", "source_id", "field_name", "field_value")
    named = cut(claims.select(*columns).dropna().distinct())
    asked = cut(named.groupBy("group_id", "field_name").agg(F.count_distinct("source_id").alias("n")).filter("n > 1").drop("n"))
    contested = cut(named.join(asked, ["group_id", "field_name"]))
    sources = cut(named.groupBy("source_id").agg(F.count("*").alias("n_claims")).withColumn("accuracy", F.lit(0.75)))
    few = sources.limit(SOURCES + 1).count() <= SOURCES
    for _ in range(rounds):
        held = _votes(contested, sources, few)
        right = contested.join(held, ["group_id", "field_name", "field_value"]).groupBy("source_id").agg(F.sum("confidence").alias("right"), F.count("*").alias("of"))
        fresh = sources.join(right, "source_id", "left").select(
            "source_id", "n_claims", ((F.coalesce("right", F.lit(0.0)) + PRIOR_CLAIMS / 2) / (F.coalesce("of", F.lit(0)) + PRIOR_CLAIMS)).alias("accuracy"), F.col("accuracy").alias("before")
        )
        fresh = cut(fresh)
        moved = fresh.agg(F.max(F.abs(F.col("accuracy") - F.col("before")))).first()[0]
        sources = fresh.drop("before")
        if moved is None or moved < tolerance:
            break
    best = _votes(named, sources, few).groupBy("group_id", "field_name").agg(F.min_by(F.struct("field_value", "confidence"), F.struct(-F.round("confidence", 9), "field_value")).alias("w"))
    return best.select("group_id", "field_name", F.col("w.field_value").alias("field_value"), F.col("w.confidence").alias("confidence")), sources.select("source_id", "accuracy", "n_claims")


def _votes(claims: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """(group_id, field_name, field_value, confidence) by the weighted votes."""
    weight = F.greatest(F.log(F.col("accuracy") / (1 - F.col("accuracy"))), F.lit(LEAST_WEIGHT))
    weights = sources.select("source_id", weight.alias("weight"))
    votes = claims.join(F.broadcast(weights) if few else weights, "source_id").groupBy("group_id", "field_name", "field_value").agg(F.sum("weight").alias("votes"))
    most = votes.groupBy("group_id", "field_name").agg(F.max("votes").alias("most"))
    odds = votes.join(most, ["group_id", "field_name"]).withColumn("odds", F.exp(F.col("votes") - F.col("most")))
    total = odds.groupBy("group_id", "field_name").agg(F.sum("odds").alias("total"))
    return odds.join(total, ["group_id", "field_name"]).select("group_id", "field_name", "field_value", (F.col("odds") / F.col("total")).alias("confidence"))
