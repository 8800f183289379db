"""Counting texts by patterns in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_label(text: str, probes: Sequence[tuple[str, str]]) -> Column:
    """The label of the first pattern that a text matches, else null."""
    out = F.lit(None).cast("string")
    for label, pattern in reversed(probes):
        out = F.when(F.col(text).rlike(f"(?i){pattern}"), F.lit(label)).otherwise(out)
    return out


def all_labels(text: str, probes: Sequence[tuple[str, str]]) -> Column:
    """The labels of all patterns that a text matches."""
    return F.array_compact(F.array(*[F.when(F.col(text).rlike(f"(?i){p}"), F.lit(label)) for label, p in probes]))


def count_labels(df: DataFrame, text: str, probes: Sequence[tuple[str, str]], zeros: bool = False) -> DataFrame:
    """(label, mentions): texts that match each pattern, a text once for each label.
    One scan serves all patterns; zeros adds the labels without a hit."""
    found = df.select(F.explode(all_labels(text, probes)).alias("label")).groupBy("label").agg(F.count("*").alias("mentions"))
    return with_zeros(found, probes) if zeros else found


def with_zeros(found: DataFrame, probes: Sequence[tuple[str, str]]) -> DataFrame:
    """(label, mentions) with a row of 0 for each label that was not found."""
    labels = found.sparkSession.createDataFrame([(label,) for label, _ in probes], "label string")
    return labels.join(found, "label", "left").select("label", F.coalesce("mentions", F.lit(0)).alias("mentions"))
