"""Relevance and rule-based classes as Column expressions; all words are parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import half_up, word_tokens


def text_relevance(text: str, community: str, word: str, primary: Sequence[str], secondary: Sequence[str], boosts: Mapping[str, float], negatives: Mapping[str, float]) -> Column:
    """0 where the word is missing, else 0.4, and 0.4 more in a primary or 0.2 in a
    secondary community, and the weights of other words found added or taken off;
    within 0..1, three digits. Letters beyond ASCII do not count as word letters."""
    tokens = word_tokens(text)
    where = F.lower(community)
    base = F.lit(0.4) + F.when(where.isin(*primary), 0.4).when(where.isin(*secondary), 0.2).otherwise(0.0)
    add = lambda words, sign: [F.when(F.array_contains(tokens, w), sign * v).otherwise(0.0) for w, v in words.items()]
    score = reduce(lambda a, b: a + b, [*add(boosts, 1.0), *add(negatives, -1.0)], base)
    hit = F.col(text).rlike(f"(?i)(?<![A-Za-z0-9_]){word}(?![A-Za-z0-9_])")
    return F.when(hit, half_up(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 3)).otherwise(0.0)


def repository_relevance(in_readme: Column, in_metadata: Column, in_code: Column) -> Column:
    """0.9 for a mention in the readme, 0.6 in the metadata, 0.3 in code alone, else 0."""
    return F.greatest(F.when(in_readme, 0.9).otherwise(0.0), F.when(in_metadata, 0.6).otherwise(0.0), F.when(in_code & ~in_readme & ~in_metadata, 0.3).otherwise(0.0))


def artifact_type(topics: Column, description: Column) -> Column:
    """The first theme that topics or description name, else documentation."""
    text, names = F.lower(F.coalesce(description, F.lit(""))), F.transform(F.coalesce(topics, F.array().cast("array<string>")), F.lower)
    out = F.lit("documentation")
    for word, kind in reversed((("mcp", "mcp_config"), ("rules", "rules_template"), ("agent", "agent_definition"), ("tutorial", "tutorial"))):
        out = F.when(F.array_contains(names, word) | text.rlike(rf"\b{word}\b"), kind).otherwise(out)
    return out


def event_status(starts: Column, ends: Column, observed: Column) -> Column:
    """completed once over, scheduled before, null without a start."""
    return F.when(starts.isNull() | observed.isNull(), F.lit(None)).when(F.coalesce(ends, starts) < observed, "completed").otherwise("scheduled")


def event_format(mode: Column, online: Column, html: Column) -> Column:
    """virtual, in_person or hybrid by the stated mode, a flag, or the links of a page."""
    return (
        F.when(mode.rlike("(?i)online"), "virtual").when(mode.rlike("(?i)offline|in.?person"), "in_person").when(mode.rlike("(?i)mixed|hybrid"), "hybrid")
        .when(online, "virtual").when(~online, "in_person").when(html.rlike(r"(?i)zoom\.us/|meet\.google\.com|youtube\.com/live"), "virtual")
    )


def still_holds(observed: Column, days: int, as_of: Column) -> Column:
    """Is a signal younger than its window?"""
    return observed + F.make_interval(days=F.lit(days)) > as_of


def inactive(last: Column, as_of: Column, days: int = 180) -> Column:
    """Has nothing been seen for so many days?"""
    return last < as_of - F.make_interval(days=F.lit(days))
