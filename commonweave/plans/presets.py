"""The six preset questions, each a query of this package over a data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from . import lookups
from .adhoc import Asker, log_folder

#: Preset question by name: what it asks, and the query that answers it.
PRESETS: dict[str, tuple[str, Callable[[SparkSession, str], DataFrame]]] = {
    "top-engagement": ("Which posts are liked most?", lookups.top_engagement),
    "topic-share": ("What is talked about most?", lookups.topic_share),
    "failure-share": ("How much of the talk is about failures?", lookups.failure_share),
    "feature-mentions": ("Which features are mentioned?", lookups.feature_mentions),
    "reply-hubs": ("Who is answered most?", lookups.reply_hubs),
    "voices-outside": ("Who is liked without an account on the event platform?", lookups.voices_without_event_account),
}


def asker(spark: SparkSession, folder: str, log: str | None = None, **options: object) -> Asker:
    """An Asker over the folder with the presets, its log appended to the folder `log`."""
    presets = {name: partial(query, spark, folder) for name, (_, query) in PRESETS.items()}
    return Asker(spark, presets, sink=log_folder(spark, log) if log else None, **options)  # type: ignore[arg-type]
