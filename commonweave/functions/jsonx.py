"""JSON functions: canonical text and its hash, and picking the first usable key."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """JSON with sorted keys and no blanks, so that equal payloads have equal text; null for what is no JSON."""

    def canonical(t: str | None) -> str | None:
        try:
            return json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"), ensure_ascii=False) if t is not None else None
        except ValueError:
            return None

    return text.map(canonical, na_action="ignore")


def payload_hash(text: Column) -> Column:
    """SHA-256 of the canonical JSON."""
    return F.sha2(canonical_json(text), 256)


def first_text(payload: Column, *keys: str) -> Column:
    """The first non-blank text among the keys of a JSON object."""
    return F.coalesce(*[F.nullif(F.trim(F.get_json_object(payload, f"$.{k}")), F.lit("")) for k in keys])


def first_number(payload: Column, *keys: str) -> Column:
    """The first finite number among the keys of a JSON object."""
    return F.coalesce(*[F.get_json_object(payload, f"$.{k}").try_cast("double") for k in keys])


def first_flag(payload: Column, *keys: str) -> Column:
    """The first true or false among the keys of a JSON object."""
    return F.coalesce(*[F.get_json_object(payload, f"$.{k}").try_cast("boolean") for k in keys])
