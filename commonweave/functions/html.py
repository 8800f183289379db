"""HTML to text, meta tags, links and embedded JSON of a page."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TAG = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]+>", re.S | re.I)


@F.pandas_udf(T.StringType())
def html_text(html: pd.Series) -> pd.Series:
    """Text of HTML: tags dropped, entities decoded, blanks made single."""
    return html.map(lambda h: re.sub(r"\s+", " ", unescape(_TAG.sub(" ", h))).strip(), na_action="ignore")


def meta_content(html: Column, name: str) -> Column:
    """The content of the meta tag with that name or property, in either order of attributes."""
    n = re.escape(name)
    before = F.regexp_extract(html, rf"""(?i)<meta[^>]*(?:name|property)\s*=\s*["']{n}["'][^>]*content\s*=\s*["']([^"']*)["']""", 1)
    after = F.regexp_extract(html, rf"""(?i)<meta[^>]*content\s*=\s*["']([^"']*)["'][^>]*(?:name|property)\s*=\s*["']{n}["']""", 1)
    return F.coalesce(F.nullif(before, F.lit("")), F.nullif(after, F.lit("")))


def links(html: Column) -> Column:
    """All href values of anchors."""
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\b[^>]*?href\s*=\s*["']([^"'#][^"']*)["']"""), F.lit(1))


def visible_count(html: Column, word: str) -> Column:
    """The number before a word, as in '1,234 attending'."""
    return F.regexp_replace(F.regexp_extract(html, rf"(?i)([0-9][0-9,.]*)\s*(?:people\s+)?{word}", 1), "[,.]", "").try_cast("int")


def json_blocks(html: str) -> Iterator[Any]:
    """The values of the JSON-LD blocks and of embedded page data; broken ones are passed over."""
    for m in re.finditer(r"<script\b[^>]*type\s*=\s*[\"']application/(?:ld\+)?json[\"'][^>]*>(.*?)</script>", html, re.S | re.I):
        try:
            yield json.loads(unescape(m.group(1)).strip())
        except ValueError:
            continue


def visit(node: Any) -> Iterator[dict[str, Any]]:
    """Every object within a JSON value, outermost first."""
    stack = [node]
    while stack:
        at = stack.pop()
        if isinstance(at, dict):
            yield at
            stack.extend(reversed(list(at.values())))
        elif isinstance(at, list):
            stack.extend(reversed(at))


def is_event(node: dict[str, Any]) -> bool:
    """Does a JSON-LD object describe an event?"""
    kind = node.get("@type")
    kinds = kind if isinstance(kind, list) else [kind]
    return any(isinstance(k, str) and k.lower().endswith("event") for k in kinds)
