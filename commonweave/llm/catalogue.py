"""The modules of this package with queries, each with QUERIES and SQL by name."""

from __future__ import annotations

from types import ModuleType

from . import corpus, identity_queries, merge_queries, pii_queries, place_queries, residue_queries


def modules() -> list[ModuleType]:
    """All modules with queries."""
    return [identity_queries, place_queries, merge_queries, pii_queries, corpus, residue_queries]
