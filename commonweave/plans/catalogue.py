"""The plan modules with queries, each with QUERIES and SQL by name."""

from __future__ import annotations

from types import ModuleType

from . import api, extras, lookups, processing, rollups, threads

FLAGSHIP = "city_signal"


def modules() -> list[ModuleType]:
    """All plan modules of the core."""
    return [rollups, lookups, api, processing, extras, threads]
