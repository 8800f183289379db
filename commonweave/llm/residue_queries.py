"""Problem 9 over the table documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..tables import table
from .residue import find_residue


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """The documents to exclude."""
    return find_residue(table(spark, folder, "documents"), "doc_id", "text").filter("excluded").select("doc_id")


def p9_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that stay, null and blank ones included."""
    return find_residue(table(spark, folder, "documents"), "doc_id", "text").filter("not excluded").select("doc_id")


QUERIES = {"p9_found": p9_found, "p9_kept": p9_kept}
SQL: dict[str, str] = {}
