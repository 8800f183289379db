"""The queries over empty tables, and over rows whose columns are null."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from commonweave.llm import catalogue

from ..conftest import TINY

QUERIES = {n: q for m in catalogue.modules() for n, q in m.QUERIES.items() if n.endswith(("_found", "_ids", "_containers"))}
TABLES = ("person", "person_platform_identity", "github_profile", "communication", "raw_reddit_item", "community_event", "company", "city_coordinates", "person_merge", "documents")
KEYS = ("id", "thing_id", "kind", "doc_id", "group_id", "person_id", "city_id")

pytestmark = pytest.mark.skipif(not os.path.isdir(TINY), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    empty, nulls = (str(tmp_path_factory.mktemp(n)) for n in ("empty", "nulls"))
    for name in TABLES:
        df = spark.read.parquet(f"{TINY}/{name}.parquet")
        df.limit(0).coalesce(1).write.parquet(f"{empty}/{name}.parquet")
        bare = df.limit(20).select(*[F.col(f.name) if f.name in KEYS else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema], F.lit("clash").alias("text_"), F.lit("x").alias("key"))
        bare.unionByName(bare).coalesce(1).write.parquet(f"{nulls}/{name}.parquet")
    return empty, nulls


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, folders, name):
    assert QUERIES[name](spark, folders[0]).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_null_columns(spark, folders, name):
    rows = QUERIES[name](spark, folders[1]).collect()
    if name == "p7_ids":
        assert rows and all(r["ids"] == [] for r in rows)
    else:
        assert rows == []
