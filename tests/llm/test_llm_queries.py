"""The queries of the training-data operators on the smallest tables."""

from __future__ import annotations

import os

import pytest

from commonweave.llm import catalogue

from ..conftest import TINY

QUERIES = {n: q for m in catalogue.modules() for n, q in m.QUERIES.items()}
SQL = {n: s for m in catalogue.modules() for n, s in m.SQL.items()}


@pytest.mark.skipif(not os.path.isdir(TINY), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    from compare import canonical, tables

    df = QUERIES[name](spark, TINY)
    pdf = df.toPandas()
    assert not pdf.isna().any().any() if name.endswith("_found") else True
    if name.endswith("_found"):
        assert not pdf.duplicated().any()
    if name in SQL:
        assert canonical(pdf) == canonical(tables(TINY).execute(SQL[name]).df())


def test_nothing_outside_imports_the_package():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, files in os.walk(os.path.join(root, "commonweave")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    assert "llm" not in open(os.path.join(folder, f)).read()
