"""Scalar functions on literal values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from commonweave.functions import html, jsonx
from commonweave.functions import text as X
from commonweave.functions.similarity import cosine, jaro_winkler_of


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr.alias("o")).first()["o"]


@pytest.mark.parametrize(
    ("make", "value", "want"),
    [
        (X.normalize_name, "  José  ÁLVAREZ ", "jose alvarez"), (X.normalize_email, " A@B.C ", "a@b.c"), (X.email_domain, "a@b@c.d", "c.d"), (X.email_domain, "@c.d", ""), (X.email_domain, "ac.d", ""),
        (X.normalize_handle, " @Ab ", "ab"), (X.name_core, "Zoë O'Neil-2", "zoeoneil2"), (X.slug, "Ça va & co", "ca-va-co"), (X.encode_component, "a b&c", "a%20b%26c"), (X.url_host, "https://WWW.Ab.example/x", "ab.example"),
        (X.first_path_segment, "https://a.example/u/x?y", "u"), (X.redacted, " [removed] ", None), (X.redacted, "x", "x"),
    ],
)
def test_text(spark, make, value, want):
    assert one(spark, value, make("v")) == want


def test_nulls_stay_null(spark):
    for make in (X.normalize_name, X.name_core, X.normalize_email, X.slug, X.redacted, X.url_host):
        assert one(spark, None, make("v")) is None


def test_mentions_and_variants(spark):
    assert one(spark, "hi @Ann_b and u/cee, mail x@y.z, @me", X.mentioned_handles("v", F.lit("ann_b"))) == ["cee"]
    assert "jdoe" in one(spark, "Jane Doe", X.handle_variants("v")) and "doejane" in one(spark, "Jane Doe", X.handle_variants("v"))


def test_snippets(spark):
    assert one(spark, "a |  b" + "c" * 20, X.snippet("v", 6)) == "a \\| …" and one(spark, "ab  cd", X.excerpt("v", 4)) == "ab…"


def test_jaro_winkler():
    assert jaro_winkler_of("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert jaro_winkler_of("dixon", "dicksonx") == pytest.approx(0.8133, abs=1e-4)
    assert jaro_winkler_of("", "a") == 0.0 and jaro_winkler_of("a", "a") == 1.0 and jaro_winkler_of("abc", "xyz") == 0.0


def test_json_and_vectors(spark):
    a, b = ('{"b": 1, "a": [1, 2]}', '{"a":[1,2],"b":1}')
    assert one(spark, a, jsonx.payload_hash(F.col("v"))) == one(spark, b, jsonx.payload_hash(F.col("v")))
    assert one(spark, "no json", jsonx.payload_hash(F.col("v"))) is None
    assert one(spark, '{"x": " ", "y": "k"}', jsonx.first_text(F.col("v"), "x", "y")) == "k"
    row = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0], [0.0, 0.0])], "a array<double>, b array<double>, z array<double>")
    got = row.select(cosine(F.col("a"), F.col("b")).alias("c"), cosine(F.col("a"), F.col("z")).alias("n")).first()
    assert got["c"] == pytest.approx(0.70710678) and got["n"] is None


def test_html(spark):
    page = "<p>a &amp; b</p><script>x</script><meta content='T' property=\"og:title\"><a href='/e1'>1,234 attending</a>"
    assert one(spark, page, html.html_text(F.col("v"))) == "a & b 1,234 attending"
    assert one(spark, page, html.meta_content(F.col("v"), "og:title")) == "T"
    assert one(spark, page, html.visible_count(F.col("v"), "attending")) == 1234
