"""Problem 6 over communication and raw_reddit_item."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import table
from .pii import GIVEN_LIMIT, disclosing_terms, find_pii, given_names, replace_spans


def texts_of(spark: SparkSession, folder: str) -> DataFrame:
    """(source_table, record_id, version, text) of every row; the row of a record
    with the greatest version holds."""
    said = table(spark, folder, "communication").select(
        F.lit("communication").alias("source_table"), F.col("id").alias("record_id"), F.col("ingested_at").cast("timestamp").alias("at"), F.col("content_text").alias("text")
    )
    items = table(spark, folder, "raw_reddit_item").select(
        F.lit("raw_reddit_item").alias("source_table"), F.col("thing_id").alias("record_id"), F.col("fetched_at").cast("timestamp").alias("at"),
        F.when(F.col("kind") == "t3", F.col("selftext")).when(F.col("kind") == "t1", F.col("body")).alias("text"),
    )
    rows = said.unionByName(items).filter("record_id is not null")
    version = F.struct(F.coalesce(F.unix_micros("at"), F.lit(-1)).alias("at"), F.xxhash64("text").alias("h"))
    return rows.select("source_table", "record_id", F.concat_ws(":", F.lpad((version["at"]).cast("string"), 20, "0"), F.hex(version["h"])).alias("version"), "text")


def learned_given_names(spark: SparkSession, folder: str) -> list[str]:
    """The given names among the names of persons; by their definition at most GIVEN_LIMIT."""
    person = table(spark, folder, "person")
    names = person.select(F.col("canonical_name").alias("n")).unionByName(person.select(F.explode("names_seen").alias("n")))
    found = [r[0] for r in given_names(names, "n").limit(GIVEN_LIMIT + 1).collect()]
    if len(found) > GIVEN_LIMIT:
        raise ValueError("more given names than the workers are meant to hold")
    return found


def _current(spark: SparkSession, folder: str) -> DataFrame:
    """The findings in the row of each record that holds."""
    texts = texts_of(spark, folder)
    found = find_pii(texts, learned_given_names(spark, folder))
    repeated = texts.groupBy("source_table", "record_id").agg(F.count("*").alias("rows"), F.max("version").alias("latest")).filter("rows > 1")
    return found.join(repeated, ["source_table", "record_id"], "left").filter("latest is null or latest = version")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each occurrence of personal information."""
    return _current(spark, folder).select("source_table", "record_id", "pii_type", "start_pos").distinct()


def p6_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Each text that is not null, with typed placeholders for the personal information in it."""
    spans = _current(spark, folder).groupBy("source_table", "record_id", "version").agg(F.collect_set(F.struct("start_pos", "end_pos", "pii_type")).alias("spans"))

    @F.pandas_udf("string")
    def replaced(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if x is None else replace_spans(t, [(s["start_pos"], s["end_pos"], s["pii_type"]) for s in x]) for t, x in zip(text, spans)])

    texts = texts_of(spark, folder)
    repeated = texts.groupBy("source_table", "record_id").agg(F.count("*").alias("rows"), F.max("version").alias("latest")).filter("rows > 1").drop("rows")
    rows = texts.join(repeated, ["source_table", "record_id"], "left").filter("text is not null and (latest is null or latest = version)").drop("latest")
    rows = rows.dropDuplicates(["source_table", "record_id"]).join(spans, ["source_table", "record_id", "version"], "left")
    # only texts with findings go through Python
    hit = rows.filter("spans is not null").select("source_table", "record_id", replaced("text", "spans").alias("text"))
    return rows.filter("spans is null").select("source_table", "record_id", "text").unionByName(hit)


def p6_terms(spark: SparkSession, folder: str) -> DataFrame:
    """(person, term, n_texts, disclosure): the words that give away persons named in texts."""
    found = _current(spark, folder).filter("pii_type = 'name'").select("source_table", "record_id", "version", "start_pos", "end_pos")
    texts = texts_of(spark, folder).filter("text is not null").dropDuplicates(["source_table", "record_id", "version"])
    key = F.concat_ws("|", "source_table", "record_id", "version")
    name = F.lower(F.expr("substring(text, start_pos + 1, end_pos - start_pos)"))
    parts = F.array_sort(F.filter(F.split(name, r"[^\p{L}\p{M}]+"), lambda w: F.length(w) > 1))
    named = found.join(texts, ["source_table", "record_id", "version"]).select(key.alias("key"), F.array_join(parts, " ").alias("person"))
    terms = disclosing_terms(texts.select(key.alias("key"), "text"), named)
    return terms.filter(~F.array_contains(F.split("person", " "), F.col("term"))).select("person", "term", "n_texts", F.round("disclosure", 4).alias("disclosure"))


QUERIES = {"p6_found": p6_found, "p6_texts": p6_texts, "p6_terms": p6_terms}
SQL: dict[str, str] = {}
