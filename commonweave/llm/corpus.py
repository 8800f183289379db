"""Problems 7 and 8 over the table documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import table
from .packing import pack
from .tokenize import decode_corpus, encode_corpus, token_counts

#: Tokens that a container holds.
CAPACITY = 2048


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of each document by byte_bpe_50k."""
    return encode_corpus(table(spark, folder, "documents"), "doc_id", "text")


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    """The container of each document, or of each part of one that alone exceeds the capacity."""
    sizes = token_counts(table(spark, folder, "documents"), "doc_id", "text")
    placed = pack(sizes, "doc_id", "n_tokens", CAPACITY)
    return placed.select("doc_id", "part", F.col("start").alias("start_token"), F.col("size").alias("n_tokens"), "container_id")


def p7_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of all documents encoded and decoded again, as lengths and hashes."""
    back = decode_corpus(p7_ids(spark, folder), "doc_id", "ids")
    return back.select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("hash"))


def p8_totals(spark: SparkSession, folder: str) -> DataFrame:
    """(placed, overfull, wrongly_split): documents in containers, containers above the capacity, and documents
    in several parts that one container could hold."""
    placed = p8_containers(spark, folder)
    full = placed.groupBy("container_id").agg(F.sum("n_tokens").alias("n")).agg(F.count(F.when(F.col("n") > CAPACITY, 1)).alias("overfull"))
    docs = placed.groupBy("doc_id").agg(F.count("*").alias("parts"), F.sum("n_tokens").alias("n"))
    return docs.agg(F.count("*").alias("placed"), F.count(F.when((F.col("parts") > 1) & (F.col("n") <= CAPACITY), 1)).alias("wrongly_split")).crossJoin(F.broadcast(full))  # one row each


QUERIES = {"p7_ids": p7_ids, "p7_round_trip": p7_round_trip, "p8_containers": p8_containers, "p8_totals": p8_totals}
SQL = {
    "p7_round_trip": "SELECT doc_id, length(coalesce(text, '')) AS n_chars, md5(coalesce(text, '')) AS hash FROM documents",
    "p8_totals": "SELECT count(DISTINCT doc_id) FILTER (WHERE length(text) > 0) AS placed, 0 AS wrongly_split, 0 AS overfull FROM documents",
}
