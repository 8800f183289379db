"""Encoding a whole corpus with a public tokenizer (problem 7)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .bytebpe import loaded


def default_vocabulary() -> str:
    """The file of byte_bpe_50k of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


#: Characters encoded before a batch is handed on, so that long texts do not pile up.
BATCH_CHARS = 4_000_000


def encode_corpus(df: DataFrame, id_col: str, text_col: str, vocabulary: str | None = None) -> DataFrame:
    """(id_col, ids): the token ids of each row's text, without special tokens.

    One row comes out for each row that goes in, repeated rows included. A null
    and an empty text give an empty list; blank texts have ids like any other.
    Other columns are not read. The whole of a text is encoded, however long.
    Partitions are encoded where they are read, unless there are fewer than cores.
    """
    path = vocabulary or default_vocabulary()
    id_type = df.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            ids, start, chars = [], 0, 0
            for i, text in enumerate(batch.column(1)):
                value = text.as_py()
                ids.append(bpe.encode(value))
                chars += len(value or "")
                if chars > BATCH_CHARS:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(ids)), pa.array(ids, pa.list_(pa.int32()))], names=["key", "ids"])
                    ids, start, chars = [], i + 1, 0
            if ids:
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(ids)), pa.array(ids, pa.list_(pa.int32()))], names=["key", "ids"])

    two = spread(df.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")))
    return two.mapInArrow(encode, f"key {id_type}, ids array<int>").withColumnRenamed("key", id_col)


def token_counts(df: DataFrame, id_col: str, text_col: str, vocabulary: str | None = None) -> DataFrame:
    """(id_col, n_tokens): as encode_corpus, but only the number of ids."""
    path = vocabulary or default_vocabulary()
    id_type = df.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            n = pa.array([bpe.count(t.as_py()) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n], names=["key", "n_tokens"])

    two = spread(df.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")))
    return two.mapInArrow(count, f"key {id_type}, n_tokens long").withColumnRenamed("key", id_col)


def decode_corpus(encoded: DataFrame, id_col: str, ids_col: str, vocabulary: str | None = None) -> DataFrame:
    """(id_col, text): the texts of token ids, the way back of encode_corpus; no ids give an empty text."""
    path = vocabulary or default_vocabulary()
    id_type = encoded.schema[id_col].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token.encode("latin-1") for token, rank in loaded(path).ranks.items()}
        for batch in batches:
            texts = [b"".join(tokens[i] for i in ids.as_py() or ()).decode("utf-8") for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    two = encoded.select(F.col(id_col).alias("key"), F.col(ids_col).alias("ids"))
    return two.mapInArrow(decode, f"key {id_type}, text string").withColumnRenamed("key", id_col)
