"""Encoding and packing."""

from __future__ import annotations

import base64
import random

import pytest

from commonweave.llm.bytebpe import ByteBpe
from commonweave.llm.packing import fill_window, pack, plan_fillings
from commonweave.llm.tokenize import default_vocabulary, encode_corpus, token_counts

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(default_vocabulary(), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(default_vocabulary())


def test_equals_reference_encoder(bpe, reference):
    random.seed(3)
    texts = ["", " ", "\n\n\t", "I'll've 12,345 naïve 日本語の文章 🙂👩‍👩‍👧 <|endoftext|>", "a" * 30_000, "ab" * 20_000 + "é" * 5_000, "​﻿؜ x"]
    texts += ["".join(random.choice("abcde éßя日  \n'12!?🙂tT") for _ in range(random.randint(1, 400))) for _ in range(400)]
    for t in texts:
        assert bpe.encode(t) == reference.encode_ordinary(t)


def test_encode_corpus_rows(spark, reference):
    rows = [(1, "hello world", "x"), (1, "hello world", "x"), (2, "", None), (3, None, "y"), (None, "z", None), (4, " \n ", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r["doc_id"], list(r["ids"])) for r in encode_corpus(df, "doc_id", "text").collect()), key=str)
    assert got == sorted(((d, reference.encode_ordinary(t or "")) for d, t, _ in rows), key=str)
    assert encode_corpus(df.limit(0), "doc_id", "text").count() == 0
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts(df, "doc_id", "text").collect()}[3] == 0


def brute_best(counts: dict[int, int], room: int) -> int:
    sums = {0}
    for n, c in counts.items():
        for _ in range(c):
            sums |= {s + n for s in sums if s + n <= room}
    return max(sums)


def test_fill_window_is_best():
    random.seed(5)
    for _ in range(200):
        counts = {random.randint(1, 40): random.randint(1, 4) for _ in range(random.randint(1, 6))}
        room = random.randint(1, 120)
        got = fill_window(counts, room)
        assert all(k <= counts[n] for n, k in got.items()) and sum(n * k for n, k in got.items()) == brute_best(counts, room)


def test_plan_places_every_item_once():
    random.seed(6)
    histogram = {random.randint(1, 64): random.randint(1, 500) for _ in range(50)}
    placed: dict[int, int] = {}
    for times, filling in plan_fillings(histogram, 64):
        assert sum(n * k for n, k in filling.items()) <= 64
        for n, k in filling.items():
            placed[n] = placed.get(n, 0) + times * k
    assert placed == histogram and plan_fillings({}, 8) == []
    with pytest.raises(ValueError):
        plan_fillings({9: 1}, 8)


def test_pack(spark):
    random.seed(8)
    rows = [(i, random.choice([5, 5, 5, 17, 30, 64, 65, 200, 0]), "c") for i in range(400)] + [(7, 5, "c"), (None, 3, "c"), (900, None, "c"), (901, -1, "c")]
    df = spark.createDataFrame(rows, "doc_id long, n long, container_id string")
    got = pack(df, "doc_id", "n", 64, rank_items=50).collect()
    fills: dict[int, int] = {}
    for r in got:
        fills[r["container_id"]] = fills.get(r["container_id"], 0) + r["size"]
    need = sum(n for _, n, _ in rows if n and n > 0)
    assert max(fills.values()) <= 64 and sum(fills.values()) == need and len(fills) <= need / 64 * 1.05 + 2
    assert sorted(fills) == list(range(len(fills)))
    assert all(r["part"] == 0 for r in got if r["size"] < 64 and r["start"] == 0)
    assert pack(df.limit(0), "doc_id", "n", 64).count() == 0
