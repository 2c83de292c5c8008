"""Token counts through the cache against plain calls of the libraries."""

from __future__ import annotations

import os

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from streetscape.llm import digest_cache as D
from streetscape.llm import queries as Q

from .conftest import prose, rows

ODD = ["a  b   c", " lead", "trail ", "tab\tnew\nline\r\n", "it's we'll", "naïve 日本語 🙂", "<|endoftext|>", "x<|endoftext|> y", "1234567890 " * 40, "\x00\x1f\x85  z"]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def entries(spark, cache):
    return spark.read.parquet(cache).count()


def test_counts_equal_the_library(spark, docs, plain):
    odd = spark.createDataFrame([(900 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    got = D.token_counts(docs.select("doc_id", "text").union(odd)).collect()
    want = sorted(((r[0], len((r[1] or "").encode()), plain(r[1])) for r in rows()), key=repr) + [(900 + i, len(t.encode()), plain(t)) for i, t in enumerate(ODD)]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)


def test_sentencepiece_model(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    got = D.token_counts(spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string"), tokenizer=path).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(own.encode(t)) for i, t in enumerate(ODD)}


def test_only_distinct_misses_are_encoded_and_appended(spark, tmp_path):
    cache = f"{tmp_path}/cache"
    first = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, None), (4, "")], "doc_id long, text string")
    D.token_counts(first, cache).collect()
    assert entries(spark, cache) == 2
    before = sorted(os.listdir(f"{cache}/{next(x for x in os.listdir(cache) if x.startswith('tokenizer='))}"))
    again = D.token_counts(first, cache).collect()
    assert {(r.doc_id, r.n_tokens) for r in again} == {(1, 2), (2, 2), (3, 0), (4, 0)} and entries(spark, cache) == 2
    more = first.union(spark.createDataFrame([(5, "three"), (6, "three")], "doc_id long, text string"))
    assert {r.doc_id: r.n_tokens for r in D.token_counts(more, cache).collect()}[6] >= 1
    assert entries(spark, cache) == 3
    folder = next(x for x in os.listdir(cache) if x.startswith("tokenizer="))
    assert set(before) <= set(os.listdir(f"{cache}/{folder}"))
    # another version of the tokenizer has its own entries
    D.token_counts(first, cache, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2 and entries(spark, cache) == 5


def test_stored_counts_are_used_and_doubled_entries_count_once(spark, tmp_path):
    cache = f"{tmp_path}/cache"
    docs = spark.createDataFrame([(1, "one two"), (2, "one two")], "doc_id long, text string")
    version = D._tokenizer(None)[2]
    told = docs.limit(1).select(F.lit(version).alias("tokenizer"), D.digest(F.col("text")).alias("digest"), F.lit(77).cast("long").alias("n_tokens"))
    for _ in range(2):  # as two runs at once would
        told.write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert sorted((r.doc_id, r.n_tokens) for r in D.token_counts(docs, cache).collect()) == [(1, 77), (2, 77)]


def test_hot_digests(spark, plain):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("the same text")).when(F.col("id") % 3 == 1, None).otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"))
    got = {r.doc_id: r.n_tokens for r in D.token_counts(docs).collect()}
    assert len(got) == 3000 and all(got[i] == plain("the same text" if i % 3 == 0 else "" if i % 3 == 1 else f"text {i}") for i in range(0, 3000, 7))


def test_slices_cut_where_no_token_crosses(plain):
    model = open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()
    assert D.sliceable(model, "json") and not D.sliceable(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read(), "json")
    text = "  ".join(ODD) + prose(3, 400) + " it's  9 x " + "日本語 のテキスト " * 30
    parts = list(D.slices(text, 20))
    assert len(parts) > 20 and "".join(parts) == text and sum(map(plain, parts)) == plain(text)
    assert list(D.slices("x" * 100, 20)) == ["x" * 100]


def test_words_cut_where_no_token_crosses(plain, monkeypatch):
    import random

    rng = random.Random(8)
    model = open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()
    texts = ["".join(rng.choice(["a", "Bc", "it's", " ", "  ", "\n", "\n\n", "\t", " \n", "1", "22", ".", "...", "é", "\xa0", "\u2003", "日", "<|endoftext|>", "\x1f", "\x85", "\0"]) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [prose(k, 80) for k in range(20)] + [" a", "a ", "\na", "a\n", " ", "\n", "a \nb", "a\n b"]
    want = [plain(t) for t in texts]
    for limit in (D.KNOWN_WORDS, 3):
        monkeypatch.setattr(D, "KNOWN_WORDS", limit)
        count = D.by_words(lambda some: [plain(x) for x in some])
        assert [n for k in range(0, len(texts), 500) for n in count(texts[k : k + 500])] == want
    assert D.counter(model, "json")(texts) == want


def test_odd_tables(spark, docs, no_docs):
    assert D.token_counts(no_docs).count() == 0
    extra = docs.withColumns({c: F.lit("x") for c in ("digest", "n_tokens", "n", "at", "tokenizer", "hot_tokens", "n_bytes")})
    key = lambda d: sorted(map(repr, D.token_counts(d).collect()))
    assert key(extra) == key(docs)


def test_query_at_smallest_size(spark, plain):
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = Q.op13_digest_cache(spark, sf).collect()
    assert len(got) == len(text)
    for r in got:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((text[r.doc_id] or "").encode()), plain(text[r.doc_id]), plain(text[r.doc_id]) > 1024)
