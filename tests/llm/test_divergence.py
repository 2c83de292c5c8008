"""The audit against a plain count of every term in every group."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from streetscape.llm import divergence as D
from streetscape.llm import queries as Q

from .conftest import SCHEMA, rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, min_df, top=10):
    def words(text):
        return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    by_lang = defaultdict(list)
    for lang, source, text in docs:
        by_lang[lang or ""].append((source or "", words(text)))
    out = []
    for lang, members in by_lang.items():
        df = Counter(t for _, w in members for t in set(w))
        kept = sorted(t for t, n in df.items() if n >= min_df)
        counts = defaultdict(Counter)
        for source, w in members:
            counts[source].update(t for t in w if df[t] >= min_df)

        def shares(c):
            total = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in p:
            found = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in p if o != s)
            out += [(lang, s, "pair", o.decode(), -v, k + 1) for k, (v, o) in enumerate(found)]
            found = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(found[:top])]
    return sorted(out)


def table_rows():
    rng = random.Random(4)
    words = ["Alpha", "beta", "gamma", "Élan", "élan", "日本", "🙂x", "don't", "z9y", "_w_", "MIX", "mix", "tail"]
    out = []
    for i in range(160):
        source = rng.choice(["a", "b", "c", "d", "", None, "é"])
        out.append((rng.choice(["x", "y", "", None]), source, " ".join(rng.choice(words[: 5 + (i % 9)]) for _ in range(rng.randint(0, 30)))))
    out += [("x", "silent", None), ("x", "silent", "12 34"), ("lone", "one", "alpha beta"), ("few", "one", "rare"), ("few", "two", None), ("x\0y", "a", "alpha " * 5)] + out[:3]
    return out


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def small(spark):
    data = table_rows()
    return spark.createDataFrame(data, "lang string, source string, text string").repartition(3), data


@pytest.mark.parametrize("min_df", [1, 3, 10])
@pytest.mark.parametrize("max_terms", [D.MAX_TERMS, 0])
def test_equals_brute_force_by_either_count(small, min_df, max_terms):
    docs, data = small
    assert got(D.audit(docs, min_df=min_df, max_terms=max_terms)) == brute(data, min_df)


@pytest.mark.parametrize("block", [1, 300, 1 << 20])
def test_a_group_looks_each_term_up_once_for_each_one_of_its_count(monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    texts = [(1, 33, "Alpha beta alpha 日本 " * 50), (2, 34, "alpha"), (1, 33, None), (1, 33, "12 34"), (1, 33, "beta gamma " * 7), (2, 34, "alpha " * 3)]
    gid, code, text = zip(*texts)
    batch = pa.RecordBatch.from_arrays([pa.array(gid, pa.int64()), pa.array(text), pa.array(code, pa.int16())], names=["gid", "text", "code"])
    rows = [r for b in D._group_terms(iter([batch.slice(0, 2), batch.slice(2)])) for r in b.to_pylist()]
    got, want = Counter(), Counter()
    for r in rows:
        assert len(set(r["terms"])) == len(r["terms"])
        got.update({(r["gid"], t): r["weight"] for t in r["terms"]})
    for g, c, t in texts:
        want.update((g, chr(c) + w) for w in TERM.findall((t or "").replace("A", "a")))
    assert got == want
    if block > 300:
        assert sum(len(r["terms"]) for r in rows) == sum(n.bit_count() for n in want.values()) < sum(want.values()) / 10


def test_each_row_is_transformed_once(small):
    docs = small[0].select(F.lit(1).cast("long").alias("gid"), F.lit(1).cast("long").alias("lid"), "text")
    sums = D.counts_by_vectors(docs, 3)[1]
    assert sums._jdf.queryExecution().executedPlan().toString().count("UDF(") == 1


def test_values_that_need_more_than_double(spark):
    docs = spark.createDataFrame([("x", "a", "w " * 30_000 + "u v"), ("x", "b", "u " * 7 + "v " * 20_000)], "lang string, source string, text string")
    want = brute([("x", "a", "w " * 30_000 + "u v"), ("x", "b", "u " * 7 + "v " * 20_000)], 1)
    assert got(D.audit(docs, min_df=1)) == want


def test_shares_beyond_64_bits(spark):
    n = 4 * 10**12
    out = spark.range(1).select(D._share(F.lit(n), F.lit(3 * n), F.lit(5)).alias("p")).first().p
    assert out == 1 + 10**9 * (n + 2) // (3 * n + 10)


def test_more_languages_than_codes(spark):
    data = [(f"l{i % 70}", f"s{i % 3}", f"alpha beta w{i % 5} " * (1 + i % 4)) for i in range(700)]
    assert got(D.audit(spark.createDataFrame(data, "lang string, source string, text string"), min_df=2)) == brute(data, 2)


def test_estimate_of_kept_terms(spark):
    word = lambda k: "".join(chr(97 + k // 26**p % 26) for p in range(4))
    docs = spark.createDataFrame([(1, 1, " ".join(map(word, range(60_000)))), (1, 1, " ".join(map(word, range(20_000, 90_000))))], "gid long, lid long, text string")
    assert 32_000 < D.kept_terms(docs, 2) < 50_000 and 75_000 < D.kept_terms(docs, 1) < 106_000


@pytest.mark.parametrize("held", [2, 1_000_000])
def test_fit_reads_frequent_terms_only_and_in_min_df_rows(spark, monkeypatch, held):
    monkeypatch.setattr(D, "HELD", held)
    texts = [(33, f"common Pair{'x' if k < 2 else ''} w{'abcdefgh'[k % 8]}{'z' * k} common") for k in range(40)] + [(34, "common"), (33, None)]
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in texts]), pa.array([c for c, _ in texts], pa.int16())], names=["text", "code"])
    packed = sorted((r for b in D._frequencies(3)(iter([batch.slice(0, 7), batch.slice(7)])) for r in b.to_pylist()), key=lambda r: r["part"])
    blocks = [pa.RecordBatch.from_pylist(packed)]
    rows = [r for b in D._frequent(3)(iter(blocks)) for r in b.to_pylist()]
    assert Counter(t for r in rows for t in r["terms"]) == {"!common": 3, "!pair": 3}
    assert sorted(t for r in rows if r["round"] == 0 for t in r["terms"]) == ["!common", "!pair"]


def test_odd_tables(spark, docs, no_docs):
    assert D.audit(no_docs).count() == 0
    want = brute([(r[2], r[3], r[1]) for r in rows()], 2)
    extra = docs.withColumns({c: F.lit("x") for c in "terms features idx gid n v p0 c p q value rank item part term other".split()})
    assert got(D.audit(extra, min_df=2)) == got(D.audit(docs, min_df=2)) == want
    assert got(D.audit(spark.createDataFrame([(1, "a b", "x", "s", 3), (2, None, "x", "t", None)], SCHEMA))) == [("x", "s", "pair", "t", 0, 1), ("x", "t", "pair", "s", 0, 1)]


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(Q.SQL["op12_source_divergence"]).fetchall()
    df = Q.op12_source_divergence(spark, sf)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"] and got(df) == sorted(want) and want
