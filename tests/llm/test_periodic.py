"""Periodic runs against a scan of every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from streetscape.llm import periodic as R
from streetscape.llm import queries as Q

from .conftest import prose, rows

WORD = re.compile(R.WORD)


def brute(words, min_words=R.MIN_WORDS, min_periods=R.MIN_PERIODS):
    """Every maximal stretch of each period, the smallest period of each stretch."""
    n, best = len(words), {}
    for q in range(1, n // min_periods + 1):
        x = 0
        while x + q < n:
            if words[x] != words[x + q]:
                x += 1
                continue
            y = x
            while y + q < n and words[y] == words[y + q]:
                y += 1
            if y + q - x >= max(min_words, min_periods * q):
                best.setdefault((x, y + q), q)
            x = y + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def replaced(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def answer(doc_id, text):
    words = replaced(doc_id, WORD.findall(text or ""))
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def sequences():
    rng = random.Random(11)
    out = ["", "a", "ab" * 40, "a" * 100, "abcabcab" * 9 + "x" + "abc" * 20, "aab" * 30 + "aab" * 30, "x" + "ab" * 12 + "y"]
    for n in (30, 90, 200):
        out += ["".join(rng.choice("ab") for _ in range(n)) for _ in range(15)]
    for _ in range(40):  # periodic parts with noise, overlapping and nested
        s = ""
        while len(s) < 300:
            unit = "".join(rng.choice("abc") for _ in range(rng.randint(1, 20)))
            s += unit * rng.randint(1, 9) + unit[: rng.randint(0, len(unit))] + rng.choice(["", "z", "zz"])
        out.append(s)
    fib = ["a", "ab"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    return [*out, fib[-1]]


@pytest.mark.parametrize("min_words, min_periods", [(24, 3), (2, 2), (6, 4)])
def test_runs_equal_a_scan_of_every_period(min_words, min_periods):
    for s in sequences():
        got = R.find_runs(np.frombuffer(s.encode(), np.uint8).astype(np.int64), min_words, min_periods)
        assert list(zip(*(x.tolist() for x in got))) == brute(s, min_words, min_periods), s


def test_suffix_and_lcp_arrays():
    rng = random.Random(2)
    for n in (1, 2, 50, 300):
        s = [rng.randint(0, 2) for _ in range(n)] + [1] * 20
        order, levels = R.suffix_array(np.array(s))
        assert order.tolist() == sorted(range(len(s)), key=lambda k: s[k:])
        want = [0]
        for a, b in zip(order[:-1], order[1:]):
            k = 0
            while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            want.append(k)
        assert R.lcp_array(order, levels).tolist() == want


def cases():
    rng = random.Random(5)
    out = [(r[0], r[1]) for r in rows() if r[0] != 108]
    for i in range(200, 330):
        out.append((i, prose(i, rng.randint(1, 260))))
    out += [(400, "ha " * 50 + "\n\x0b" + "ho\tho " * 40), (401, "é 日本 " * 30), (402, "one two " * 30), (-7, "a b c " * 12 + prose(1, 60)), (0, None), (None, "do re " * 40)]
    return out


def test_query_columns_equal_brute_force(spark):
    data = cases()
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = R.digests(R.periodic_runs(R.planted(docs))).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(answer(*r)) for r in data)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in data)


def test_long_run_and_its_text(spark):
    text = "head " + "lala " * 30_000 + "tail"
    r = R.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r.runs] == [(1, 30_000, 1)] and r.collapsed == "head lala tail" and r.n_words == 30_002


def test_odd_tables(spark, docs, no_docs):
    assert R.digests(R.periodic_runs(R.planted(no_docs))).count() == 0
    extra = docs.withColumns({c: F.lit("x") for c in "words g n a p h runs collapsed best start length period n_runs".split()})
    key = lambda d: sorted(map(repr, R.digests(R.periodic_runs(R.planted(d))).collect()))
    assert key(extra) == key(docs) and len(key(docs)) == docs.count()
    with pytest.raises(ValueError):
        R.periodic_runs(docs, min_periods=1)


def test_query_at_smallest_size(spark):
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = Q.op11_periodic_runs(spark, sf).collect()
    assert len(got) == len(text)
    short = [r for r in got if len(text[r.doc_id] or "") < 4000]
    assert len(short) > 100
    for r in short:
        assert tuple(r) == answer(r.doc_id, text[r.doc_id])
