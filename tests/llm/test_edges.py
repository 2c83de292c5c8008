"""Every operator and stage on empty tables, on odd rows, and with extra columns whose names clash."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from streetscape.llm import chains, decontam, html, jaccard, langid, licenses, lines, lm, packing, quality

BY_ROW = {
    "quality": lambda d, b, x: quality.quality(d, x),
    "langid": lambda d, b, x: langid.language_id(d),
    "packing": lambda d, b, x: packing.pack(d),
    "decontam": lambda d, b, x: decontam.leaks(d, b),
    "lm": lambda d, b, x: lm.score(d),
    "jaccard": lambda d, b, x: jaccard.join_components(d),
    "lines": lambda d, b, x: lines.line_report(d),
    "chains": lambda d, b, x: chains.passages(d),
    "licenses": lambda d, b, x: licenses.scan(d),
}
ONE_ROW_EACH = ("quality", "langid", "lm", "jaccard", "lines", "licenses")
CLASHING = "score kept n_words held_out lang_pred class id key part first line th place n rid bytes kind trusted span label item_id component_id".split()


@pytest.mark.parametrize("name", BY_ROW)
def test_empty_tables(spark, no_docs, benchmark, labels, name):
    assert BY_ROW[name](no_docs, benchmark.limit(0), labels.limit(0)).count() == 0


@pytest.mark.parametrize("name", BY_ROW)
def test_odd_rows_and_clashing_columns(spark, docs, benchmark, labels, name):
    plain = [tuple(r) for r in BY_ROW[name](docs, benchmark, labels).collect()]
    if name in ONE_ROW_EACH:
        assert len(plain) == docs.count()
    extra = docs.withColumns({c: F.lit("x") for c in CLASHING} | {"__removed": F.lit(1)})
    more = [tuple(r) for r in BY_ROW[name](extra, benchmark.withColumns({"doc_id": F.lit(5), "key": F.lit("k")}), labels.withColumn("text", F.lit("t"))).collect()]
    assert sorted(map(repr, more)) == sorted(map(repr, plain))


@pytest.mark.parametrize("k", range(len(P.STAGES)))
def test_stages_keep_columns_and_survive(spark, docs, no_docs, benchmark, tmp_path, k):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    name, stage = P.STAGES[k]
    extra = docs.withColumns({c: F.lit("x") for c in ("score", "kept", "class", "id", "first")})
    out = stage(spark, extra, str(tmp_path))
    none = stage(spark, no_docs, str(tmp_path))
    assert none.count() == 0
    if k < len(P.STAGES) - 1:
        assert out.columns == extra.columns
        assert none.columns == no_docs.columns
        assert out.dtypes == extra.dtypes
    assert out.count() > 0


def test_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "", ""), (None, "http://a.b/c", "<p>x"), (3, "http://a.b/d", "<p>y</p>"), (3, "http://a.b/d", "<p>y</p>")], "page_id long, url string, html string")
    got = html.main_text(pages.withColumn("path", F.lit("p")).withColumn("host", F.lit("h"))).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "x", 1), (1, "", 0), (2, "", 0), (3, "y", 1), (3, "y", 1)]
    assert html.main_text(pages.limit(0)).count() == 0
