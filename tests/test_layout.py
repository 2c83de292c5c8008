"""Stores bucketed by id: where rows lie, what a join moves and what a filter opens."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from streetscape.operators import store as ST
from streetscape.schemas import IMAGE_COLUMNS, IMAGE_SCHEMA, SCORE_SCHEMA
from streetscape.sinks.stores import append_images, append_scores, init_store
from streetscape.sources.layout import buckets_of, cached_in, ids_in, init_bucketed, new_in
from streetscape.sources.stores import scan_image_store, scan_score_store


def _image(i, at=datetime(2024, 1, 1)):
    row = dict.fromkeys(IMAGE_COLUMNS) | dict(image_id=f"id-{i}", image_blob=b"\xff\xd8" * 40, image_sha256=f"s{i}", image_bytes=80, downloaded_at=at, lon=0.0, lat=0.0)
    return tuple(row[c] for c in IMAGE_COLUMNS)


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "images")
    assert init_store(spark, path, "images", buckets=8) and not init_store(spark, path, "images", buckets=8)
    append_images(spark.createDataFrame([_image(i) for i in range(300)], IMAGE_SCHEMA), path)
    append_images(spark.createDataFrame([_image(i, datetime(2024, 2, 1)) for i in range(250, 400)], IMAGE_SCHEMA), path)
    return path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_lie_in_their_buckets(spark, store):
    assert buckets_of(spark, store) == 8
    rows = scan_image_store(spark, store).select("image_id", "source_file", F.expr("pmod(hash(image_id), 8)").alias("bucket")).collect()
    assert len(rows) == 450 and len({r.image_id for r in rows}) == 400
    assert all(int(re.search(r"_(\d{5})\.c\d+", r.source_file)[1]) == r.bucket for r in rows)
    assert spark.read.schema(IMAGE_SCHEMA).parquet(store).count() == 450  # plain readers see the same rows


def test_joins_leave_the_store_where_it_is(static_plans, store):
    spark = static_plans
    scan = scan_image_store(spark, store)
    many = spark.range(1000).select(F.concat(F.lit("id-"), F.col("id")).alias("image_id"), F.lit(1).alias("x"))
    for df, n in ((new_in(many, scan, 8), 600), (cached_in(many, scan, 8), 400)):
        plan = _plan(df)
        left, right = plan.index("Range"), plan.index("FileScan parquet")
        assert plan.count("Exchange") == 1 and left < right and "Exchange" not in plan[plan.index("\n", left) : right], plan
        assert "Bucketed: true" in plan and df.count() == n
    # latest row of each id, payload attached: aggregate and join by bucket, nothing moves
    latest = ST.latest_rows(scan)
    assert "Exchange" not in _plan(latest)
    assert {r.image_id: r.downloaded_at.month for r in latest.collect()}["id-299"] == 2 and latest.count() == 400


def test_few_candidates_open_their_buckets_only(static_plans, store):
    spark = static_plans
    scan = scan_image_store(spark, store)
    few = spark.createDataFrame([("id-3",), ("id-299",), ("none",), (None,)], "image_id string")
    expect = spark.createDataFrame([("id-3",), ("id-299",), ("none",)], "image_id string").select(F.expr("pmod(hash(image_id), 8)")).distinct().count()
    assert f"SelectedBucketsCount: {expect} out of 8" in _plan(new_in(few, scan, 8))
    # alone, the scan opens the files of those buckets and no other
    opened = ids_in(few, scan.drop("source_file"), 8).select(F.input_file_name().alias("f")).distinct()
    assert opened.count() <= 2 * expect  # a file of each append
    assert sorted(r.image_id or "" for r in new_in(few, scan, 8).collect()) == ["", "none"]
    assert sorted(r.image_id for r in cached_in(few, scan, 8).collect()) == ["id-299", "id-3"]


def test_hot_id_and_other_stores(spark, tmp_path):
    path = str(tmp_path / "scores")
    init_store(spark, path, "scores", buckets=4)
    append_scores(spark.createDataFrame([], SCORE_SCHEMA), path)
    assert scan_score_store(spark, path).count() == 0
    rows = [("hot" if i % 3 == 0 else f"id-{i}", [0.5], [("V1", 0.5)], datetime(2024, 1, 1), "m") for i in range(90)]
    append_scores(spark.createDataFrame(rows, SCORE_SCHEMA), path)
    assert scan_score_store(spark, path).where("image_id = 'hot'").count() == 30 and scan_score_store(spark, path).count() == 90


def test_plain_shards_are_not_taken_for_buckets(spark, tmp_path):
    path = str(tmp_path / "plain")
    init_store(spark, path, "images")
    append_images(spark.createDataFrame([_image(1)], IMAGE_SCHEMA), path)
    assert buckets_of(spark, path) is None and scan_image_store(spark, path).count() == 1
    with pytest.raises(ValueError, match="without buckets"):
        init_bucketed(spark, path)
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "_layout.json").write_text('{"clustered_by": "lon"}')
    with pytest.raises(ValueError, match="layout"):
        buckets_of(spark, str(tmp_path / "odd"))
