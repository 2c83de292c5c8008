"""Shards clustered in space: keys, manifest, and scans that open what meets a box."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetscape.operators.aoi import within_bbox
from streetscape.operators import spatial as P

SCHEMA = T.StructType([T.StructField("image_id", T.StringType()), T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])


def _key(lon, lat):
    x = min(max(math.floor((lon + 180) / 360 * 65536), 0), 65535)
    y = min(max(math.floor((lat + 90) / 180 * 65536), 0), 65535)
    return sum(((x >> b & 1) << 2 * b) | ((y >> b & 1) << 2 * b + 1) for b in range(16))


def test_morton_key(spark):
    rng = random.Random(1)
    at = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(200)] + [(-180.0, -90.0), (180.0, 90.0), (0.0, 0.0), (500.0, -500.0)]
    got = spark.createDataFrame(at, "lon double, lat double").select("lon", "lat", P.morton("lon", "lat").alias("k")).collect()
    assert all(r.k == _key(r.lon, r.lat) for r in got) and len(got) == len(at)
    assert spark.createDataFrame([(None, 1.0)], "lon double, lat double").select(P.morton("lon", "lat").alias("k")).first().k is None


def _points(spark, n, seed, west=-0.2, east=-0.1):
    rng = random.Random(seed)
    rows = [(f"{seed}-{i}", rng.uniform(west, east), rng.uniform(51.5, 51.6)) for i in range(n)]
    return spark.createDataFrame([*rows, (f"{seed}-none", None, 51.55), (f"{seed}-nan", float("nan"), 51.55)], SCHEMA)


def _box(w, s, e, n):
    return Row(west=w, south=s, east=e, north=n)


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "points")
    assert P.append_clustered(_points(spark, 4000, 1), path, shards=16) == 16
    P.append_clustered(_points(spark, 500, 2, 0.1, 0.2), path, shards=4)
    return path


def _scan(spark, store, box):
    full = spark.read.schema(SCHEMA).parquet(store)
    got, want = (sorted(r.image_id for r in df.collect()) for df in (P.scan_box(spark, store, box, SCHEMA), within_bbox(full, box)))
    assert got == want
    return got


def test_scan_opens_only_shards_that_meet_the_box(spark, store):
    box = _box(-0.14, 51.52, -0.13, 51.53)
    files = P.shards_meeting(spark, store, box)
    assert 0 < len(files) <= 6 and len(P._names(spark, store)) >= 19
    assert sorted(f.rsplit("/", 1)[-1] for f in P.scan_box(spark, store, box, SCHEMA).inputFiles()) == files
    assert _scan(spark, store, box)
    assert len(_scan(spark, store, _box(-1, 51, 1, 52))) == 4500
    assert _scan(spark, store, _box(5, 5, 6, 6)) == [] and P.shards_meeting(spark, store, _box(5, 5, 6, 6)) == []
    edge = spark.read.schema(SCHEMA).parquet(store).where("lon is not null and not isnan(lon)").first()
    assert edge.image_id in _scan(spark, store, _box(edge.lon, edge.lat, edge.lon, edge.lat))


def test_shards_of_a_run_that_died_are_still_read(spark, store):
    _points(spark, 50, 3).coalesce(1).write.mode("append").parquet(store)  # shards without a manifest row
    box = _box(-0.14, 51.52, -0.13, 51.53)
    before = P.shards_meeting(spark, store, box)
    _scan(spark, store, box)
    assert len(_scan(spark, store, _box(-1, 51, 1, 52))) == 4550
    assert P.complete_manifest(spark, store) == 1 and P.complete_manifest(spark, store) == 0
    assert len(P.shards_meeting(spark, store, _box(0.11, 51.5, 0.2, 51.6))) <= len(before) + 4
    assert P.manifest(spark, store).agg(F.sum("n_rows"), F.sum("unplaced")).first()[:] == (4556, 6)


def test_one_place_is_shared_by_many_shards(spark, tmp_path):
    path = str(tmp_path / "hot")
    hot = spark.range(4000).select(F.col("id").cast("string").alias("image_id"), F.lit(-0.14).alias("lon"), F.lit(51.54).alias("lat"))
    P.append_clustered(hot, path, shards=8)
    sizes = [r.n_rows for r in P.manifest(spark, path).collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_empty_input(spark, tmp_path):
    path = str(tmp_path / "none")
    P.append_clustered(spark.createDataFrame([], SCHEMA), path)
    assert P.scan_box(spark, path, _box(-1, -1, 1, 1), SCHEMA).count() == 0
    assert P.scan_box(spark, str(tmp_path / "missing"), _box(-1, -1, 1, 1), SCHEMA).count() == 0
