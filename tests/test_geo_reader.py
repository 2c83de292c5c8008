"""The GeoParquet reader: both encodings, pushed bounds, files left closed."""

from __future__ import annotations

import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, LessThanOrEqual

from streetscape.functions.geo import point_wkb
from streetscape.sinks.geoparquet import write_geo
from streetscape.sources.geoparquet import GeoReader, read_geo, schema_of


def _table(spark, n=400):
    i = F.col("id")
    point = F.when(i % 50 != 7, point_wkb((i * 0.01).cast("double"), (F.lit(50.0) + i * 0.001).cast("double")))
    return spark.range(n).select(i.cast("string").alias("image_id"), F.encode(F.lit("blob"), "UTF-8").alias("image_blob"), F.timestamp_seconds(i).cast("timestamp_ntz").alias("captured_at"), point.alias("geom"), F.array(i.cast("float")).alias("v"))


def _in(w, s, e, n):
    return Row(west=w, south=s, east=e, north=n)


@pytest.fixture(scope="module", params=["V2", "V1", "NONE", "BOTH"])
def written(spark, request, tmp_path_factory):
    path = str(tmp_path_factory.mktemp(request.param) / "out")
    write_geo(_table(spark).repartitionByRange(8, F.col("image_id").cast("int")), path, version=request.param)
    return request.param, path


def test_rows_and_schema(spark, written):
    _, path = written
    got = read_geo(spark, path)
    assert got.columns == ["image_id", "image_blob", "captured_at", "geom", "v", "geom_x", "geom_y"]
    assert dict(got.dtypes)["geom"] == "binary" and dict(got.dtypes)["captured_at"] == "timestamp_ntz"
    want = {r.image_id: tuple(r) for r in _table(spark).collect()}
    rows = got.collect()
    assert {r.image_id: tuple(r)[:5] for r in rows} == want and len(rows) == 400
    assert all((r.geom_x is None) == (r.geom is None) and (r.geom is None or r.geom_x == int(r.image_id) * 0.01) for r in rows)


def test_box_scan_equals_full_scan_and_prunes(spark, written):
    version, path = written
    box = _in(0.5, 50.0, 0.8, 50.075)
    got = sorted(r.image_id for r in read_geo(spark, path, box, ["image_id"]).collect())
    every = read_geo(spark, path).collect()
    assert got == sorted(r.image_id for r in every if r.geom_x is not None and 0.5 <= r.geom_x <= 0.8 and 50.0 <= r.geom_y <= 50.075) and got

    reader = GeoReader({"path": path}, schema_of(path, "geom"))
    filters = [GreaterThan(("geom_x",), 0.5), LessThanOrEqual(("geom_x",), 0.8), EqualTo(("image_id",), "5")]
    assert list(reader.pushFilters(filters)) == filters and reader.low["geom_x"] == 0.5
    opened = []
    reader._rows = lambda file: opened.append(file) or iter(())
    parts = reader.partitions()
    assert len(parts) == 1 and len(parts[0].paths) == 8
    for p in parts:
        list(reader.read(p))
    assert len(opened) == (8 if version == "NONE" else 1)  # without a footer box a file must be read


def test_filters_reach_the_reader(spark, written):
    _, path = written
    plan = read_geo(spark, path, _in(0.5, 50.0, 0.8, 50.1))._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan or "geoparquet" in plan.lower()
    assert read_geo(spark, path).where("geom_x = 0.5").select("image_id").collect()[0].image_id == "50"
    assert read_geo(spark, path).where("geom_x > 3.98 or image_id = '1'").count() == 2
    assert read_geo(spark, path).where("geom_x is null").count() == 8


def test_drifted_and_broken_inputs(spark, tmp_path):
    with pytest.raises(Exception, match="no parquet file"):
        read_geo(spark, str(tmp_path / "none")).count()
    point = struct.pack(">BIdd", 0, 1, 3.0, 4.0)
    line = struct.pack("<BII", 1, 2, 1) + struct.pack("<dd", 3.0, 4.0)
    (tmp_path / "t").mkdir()
    pq.write_table(pa.table({"image_id": ["a", "b"], "geom": [point, line[:9]]}), str(tmp_path / "t" / "a.parquet"))
    pq.write_table(pa.table({"geom": pa.array([None], pa.binary())}), str(tmp_path / "t" / "b.parquet"))  # lacks a column
    rows = read_geo(spark, str(tmp_path / "t")).collect()
    assert sorted((r.image_id or "", r.geom_x, r.geom_y) for r in rows if r.image_id == "a") == [("a", 3.0, 4.0)]
    assert len(rows) == 3 and sum(r.image_id is None for r in rows) == 1
