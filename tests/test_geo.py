"""WKB functions, GeoParquet writer and verifier."""

from __future__ import annotations

import json
import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from streetscape.functions.geo import geometry_type, point_wkb, point_x, point_y, wkb_to_wkt
from streetscape.sinks.geoparquet import crs_of, geo_metadata, verify_geo, write_geo


def test_point_wkb_bytes_and_decode(spark):
    df = spark.createDataFrame([(-0.144, 51.541), (1.5, -2.25), (None, 1.0)], "lon double, lat double")
    rows = df.select(point_wkb("lon", "lat").alias("g")).select("g", point_x("g").alias("x"), point_y("g").alias("y"), geometry_type("g").alias("t"), wkb_to_wkt("g").alias("w")).collect()
    assert bytes(rows[0].g) == struct.pack("<BIdd", 1, 1, -0.144, 51.541)
    assert (rows[1].x, rows[1].y, rows[1].t, rows[1].w) == (1.5, -2.25, "point", "POINT (1.5 -2.25)")
    assert rows[2].g is None and rows[2].t is None


def test_geometry_type_big_endian_and_polygon(spark):
    be_point = struct.pack(">BIdd", 0, 1, 3.0, 4.0)
    poly = struct.pack("<BII", 1, 3, 0)
    df = spark.createDataFrame([(be_point,), (poly,)], "g binary")
    rows = df.select(geometry_type("g").alias("t"), point_x("g").alias("x")).collect()
    assert rows[0].t == "point" and rows[0].x == 3.0
    assert rows[1].t == "polygon"


def _deliverable(spark, n=5000):
    return spark.range(n).select(
        F.col("id").cast("string").alias("image_id"),
        F.encode(F.lit("jpeg"), "UTF-8").alias("image_blob"),
        point_wkb((F.col("id") * 1e-6).cast("double"), F.lit(51.5)).alias("geom"),
    )


def test_write_and_verify_roundtrip(spark, tmp_dir):
    path = f"{tmp_dir}/out"
    write_geo(_deliverable(spark).repartition(3), path)
    v = verify_geo(spark, path)
    assert v == {"version": "2.0.0", "primary_column": "geom", "geo_types": ["point"], "n_rows": 5000, "n_columns": 3}
    files = [f for f in __import__("os").listdir(path) if f.endswith(".parquet")]
    assert len(files) == 3 and __import__("os").listdir(f"{path}/_staging") == []
    meta = pq.ParquetFile(f"{path}/{files[0]}")
    geo = json.loads(meta.metadata.metadata[b"geo"])
    assert geo["columns"]["geom"]["encoding"] == "WKB" and len(geo["columns"]["geom"]["bbox"]) == 4
    assert all(meta.metadata.row_group(i).num_rows <= 2048 for i in range(meta.num_row_groups))
    assert meta.metadata.row_group(0).column(0).compression == "ZSTD"
    assert geo["columns"]["geom"]["crs"]["id"] == {"authority": "OGC", "code": "CRS84"} and "Geometry" in str(meta.schema)
    assert {r.crs for r in crs_of(geo_metadata(spark, path)).collect()} == {"OGC:CRS84"}
    assert spark.read.schema("image_id string, image_blob binary, geom binary").parquet(path).count() == 5000


@pytest.mark.parametrize("version", ["V2", "V1", "NONE", "BOTH"])
@pytest.mark.parametrize("rows", [1, 2000, 2001, 5000])
def test_any_row_count_in_one_task(spark, tmp_dir, version, rows):
    path = f"{tmp_dir}/{version}-{rows}"
    write_geo(_deliverable(spark, rows).coalesce(1), path, version=version)
    back = spark.read.schema("image_id string, image_blob binary, geom binary").parquet(path)
    assert back.where(geometry_type("geom") == "point").count() == rows == back.select("image_id").distinct().count()
    (file,) = [f for f in __import__("os").listdir(path) if f.endswith(".parquet")]
    footer = pq.ParquetFile(f"{path}/{file}")
    told = footer.metadata.metadata.get(b"geo")
    assert (json.loads(told)["version"] if told else None) == {"V2": "2.0.0", "V1": "1.0.0", "NONE": None, "BOTH": "1.0.0"}[version]
    assert ("Geometry" in str(footer.schema)) == (version != "V1")


def test_empty_input_refused(spark, tmp_dir):
    with pytest.raises(RuntimeError):
        write_geo(_deliverable(spark).limit(0), f"{tmp_dir}/x")


def _plain(path, geo):
    t = pa.table({"image_id": ["1"], "geom": [struct.pack("<BIdd", 1, 1, 0.0, 0.0)]})
    if geo is not None:
        t = t.replace_schema_metadata({b"geo": json.dumps(geo).encode()})
    pq.write_table(t, path)


def test_verify_failures(spark, tmp_path):
    (tmp_path / "a").mkdir()
    _plain(str(tmp_path / "a" / "p.parquet"), None)
    with pytest.raises(AssertionError, match="no geo metadata"):
        verify_geo(spark, str(tmp_path / "a"))
    (tmp_path / "b").mkdir()
    _plain(str(tmp_path / "b" / "p.parquet"), {"version": "1.1.0", "primary_column": "geom", "columns": {"geom": {"encoding": "WKB", "geometry_types": ["Point"]}}})
    with pytest.raises(AssertionError, match="version"):
        verify_geo(spark, str(tmp_path / "b"))
    (tmp_path / "c").mkdir()
    _plain(str(tmp_path / "c" / "p.parquet"), {"version": "2.0.0", "primary_column": "geom", "columns": {"geom": {"encoding": "WKB", "geometry_types": ["Polygon"]}}})
    with pytest.raises(AssertionError, match="point"):
        verify_geo(spark, str(tmp_path / "c"))
    (tmp_path / "d").mkdir()
    _plain(str(tmp_path / "d" / "p.parquet"), {"version": "2.0.0", "primary_column": "geom", "columns": {"geom": {"encoding": "WKB", "geometry_types": []}}})
    assert verify_geo(spark, str(tmp_path / "d"))["geo_types"] == ["point"]


def test_native_geometry_logical_type(spark, tmp_dir):
    from streetscape.sources.stores import scan_deliverable

    path = f"{tmp_dir}/native"
    df = _deliverable(spark, 100).select(
        "image_id", "image_blob", F.lit("image/jpeg").alias("image_mime"), F.lit(None).cast("timestamp_ntz").alias("captured_at"),
        F.lit(1.0).alias("compass_angle"), F.lit("p").alias("camera_type"), "geom",
        F.array(F.lit(1.0).cast("float")).alias("brain_activity"),
        F.array(F.struct(F.lit("V1").alias("name"), F.lit(1.0).cast("float").alias("score"))).alias("top_regions"),
    ).coalesce(1)
    write_geo(df, path, geometry_encoding="native")
    f = [x for x in __import__("os").listdir(path) if x.endswith(".parquet")][0]
    assert "Geometry" in str(pq.ParquetFile(f"{path}/{f}").schema)
    back = scan_deliverable(spark, path)
    assert back.count() == 100 and back.select(geometry_type("geom").alias("t")).distinct().first().t == "point"
    assert verify_geo(spark, path)["n_columns"] == 9


@pytest.mark.parametrize("version,geo,native", [("V1", "1.0.0", False), ("NONE", None, True), ("BOTH", "1.0.0", True)])
def test_writer_versions(spark, tmp_dir, version, geo, native):
    path = f"{tmp_dir}/{version}"
    write_geo(_deliverable(spark, 50).coalesce(1), path, version=version)
    f = [x for x in __import__("os").listdir(path) if x.endswith(".parquet")][0]
    pf = pq.ParquetFile(f"{path}/{f}")
    kv = pf.metadata.metadata or {}
    assert (json.loads(kv[b"geo"])["version"] if b"geo" in kv else None) == geo
    assert ("Geometry" in str(pf.schema)) == native
    with pytest.raises(AssertionError):
        verify_geo(spark, path)
    with pytest.raises(ValueError):
        write_geo(_deliverable(spark, 5), f"{tmp_dir}/bad", version="V9")


def _file(path, types, blob, primary="geom"):
    geo = {"version": "2.0.0", "primary_column": primary, "columns": {primary: {"encoding": "WKB", "geometry_types": types}}}
    pq.write_table(pa.table({"image_id": ["1"], primary: [blob]}).replace_schema_metadata({b"geo": json.dumps(geo).encode()}), path)


def test_every_file_is_verified_by_itself(spark, tmp_path):
    point, polygon = struct.pack("<BIdd", 1, 1, 0.0, 0.0), struct.pack("<BII", 1, 3, 0)
    (tmp_path / "mixed").mkdir()
    _file(str(tmp_path / "mixed" / "a.parquet"), ["Point"], point)
    _file(str(tmp_path / "mixed" / "b.parquet"), [], polygon)
    with pytest.raises(AssertionError, match="polygon"):
        verify_geo(spark, str(tmp_path / "mixed"))
    (tmp_path / "primary").mkdir()
    _file(str(tmp_path / "primary" / "a.parquet"), ["Point"], point)
    _file(str(tmp_path / "primary" / "b.parquet"), ["Point"], point, "shape")
    with pytest.raises(AssertionError, match="disagree"):
        verify_geo(spark, str(tmp_path / "primary"))


def test_overwrite_leaves_other_jobs_staging_alone(spark, tmp_dir):
    import os

    path = f"{tmp_dir}/out"
    write_geo(_deliverable(spark, 30).coalesce(1), path)
    other = f"{path}/_staging/other-job"
    os.makedirs(other)
    open(f"{other}/part.tmp", "w").close()
    write_geo(_deliverable(spark, 40).repartition(2), path)
    assert os.listdir(f"{path}/_staging") == ["other-job"] and os.listdir(other) == ["part.tmp"]
    assert verify_geo(spark, path)["n_rows"] == 40
