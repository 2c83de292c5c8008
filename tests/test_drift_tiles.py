"""Shards with drifted columns, and tiles by content."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import types as T

from streetscape.operators.aoi import tiles_by_content
from streetscape.sources.drift import scan_drifted, shard_groups, widens

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("image_id", T.StringType()), ("n", T.LongType()), ("lon", T.DoubleType()), ("v", T.ArrayType(T.DoubleType())))])


def test_missing_extra_widened_reordered_and_misfitting_columns(spark, tmp_path):
    def land(name, **columns):
        pq.write_table(pa.table(columns), str(tmp_path / f"{name}.parquet"))

    land("a", image_id=["1"], n=pa.array([5], pa.int64()), lon=[0.5], v=pa.array([[1.0]], pa.list_(pa.float64())))
    land("b", lon=pa.array([1.5], pa.float32()), n=pa.array([7], pa.int32()), image_id=["2"])  # reordered, widened, without v
    land("c", image_id=["3", "4"], n=["8", "many"], extra=[True, None], lon=[2.0, None])  # text in n, a column more
    land("d", image_id=["5"], v=[["x"]], lon=pa.array([9], pa.int64()))  # a list of text, a long where a double is
    land("e", image_id=["6"], n=pa.array([9], pa.int64()), lon=[0.25], v=pa.array([[2.0]], pa.list_(pa.float64())))
    assert sorted(map(len, shard_groups(spark, str(tmp_path)))) == [1, 1, 1, 2]
    got = {r.image_id: r for r in scan_drifted(spark, str(tmp_path), SCHEMA).selectExpr("*", "to_json(drift) AS j").collect()}
    assert {k: (r.n, r.lon, r.v) for k, r in got.items()} == {"1": (5, 0.5, [1.0]), "2": (7, 1.5, None), "3": (8, 2.0, None), "4": (None, None, None), "5": (None, 9.0, None), "6": (9, 0.25, [2.0])}
    assert got["1"].j is None and got["2"].j is None and got["6"].source_file == "e.parquet"
    assert '"extra":true' in got["3"].j and '"n":"many"' in got["4"].j and '"v":["x"]' in got["5"].j


def test_what_widens():
    i, l, f, d = T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()
    assert widens(i, l) and widens(f, d) and widens(i, d) and widens(T.DateType(), T.TimestampNTZType()) and widens(T.DecimalType(5, 2), T.DecimalType(9, 3))
    assert not widens(l, i) and not widens(l, d) and not widens(d, f) and not widens(T.StringType(), l) and not widens(T.DecimalType(9, 3), T.DecimalType(9, 4))
    assert widens(T.ArrayType(f), T.ArrayType(d))


def _split(points, box, limit, area, top, level=0, col=0, row=0):
    """The quadtree by recursion over the points."""
    w, s, e, n = box
    side = 2**level
    x0, y0 = w + col * ((e - w) / side), s + row * ((n - s) / side)
    inside = [p for p in points if p[0] >> (top - level) == col and p[1] >> (top - level) == row]
    if level < top and ((e - w) * (n - s) / 4**level > area or len(inside) > limit):
        return [t for c in (0, 1) for r in (0, 1) for t in _split(inside, box, limit, area, top, level + 1, 2 * col + c, 2 * row + r)]
    return [(level, col, row, len(inside), len(inside) > limit, round(x0, 9), round(y0, 9))]


def test_tiles_keep_both_limits_and_cover_the_box(spark):
    rng = random.Random(6)
    at = [(rng.gauss(0.3, 0.05), rng.gauss(0.6, 0.1)) for _ in range(900)] + [(0.75, 0.75)] * 40 + [(0.0, 0.0), (1.0, 1.0), (0.5, 0.5), (2.0, 2.0), (None, 0.5)]
    points = spark.createDataFrame(at, "lon double, lat double")
    boxes = {"unit": (0.0, 0.0, 1.0, 1.0), "part": (0.2, 0.5, 0.45, 0.7), "empty": (5.0, 5.0, 5.5, 6.0)}
    aois = spark.createDataFrame([(k, *b) for k, b in boxes.items()], "aoi string, west double, south double, east double, north double")
    for limit, area, top in ((25, 0.3, 7), (1000, 0.01, 5), (5, 9.0, 4)):
        tiles = tiles_by_content(points, aois, limit, area, top).collect()
        for k, (w, s, e, n) in boxes.items():
            cell = lambda v, a, b: min(int((v - a) / (b - a) * 2**top), 2**top - 1)
            mine = [(cell(x, w, e), cell(y, s, n)) for x, y in at if x is not None and w <= x <= e and s <= y <= n]
            got = sorted((t.level, t.col, t.row, t.n_points, t.over, round(t.west, 9), round(t.south, 9)) for t in tiles if t.aoi == k)
            assert got == sorted(_split(mine, (w, s, e, n), limit, area, top))
            own = [t for t in tiles if t.aoi == k]
            assert abs(sum((t.east - t.west) * (t.north - t.south) for t in own) - (e - w) * (n - s)) < 1e-9 and sum(t.n_points for t in own) == len(mine)
