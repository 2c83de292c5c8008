"""Landed pages -> parsed captures: shapes, rejects, caps, time filter."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from streetscape.operators import captures as C
from streetscape.operators.aoi import named_box
from streetscape.sources.pages import scan_capture_pages

CAMDEN = named_box("camden")


def _rec(i, **kw):
    r = {
        "id": i,
        "computed_geometry": {"type": "Point", "coordinates": [-0.144, 51.541]},
        "captured_at": 1714564800000,
        "computed_compass_angle": 10.5,
        "camera_type": "perspective",
        "is_pano": False,
        "sequence": "s1",
        "creator": {"id": 5},
        "width": 2048,
        "height": 1536,
        "thumb_2048_url": f"https://x/{i}.jpg",
    }
    r.update(kw)
    return {k: v for k, v in r.items() if v is not ...}


def _write_pages(tmp_dir, pages):
    for n, recs in enumerate(pages):
        with open(f"{tmp_dir}/page-{n:04d}.json", "w") as f:
            json.dump({"data": recs, "paging": {"next": f"https://next/{n + 1}"}}, f, indent=1)


def test_parse_shapes_and_rejects(spark, tmp_dir):
    pages = [
        [
            _rec(1),
            _rec("2", sequence={"id": "s2"}, creator=..., creator_id=9),
            _rec(3, computed_geometry=...),
            _rec(4, captured_at=...),
            _rec(5, thumb_2048_url=""),
            _rec(6, is_pano=True),
            _rec(7, is_pano=..., sequence=..., creator={"username": "u"}),
        ],
        [_rec(..., camera_type="x"), _rec(9, width="abc"), _rec(10, computed_compass_angle=None, sequence=12)],
    ]
    _write_pages(tmp_dir, pages)
    recs = scan_capture_pages(spark, tmp_dir)
    parsed = {(r.page.rsplit("/", 1)[-1], r.pos): r for r in C.parse_captures(recs, is_pano=False).collect()}
    p0, p1 = "page-0000.json", "page-0001.json"
    r = parsed[(p0, 0)]
    assert (r.image_id, r.lon, r.lat, r.sequence_id, r.creator_id, r.reject_reason) == ("1", -0.144, 51.541, "s1", 5, None)
    assert parsed[(p0, 1)].sequence_id == "s2" and parsed[(p0, 1)].creator_id == 9 and parsed[(p0, 1)].image_id == "2"
    assert parsed[(p0, 2)].reject_reason == "no_coordinates"
    assert parsed[(p0, 3)].reject_reason == "no_captured_at"
    assert parsed[(p0, 4)].reject_reason == "no_url"
    assert parsed[(p0, 5)].reject_reason == "pano_mismatch"
    r7 = parsed[(p0, 6)]
    assert (r7.is_pano, r7.sequence_id, r7.creator_id, r7.reject_reason) == (False, None, None, None)
    assert parsed[(p1, 0)].reject_reason == "bad_record"
    assert parsed[(p1, 1)].reject_reason == "bad_record"
    r10 = parsed[(p1, 2)]
    assert r10.compass_angle is None and r10.sequence_id is None and r10.reject_reason is None
    kept = C.drop_incomplete(C.parse_captures(recs, is_pano=None))
    assert kept.count() == 5  # 1, 2, 6 (pano kept when no filter), 7, 10


def test_filter_pano_tristate(spark):
    df = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "image_id string, is_pano boolean")
    assert {r.image_id for r in C.filter_pano(df, False).collect()} == {"b", "c"}
    assert {r.image_id for r in C.filter_pano(df, True).collect()} == {"a"}
    assert C.filter_pano(df, None).count() == 3


def test_filter_captured_bounds(spark):
    df = spark.createDataFrame(
        [("a", datetime(2023, 4, 29, 23, 59, 59)), ("b", datetime(2023, 4, 30)), ("c", datetime(2023, 5, 2, 10))],
        "image_id string, captured_at timestamp_ntz",
    )
    assert {r.image_id for r in C.filter_captured(df, "2023-04-30").collect()} == {"b", "c"}
    assert {r.image_id for r in C.filter_captured(df, "2023-04-30T00:00:00Z", "2023-05-01").collect()} == {"b"}
    with pytest.warns(UserWarning, match="not a date"):
        assert C.filter_captured(df, "not a date").count() == 3  # an unparseable bound doesn't bind
    assert {r.image_id for r in C.filter_captured(df, "2023-04-30T02:00:00+02:00").collect()} == {"b", "c"}


def test_select_candidates_caps_before_and_after_recheck(spark):
    inside, outside = (-0.144, 51.541), (0.0, 0.0)
    rows = [(str(i), 0, i, *(outside if i in (1, 3) else inside)) for i in range(6)]
    df = spark.createDataFrame(rows, "image_id string, page int, pos int, lon double, lat double")
    got = [r.image_id for r in C.select_candidates(df, CAMDEN, max_images=4).orderBy("pos").collect()]
    assert got == ["0", "2"]  # first cap 4 -> 0..3, re-check drops 1 and 3
    allk = C.select_candidates(df, CAMDEN, max_images=0)
    assert allk.count() == 4
    dup = spark.createDataFrame([("x", 0, 0, *inside), ("x", 0, 1, *inside)], "image_id string, page int, pos int, lon double, lat double")
    assert C.select_candidates(dup, CAMDEN, 10, dedupe=True).count() == 1
    assert C.select_candidates(dup, CAMDEN, 10).count() == 2


def test_with_captured_at(spark):
    df = spark.createDataFrame([(0,), (951782399999,), (None,)], "captured_at_ms bigint")
    assert [r.captured_at for r in C.with_captured_at(df).collect()] == [datetime(1970, 1, 1), datetime(2000, 2, 28, 23, 59, 59, 999000), None]


@pytest.mark.parametrize("kind", ["int", "string"])
def test_cap_takes_the_first_rows_in_arrival_order(spark, monkeypatch, kind):
    """Pages of uneven size, one without a number; far more pages than bins; every limit."""
    import random

    monkeypatch.setattr(C, "CAP_BINS", 5)
    rng = random.Random(4)
    pages = [None, *(rng.sample(range(0, 10_000, 7), 60))]
    rows = [(None if p is None else str(p) if kind == "string" else p, k) for p in pages for k in range(rng.randint(1, 9))]
    rng.shuffle(rows)
    first = sorted(rows, key=lambda r: (r[0] is not None, "" if r[0] is None and kind == "string" else -1 if r[0] is None else r[0], r[1]))
    df = spark.createDataFrame(rows, f"page {kind}, pos int").repartition(3)
    for limit in (1, 3, 40, 123, len(rows) - 1, len(rows), len(rows) + 5):
        got = [(r.page, r.pos) for r in C.cap_candidates(df, limit).collect()]
        assert sorted(map(str, got)) == sorted(map(str, first[:limit]))
    assert C.cap_candidates(df, None).count() == C.cap_candidates(df, 0).count() == len(rows)


def test_landed_page_directories_keep_fetch_order(spark, tmp_dir):
    from streetscape.streaming.incremental import land_pages

    recs = spark.createDataFrame(
        [(p, i, json.dumps(_rec(f"{p}-{i}"))) for p in (10, 2, 1) for i in (1, 0)], "page int, pos int, record_text string"
    )
    land_pages(recs, f"{tmp_dir}/landed")
    parsed = C.parse_captures(scan_capture_pages(spark, f"{tmp_dir}/landed"))
    ids = [r.image_id for r in parsed.orderBy("page", "pos").collect()]
    assert ids == ["1-0", "1-1", "2-0", "2-1", "10-0", "10-1"]
