"""Image store: landing, id joins, latest row, working set, audit."""

from __future__ import annotations

import hashlib
from datetime import datetime, timedelta

import pytest

from streetscape.operators import store as ST
from streetscape.operators.aoi import bbox_text, box, named_box
from streetscape.schemas import IMAGE_COLUMNS, IMAGE_SCHEMA
from streetscape.sinks.stores import append_images, init_store
from streetscape.sources.stores import scan_image_store

CAMDEN = named_box("camden")
DAY = datetime(2021, 11, 5)


def _row(image_id, blob=b"pixels", downloaded=DAY, sha="none", **other):
    """One store row; columns that a test doesn't name are empty."""
    given = {"image_id": image_id, "image_blob": blob, "image_sha256": sha, "image_bytes": len(blob or b""), "downloaded_at": downloaded, "source": "test"}
    return tuple((given | other).get(c) for c in IMAGE_COLUMNS)


def _cands(spark, ids):
    return spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "image_id string, ord int")


@pytest.fixture
def store_of(spark, tmp_dir):
    """A store with one shard for each list of rows."""

    def make(*shards):
        path = f"{tmp_dir}/images"
        init_store(spark, path)
        for rows in shards:
            append_images(spark.createDataFrame(rows, IMAGE_SCHEMA).coalesce(1), path)
        return scan_image_store(spark, path)

    return make


def test_a_store_begins_empty_and_is_made_once(spark, tmp_dir):
    assert scan_image_store(spark, f"{tmp_dir}/absent").count() == 0
    made = [init_store(spark, f"{tmp_dir}/new") for _ in range(3)]
    assert made == [True, False, False]
    empty = scan_image_store(spark, f"{tmp_dir}/new")
    assert empty.count() == 0 and set(IMAGE_COLUMNS) <= set(empty.columns)
    assert ST.cached_images(_cands(spark, ["k"]), empty).count() == 0
    assert ST.new_images(_cands(spark, ["k", "l"]), empty).count() == 2


def test_stats_over_shards(store_of):
    taken = datetime(2019, 2, 3, 4, 5, 6)
    s = ST.store_stats(store_of([_row("p", b"12345", captured_at=taken), _row("q", b"123", captured_at=taken + timedelta(days=40))], [_row("p", b"1")], [_row("r", None)])).first()
    assert (s.n_rows, s.n_shards, s.total_bytes) == (4, 3, 9)
    assert (s.oldest_captured_at, s.newest_captured_at) == (taken, taken + timedelta(days=40))


def test_ids_of_the_store_decide_what_is_new(spark, store_of):
    store = store_of([_row("p"), _row("q")], [_row("p")])
    assert sorted(r.image_id for r in ST.store_ids(store).collect()) == ["p", "q"]
    cands = _cands(spark, ["z", "q", "y", "p", "z"])
    assert [(r.image_id, r.ord) for r in ST.new_images(cands, store).orderBy("ord").collect()] == [("z", 0), ("y", 2), ("z", 4)]
    assert sorted(r.image_id for r in ST.cached_images(cands, store).collect()) == ["p", "q"]


def test_placeholder_rows_are_no_images(store_of):
    store = store_of([_row("__sentinel__", None)], [_row("p"), _row("__sentinel__", None)])
    assert [r.image_id for r in store.collect()] == ["p"]
    assert ST.store_stats(store).first().n_rows == 1


def test_store_rows_from_captures_and_blobs(spark):
    ms = 1_234_567_890_123
    caps = spark.createDataFrame(
        [("n1", 5.5, -12.25, None, ms, "fisheye", True, None, 3, 10, 20, "u"), ("n2", 6.0, 1.0, 2.0, 0, None, None, "s", None, None, None, "u"), ("n3", 0.0, 0.0, 0.0, 0, None, None, None, None, None, None, "u")],
        "image_id string, lon double, lat double, compass_angle double, captured_at_ms bigint, camera_type string, is_pano boolean, sequence_id string, creator_id bigint, width int, height int, thumb_2048_url string",
    )
    blobs = spark.createDataFrame([("n1", b""), ("n2", "ü".encode()), ("other", b"x")], "image_id string, image_blob binary")
    around = box(-1.0, -2.0, 3.0, 4.5)
    rows = {r.image_id: r for r in ST.build_image_rows(caps, blobs, bbox_text(around)).collect()}
    assert sorted(rows) == ["n1", "n2"]
    for k, blob in (("n1", b""), ("n2", b"\xc3\xbc")):
        assert (rows[k].image_bytes, rows[k].image_sha256) == (len(blob), hashlib.sha256(blob).hexdigest())
    assert rows["n1"].captured_at == datetime(2009, 2, 13, 23, 31, 30, 123000) and rows["n2"].captured_at == datetime(1970, 1, 1)
    assert rows["n1"].is_pano is True and rows["n2"].is_pano is None and rows["n2"].image_width is None
    assert {r.mapillary_bbox_query for r in rows.values()} == {"-1.000000,-2.000000,3.000000,4.500000"}


def test_newest_row_counts_even_without_a_blob(spark, store_of):
    later = DAY + timedelta(hours=1)
    store = store_of([_row("p", b"first", DAY, "p1"), _row("q", b"had one", DAY, "q1")], [_row("p", b"second", later, "p2"), _row("q", None, later, "q2")])
    assert {r.image_id: r.image_sha256 for r in ST.latest_rows(store).collect()} == {"p": "p2", "q": "q2"}
    ws = {r.image_id: (r.drop_reason, r.image_blob and bytes(r.image_blob)) for r in ST.working_set(_cands(spark, ["q", "p", "x"]), store).collect()}
    assert ws == {"p": (None, b"second"), "q": ("null_blob", None), "x": ("not_in_cache", None)}
    index = ST.store_index(store)
    assert index.count() == 2 and "image_blob" not in index.columns


def test_latest_tie_broken_by_file_then_row(spark):
    rows = [("x", datetime(2024, 1, 1), "a.parquet", 5, "first"), ("x", datetime(2024, 1, 1), "b.parquet", 0, "second"), ("x", datetime(2024, 1, 1), "b.parquet", 3, "third")]
    df = spark.createDataFrame(rows, "image_id string, downloaded_at timestamp_ntz, source_file string, row_index bigint, tag string")
    assert ST.latest_rows(df).first().tag == "third"


def test_store_file_lacking_a_column(spark, tmp_dir):
    path = f"{tmp_dir}/images"
    narrow = spark.createDataFrame([_row("9")], IMAGE_SCHEMA).drop("image_width", "creator_id")
    narrow.write.parquet(path)
    r = scan_image_store(spark, path).first()
    assert r.image_id == "9" and r.image_width is None and r.creator_id is None


def test_duplicate_candidates_both_kept_without_dedupe(spark, tmp_dir):
    path = f"{tmp_dir}/images"
    init_store(spark, path)
    new = ST.new_images(_cands(spark, ["a", "a", "b"]), scan_image_store(spark, path))
    assert sorted(r.image_id for r in new.collect()) == ["a", "a", "b"]


def test_audit_drops(spark, tmp_dir):
    path = f"{tmp_dir}/images"
    append_images(spark.createDataFrame([_row("in"), _row("nb", None)], IMAGE_SCHEMA), path)
    raw = spark.createDataFrame(
        [("in", -0.144, 51.541), ("nb", -0.144, 51.541), ("miss", -0.144, 51.541), ("far", 0.0, 0.0), ("nul", None, 51.541)],
        "image_id string, lon double, lat double",
    )
    got = {r.image_id: r.drop_reason for r in ST.audit_drops(raw, CAMDEN, scan_image_store(spark, path)).collect()}
    assert got == {"nb": "null_blob", "miss": "not_in_cache", "far": "out_of_bbox", "nul": "out_of_bbox"}


def test_id_joins_read_no_blob(spark, store_of):
    store = store_of([_row("1")])
    for df in (ST.new_images(_cands(spark, ["1", "2"]), store), ST.cached_images(_cands(spark, ["1", "2"]), store)):
        schemas = [x.split(">")[0] for x in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1:]]
        assert schemas and all("image_id" in x and "image_blob" not in x for x in schemas)


def test_anti_semi_join_large_candidate_path(spark, tmp_dir):
    path = f"{tmp_dir}/images"
    append_images(spark.createDataFrame([_row("1"), _row("2")], IMAGE_SCHEMA), path)
    store = scan_image_store(spark, path)
    cands = _cands(spark, ["1", "3", "3"])
    assert sorted(r.image_id for r in ST.new_images(cands, store, broadcast_bytes=0).collect()) == ["3", "3"]
    assert [r.image_id for r in ST.cached_images(cands, store, broadcast_bytes=0).collect()] == ["1"]
    ws = {r.image_id: r.drop_reason for r in ST.working_set(cands, store, broadcast_bytes=0).collect()}
    assert ws == {"1": None, "3": "not_in_cache"}


def test_null_downloaded_at_still_wins(spark, tmp_dir):
    path = f"{tmp_dir}/images"
    append_images(spark.createDataFrame([_row("n", b"blob", None, "s-null")], IMAGE_SCHEMA), path)
    store = scan_image_store(spark, path)
    assert [r.image_sha256 for r in ST.latest_rows(store).collect()] == ["s-null"]
    ws = ST.working_set(_cands(spark, ["n"]), store, broadcast_bytes=0).first()
    assert ws.drop_reason is None and ws.image_sha256 == "s-null"


def test_working_set_large_path_moves_blobs_once(spark, tmp_dir):
    path = f"{tmp_dir}/images"
    append_images(spark.createDataFrame([_row(str(i), b"x" * 10) for i in range(20)], IMAGE_SCHEMA), path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = ST.working_set(_cands(spark, [str(i) for i in range(25)]), scan_image_store(spark, path), broadcast_bytes=0)
        plan = df._jdf.queryExecution().executedPlan().toString()
        blob_exchanges = [ln for ln in plan.splitlines() if "Exchange" in ln and "image_blob" in ln]
        assert len(blob_exchanges) <= 1
        assert df.filter("drop_reason is null").count() == 20
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_append_scores_without_rows_writes_no_file(spark, tmp_dir):
    import os

    from streetscape.schemas import SCORE_SCHEMA
    from streetscape.sinks.stores import append_scores
    from streetscape.sources.stores import scan_score_store

    path = f"{tmp_dir}/scores"
    append_scores(spark.createDataFrame([], SCORE_SCHEMA), path)
    assert not os.path.exists(path)
    row = ("a", [1.0, 2.0], [("V1", 0.5)], datetime(2024, 1, 1), "m")
    append_scores(spark.createDataFrame([row], SCORE_SCHEMA), path)
    append_scores(spark.createDataFrame([row], SCORE_SCHEMA), path)
    assert scan_score_store(spark, path).count() == 2  # appends never overwrite (H7)
