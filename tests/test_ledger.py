"""Epochs published once, rejects kept, and dedup by the stream's own state."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from streetscape.operators import atlas as AT
from streetscape.operators import scoring as M
from streetscape.operators.aoi import named_box
from streetscape.sinks.stores import init_store
from streetscape.sources.layout import buckets_of
from streetscape.sources.stores import scan_image_store, scan_score_store
from streetscape.streaming.incremental import retry_rejected, score_epochs, stream_score
from streetscape.streaming.ledger import EpochLedger, query_key, scan_rejects
from streetscape.streaming.stateful import FirstArrival, stream_ingest_stateful

CAMDEN = named_box("camden")


def _rows(spark, n=20):
    return spark.range(n).select(F.col("id").cast("string").alias("image_id"), F.lit(1.5).alias("v"))


def test_an_epoch_is_published_once(spark, tmp_path):
    target, ledger = str(tmp_path / "t"), EpochLedger(spark, str(tmp_path / "l"), "q")
    assert ledger.publish(_rows(spark), target, 0) and not ledger.publish(_rows(spark), target, 0)
    assert ledger.publish(_rows(spark), target, 1) and ledger.publish(_rows(spark, 3), target, 1, "other")
    assert EpochLedger(spark, str(tmp_path / "l"), "q2").publish(_rows(spark, 1), target, 0)
    assert spark.read.parquet(target).count() == 20 + 20 + 3 + 1
    assert sorted((r.query, r.epoch, r.part, r.state) for r in ledger.entries().collect()) == [("q", 0, "rows", "published"), ("q", 1, "other", "published"), ("q", 1, "rows", "published"), ("q2", 0, "rows", "published")]


@pytest.mark.parametrize("moved", [0, 1, 3])
def test_a_death_while_moving_is_made_good(spark, tmp_path, moved):
    target, ledger = str(tmp_path / "t"), EpochLedger(spark, str(tmp_path / "l"), "q")
    real, done = ledger.fs.move, []

    class Dying:
        def __getattr__(self, name):
            return getattr(ledger_fs, name)

        def move(self, a, b):
            return real(a, b)

    ledger_fs = ledger.fs
    ledger.fs = Dying()
    note = ledger._note

    def dies(epoch, part, state, *rest):
        if state == "published":
            raise OSError("lost")
        note(epoch, part, state, *rest)

    ledger._note = dies
    with pytest.raises(OSError):
        ledger.publish(_rows(spark).repartition(4), target, 7)
    files = sorted(f for f in os.listdir(target) if f.endswith(".parquet"))
    for f in files[moved:]:  # as if it had died after ``moved`` files
        back = f"{tmp_path}/l/staging/q-rows-{7:012d}/{f.split('-', 3)[3]}"
        os.rename(f"{target}/{f}", back)
        done.append(back)
    again = EpochLedger(spark, str(tmp_path / "l"), "q")
    assert again.publish(_rows(spark, 5), target, 7) and not again.publish(_rows(spark), target, 7)
    assert spark.read.parquet(target).count() == 20 and len(files) == 4  # the prepared rows, not those of the second call


def _scoring(spark):
    atlas = spark.createDataFrame([("V1", 0, v) for v in range(4)], "parcel string, ordinal int, vertex int")
    return atlas, AT.alias_map_df(spark), AT.alias_names()


def _store(spark, path, buckets=None):
    from datetime import datetime

    from streetscape.schemas import IMAGE_COLUMNS, IMAGE_SCHEMA
    from streetscape.sinks.stores import append_images

    def row(i, blob, at=datetime(2024, 1, 1)):
        return tuple((dict.fromkeys(IMAGE_COLUMNS) | {"image_id": i, "image_blob": blob, "downloaded_at": at})[c] for c in IMAGE_COLUMNS)

    init_store(spark, path, "images", buckets)
    rows = [row(str(i), bytes([i + 1]) * 9) for i in range(6)] + [row("bad", b"FAILxx"), row("none", None), row("0", b"older", datetime(2023, 1, 1))]
    append_images(spark.createDataFrame(rows, IMAGE_SCHEMA), path)


@pytest.mark.parametrize("buckets", [None, 4])
def test_scoring_epochs_again_and_every_failure_is_a_row(spark, tmp_path, buckets):
    store, scores = str(tmp_path / "images"), str(tmp_path / "scores")
    _store(spark, store)
    init_store(spark, scores, "scores", buckets)
    failing = lambda: M.ByteProbePredictor(fail_marker=b"FAIL")
    process = score_epochs(spark, scores, "q", *_scoring(spark), predictor_factory=failing)
    batch = scan_image_store(spark, store)
    for _ in range(2):
        process(batch, 0)
    assert sorted(r.image_id for r in scan_score_store(spark, scores).collect()) == [str(i) for i in range(6)]
    lost = sorted((r.image_id, r.stage, r.reason.split(":")[0]) for r in scan_rejects(spark, f"{scores}-rejects").collect())
    assert lost == [("bad", "inference", "inference_failed"), ("none", "inference", "null_blob")]
    assert buckets_of(spark, scores) == buckets
    # a model that has been mended scores what failed; what has no blob is rejected again
    assert retry_rejected(spark, store, scores, *_scoring(spark), predictor_factory=lambda: M.ByteProbePredictor(fail_marker=None)) == 2
    assert "bad" in {r.image_id for r in scan_score_store(spark, scores).collect()} and scan_score_store(spark, scores).count() == 7
    assert scan_rejects(spark, f"{scores}-rejects").where("image_id = 'none'").count() == 2


def test_stream_score_writes_rejects(spark, tmp_path):
    store, scores = str(tmp_path / "images"), str(tmp_path / "scores")
    _store(spark, store)
    for ck in ("a", "b"):
        stream_score(spark, store, scores, str(tmp_path / ck), *_scoring(spark), predictor_factory=lambda: M.ByteProbePredictor(fail_marker=b"FAIL")).awaitTermination()
    assert scan_score_store(spark, scores).count() == 6
    assert {r.query for r in scan_rejects(spark, f"{scores}-rejects").collect()} == {query_key(str(tmp_path / "a")), query_key(str(tmp_path / "b"))}


def _page(path, ids, lon=-0.144):
    recs = [{"id": i, "computed_geometry": {"coordinates": [lon, 51.541]}, "captured_at": 1714564800000 + int(i), "thumb_2048_url": f"u/{i}", "is_pano": False} for i in ids]
    path.write_text(json.dumps({"data": recs, "paging": {}}))


def test_state_holds_what_was_seen(spark, tmp_path):
    pages, store, check = tmp_path / "pages", str(tmp_path / "images"), str(tmp_path / "check")
    pages.mkdir()
    _store(spark, store)  # ids 0-5 are there before the stream begins
    blobs = spark.createDataFrame([(str(i), bytes([i % 251 + 1]) * (i + 3)) for i in range(5, 20)], "image_id string, image_blob binary")

    def run():
        stream_ingest_stateful(spark, str(pages), blobs, store, check, CAMDEN, max_files_per_trigger=1).awaitTermination()
        return sorted(r.image_id for r in scan_image_store(spark, store).where("image_sha256 IS NOT NULL").collect())

    _page(pages / "a.json", ["3", "7", "8"])
    _page(pages / "b.json", ["8", "7", "9", "99"])  # repeats in another file, 99 has no image
    assert run() == ["7", "8", "9"]
    _page(pages / "c.json", ["9", "10", "5", "99"])
    assert run() == ["10", "7", "8", "9"] and run() == ["10", "7", "8", "9"]
    assert [r.image_id for r in scan_rejects(spark, f"{store}-rejects").collect()] == ["99"]


def test_a_bucket_of_ids_asks_for_its_state_once():
    """one look-up and one update for all ids of a bucket (before: for each id); the least row of each new id, once."""
    asked = []

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            asked.append("get")
            return self.held

        def update(self, value):
            asked.append("update")
            self.held = value

    state = Value()
    processor = FirstArrival("image_id", "string", ("page", "pos"), ["image_id", "page", "pos"])
    processor.init(type("Handle", (), {"getValueState": lambda self, name, schema: state})())
    row = Row("image_id", "page", "pos", "__bucket")
    processor.handleInitialState((7,), Row(__bucket=7, ids=["0", "1"]), None)
    asked.clear()
    rows = [row(str(i), p, i % 5, 7) for i in range(300) for p in ("b", None, "a")]
    first = list(processor.handleInputRows((7,), iter(rows), None))
    assert asked == ["get", "update"]
    assert sorted(tuple(r) for r in first) == sorted((str(i), None, i % 5) for i in range(2, 300)) and list(first[0].__fields__) == ["image_id", "page", "pos"]
    assert not list(processor.handleInputRows((7,), iter(rows), None)) and asked == ["get", "update", "get"]
