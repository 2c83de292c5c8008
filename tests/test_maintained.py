"""The maintained index against the full computation, through appends, deletions and a refresh that died."""

from __future__ import annotations

import os
from datetime import datetime

from streetscape.operators import maintained as I
from streetscape.operators import store as ST
from streetscape.schemas import IMAGE_COLUMNS, IMAGE_SCHEMA
from streetscape.sinks.stores import append_images
from streetscape.sources.stores import scan_image_store


def _append(spark, path, ids, day, blob=b"x"):
    def row(i):
        told = dict.fromkeys(IMAGE_COLUMNS) | dict(image_id=i, image_blob=blob, image_sha256=f"{i}-{day}", image_bytes=len(i), downloaded_at=None if day is None else datetime(2024, 1, day), captured_at=datetime(2023, 1, len(i)))
        return tuple(told[c] for c in IMAGE_COLUMNS)

    append_images(spark.createDataFrame([row(i) for i in ids], IMAGE_SCHEMA).coalesce(1), path)


def _same(spark, store, index):
    scan = scan_image_store(spark, store)
    want = sorted(map(tuple, ST.store_index(scan).select("image_id", "downloaded_at", "source_file", "image_sha256", "image_bytes").collect()))
    got = sorted(map(tuple, I.read_index(spark, index).select("image_id", "downloaded_at", "source_file", "image_sha256", "image_bytes").collect()))
    assert got == want
    assert tuple(I.read_stats(spark, index).first()) == tuple(ST.store_stats(scan).first())


def _shards(path):
    return {f for f in os.listdir(path) if f.endswith(".parquet")}


def test_refresh_reads_new_shards_only_and_equals_the_full_computation(spark, tmp_path, monkeypatch):
    store, index = str(tmp_path / "images"), str(tmp_path / "index")
    read = []
    scan = I.scan_shards
    monkeypatch.setattr(I, "scan_shards", lambda s, p, files: read.append(sorted(files)) or scan(s, p, files))
    _append(spark, store, ["a", "bb", "ccc"], 1)
    first = _shards(store)
    assert I.refresh(spark, store, index)[0] == 1 and read == [sorted(first)]
    _same(spark, store, index)
    _append(spark, store, ["bb", "dd", "__sentinel__"], 5)
    second = _shards(store) - first
    assert I.refresh(spark, store, index)[1] == sorted(second) and read[1:] == [sorted(second)]
    _same(spark, store, index)
    assert I.refresh(spark, store, index) == (2, [], []) and len(read) == 2  # nothing new, nothing read
    _append(spark, store, ["ccc", "bb", "a"], 3)  # older than what is there, or tied by nothing
    _append(spark, store, ["ccc"], None)
    I.refresh(spark, store, index)
    _same(spark, store, index)

    for f in second:  # bb falls back to an older shard, dd is gone
        os.remove(f"{store}/{f}")
    at, new, gone = I.refresh(spark, store, index)
    assert (at, new, gone) == (4, [], sorted(second))
    _same(spark, store, index)
    assert {r.image_id for r in I.read_index(spark, index).collect()} == {"a", "bb", "ccc"}


def test_a_refresh_that_died_leaves_the_version_before(spark, tmp_path):
    store, index = str(tmp_path / "images"), str(tmp_path / "index")
    _append(spark, store, ["a"], 1)
    I.refresh(spark, store, index)
    _append(spark, store, ["b"], 2)
    I.refresh(spark, store, index)
    os.remove(f"{index}/v2/commit.json")
    assert I.version(spark, index) == 1 and [r.image_id for r in I.read_index(spark, index).collect()] == ["a"]
    assert I.refresh(spark, store, index)[0] == 2
    _same(spark, store, index)


def test_nothing_yet(spark, tmp_path):
    index = str(tmp_path / "index")
    assert I.version(spark, index) == 0 and I.read_index(spark, index).count() == 0
    assert I.refresh(spark, str(tmp_path / "none"), index)[0] == 1
    assert I.read_stats(spark, index).first().n_rows == 0
