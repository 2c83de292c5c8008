"""Packed image shards against single files; orphans, repeats, empty landings; a whole run over shards."""

from __future__ import annotations

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from streetscape.plans.pipeline import RunConfig, run
from streetscape.sinks.files import land_files
from streetscape.sources import image_shards as S
from streetscape.sources.images import read_images_of, scan_image_files

JPEG = bytes.fromhex("ffd8ffe0")


@pytest.fixture
def images(spark):
    data = [(str(i), (JPEG if i % 5 else b"none") + bytes([i % 251]) * (i * 37 % 4000)) for i in range(300)]
    return spark.createDataFrame([*data, (None, b"x"), ("gone", None)], "image_id string, image_blob binary").repartition(5)


def told(df):
    return sorted((r.image_id, bytes(r.image_blob), r.reject_reason) for r in df.collect())


def test_shards_hold_what_files_hold(spark, tmp_path, images):
    shards, files = str(tmp_path / "shards"), str(tmp_path / "files")
    assert S.land_shards(images.where("coalesce(try_cast(image_id AS INT), 0) % 2 = 0"), shards, folders=3) == 150
    assert S.land_shards(images.where("coalesce(try_cast(image_id AS INT), 0) % 2 = 1"), shards) == 150  # the marker's folders hold
    land_files(images, files)
    assert told(S.scan_image_shards(spark, shards)) == told(scan_image_files(spark, files))
    ids = spark.createDataFrame([(str(i),) for i in range(100, 400, 7)], "image_id string")
    assert told(read_images_of(spark, shards, ids)) == told(read_images_of(spark, files, ids))
    entries = S.shard_entries(spark, shards)
    assert sorted(r.image_id for r in entries.where(F.col("image_id").isin("3", "250", "x")).collect()) == ["250", "3"]
    assert entries.rdd.getNumPartitions() == 3


def test_shards_roll_and_ignore_what_no_index_names(spark, tmp_path, images):
    root = tmp_path / "shards"
    S.land_shards(images, str(root), folders=2, shard_bytes=2000)
    assert len(list(root.glob("f*/*.pack"))) > len(list(root.glob("f*/*.idx"))) > 0
    (root / "f0000" / "dead.pack").write_bytes(b"left by a task that died")
    (root / "f0000" / ".dead.staged").write_bytes(b"not an index")
    assert S.scan_image_shards(spark, str(root)).count() == 300


def test_repeated_ids_and_empty_landings(spark, tmp_path, images):
    root = str(tmp_path / "shards")
    assert S.land_shards(images.limit(0), root) == 0
    assert S.scan_image_shards(spark, root).count() == 0
    ids = spark.createDataFrame([("a",), ("a",), ("zz",)], "image_id string")
    assert read_images_of(spark, root, ids).count() == 0
    twice = spark.createDataFrame([("a", JPEG + b"1"), ("a", JPEG + b"2")], "image_id string, image_blob binary")
    S.land_shards(twice, root)
    assert S.scan_image_shards(spark, root).count() == 2 and read_images_of(spark, root, ids).count() == 1
    with pytest.raises(Exception, match=S.MARKER):
        S.shard_entries(spark, str(tmp_path)).count()


def test_the_driver_lists_no_folder_of_shards(tmp_path, spark, images, monkeypatch):
    root = str(tmp_path / "shards")
    S.land_shards(images, root, folders=4)
    reader = S.ShardReader({"path": root, "tasks": "3"})
    asked = []
    monkeypatch.setattr(pafs, "FileSelector", lambda *a, **k: asked.append(a))
    assert sorted(n for p in reader.partitions() for n in p.names) == [S._sub(k) for k in range(4)] and not asked


def test_run_over_shards(spark, tmp_path):
    from tests.test_pipeline import _fixtures

    pages, files, atlas = _fixtures(tmp_path, spark)
    shards = str(tmp_path / "shards")
    S.land_shards(scan_image_files(spark, files), shards)
    outs = []
    for name, where in (("files", files), ("shards", shards)):
        at = tmp_path / name
        outs.append(run(spark, RunConfig(pages, where, str(at / "images"), str(at / "scores"), str(at / "out"), atlas, start_captured_at="2024-01-01")))
    assert outs[0]["counts"] == outs[1]["counts"] and outs[1]["counts"]["written"] == 9
    again = run(spark, RunConfig(pages, shards, str(tmp_path / "shards-store"), str(tmp_path / "shards-scores"), str(tmp_path / "out2"), atlas, start_captured_at="2024-01-01"))
    assert again["counts"]["downloaded"] == 9


def test_small_files_are_listed_by_few_tasks(spark, tmp_path):
    images = tmp_path / "many"
    images.mkdir()
    for i in range(1500):
        (images / f"{i}.jpg").write_bytes(b"\xff\xd8\xff" + bytes(i % 50))
    ids = spark.range(0, 1500, 2).selectExpr("cast(id as string) image_id")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.sparkContext.setJobGroup("few", "listing")
    try:
        rows = read_images_of(spark, str(images), ids)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    told = spark.sparkContext.statusTracker()
    tasks = [told.getStageInfo(s).numTasks for j in told.getJobIdsForGroup("few") for s in told.getJobInfo(j).stageIds if told.getStageInfo(s)]
    assert tasks and max(tasks) <= max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))) + 1 < 46  # 32 files a task before
    assert rows.count() == 750 and spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_image_files_are_listed_by_a_task(spark, tmp_path):
    """the driver holds no file of a landing folder; the files are those of Spark's own scan."""
    from streetscape.sources.images import list_files

    for name in ("files/1.jpg", "files/2.png", "files/a b.jpg", "files/_hidden.jpg", "files/.5.jpg", "files/_temporary/6.jpg", "files/sub/7.jpg", "days/day=3/4.jpg", "days/day=4/5.jpg"):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"\xff\xd8\xff" + name.encode())
    ids = spark.createDataFrame([("2",), ("4",), ("9",)], "image_id string")
    for root, n, found in ((str(tmp_path / "files"), 3, ["2"]), (str(tmp_path / "days"), 2, ["4"])):
        listed, scanned = list_files(spark, root), scan_image_files(spark, root)
        assert listed.inputFiles() == [] and len(scanned.inputFiles()) == n
        assert sorted((r.path, r.length) for r in listed.collect()) == sorted((r.path, len(r.image_blob)) for r in scanned.collect())
        assert sorted(r.image_id for r in read_images_of(spark, root, ids).collect()) == found
    assert list_files(spark, str(tmp_path / "files"), "*.jpg").count() == 2
