"""Landed image files -> (image_id, image_blob, path), JPEG checked by its magic bytes.

The id is taken from the file name (``<id>.jpg`` by default). Files whose bytes do not start
with the JPEG marker come back with ``reject_reason = 'not_image'`` (the reference rejects a
non-image content type the same way).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.session import shared_path

JPEG_MAGIC_HEX = "FFD8FF"
#: Bytes and files that a task opens, about.
TASK_BYTES, TASK_FILES = 128 << 20, 2_000


def scan_image_files(spark: SparkSession, path: str, id_pattern: str = r"([^/]+)\.[A-Za-z0-9]+$", glob: str = "*") -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(
        F.regexp_extract("path", id_pattern, 1).alias("image_id"),
        F.col("content").alias("image_blob"),
        F.col("path"),
        F.when(F.hex(F.substring("content", 1, 3)) != F.lit(JPEG_MAGIC_HEX), F.lit("not_image")).alias("reject_reason"),
    )


@contextmanager
def _cheap_to_open(spark: SparkSession) -> Iterator[None]:
    """Files count for ``TASK_BYTES / TASK_FILES`` more than their size where they are shared out, not for the 4 MB of
    Spark's default, by which a task lists a few dozen small ones. Only for what is run inside."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(TASK_BYTES // TASK_FILES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from streetscape.sinks.geoparquet import _fs

    for b in batches:
        for image_id, path in zip(b.column("image_id").to_pylist(), b.column("path").to_pylist()):
            fs, local = _fs(path)
            with fs.open_input_stream(local) as f:
                blob = f.read()
            yield pa.RecordBatch.from_arrays([pa.array([image_id]), pa.array([blob], pa.binary()), pa.array([path])], names=["image_id", "image_blob", "path"])


def _listed():
    """The files (path, length) of a folder, and of its folders ``name=value``, as Spark's scan takes them, in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        from streetscape.sinks.geoparquet import _fs

        for b in batches:
            for url in b.column("root").to_pylist():
                todo = [url]
                while todo:
                    at = todo.pop()
                    fs, base = _fs(at)
                    found = fs.get_file_info(pafs.FileSelector(base))
                    names = [(i.base_name, i.size, i.type == pafs.FileType.Directory) for i in found if not i.base_name.startswith(("_", "."))]
                    del found
                    todo += [f"{at}/{name}" for name, _, folder in names if folder and "=" in name]
                    for k in range(0, len(names), 10_000):
                        files = [(f"{at}/{name}", size) for name, size, folder in names[k : k + 10_000] if not folder]
                        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in files], pa.string()), pa.array([n for _, n in files], pa.int64())], names=["path", "length"])

    return run


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """The landed files (path, length). A folder is listed by a task, so that the driver holds no file of it; anything but a plain folder, and a
    glob, by Spark's own scan."""
    import pyarrow.fs as pafs

    from streetscape.sinks.geoparquet import _fs, qualified

    root = qualified(spark, path).rstrip("/")
    fs, base = _fs(root)
    if glob != "*" or fs.get_file_info(base).type != pafs.FileType.Directory:
        return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")
    return spark.range(1, numPartitions=1).select(F.lit(root).alias("root")).mapInArrow(_listed(), "path string, length bigint")


def read_images_of(spark: SparkSession, path: str, ids: DataFrame, id_pattern: str = r"([^/]+)\.[A-Za-z0-9]+$", glob: str = "*") -> DataFrame:
    """The landed images of ``ids`` alone, as ``scan_image_files`` gives them: files are listed by a task, joined by
    id on their names, and only those that remain are opened, one at a time, by the executors, shared out by their number and size. A folder of packed shards
    (``sources.image_shards``) isn't listed by the driver."""
    from streetscape.sinks.geoparquet import qualified
    from streetscape.sources.image_shards import folders_of, read_shard_images_of

    if folders_of(qualified(spark, path)) is not None:
        return read_shard_images_of(spark, path, ids)
    listed = list_files(spark, path, glob).select(F.regexp_extract("path", id_pattern, 1).alias("image_id"), "path", "length")
    kept = f"{shared_path(spark, 'wanted')}/files"
    with _cheap_to_open(spark):
        listed.join(ids.select("image_id").distinct(), "image_id", "left_semi").write.parquet(kept)
    wanted = spark.read.schema("image_id string, path string, length bigint").parquet(kept)
    n, volume = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    # Spark's scan takes a file for 4 MB at least: a task for every few dozen small ones
    tasks = max(spark.sparkContext.defaultParallelism, -(-volume // TASK_BYTES), -(-n // TASK_FILES))
    read = wanted.repartition(int(tasks), "path").mapInArrow(_contents, "image_id string, image_blob binary, path string")
    return read.withColumn("reject_reason", F.when(F.hex(F.substring("image_blob", 1, 3)) != F.lit(JPEG_MAGIC_HEX), F.lit("not_image")))
