"""S2 at scale: images landed in packed shards with an index of offsets, listed by the executors.

A landing folder has a fixed number of sub-folders, told by its marker file, so that the driver names them without
listing any. A task that lands images appends them to packs of about ``SHARD_BYTES`` in the sub-folder of its partition and
writes one index (image_id, pack, offset, length) at its end; the index appears by a rename, and a pack that none names,
left by a task that died, isn't read. A repeated task replaces its index.

``format("image_shards")`` is the table of the index entries: each of its partitions lists some sub-folders. Contents are
read by offset, for all entries or for those of given ids; an id landed twice then counts once, by the greatest pack and offset.

Defined cases: rows without an id or content aren't landed; an empty table lands the marker alone; a folder
without the marker is one of single files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from streetscape.session import shared_path
from streetscape.sinks.geoparquet import _fs, qualified
from streetscape.sources.images import JPEG_MAGIC_HEX

MARKER = "_shards.json"
FOLDERS = 64
SHARD_BYTES = 128 << 20
READ_BYTES = 32 << 20
INDEX = pa.schema([("image_id", pa.string()), ("pack", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
ENTRY = "image_id string, pack string, offset bigint, length bigint"
CONTENT = "image_id string, image_blob binary, path string"


def folders_of(root: str) -> int | None:
    """The sub-folders of a landing folder of shards; None for any other folder."""
    fs, base = _fs(f"{root.rstrip('/')}/{MARKER}")
    if fs.get_file_info(base).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(base) as f:
        return int(json.loads(f.read())["folders"])


def _sub(k: int) -> str:
    return f"f{k:04d}"


def land_shards(df: DataFrame, path: str, id_col: str = "image_id", blob_col: str = "image_blob", folders: int = FOLDERS, shard_bytes: int = SHARD_BYTES) -> int:
    """Append ``blob_col`` of every row to the shards under ``path``; returns the number of images."""
    spark = df.sparkSession
    root = qualified(spark, path.rstrip("/"))
    told = folders_of(root)
    if told is None:
        fs, base = _fs(root)
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/{MARKER}") as out:
            out.write(json.dumps({"folders": folders}).encode())
        told = folders
    written = df.select(F.col(id_col).cast("string").alias("image_id"), F.col(blob_col).alias("image_blob")).mapInArrow(_land(root, told, uuid.uuid4().hex, shard_bytes), "n bigint")
    return int(written.agg(F.sum("n")).first()[0] or 0)


def _land(root: str, folders: int, job: str, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, base = _fs(f"{root}/{_sub(partition % folders)}")
        fs.create_dir(base, recursive=True)
        entries: list[tuple[str, str, int, int]] = []
        out, at, packs = None, 0, 0
        try:
            for b in batches:
                for image_id, blob in zip(b.column("image_id").to_pylist(), b.column("image_blob")):
                    if image_id is None or not blob.is_valid:
                        continue
                    if out is None or at >= shard_bytes:
                        if out is not None:
                            out.close()
                        pack, at, packs = f"{job}-{partition:06d}-{packs:04d}-{attempt}.pack", 0, packs + 1
                        out = fs.open_output_stream(f"{base}/{pack}")
                    content = blob.as_buffer()
                    out.write(content)
                    entries.append((image_id, f"{_sub(partition % folders)}/{pack}", at, content.size))
                    at += content.size
        finally:
            if out is not None:
                out.close()
        if entries:
            table = pa.table([pa.array(c, t) for c, t in zip(zip(*entries), INDEX.types)], schema=INDEX)
            staged = f"{base}/.{attempt}.staged"
            with fs.open_output_stream(staged) as f:
                pq.write_table(table, f, compression="zstd")
            fs.move(staged, f"{base}/{job}-{partition:06d}.idx")
        yield pa.RecordBatch.from_arrays([pa.array([len(entries)], pa.int64())], names=["n"])

    return run


@dataclass
class Folders(InputPartition):
    names: list[str] = field(default_factory=list)


class ShardSource(DataSource):
    """``format("image_shards")``: the index entries of a landing folder."""

    @classmethod
    def name(cls) -> str:
        return "image_shards"

    def schema(self) -> str:
        return ENTRY

    def reader(self, schema) -> DataSourceReader:
        return ShardReader(self.options)


class ShardReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root = options["path"].rstrip("/")
        self.tasks = int(options.get("tasks", FOLDERS))
        self.ids: list[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and tuple(f.attribute) == ("image_id",) and self.ids is None:
                self.ids = [str(v) for v in (f.value if isinstance(f, In) else [f.value])]
            yield f  # Spark applies it again

    def partitions(self) -> list[Folders]:
        folders = folders_of(self.root)
        if folders is None:
            raise FileNotFoundError(f"{self.root} holds no {MARKER}")
        tasks = max(1, min(self.tasks, folders))
        return [Folders([_sub(k) for k in range(t, folders, tasks)]) for t in range(tasks)]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(self.root)
        for name in partition.names:
            found = fs.get_file_info(pafs.FileSelector(f"{base}/{name}", allow_not_found=True))
            for info in found:
                if info.base_name.endswith(".idx") and not info.base_name.startswith("."):
                    with fs.open_input_file(info.path) as f:
                        for batch in pq.ParquetFile(f).iter_batches():
                            if self.ids is not None:
                                batch = batch.filter(pc.is_in(batch.column("image_id"), pa.array(self.ids, pa.string())))
                            if batch.num_rows:
                                yield batch


def shard_entries(spark: SparkSession, path: str) -> DataFrame:
    """The index: image_id, pack, offset, length."""
    spark.dataSource.register(ShardSource)
    return spark.read.format("image_shards").load(qualified(spark, path.rstrip("/")))


def _contents(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(root)
        name, file, rows, held = None, None, [], 0
        try:
            for b in batches:
                for image_id, pack, offset, length in zip(*(b.column(c).to_pylist() for c in INDEX.names)):
                    if pack != name:
                        if file is not None:
                            file.close()
                        name, file = pack, fs.open_input_file(f"{base}/{pack}")
                    file.seek(offset)
                    rows.append((image_id, file.read(length), f"{root}/{pack}#{offset}"))
                    held += length
                    if held >= READ_BYTES or len(rows) >= 1000:
                        yield _batch(rows)
                        rows, held = [], 0
        finally:
            if file is not None:
                file.close()
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary(), pa.string()))], names=["image_id", "image_blob", "path"])


def _checked(entries: DataFrame, root: str) -> DataFrame:
    rows = entries.select(*INDEX.names).mapInArrow(_contents(root), CONTENT)
    return rows.withColumn("reject_reason", F.when(F.hex(F.substring("image_blob", 1, 3)) != F.lit(JPEG_MAGIC_HEX), F.lit("not_image")))


def scan_image_shards(spark: SparkSession, path: str) -> DataFrame:
    """Every landed image, with the columns of ``images.scan_image_files``; nothing is shuffled."""
    return _checked(shard_entries(spark, path), qualified(spark, path.rstrip("/")))


def read_shard_images_of(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """The landed images of ``ids`` alone: the index is joined by id, what remains is written down, shared out by pack into
    tasks of about ``SHARD_BYTES`` of contents and read in the order of offsets."""
    wanted = shard_entries(spark, path).join(ids.select("image_id").distinct(), "image_id", "left_semi")
    one = wanted.groupBy("image_id").agg(F.max(F.struct("pack", "offset", "length")).alias("at")).select("image_id", "at.*")
    kept = f"{shared_path(spark, 'wanted')}/entries"
    one.write.parquet(kept)
    one = spark.read.schema(ENTRY).parquet(kept)
    volume = one.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-volume // SHARD_BYTES))
    return _checked(one.repartition(int(tasks), "pack").sortWithinPartitions("pack", "offset"), qualified(spark, path.rstrip("/")))
