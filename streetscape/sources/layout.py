"""K1-K3, J1-J3 at scale: stores bucketed by image id.

A bucketed store is an ordinary folder of Parquet shards whose files are hashed by ``image_id`` into a fixed number of
buckets; ``_layout.json`` beside them says so. Each session declares the folder as an external table clustered by the id, so
that Spark knows the partitioning of a scan: joins and aggregates on the id read a store's buckets where they lie, without
a shuffle of the store, and a filter on few ids opens their buckets only. Plain readers of the folder still see every row.

An append shuffles the new rows once, by bucket. Its tasks are rebalanced, so a bucket that holds much more than the
others is written by several tasks, as several files of that bucket.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYOUT_FILE = "_layout.json"
DEFAULT_BUCKETS = 64
#: Up to this many candidate ids for each bucket are named in a filter, so that only their buckets are opened; with
#: more of them nearly every bucket is needed anyway.
IDS_PER_BUCKET = 2


def _place(spark: SparkSession, path: str):
    from streetscape.sinks.geoparquet import _fs, qualified

    fs, root = _fs(qualified(spark, path))
    return fs, root.rstrip("/")


def buckets_of(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of the store in ``path``; None for a folder of plain shards or a missing one."""
    import pyarrow.fs as pafs

    try:
        fs, root = _place(spark, path)
        if fs.get_file_info(f"{root}/{LAYOUT_FILE}").type != pafs.FileType.File:
            return None
    except (OSError, ValueError):  # a file system PyArrow doesn't know holds no bucketed store of ours
        return None
    with fs.open_input_stream(f"{root}/{LAYOUT_FILE}") as f:
        told = json.loads(f.read())
    if told.get("clustered_by") != "image_id" or not isinstance(told.get("buckets"), int):
        raise ValueError(f"{path}/{LAYOUT_FILE} isn't a layout of this package: {told}")
    return told["buckets"]


def init_bucketed(spark: SparkSession, path: str, buckets: int = DEFAULT_BUCKETS) -> bool:
    """Make ``path`` a bucketed store, empty so far. False if it is one already; a folder with plain shards is refused,
    since their rows lie in no bucket."""
    import pyarrow.fs as pafs

    if buckets < 1:
        raise ValueError("a store has one bucket at least")
    if buckets_of(spark, path) is not None:
        return False
    fs, root = _place(spark, path)
    fs.create_dir(root, recursive=True)
    if any(i.base_name.endswith(".parquet") for i in fs.get_file_info(pafs.FileSelector(root))):
        raise ValueError(f"{path} holds shards without buckets")
    with fs.open_output_stream(f"{root}/{LAYOUT_FILE}") as out:
        out.write(json.dumps({"clustered_by": "image_id", "buckets": buckets}).encode())
    return True


def bucketed_table(spark: SparkSession, path: str, schema: T.StructType) -> str:
    """The name under which this session knows the store; its file list is refreshed, as other sessions append too."""
    from streetscape.sinks.geoparquet import qualified

    n = buckets_of(spark, path)
    if n is None:
        raise ValueError(f"{path} isn't a bucketed store")
    where = qualified(spark, path)
    name = f"streetscape_{hashlib.md5(f'{where} {schema.simpleString()}'.encode()).hexdigest()}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS ('compression' 'zstd', 'parquet.compression.codec.zstd.level' '9') "
            f"CLUSTERED BY (image_id) SORTED BY (image_id) INTO {n} BUCKETS LOCATION '{where}'"
        )
    spark.catalog.refreshTable(name)
    return name


def append_bucketed(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append rows, each into its id's bucket."""
    spark = df.sparkSession
    name = bucketed_table(spark, path, schema)
    df.select(*schema.fieldNames()).hint("rebalance", buckets_of(spark, path), F.col("image_id")).write.insertInto(name)


def ids_in(candidates: DataFrame, store: DataFrame, buckets: int) -> DataFrame:
    """The ids of a bucketed store that matter to ``candidates``: those of their buckets if the candidates are few, all
    otherwise. Only the id column is read; the scan keeps its partitioning by bucket."""
    ids = store.select("image_id")
    wanted = candidates.where("image_id IS NOT NULL").select("image_id").distinct()
    bound = IDS_PER_BUCKET * buckets
    if wanted.count() <= bound:
        ids = ids.where(F.col("image_id").isin([r[0] for r in wanted.limit(bound).collect()]))
    return ids


def new_in(candidates: DataFrame, store: DataFrame, buckets: int) -> DataFrame:
    """J1, J2 over a bucketed store: candidates it lacks. Candidates move to the store's buckets, the store stays."""
    return candidates.join(ids_in(candidates, store, buckets), "image_id", "left_anti")


def cached_in(candidates: DataFrame, store: DataFrame, buckets: int) -> DataFrame:
    """J3 over a bucketed store: candidates it holds."""
    return candidates.join(ids_in(candidates, store, buckets), "image_id", "left_semi")
