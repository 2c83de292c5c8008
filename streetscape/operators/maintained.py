"""A7, A1 kept up to date: an index of the latest rows and the store's figures, from a log of the shards seen.

A version of the index is two tables: ``shards`` (each shard seen, with its rows, bytes and capture times) and ``rows`` (the
latest row of each id, without the image). ``refresh`` lists the store, reads the slim columns of shards that the last
version hasn't seen, and merges their latest rows with it; the store's own size plays no part. Shards that are gone take
their rows with them: only for ids whose latest row lay in one are the remaining shards' rows looked at again.

A version counts once its ``commit.json`` is there, which is written last; a refresh that dies leaves the version before. The
result is that of ``store_index`` and ``store_stats`` over the whole store.
"""

from __future__ import annotations

import json

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.operators.sizing import broadcast_if_small
from streetscape.operators.spatial import _names
from streetscape.operators.store import drop_sentinel
from streetscape.schemas import IMAGE_SCHEMA
from streetscape.sinks.geoparquet import _fs, qualified

SHARD_DDL = "file string, n_rows long, total_bytes long, oldest timestamp_ntz, newest timestamp_ntz"
ROW_DDL = "image_id string, downloaded_at timestamp_ntz, source_file string, row_index long, image_sha256 string, image_bytes long"
ORDER = ("downloaded_at", "source_file", "row_index", "image_sha256", "image_bytes")


def version(spark: SparkSession, index: str) -> int:
    """The last version that is whole; 0 before the first."""
    fs, root = _fs(qualified(spark, index))
    found = fs.get_file_info(pafs.FileSelector(root.rstrip("/"), allow_not_found=True))
    numbers = [int(i.base_name[1:]) for i in found if i.type == pafs.FileType.Directory and i.base_name[:1] == "v" and i.base_name[1:].isdigit()]
    whole = [n for n in numbers if fs.get_file_info(f"{root.rstrip('/')}/v{n}/commit.json").type == pafs.FileType.File]
    return max(whole, default=0)


def _table(spark: SparkSession, index: str, at: int, name: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(f"{index.rstrip('/')}/v{at}/{name}") if at else spark.createDataFrame([], ddl)


def read_index(spark: SparkSession, index: str) -> DataFrame:
    """The latest row of each id as of the last refresh."""
    return _table(spark, index, version(spark, index), "rows", ROW_DDL).drop("row_index")


def read_stats(spark: SparkSession, index: str) -> DataFrame:
    """A1: the store's figures as of the last refresh, from a row for each shard."""
    shards = _table(spark, index, version(spark, index), "shards", SHARD_DDL)
    return shards.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows"),
        F.count_if(F.col("n_rows") > 0).alias("n_shards"),
        F.coalesce(F.sum("total_bytes"), F.lit(0)).cast("long").alias("total_bytes"),
        F.min("oldest").alias("oldest_captured_at"),
        F.max("newest").alias("newest_captured_at"),
    )


def scan_shards(spark: SparkSession, store: str, files: list[str]) -> DataFrame:
    """The slim columns of the named shards."""
    if not files:
        return spark.createDataFrame([], f"{ROW_DDL}, captured_at timestamp_ntz")
    rows = spark.read.schema(IMAGE_SCHEMA).parquet(*[f"{store.rstrip('/')}/{f}" for f in files])
    return drop_sentinel(rows).select("image_id", "downloaded_at", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.row_index").alias("row_index"), "image_sha256", "image_bytes", "captured_at")


def _latest(rows: DataFrame) -> DataFrame:
    best = rows.groupBy("image_id").agg(F.max(F.struct(*ORDER)).alias("b"))  # file and row decide before the rest is compared
    return best.select("image_id", *[F.col(f"b.{c}").alias(c) for c in ORDER])


def refresh(spark: SparkSession, store: str, index: str) -> tuple[int, list[str], list[str]]:
    """Bring the index up to date; returns its version, the shards it read as new and those it found gone."""
    at = version(spark, index)
    shards, rows = _table(spark, index, at, "shards", SHARD_DDL), _table(spark, index, at, "rows", ROW_DDL)
    listed = _names(spark, store)
    seen = {r.file for r in shards.select("file").collect()}  # a name for each shard, as in any listing
    new, gone = sorted(set(listed) - seen), sorted(seen - set(listed))
    if at and not new and not gone:
        return at, new, gone

    fresh = scan_shards(spark, store, new)
    figures = fresh.groupBy(F.col("source_file").alias("file")).agg(F.count("*").alias("n_rows"), F.coalesce(F.sum("image_bytes"), F.lit(0)).alias("total_bytes"), F.min("captured_at").alias("oldest"), F.max("captured_at").alias("newest"))
    names = spark.createDataFrame([(f,) for f in new], "file string")
    told = names.join(figures, "file", "left").na.fill(0, ["n_rows", "total_bytes"])
    merged = rows.unionByName(_latest(fresh))
    if gone:
        lost = broadcast_if_small(spark.createDataFrame([(f,) for f in gone], "file string"))
        shards = shards.join(lost, "file", "left_anti")
        by_file = rows.withColumnRenamed("source_file", "file")
        bereft = by_file.join(lost, "file", "left_semi").select("image_id")
        kept = by_file.join(lost, "file", "left_anti").withColumnRenamed("file", "source_file")
        others = scan_shards(spark, store, sorted(seen & set(listed))).drop("captured_at").join(broadcast_if_small(bereft), "image_id", "left_semi")
        merged = kept.unionByName(others).unionByName(_latest(fresh))

    after, root = at + 1, f"{index.rstrip('/')}/v{at + 1}"
    shards.unionByName(told).write.mode("overwrite").parquet(f"{root}/shards")  # over what a refresh that died has left
    _latest(merged).write.mode("overwrite").parquet(f"{root}/rows")
    fs, place = _fs(qualified(spark, root))
    with fs.open_output_stream(f"{place}/commit.json") as out:
        out.write(json.dumps({"version": after, "new": len(new), "gone": len(gone)}).encode())
    return after, new, gone
