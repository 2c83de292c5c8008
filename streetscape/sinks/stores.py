"""K1-K3: append-only Parquet stores (ZSTD level 9). Spark's file commit protocol makes a shard
visible only when its job commits; appends never overwrite an existing shard. A store that was
made with buckets (``sources.layout``) gets its rows by bucket of the id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from streetscape.schemas import IMAGE_SCHEMA, SCORE_SCHEMA
from streetscape.sources.layout import append_bucketed, buckets_of, init_bucketed

ZSTD_OPTIONS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}


def _append(df: DataFrame, path: str, schema: T.StructType, skip_empty: bool) -> DataFrame:
    out = df.select(*schema.fieldNames())
    if skip_empty and out.isEmpty():
        return out
    if buckets_of(df.sparkSession, path) is not None:
        append_bucketed(out, path, schema)
        return out
    out.write.mode("append").options(**ZSTD_OPTIONS).parquet(path)
    return out


def append_images(df: DataFrame, path: str) -> DataFrame:
    """K1: append rows (IMAGE columns, in order) as new shard files."""
    return _append(df, path, IMAGE_SCHEMA, skip_empty=True)


def append_scores(df: DataFrame, path: str) -> DataFrame:
    """K2: append score rows; no rows -> no file."""
    return _append(df, path, SCORE_SCHEMA, skip_empty=True)


def _exists(spark: SparkSession, path: str) -> bool:
    """File-system metadata lookup on the driver (no Spark job)."""
    import pyarrow.fs as pafs

    from streetscape.sinks.geoparquet import _fs, qualified

    try:
        fs, p = _fs(qualified(spark, path))
        return fs.get_file_info(p).type != pafs.FileType.NotFound
    except Exception:  # noqa: BLE001  (unknown scheme for PyArrow: ask Spark instead)
        try:
            spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
            return True
        except Exception:  # noqa: BLE001
            return False


def init_store(spark: SparkSession, path: str, kind: str = "images", buckets: int | None = None) -> bool:
    """K3: create an empty store (schema only, no sentinel row) if the path is missing, bucketed by
    id if ``buckets`` says how often. Idempotent; returns True when it created the store."""
    if _exists(spark, path):
        return False
    if buckets:
        return init_bucketed(spark, path, buckets)
    schema = IMAGE_SCHEMA if kind == "images" else SCORE_SCHEMA
    try:
        # A schema-only file needs no Spark job: write it with PyArrow on the driver.
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        from streetscape.sinks.geoparquet import _fs, qualified

        fs, p = _fs(qualified(spark, path))
        fs.create_dir(p, recursive=True)
        arrow_schema = to_arrow_schema(schema)
        with fs.open_output_stream(f"{p}/part-00000-init.zstd.parquet") as out:
            pq.write_table(pa.Table.from_batches([], schema=arrow_schema), out, compression="zstd")
    except Exception:  # noqa: BLE001
        spark.createDataFrame([], schema).coalesce(1).write.mode("ignore").options(**ZSTD_OPTIONS).parquet(path)
    return True
