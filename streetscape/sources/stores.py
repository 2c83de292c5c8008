"""Append-only Parquet stores (images, scores), segments, labels and the deliverable.

Reads use an explicit schema, so shards written with fewer columns read as NULL there and INT
files widen to BIGINT (union by name). The sentinel id (and NULL ids) are filtered out.
``source_file`` and ``row_index`` come from the scan's hidden ``_metadata`` and are pruned when
unused.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetscape.schemas import (
    IMAGE_SCHEMA,
    LABEL_SCHEMA,
    SCORE_SCHEMA,
    SEGMENT_SCHEMA,
    SENTINEL_ID,
)
from streetscape.sources.layout import bucketed_table, buckets_of


def _read(spark: SparkSession, path: str, schema: T.StructType, with_file: bool) -> DataFrame:
    try:
        if buckets_of(spark, path) is not None:  # the scan then tells its partitioning by id
            df = spark.table(bucketed_table(spark, path, schema))
        else:
            df = spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:  # store never written yet
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        df = spark.createDataFrame([], schema)
        if with_file:
            df = df.withColumn("source_file", F.lit(None).cast("string")).withColumn("row_index", F.lit(None).cast("bigint"))
        return df
    if with_file:
        df = df.select("*", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.row_index").alias("row_index"))
    return df


def scan_image_store(spark: SparkSession, path: str, with_file: bool = True) -> DataFrame:
    """S3: all shards of the image store, sentinel removed."""
    return _read(spark, path, IMAGE_SCHEMA, with_file).filter(F.col("image_id") != F.lit(SENTINEL_ID))


def scan_score_store(spark: SparkSession, path: str, with_file: bool = True) -> DataFrame:
    """All shards of the score store, sentinel removed."""
    return _read(spark, path, SCORE_SCHEMA, with_file).filter(F.col("image_id") != F.lit(SENTINEL_ID))


def load_scores(scores: DataFrame, ids: DataFrame, model_repo: str | None = None) -> DataFrame:
    """image_id, brain_activity, top_regions for the given ids (semi join; optional model filter)."""
    if model_repo is not None:
        scores = scores.filter(F.col("model_repo") == F.lit(model_repo))
    return scores.select("image_id", "brain_activity", "top_regions").join(
        ids.select("image_id").distinct(), "image_id", "left_semi"
    )


def scan_segments(spark: SparkSession, path: str) -> DataFrame:
    """Landed model output rows (image_id, timeline, segment_idx, activity)."""
    return spark.read.schema(SEGMENT_SCHEMA).parquet(path)


def scan_parcel_labels(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Long label rows (name, hemi, vertex)."""
    reader = spark.read.schema(LABEL_SCHEMA)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


def scan_deliverable(spark: SparkSession, path: str) -> DataFrame:
    """Read back the geo table; ``geom`` is WKB binary (the schema must be explicit)."""
    schema = T.StructType(
        [
            T.StructField("image_id", T.StringType()),
            T.StructField("image_blob", T.BinaryType()),
            T.StructField("image_mime", T.StringType()),
            T.StructField("captured_at", T.TimestampNTZType()),
            T.StructField("compass_angle", T.DoubleType()),
            T.StructField("camera_type", T.StringType()),
            T.StructField("geom", T.BinaryType()),
            T.StructField("brain_activity", T.ArrayType(T.FloatType())),
            T.StructField("top_regions", SCORE_SCHEMA["top_regions"].dataType),
        ]
    )
    return spark.read.schema(schema).parquet(path)
