"""Table schemas (names, order and types of the stores, segments, labels and deliverable)."""

from __future__ import annotations

from pyspark.sql import types as T

SENTINEL_ID = "__sentinel__"
IMAGE_MIME = "image/jpeg"
IMAGE_SOURCE = "mapillary"

IMAGE_SCHEMA = T.StructType(
    [
        T.StructField("image_id", T.StringType()),
        T.StructField("image_blob", T.BinaryType()),
        T.StructField("image_sha256", T.StringType()),
        T.StructField("image_mime", T.StringType()),
        T.StructField("image_bytes", T.LongType()),
        T.StructField("image_width", T.IntegerType()),
        T.StructField("image_height", T.IntegerType()),
        T.StructField("downloaded_at", T.TimestampNTZType()),
        T.StructField("source", T.StringType()),
        T.StructField("mapillary_bbox_query", T.StringType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("compass_angle", T.DoubleType()),
        T.StructField("captured_at", T.TimestampNTZType()),
        T.StructField("camera_type", T.StringType()),
        T.StructField("is_pano", T.BooleanType()),
        T.StructField("sequence_id", T.StringType()),
        T.StructField("creator_id", T.LongType()),
    ]
)
IMAGE_COLUMNS = [f.name for f in IMAGE_SCHEMA.fields]

REGION_TYPE = T.StructType([T.StructField("name", T.StringType()), T.StructField("score", T.FloatType())])

SCORE_SCHEMA = T.StructType(
    [
        T.StructField("image_id", T.StringType()),
        T.StructField("brain_activity", T.ArrayType(T.FloatType())),
        T.StructField("top_regions", T.ArrayType(REGION_TYPE)),
        T.StructField("inferred_at", T.TimestampNTZType()),
        T.StructField("model_repo", T.StringType()),
    ]
)
SCORE_COLUMNS = [f.name for f in SCORE_SCHEMA.fields]

CAPTURE_SCHEMA = T.StructType(
    [
        T.StructField("image_id", T.StringType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("compass_angle", T.DoubleType()),
        T.StructField("captured_at_ms", T.LongType()),
        T.StructField("camera_type", T.StringType()),
        T.StructField("is_pano", T.BooleanType()),
        T.StructField("sequence_id", T.StringType()),
        T.StructField("creator_id", T.LongType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("thumb_2048_url", T.StringType()),
    ]
)

SEGMENT_SCHEMA = T.StructType(
    [
        T.StructField("image_id", T.StringType()),
        T.StructField("timeline", T.StringType()),
        T.StructField("segment_idx", T.IntegerType()),
        T.StructField("activity", T.ArrayType(T.FloatType())),
    ]
)

LABEL_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("hemi", T.StringType()),
        T.StructField("vertex", T.LongType()),
    ]
)

# Long-form atlas: one row per (parcel, vertex); ``ordinal`` is the parcel's position.
ATLAS_SCHEMA = T.StructType(
    [
        T.StructField("parcel", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("vertex", T.IntegerType()),
    ]
)

DELIVERABLE_COLUMNS = [
    "image_id",
    "image_blob",
    "image_mime",
    "captured_at",
    "compass_angle",
    "camera_type",
    "geom",
    "brain_activity",
    "top_regions",
]

# Landed capture page: {"request": "...", "data": [ {...}, ... ], "paging": {"next": "..."}}; request may be missing
PAGE_DDL = "request string, data array<variant>, paging struct<next: string>"
