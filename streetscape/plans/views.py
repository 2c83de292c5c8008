"""Capture-like views over the driver's test tables (events, documents, embeddings).

The tables hold no images, so stand-ins are derived with plain column arithmetic; the oracle
SQL in ``plans.oracle`` builds the same views. Literals use exponent notation so both engines
compute in doubles. Every view grows with its table; nothing is sampled or capped.

    captures   events     image_id = event_id as text; lon = -0.1465 + (event_id % 1000) * 6.5e-6;
                          lat = 51.5405 + (user_id % 150) * 2e-5; captured_at = ts;
                          compass = value % 360; camera_type = event_type; is_pano = 'error';
                          sequence_id = user_id as text; creator_id = user_id; page/pos by event_id
    blobs      documents  UTF-8 bytes of text, image_id = doc_id as text
    store      captures x blobs: shard 1 = every third id (earlier runs),
                          shard 2 = the 'error' rows of shard 1 downloaded again a day later
    segments   embeddings image_id = vec_id div 5, segment_idx = vec_id % 5
    labels     embeddings side by vec_id parity, parcel from ``label``, vertex = 7 * vec_id % 11000
    atlas      16 test parcels x 4 vertices over 0..63
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.functions.timeparse import ntz_literal
from streetscape.operators.aoi import bbox_text, named_box
from streetscape.operators.store import build_image_rows

# Fixed values for the test atlas: parcel names in ordinal order, 4 vertices each.
TEST_PARCELS = ["V1", "V4", "V4t", "MT", "MST", "FFC", "PHA1", "PHA2", "PHA3", "PH", "PHT", "TE2p", "VVC", "STSdp", "45", "A5"]
VERTICES_PER_PARCEL = 4
# Label vertices run a little beyond a hemisphere, so that some fail the range check.
LABEL_VERTICES = 11_000

# A third of the captures, by id, was stored by earlier runs; the others are new whatever the data.
STORED_EACH = 3
SHARD1_AT = datetime(2024, 1, 16)
SHARD2_AT = datetime(2024, 1, 17)
SCORED_AT = datetime(2024, 2, 1)
CAMDEN = named_box("camden")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("image_id"),
        (F.lit(-0.1465) + (F.col("event_id") % 1000) * F.lit(6.5e-6)).alias("lon"),
        (F.lit(51.5405) + (F.col("user_id") % 150) * F.lit(2e-5)).alias("lat"),
        (F.col("value") % 360).alias("compass_angle"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("captured_at_ms"),
        F.col("ts").alias("captured_at"),
        F.col("event_type").alias("camera_type"),
        (F.col("event_type") == "error").alias("is_pano"),
        F.col("user_id").cast("string").alias("sequence_id"),
        F.col("user_id").alias("creator_id"),
        F.lit(2048).alias("width"),
        F.lit(1536).alias("height"),
        F.concat(F.lit("https://img.example/"), F.col("event_id").cast("string"), F.lit(".jpg")).alias("thumb_2048_url"),
        F.floor(F.col("event_id") / 1000).alias("page"),
        (F.col("event_id") % 1000).alias("pos"),
    )


def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = table(spark, sf_dir, "documents")
    return doc.select(F.col("doc_id").cast("string").alias("image_id"), F.encode("text", "UTF-8").alias("image_blob"))


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-shard image store (18 columns + source_file, row_index)."""
    caps = captures(spark, sf_dir).filter(F.col("image_id").cast("bigint") % STORED_EACH == 0)
    rows = build_image_rows(caps, blobs(spark, sf_dir), bbox_text(CAMDEN), ntz_literal(SHARD1_AT))
    s1 = rows.withColumn("source_file", F.lit("shard-1.parquet")).withColumn("row_index", F.col("image_id").cast("bigint"))
    s2 = (
        s1.filter(F.col("camera_type") == "error")
        .withColumn("downloaded_at", ntz_literal(SHARD2_AT))
        .withColumn("source_file", F.lit("shard-2.parquet"))
    )
    return s1.unionByName(s2)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    image_id = F.floor(F.col("vec_id") / 5).cast("string")
    return emb.select(
        image_id.alias("image_id"),
        F.concat(F.lit("clip_"), image_id).alias("timeline"),
        (F.col("vec_id") % 5).cast("int").alias("segment_idx"),
        F.col("embedding").alias("activity"),
    )


def atlas(spark: SparkSession) -> DataFrame:
    """Long test atlas (parcel, ordinal, vertex). A lookup table, broadcast by its users."""
    rows = [(p, i, i * VERTICES_PER_PARCEL + j) for i, p in enumerate(TEST_PARCELS) for j in range(VERTICES_PER_PARCEL)]
    return spark.createDataFrame(rows, "parcel string, ordinal int, vertex int")


def parcel_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(TEST_PARCELS)), "ordinal int, name string")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw label rows (name, hemi, vertex): ``L_<parcel>_ROI-lh`` / ``R_<parcel>_ROI-rh``."""
    emb = table(spark, sf_dir, "embeddings")
    names = F.array(*[F.lit(p) for p in TEST_PARCELS])
    left = F.col("vec_id") % 2 == 0
    hemi = F.when(left, F.lit("lh")).otherwise(F.lit("rh"))
    parcel = F.element_at(names, ((F.col("label") + F.col("vec_id")) % len(TEST_PARCELS) + 1).cast("int"))
    name = F.concat(F.when(left, F.lit("L_")).otherwise(F.lit("R_")), parcel, F.lit("_ROI-"), hemi)
    return emb.select(name.alias("name"), hemi.alias("hemi"), (F.col("vec_id") * 7 % LABEL_VERTICES).alias("vertex"))
