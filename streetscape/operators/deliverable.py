"""Deliverable join/projection, preview, stage counts and run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from streetscape.functions.geo import point_wkb, wkb_to_wkt
from streetscape.operators.aoi import within_bbox
from streetscape.operators.store import drop_sentinel, latest_keys
from streetscape.schemas import DELIVERABLE_COLUMNS

CRS = "OGC:CRS84"


def _residual_match(*pairs: tuple[str, str]) -> Column:
    """Row-identity match kept as a residual join condition: written as equalities, Catalyst
    would make the file/row columns join keys and partition on them, forcing the payload to be
    shuffled again for the next join on ``image_id``."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & F.coalesce(F.col(a) == F.col(b), F.lit(False))
    return cond


def deliverable_rows(images: DataFrame, scores: DataFrame, bbox: Row | None = None, dedupe: bool = True) -> DataFrame:
    """J5 + G6 + G7 + P10: images inside the bbox joined (inner, on image_id) with their scores,
    projected to the 9 deliverable columns; ``geom`` is a WKB point (x = lon).

    ``dedupe`` keeps the latest row per id on both sides (the reference fans out duplicates;
    ``dedupe=False`` reproduces that). The bbox predicate reaches the Parquet scan.

    Plan shape: the winners of both sides are found on key columns only, paired by id, and the
    two payloads (blobs, vectors) are each joined once on ``image_id``; the second join reuses
    the first one's partitioning, so no payload crosses the network twice.
    """
    imgs = drop_sentinel(images)
    if bbox is not None:
        imgs = within_bbox(imgs, bbox)
    sc = drop_sentinel(scores)
    img_cols = ["image_id", "image_blob", "image_mime", "captured_at", "compass_angle", "camera_type", "lon", "lat"]
    img_keyed = dedupe and "source_file" in imgs.columns
    sc_keyed = dedupe and "source_file" in sc.columns
    if not img_keyed:
        img_payload = imgs.select(*img_cols)
        pairs = None
    else:
        pairs = latest_keys(imgs.select("image_id", "downloaded_at", "source_file", "row_index")).select(
            "image_id", F.col("source_file").alias("__if"), F.col("row_index").alias("__ir")
        )
    if sc_keyed:
        sc_keys = sc.select(
            "image_id",
            F.coalesce("inferred_at", F.lit("1970-01-01").cast("timestamp_ntz")).alias("__at"),
            F.col("source_file").alias("__sf"),
            F.col("row_index").alias("__sr"),
        )
        sc_win = latest_keys(sc_keys, ["__at", "__sf", "__sr"]).drop("__at")
        pairs = sc_win if pairs is None else pairs.join(sc_win, "image_id", "inner")
    if img_keyed:
        img_payload = (
            imgs.select(*img_cols, "source_file", "row_index")
            .join(pairs, "image_id", "inner")
            .filter(_residual_match(("source_file", "__if"), ("row_index", "__ir")))
            .drop("source_file", "row_index", "__if", "__ir")
        )
    elif pairs is not None:
        img_payload = img_payload.join(pairs, "image_id", "inner")
    if sc_keyed:
        sc_payload = sc.select(
            "image_id", "brain_activity", "top_regions", F.col("source_file").alias("__s_file"), F.col("row_index").alias("__s_row")
        )
        joined = img_payload.join(sc_payload, "image_id", "inner").filter(
            _residual_match(("__s_file", "__sf"), ("__s_row", "__sr"))
        )
    else:
        joined = img_payload.join(sc.select("image_id", "brain_activity", "top_regions"), "image_id", "inner")
    return joined.withColumn("geom", point_wkb("lon", "lat")).select(*DELIVERABLE_COLUMNS)


def preview(deliverable: DataFrame, n: int = 10, crs: str = CRS) -> DataFrame:
    """First ``n`` rows by (captured_at, image_id): id, time, WKT, CRS, compass, camera,
    mime, blob length, vector length, top regions."""
    return (
        deliverable.select(
            "image_id",
            "captured_at",
            wkb_to_wkt("geom").alias("geom_wkt"),
            F.lit(crs).alias("crs"),
            "compass_angle",
            "camera_type",
            "image_mime",
            F.octet_length("image_blob").alias("blob_bytes"),
            F.size("brain_activity").alias("n_activity"),
            "top_regions",
        )
        .orderBy("captured_at", "image_id")
        .limit(n)
    )


STAGES = ("candidates", "cached", "downloaded", "inference_cache_hit", "inferred", "written")


def stage_counts(tagged: DataFrame, stage_col: str = "stage") -> DataFrame:
    """One row of counts per stage from one DataFrame of (image_id, stage) tags."""
    return tagged.agg(*[F.count_if(F.col(stage_col) == s).cast("bigint").alias(s) for s in STAGES])


def run_summary(counts: dict[str, int], timings: dict[str, float], verify: dict, out: str) -> dict:
    """K6: the run's summary record (counts per stage, timings, verify result, output path)."""
    return {"counts": dict(counts), "timings_s": dict(timings), "verify": dict(verify), "out": out}
