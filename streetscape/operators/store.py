"""Image/score store operators: row building, id joins, latest row per id, stats, working set.

Payloads (blobs, vectors) stay out of shuffles: id work runs on key columns only and payloads
are attached last, through a broadcast of the (size-checked) winning keys when possible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetscape.operators.sizing import DEFAULT_BROADCAST_BYTES, is_small
from streetscape.schemas import IMAGE_MIME, IMAGE_SOURCE, SENTINEL_ID


def drop_sentinel(df: DataFrame, col: str = "image_id") -> DataFrame:
    """``image_id <> '__sentinel__'`` (also drops NULL ids)."""
    return df.filter(F.col(col) != F.lit(SENTINEL_ID))


def build_image_rows(
    captures: DataFrame,
    blobs: DataFrame,
    bbox_query: str | Column,
    downloaded_at: Column | None = None,
    source: str = IMAGE_SOURCE,
    mime: str = IMAGE_MIME,
) -> DataFrame:
    """Captures (CAPTURE columns) joined with blobs (image_id, image_blob) -> store rows.

    sha256 hex and byte length of the blob, epoch ms -> naive UTC ``captured_at``,
    ``downloaded_at`` (default: now, UTC), constant mime and source.
    """
    q = F.lit(bbox_query) if isinstance(bbox_query, str) else bbox_query
    now = downloaded_at if downloaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    joined = captures.join(blobs.select("image_id", "image_blob"), "image_id", "inner")
    return joined.select(
        F.col("image_id").cast("string").alias("image_id"),
        F.col("image_blob"),
        F.sha2(F.col("image_blob"), 256).alias("image_sha256"),
        F.lit(mime).alias("image_mime"),
        F.octet_length("image_blob").cast("bigint").alias("image_bytes"),
        F.col("width").cast("int").alias("image_width"),
        F.col("height").cast("int").alias("image_height"),
        now.alias("downloaded_at"),
        F.lit(source).alias("source"),
        q.alias("mapillary_bbox_query"),
        F.col("lon").cast("double").alias("lon"),
        F.col("lat").cast("double").alias("lat"),
        F.col("compass_angle").cast("double").alias("compass_angle"),
        F.timestamp_millis(F.col("captured_at_ms")).cast("timestamp_ntz").alias("captured_at"),
        F.col("camera_type"),
        F.col("is_pano"),
        F.col("sequence_id"),
        F.col("creator_id").cast("bigint").alias("creator_id"),
    )


def store_ids(store: DataFrame) -> DataFrame:
    """Distinct ids of a store (reads only the id column)."""
    return drop_sentinel(store.select("image_id")).distinct()


def _ids_present(candidates: DataFrame, store: DataFrame, broadcast_bytes: int) -> DataFrame | None:
    """Store ids that are also candidates, when the candidate id set is small: the store's id
    column is then filtered map-side by a broadcast hash join (the store is never shuffled).
    Returns None for a large candidate set (callers fall back to one sort-merge join)."""
    cand_ids = candidates.select("image_id").distinct()
    if not is_small(cand_ids, broadcast_bytes):
        return None
    return drop_sentinel(store.select("image_id")).join(F.broadcast(cand_ids), "image_id", "left_semi").distinct()


def new_images(candidates: DataFrame, store: DataFrame, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Candidates whose id is not in the store (left anti; arrival columns kept)."""
    present = _ids_present(candidates, store, broadcast_bytes)
    if present is None:
        present = drop_sentinel(store.select("image_id"))
    return candidates.join(present, "image_id", "left_anti")


def cached_images(candidates: DataFrame, store: DataFrame, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Candidates whose id is in the store (left semi)."""
    present = _ids_present(candidates, store, broadcast_bytes)
    if present is None:
        present = drop_sentinel(store.select("image_id"))
    return candidates.join(present, "image_id", "left_semi")


_ORDER_KEY = ["downloaded_at", "source_file", "row_index"]


def latest_keys(store: DataFrame, order_key: list[str] | None = None) -> DataFrame:
    """Winning (image_id, order key) per id: the latest ``downloaded_at``, ties broken by shard
    file name then row position. ``max(struct)`` is a partial aggregate, so a hot id is
    combined map-side and never lands whole in one task."""
    key = order_key or _ORDER_KEY
    agg = drop_sentinel(store.select("image_id", *key)).groupBy("image_id").agg(F.max(F.struct(*key)).alias("__k"))
    return agg.select("image_id", *[F.col(f"__k.{c}").alias(c) for c in key])


def winning_rows(df: DataFrame, winners: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``df`` that are their id's winner in ``winners`` (image_id + key columns).

    A store row is identified by (source_file, row_index) when the scan exposes them; the match
    is then an ``image_id`` join with the identity as a residual condition, so the output stays
    hash-partitioned by ``image_id`` alone (a following join on the id does not re-shuffle the
    payload) and a NULL ``downloaded_at`` cannot lose the winner. Without file info the key
    columns are compared null-safely.
    """
    ident = ["source_file", "row_index"] if {"source_file", "row_index"} <= set(df.columns) and {"source_file", "row_index"} <= set(key) else key
    w = winners.select("image_id", *[F.col(c).alias(f"__w_{c}") for c in ident])
    if ident == ["source_file", "row_index"]:
        cond = F.lit(True)
        for c in ident:
            cond = cond & F.coalesce(F.col(c) == F.col(f"__w_{c}"), F.lit(False))
        return df.join(w, "image_id", "inner").filter(cond).drop(*[f"__w_{c}" for c in ident])
    cond = None
    for c in ident:
        e = F.col(c).eqNullSafe(F.col(f"__w_{c}"))
        cond = e if cond is None else cond & e
    return df.join(w, "image_id", "inner").filter(cond).drop(*[f"__w_{c}" for c in ident])


def latest_rows(store: DataFrame, broadcast_bytes: int | None = None, order_key: list[str] | None = None) -> DataFrame:
    """The last written row of every id (keys aggregated first, full rows attached by join)."""
    key = order_key or _ORDER_KEY
    winners = latest_keys(store, key)
    if broadcast_bytes is not None and is_small(winners, broadcast_bytes):
        winners = F.broadcast(winners)
    return winning_rows(drop_sentinel(store), winners, key)


def store_index(store: DataFrame) -> DataFrame:
    """Skinny index of the latest rows, no blobs: id, downloaded_at, sha256, bytes, file."""
    slim = store.select("image_id", "downloaded_at", "image_sha256", "image_bytes", "source_file", "row_index")
    return latest_rows(slim).drop("row_index")


def store_stats(store: DataFrame) -> DataFrame:
    """A1: one row: n_rows, n_shards (data files), total_bytes, oldest/newest captured_at."""
    return drop_sentinel(store).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("source_file").alias("n_shards"),
        F.coalesce(F.sum("image_bytes"), F.lit(0)).cast("bigint").alias("total_bytes"),
        F.min("captured_at").alias("oldest_captured_at"),
        F.max("captured_at").alias("newest_captured_at"),
    )


def working_set(
    candidates: DataFrame,
    store: DataFrame,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    with_blob: bool = True,
) -> DataFrame:
    """J4 + P9: every candidate with its latest store row's payload, or a drop reason.

    Output: candidate columns + image_sha256, image_bytes, [image_blob], ``drop_reason`` in
    (NULL, 'not_in_cache', 'null_blob'). Steps: store keys restricted to candidate ids -> latest
    key per id (key-only shuffle) -> payload fetched for the winners only (broadcast of the
    winner keys when small, so blobs are filtered map-side and never shuffled) -> left join.
    """
    keys = drop_sentinel(store.select("image_id", *_ORDER_KEY))
    cand_ids = candidates.select("image_id").distinct()
    small = is_small(cand_ids, broadcast_bytes)
    keys = keys.join(F.broadcast(cand_ids) if small else cand_ids, "image_id", "left_semi")
    winners = latest_keys(keys)
    if small:
        winners = F.broadcast(winners)
    payload_cols = ["image_sha256", "image_bytes"] + (["image_blob"] if with_blob else [])
    payload = (
        winning_rows(
            drop_sentinel(store.select("image_id", *_ORDER_KEY, *payload_cols, F.col("image_blob").isNull().alias("__null_blob"))),
            winners,
            _ORDER_KEY,
        )
        .drop(*_ORDER_KEY)
        .withColumn("__hit", F.lit(True))
    )
    joined = candidates.join(payload, "image_id", "left")
    reason = F.when(F.col("__hit").isNull(), F.lit("not_in_cache")).when(F.col("__null_blob"), F.lit("null_blob"))
    return joined.withColumn("drop_reason", reason).drop("__hit", "__null_blob")


def audit_drops(
    raw_candidates: DataFrame,
    bbox,
    store: DataFrame,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Every dropped candidate with a reason: ``out_of_bbox`` (failed the re-check),
    ``not_in_cache``, ``null_blob``. Kept rows are not listed."""
    from streetscape.operators.aoi import inside

    flagged = raw_candidates.withColumn("__in", F.coalesce(inside("lon", "lat", bbox), F.lit(False)))
    outside = flagged.filter(~F.col("__in")).drop("__in").withColumn("drop_reason", F.lit("out_of_bbox"))
    ws = working_set(flagged.filter(F.col("__in")).drop("__in"), store, broadcast_bytes, with_blob=False)
    ws = ws.filter(F.col("drop_reason").isNotNull()).drop("image_sha256", "image_bytes")
    return outside.unionByName(ws)


def hit_miss(working: DataFrame, scores: DataFrame, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """Split the working set into (hits, misses) against the score store."""
    return cached_images(working, scores, broadcast_bytes), new_images(working, scores, broadcast_bytes)
