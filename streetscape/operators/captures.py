"""Capture records -> clean candidate rows (parse, drop incomplete, pano and time filters, caps).

Records are VARIANT values (one JSON object per image, as found in the ``data`` array of a
landed page). Parsing is native Spark (``try_variant_get``); a record that the reference would
abort on (no id, a field that does not cast) becomes a reject row instead.
"""

from __future__ import annotations

import warnings
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetscape.functions.timeparse import ntz_literal, parse_utc_bound

CAPTURE_COLUMNS = [
    "image_id",
    "lon",
    "lat",
    "compass_angle",
    "captured_at_ms",
    "camera_type",
    "is_pano",
    "sequence_id",
    "creator_id",
    "width",
    "height",
    "thumb_2048_url",
]


def _get(rec: str, path: str, typ: str) -> Column:
    return F.expr(f"try_variant_get({rec}, '{path}', '{typ}')")


def _present(rec: str, path: str) -> Column:
    """Field exists and is not JSON null."""
    v = F.expr(f"try_variant_get({rec}, '{path}', 'variant')")
    return v.isNotNull() & ~F.expr(f"is_variant_null(try_variant_get({rec}, '{path}', 'variant'))")


def _kind(rec: str, path: str) -> Column:
    return F.expr(f"schema_of_variant(try_variant_get({rec}, '{path}', 'variant'))")


def parse_captures(records: DataFrame, record: str = "record", is_pano: bool | None = False) -> DataFrame:
    """Variant records -> capture rows plus ``reject_reason`` (NULL = kept).

    Rules: coordinates[0/1] give lon/lat; sequence is a string, or an object's ``id``; creator is
    ``creator.id`` when ``creator`` is an object, else the flat ``creator_id``; a missing
    ``is_pano`` is false. Rejects, first match wins: ``bad_record`` (no id or a failed cast),
    ``no_coordinates``, ``pano_mismatch`` (when ``is_pano`` is not None), ``no_captured_at``,
    ``no_url``.
    """
    r = record
    seq_kind = _kind(r, "$.sequence")
    creator_is_obj = _kind(r, "$.creator").startswith("OBJECT")
    cols = {
        "image_id": _get(r, "$.id", "string"),
        "lon": _get(r, "$.computed_geometry.coordinates[0]", "double"),
        "lat": _get(r, "$.computed_geometry.coordinates[1]", "double"),
        "compass_angle": _get(r, "$.computed_compass_angle", "double"),
        "captured_at_ms": _get(r, "$.captured_at", "bigint"),
        "camera_type": _get(r, "$.camera_type", "string"),
        "is_pano": F.coalesce(_get(r, "$.is_pano", "boolean"), F.lit(False)),
        "sequence_id": F.when(seq_kind.startswith("OBJECT"), _get(r, "$.sequence.id", "string"))
        .when(seq_kind == "STRING", _get(r, "$.sequence", "string")),
        "creator_id": F.when(creator_is_obj, _get(r, "$.creator.id", "bigint")).otherwise(_get(r, "$.creator_id", "bigint")),
        "width": _get(r, "$.width", "int"),
        "height": _get(r, "$.height", "int"),
        "thumb_2048_url": _get(r, "$.thumb_2048_url", "string"),
    }
    # A field present but not castable is a bad record (the reference raises on these).
    checks = [
        ("$.id", cols["image_id"]),
        ("$.computed_geometry.coordinates[0]", cols["lon"]),
        ("$.computed_geometry.coordinates[1]", cols["lat"]),
        ("$.computed_compass_angle", cols["compass_angle"]),
        ("$.captured_at", cols["captured_at_ms"]),
        ("$.width", cols["width"]),
        ("$.height", cols["height"]),
    ]
    bad = ~_present(r, "$.id")
    for path, value in checks:
        bad = bad | (_present(r, path) & value.isNull())
    bad = bad | (creator_is_obj & _present(r, "$.creator.id") & cols["creator_id"].isNull())
    bad = bad | (~creator_is_obj & _present(r, "$.creator_id") & cols["creator_id"].isNull())

    passthrough = [c for c in records.columns if c != record]
    out = records.select(*passthrough, *[v.alias(k) for k, v in cols.items()], bad.alias("__bad"))
    reason = (
        F.when(F.col("__bad"), F.lit("bad_record"))
        .when(F.col("lon").isNull() | F.col("lat").isNull(), F.lit("no_coordinates"))
    )
    if is_pano is not None:
        reason = reason.when(F.col("is_pano") != F.lit(is_pano), F.lit("pano_mismatch"))
    reason = reason.when(F.col("captured_at_ms").isNull(), F.lit("no_captured_at")).when(
        F.coalesce(F.length("thumb_2048_url"), F.lit(0)) == 0, F.lit("no_url")
    )
    return out.withColumn("reject_reason", reason).drop("__bad")


def drop_incomplete(parsed: DataFrame) -> DataFrame:
    """Keep parsed rows without a reject reason."""
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def filter_pano(df: DataFrame, is_pano: bool | None) -> DataFrame:
    """Tri-state: None keeps all rows; a missing flag counts as false."""
    if is_pano is None:
        return df
    return df.filter(F.coalesce(F.col("is_pano"), F.lit(False)) == F.lit(is_pano))


def with_captured_at(df: DataFrame, ms_col: str = "captured_at_ms", out: str = "captured_at") -> DataFrame:
    """Epoch milliseconds -> naive UTC timestamp."""
    return df.withColumn(out, F.timestamp_millis(F.col(ms_col)).cast("timestamp_ntz"))


def _bound(given: str | datetime | None) -> datetime | None:
    parsed = parse_utc_bound(given) if isinstance(given, str) else given
    if given and parsed is None:
        warnings.warn(f"{given!r} is no ISO date or time; captures aren't bounded by it", stacklevel=3)
    return parsed


def filter_captured(
    df: DataFrame,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    col: str = "captured_at",
) -> DataFrame:
    """``start <= col <= end`` (each bound optional, whole-second UTC).

    Text bounds are ISO dates or datetimes; an unparseable bound means no bound, with a warning.
    """
    lo, hi = (_bound(x) for x in (start, end))
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= ntz_literal(lo.replace(microsecond=0)))
    if hi is not None:
        cond = cond & (F.col(col) <= ntz_literal(hi.replace(microsecond=0)))
    return df.filter(cond)


def cap_candidates(df: DataFrame, limit: int | None, order: tuple[str, ...] = ("page", "pos")) -> DataFrame:
    """First ``limit`` rows in arrival order (page, then position in the page; NULLs first); all
    rows for None or a limit below 1. The order of the result isn't defined.

    One way for every size and type of page: the rows of each page are counted, the page in which the
    limit falls is found by narrowing a histogram between ``CAP_BINS`` of the pages a round, whole
    pages before it are taken by a filter, and only rows of that page are ranked, by a top-N.
    """
    if limit is None or limit < 1:
        return df
    page, rest = order[0], order[1:]
    sizes = df.groupBy(F.col(page).alias("page")).agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total, none = sizes.agg(F.sum("n"), F.coalesce(F.sum(F.when(F.col("page").isNull(), F.col("n"))), F.lit(0))).first()
        if total is None or total <= limit:
            return df
        if none >= limit:
            return _first_of_page(df.where(F.col(page).isNull()), limit, rest)
        cut, left = _cut_page(sizes.where("page IS NOT NULL"), limit - none)
    finally:
        sizes.unpersist()
    before = df.where(F.col(page).isNull() | (F.col(page) < cut))
    return before.unionAll(_first_of_page(df.where(F.col(page) == cut), left, rest))


CAP_BINS = 256


def _cut_page(sizes: DataFrame, left: int) -> tuple:
    """The page of (page, n) that holds the ``left``-th row in page order, and the row's rank in it."""
    while True:
        head = sizes.orderBy("page").limit(CAP_BINS + 1).collect()
        for page, n in head:
            if n >= left:
                return page, left
            left -= n
        sizes = sizes.where(F.col("page") > F.lit(head[-1][0]))
        splits = sorted(r[0] for r in sizes.orderBy(F.xxhash64("page"), "page").limit(CAP_BINS).collect())
        bin_ = F.size(F.filter(F.array(*[F.lit(x) for x in splits]), lambda x: x < F.col("page")))
        counts = dict(sizes.groupBy(bin_.alias("bin")).agg(F.sum("n")).collect())  # CAP_BINS + 1 rows
        for k in sorted(counts):
            if counts[k] >= left:
                break
            left -= counts[k]
        if k:
            sizes = sizes.where(F.col("page") > F.lit(splits[k - 1]))
        if k < len(splits):
            sizes = sizes.where(F.col("page") <= F.lit(splits[k]))


def _first_of_page(rows: DataFrame, n: int, order: tuple[str, ...]) -> DataFrame:
    return (rows.orderBy(*order) if order else rows).limit(n)


def select_candidates(
    parsed: DataFrame,
    bbox,
    max_images: int | None = None,
    order: tuple[str, ...] = ("page", "pos"),
    dedupe: bool = False,
) -> DataFrame:
    """The candidate list: first cap in arrival order, inclusive bbox re-check, second cap. Without
    ``max_images`` (None or below 1) nothing is capped. With ``dedupe`` the first arrival of every
    id is kept (the reference keeps duplicates)."""
    from streetscape.operators.aoi import within_bbox

    kept = cap_candidates(within_bbox(cap_candidates(parsed, max_images, order), bbox), max_images, order)
    return first_arrival(kept, order) if dedupe else kept


def first_arrival(df: DataFrame, order: tuple[str, ...] = ("page", "pos"), key: str = "image_id") -> DataFrame:
    """The first row of every ``key`` in arrival order. ``min(struct(order..., rest...))`` is a
    partial aggregate: repeats of a hot id are combined map-side, never sorted in one task."""
    rest = [c for c in df.columns if c != key and c not in order]
    agg = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("__m"))
    return agg.select(key, *[F.col(f"__m.{c}").alias(c) for c in (*order, *rest)]).select(*df.columns)
