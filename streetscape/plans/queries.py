"""The driver's queries: one per operator group, each over the whole test tables.

Every float output is rounded (coordinates to 9 places, scores to 6) and nested values are
exploded, so that Spark and the DuckDB oracle compare scalar by scalar.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.functions.geo import geometry_type, point_wkb
from streetscape.operators import aoi as G
from streetscape.operators import atlas as AT
from streetscape.operators import captures as C
from streetscape.operators import deliverable as D
from streetscape.operators import scoring as M
from streetscape.operators import store as ST
from streetscape.operators import summary as S
from streetscape.plans import views as V

CAMDEN = G.named_box("camden")
R9 = 9


def _r(c, n=R9):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


# ---------------------------------------------------------------- AOI / geometry


def q_square_bbox(spark: SparkSession, d: str) -> DataFrame:
    caps = V.captures(spark, d).withColumn("bbox", G.square_bbox("lon", "lat", 300.0))
    return caps.select("image_id", *[_r(F.col("bbox")[k]).alias(k) for k in ("west", "south", "east", "north")])


def q_bbox_text(spark: SparkSession, d: str) -> DataFrame:
    caps = V.captures(spark, d).withColumn("bbox", G.square_bbox("lon", "lat", 300.0))
    return caps.select("image_id", G.bbox_text("bbox").alias("bbox_text"))


def q_bbox_area_guard(spark: SparkSession, d: str) -> DataFrame:
    caps = V.captures(spark, d).withColumn("bbox", G.square_bbox("lon", "lat", F.col("compass_angle") * 100.0))
    return G.bbox_guard(caps).select("image_id", _r("area", 12).alias("area"), "within_limit")


def q_tile_aoi(spark: SparkSession, d: str) -> DataFrame:
    caps = V.captures(spark, d).withColumn("bbox", G.square_bbox("lon", "lat", F.col("compass_angle") * 100.0))
    tiles = G.tile_aoi(caps.select("image_id", "bbox"))
    return tiles.select(
        "image_id", "n_tiles", "tile_row", "tile_col", *[_r(F.col("tile")[k]).alias(k) for k in ("west", "south", "east", "north")]
    )


def q_within_bbox(spark: SparkSession, d: str) -> DataFrame:
    return G.within_bbox(V.captures(spark, d), CAMDEN).select("image_id", "lon", "lat")


def _sequence_aois(caps: DataFrame) -> DataFrame:
    seq = caps.groupBy("sequence_id").agg(F.min("lon").alias("lon0"), F.min("lat").alias("lat0"))
    box = G.square_bbox("lon0", "lat0", 30.0)
    return seq.select(
        F.concat(F.lit("seq-"), F.col("sequence_id")).alias("aoi"),
        box["west"].alias("west"),
        box["south"].alias("south"),
        box["east"].alias("east"),
        box["north"].alias("north"),
    )


def q_multi_aoi_join(spark: SparkSession, d: str) -> DataFrame:
    caps = V.captures(spark, d)
    aois = G.aois_df(spark).withColumnRenamed("name", "aoi").unionByName(_sequence_aois(caps))
    return G.join_aoi(caps.select("image_id", "lon", "lat"), aois).select("aoi", "image_id")


def q_point_wkb(spark: SparkSession, d: str) -> DataFrame:
    caps = G.within_bbox(V.captures(spark, d), CAMDEN)
    return caps.select("image_id", F.hex(point_wkb("lon", "lat")).alias("geom_hex"))


# ---------------------------------------------------------------- captures


def capture_records(spark: SparkSession, d: str) -> DataFrame:
    """Landed-page records rebuilt from events as JSON text with every shape the parser must
    handle: id as number or string, sequence as string / object / absent, creator as object
    (with or without id) or flat, is_pano absent, missing coordinates / time / URL, bad width."""
    ev = V.table(spark, d, "events")
    eid, uid, et, val = F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("value")
    lon = F.lit(-0.1465) + (eid % 1000) * F.lit(6.5e-6)
    lat = F.lit(51.5405) + (uid % 150) * F.lit(2e-5)
    s = lambda c: c.cast("string")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    parts = [
        F.when(val > 489, F.lit(None)).when(eid % 2 == 0, F.concat(F.lit('"id":'), s(eid))).otherwise(F.concat(F.lit('"id":'), q(s(eid)))),
        F.when((et == "view") & (val < 5), F.lit(None)).otherwise(
            F.concat(F.lit('"computed_geometry":{"type":"Point","coordinates":['), s(lon), F.lit(","), s(lat), F.lit("]}"))
        ),
        F.when((et == "signup") & (val < 5), F.lit(None)).otherwise(F.concat(F.lit('"captured_at":'), s(F.unix_millis(F.col("ts").cast("timestamp"))))),
        F.when(et == "click", F.lit('"computed_compass_angle":null')).otherwise(F.concat(F.lit('"computed_compass_angle":'), s(val % 360))),
        F.concat(F.lit('"camera_type":'), q(et)),
        F.when(uid % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit('"is_pano":'), F.when(et == "error", F.lit("true")).otherwise(F.lit("false")))),
        F.when((et == "purchase") & (val < 5), F.lit(None))
        .when(uid % 2 == 0, F.concat(F.lit('"sequence":'), q(s(uid))))
        .otherwise(F.concat(F.lit('"sequence":{"id":'), q(s(uid)), F.lit("}"))),
        F.when(uid % 4 == 0, F.concat(F.lit('"creator":{"id":'), s(uid), F.lit(',"username":"u"}')))
        .when(uid % 4 == 1, F.lit('"creator":{"username":"u"}'))
        .otherwise(F.concat(F.lit('"creator_id":'), s(uid))),
        F.when((val >= 100) & (val < 101), F.lit('"width":"wide"')).otherwise(F.lit('"width":2048')),
        F.lit('"height":1536'),
        F.when((et == "purchase") & (val < 10), F.lit('"thumb_2048_url":""')).otherwise(
            F.concat(F.lit('"thumb_2048_url":"https://img.example/'), s(eid), F.lit('.jpg"'))
        ),
    ]
    body = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return ev.select(F.floor(eid / 1000).alias("page"), (eid % 1000).alias("pos"), body.alias("record_text"))


def q_parse_captures(spark: SparkSession, d: str) -> DataFrame:
    records = capture_records(spark, d).select("page", "pos", F.parse_json("record_text").alias("record"))
    parsed = C.parse_captures(records, is_pano=False)
    return parsed.select("page", "pos", *C.CAPTURE_COLUMNS, "reject_reason")


def q_filter_pano(spark: SparkSession, d: str) -> DataFrame:
    return C.filter_pano(V.captures(spark, d), False).select("image_id", "camera_type")


def q_filter_captured(spark: SparkSession, d: str) -> DataFrame:
    caps = C.filter_captured(V.captures(spark, d), "2024-01-08", "2024-01-21T12:00:00Z")
    return caps.select("image_id", "captured_at")


def q_cap_candidates(spark: SparkSession, d: str) -> DataFrame:
    return C.select_candidates(V.captures(spark, d), CAMDEN, max_images=1000).select("image_id", "lon", "lat")


# ---------------------------------------------------------------- stores


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return G.within_bbox(V.captures(spark, d), CAMDEN)


def q_build_image_rows(spark: SparkSession, d: str) -> DataFrame:
    caps = V.captures(spark, d)
    day_later = F.timestamp_millis(F.col("captured_at_ms") + F.lit(86_400_000)).cast("timestamp_ntz")
    rows = ST.build_image_rows(caps, V.blobs(spark, d), G.bbox_text(CAMDEN), day_later)
    return rows.drop("image_blob")


def q_new_images(spark: SparkSession, d: str) -> DataFrame:
    return ST.new_images(_candidates(spark, d), V.store(spark, d)).select("image_id")


def q_cached_images(spark: SparkSession, d: str) -> DataFrame:
    return ST.cached_images(_candidates(spark, d), V.store(spark, d)).select("image_id")


def q_id_set_ops(spark: SparkSession, d: str) -> DataFrame:
    cand = _candidates(spark, d).select("image_id")
    ids = ST.store_ids(V.store(spark, d))
    new = cand.subtract(ids).withColumn("side", F.lit("new"))
    both = cand.intersect(ids).withColumn("side", F.lit("cached"))
    return new.unionByName(both)


def q_working_set(spark: SparkSession, d: str) -> DataFrame:
    ws = ST.working_set(_candidates(spark, d), V.store(spark, d), with_blob=False)
    return ws.select("image_id", "image_sha256", "image_bytes", "drop_reason")


def q_audit_drops(spark: SparkSession, d: str) -> DataFrame:
    return ST.audit_drops(V.captures(spark, d), CAMDEN, V.store(spark, d)).select("image_id", "drop_reason")


def q_latest_rows(spark: SparkSession, d: str) -> DataFrame:
    return ST.latest_rows(V.store(spark, d)).select("image_id", "downloaded_at", "source_file", "image_sha256")


def q_store_index(spark: SparkSession, d: str) -> DataFrame:
    return ST.store_index(V.store(spark, d))


def q_store_stats(spark: SparkSession, d: str) -> DataFrame:
    return ST.store_stats(V.store(spark, d))


def q_union_by_name(spark: SparkSession, d: str) -> DataFrame:
    st = V.store(spark, d)
    wide = st.filter(F.col("source_file") == "shard-1.parquet")
    narrow = st.filter(F.col("source_file") == "shard-2.parquet").drop("image_width", "image_height")
    u = wide.unionByName(narrow, allowMissingColumns=True)
    return u.select("image_id", "source_file", "image_width", "image_height")


# ---------------------------------------------------------------- summaries


def _collapsed(spark: SparkSession, d: str, mode: str = "mean") -> DataFrame:
    return S.collapse_segments(V.segments(spark, d), mode).select("image_id", "brain_activity")


def _vector_rows(vectors: DataFrame) -> DataFrame:
    return S.explode_vector(vectors, "brain_activity").select("image_id", "pos", F.round(F.col("value").cast("double"), 6).alias("value"))


def q_collapse_mean(spark: SparkSession, d: str) -> DataFrame:
    return _vector_rows(_collapsed(spark, d))


def q_collapse_max(spark: SparkSession, d: str) -> DataFrame:
    return _vector_rows(_collapsed(spark, d, "max"))


def q_parcel_means(spark: SparkSession, d: str) -> DataFrame:
    pm = S.parcel_means(_collapsed(spark, d), V.atlas(spark))
    return pm.select("image_id", "parcel", F.round("mean", 6).alias("mean"))


def q_name_parcels(spark: SparkSession, d: str) -> DataFrame:
    named = S.name_parcels(_collapsed(spark, d), "brain_activity", V.parcel_names(spark))
    return named.select("image_id", "ordinal", "name", F.round(F.col("value").cast("double"), 6).alias("value"))


def q_alias_parcels(spark: SparkSession, d: str) -> DataFrame:
    """J6 over the merged parcels of the label rows."""
    return S.alias_parcels(AT.merge_labels(V.labels(spark, d)), AT.alias_map_df(spark)).select("alias", "parcel")


def q_alias_scores(spark: SparkSession, d: str) -> DataFrame:
    sc = S.alias_scores(_collapsed(spark, d), V.atlas(spark), AT.alias_map_df(spark), AT.alias_names())
    return sc.select("image_id", "alias", F.round("score", 6).alias("score"))


def q_top_regions(spark: SparkSession, d: str) -> DataFrame:
    tr = S.top_regions(_collapsed(spark, d), V.atlas(spark), AT.alias_map_df(spark), AT.alias_names(), 10)
    return tr.select("image_id", F.posexplode("top_regions").alias("rank0", "r")).select(
        "image_id", (F.col("rank0") + 1).alias("rank"), F.col("r.name").alias("name"), F.round(F.col("r.score").cast("double"), 6).alias("score")
    )


def q_label_means(spark: SparkSession, d: str) -> DataFrame:
    """S7 -> P13, P14, A9 -> A4 in one chain: raw labels to merged parcels to each image's parcel
    means, over the vertices that the vectors have."""
    pm = S.parcel_means(_collapsed(spark, d), AT.merge_labels(V.labels(spark, d)))
    return pm.select("image_id", "parcel", "ordinal", F.round("mean", 6).alias("mean"))


# ---------------------------------------------------------------- atlas


def q_merge_labels(spark: SparkSession, d: str) -> DataFrame:
    return AT.merge_labels(V.labels(spark, d)).select("parcel", "ordinal", "hemi", "vertex")


def q_alias_vertices(spark: SparkSession, d: str) -> DataFrame:
    av = AT.alias_vertices(AT.merge_labels(V.labels(spark, d)), AT.alias_map_df(spark))
    return av.select("alias", "n_parcels", "n_vertices", F.explode_outer("vertices").alias("vertex"))


def q_alias_atlas_json(spark: SparkSession, d: str) -> DataFrame:
    """K5 payload: one compact JSON object alias -> sorted vertex list."""
    av = AT.alias_vertices(AT.merge_labels(V.labels(spark, d)), AT.alias_map_df(spark))
    return AT.alias_atlas_json(av).withColumnRenamed("value", "alias_atlas")


# ---------------------------------------------------------------- segments


def vector_sum(vector: str = "brain_activity") -> F.Column:
    """A digest of a whole vector: the sum of its values, each times its place from 1."""
    weighted = F.transform(vector, lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), 3)


def region_text() -> F.Column:
    return F.array_join(F.transform("top_regions", lambda r: r["name"]), ",")


def region_sum() -> F.Column:
    scores = F.transform("top_regions", lambda r, i: r["score"].cast("double") * (i + 1))
    return F.round(F.aggregate(scores, F.lit(0.0), lambda a, x: a + x), 5)


def q_stack_segments(spark: SparkSession, d: str) -> DataFrame:
    st = M.stack_segments(V.segments(spark, d))
    return st.select("image_id", F.size("segments").cast("bigint").alias("n_segments"), vector_sum(F.flatten("segments")).alias("stack_sum"))


def q_attach_timeline(spark: SparkSession, d: str) -> DataFrame:
    """Model segments (tagged clip_<id>) matched back to the capture candidates."""
    seg = V.segments(spark, d).drop("image_id")
    return M.attach_timeline(seg, _candidates(spark, d)).select("image_id", "segment_idx")


def q_load_scores(spark: SparkSession, d: str) -> DataFrame:
    """Stored scores of the AOI candidates."""
    from streetscape.sources.stores import load_scores

    sc = load_scores(score_view(spark, d), _candidates(spark, d))
    return sc.select(
        "image_id",
        F.size("brain_activity").cast("bigint").alias("n_activity"),
        vector_sum().alias("activity_sum"),
        region_text().alias("regions"),
        region_sum().alias("region_sum"),
    )


# ---------------------------------------------------------------- frame plan


def q_pseudo_clip_plan(spark: SparkSession, d: str) -> DataFrame:
    return M.pseudo_clip_plan(V.captures(spark, d), target=64)


# ---------------------------------------------------------------- deliverable


def score_view(spark: SparkSession, d: str) -> DataFrame:
    """Score-store rows for every image with segments (M4 over the segments view)."""
    return M.postprocess_scores(
        V.segments(spark, d), V.atlas(spark), AT.alias_map_df(spark), AT.alias_names(), k=10, inferred_at=V.SCORED_AT
    )


def deliverable(spark: SparkSession, d: str) -> DataFrame:
    return D.deliverable_rows(V.store(spark, d), score_view(spark, d), CAMDEN)


def deliverable_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "image_id",
        "image_mime",
        "captured_at",
        "compass_angle",
        "camera_type",
        F.hex("geom").alias("geom_hex"),
        F.octet_length("image_blob").cast("bigint").alias("blob_bytes"),
        F.size("brain_activity").cast("bigint").alias("n_activity"),
        vector_sum().alias("activity_sum"),
        region_text().alias("regions"),
        region_sum().alias("region_sum"),
    )


def q_deliverable(spark: SparkSession, d: str) -> DataFrame:
    return deliverable_columns(deliverable(spark, d))


def q_preview(spark: SparkSession, d: str) -> DataFrame:
    pv = D.preview(deliverable(spark, d), 10)
    return pv.select(
        "image_id", "captured_at", "geom_wkt", "crs", F.col("blob_bytes").cast("bigint").alias("blob_bytes"), F.col("n_activity").cast("bigint").alias("n_activity")
    )


def q_geometry_types(spark: SparkSession, d: str) -> DataFrame:
    return deliverable(spark, d).select(geometry_type("geom").alias("geometry_type")).filter("geometry_type is not null").distinct()


def q_stage_counts(spark: SparkSession, d: str) -> DataFrame:
    """A11 over one pass of the pipeline on the views: per-candidate stage flags from key-only
    left joins (store ids, usable stored blobs, landed blobs, scored ids), the stand-in model on
    the misses, then one tagged count."""
    cand = _candidates(spark, d).select("image_id")
    st = V.store(spark, d)
    blobs = V.blobs(spark, d)

    def flag(ids: DataFrame, name: str) -> DataFrame:
        return ids.select("image_id").distinct().withColumn(name, F.lit(True))

    flags = (
        cand.join(flag(ST.store_ids(st), "in_store"), "image_id", "left")
        .join(flag(st.filter(F.col("image_blob").isNotNull()), "stored_ok"), "image_id", "left")
        .join(flag(blobs, "landed"), "image_id", "left")
        .join(flag(score_view(spark, d), "scored"), "image_id", "left")
        .fillna(False, subset=["in_store", "stored_ok", "landed", "scored"])
    )
    downloaded = ~F.col("in_store") & F.col("landed")
    working = (F.col("in_store") & F.col("stored_ok")) | downloaded
    flags = flags.withColumn("downloaded", downloaded).withColumn("hit", working & F.col("scored"))
    misses = flags.filter(working & ~F.col("scored")).join(blobs, "image_id", "inner")
    seg = M.score_images(misses.select("image_id", "image_blob"), lambda: M.ByteProbePredictor(fail_marker=None))
    inferred = flag(M.good_segments(seg), "inferred")
    flags = flags.join(inferred, "image_id", "left").fillna(False, subset=["inferred"])
    stages = F.array_compact(
        F.array(
            F.lit("candidates"),
            F.when(F.col("in_store"), F.lit("cached")),
            F.when(F.col("downloaded"), F.lit("downloaded")),
            F.when(F.col("hit"), F.lit("inference_cache_hit")),
            F.when(F.col("inferred"), F.lit("inferred")),
            F.when(F.col("hit") | F.col("inferred"), F.lit("written")),
        )
    )
    return D.stage_counts(flags.select("image_id", F.explode(stages).alias("stage")))


# ---------------------------------------------------------------- scoring, geo output, streaming


def q_score_images(spark: SparkSession, d: str) -> DataFrame:
    """M1-M3 with the stand-in predictor over every latest store row with a blob."""
    items = ST.latest_rows(V.store(spark, d)).select("image_id", "image_blob")
    seg = M.good_segments(M.score_images(items, lambda: M.ByteProbePredictor(fail_marker=None)))
    return seg.select(
        "image_id",
        "segment_idx",
        F.size("activity").cast("bigint").alias("n_values"),
        vector_sum("activity").alias("activity_sum"),
    )


def q_geo_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """K4 -> V1 -> S8: write the deliverable as GeoParquet, verify the footers, read it back."""
    from streetscape.session import shared_path
    from streetscape.sinks.geoparquet import verify_geo, write_geo
    from streetscape.sources.stores import scan_deliverable

    path = shared_path(spark, "deliverable")
    write_geo(deliverable(spark, d), path)
    verify_geo(spark, path)
    return deliverable_columns(scan_deliverable(spark, path))


def _ingest(spark: SparkSession, d: str) -> str:
    from streetscape.session import shared_path
    from streetscape.streaming.incremental import land_pages, stream_ingest

    root = shared_path(spark, "stream")
    land_pages(capture_records(spark, d), f"{root}/pages")
    q = stream_ingest(spark, f"{root}/pages", V.blobs(spark, d), f"{root}/images", f"{root}/ckpt-ingest", CAMDEN)
    q.awaitTermination()
    return root


def q_stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """T1 + T3: landed pages -> parse -> AOI -> anti join -> append; run twice, the second run
    (same pages again, fresh checkpoint) must add nothing."""
    from streetscape.sources.stores import scan_image_store
    from streetscape.streaming.incremental import stream_ingest

    root = _ingest(spark, d)
    again = stream_ingest(spark, f"{root}/pages", V.blobs(spark, d), f"{root}/images", f"{root}/ckpt-ingest-2", CAMDEN)
    again.awaitTermination()
    return scan_image_store(spark, f"{root}/images", with_file=False).select("image_id", "image_sha256", "image_bytes", "lon", "lat")


def q_stream_score(spark: SparkSession, d: str) -> DataFrame:
    """The ingested store streamed through the stand-in model into the score store."""
    from streetscape.sources.stores import scan_score_store
    from streetscape.streaming.incremental import stream_score

    root = _ingest(spark, d)
    q = stream_score(
        spark, f"{root}/images", f"{root}/scores", f"{root}/ckpt-score", V.atlas(spark), AT.alias_map_df(spark), AT.alias_names(),
        predictor_factory=lambda: M.ByteProbePredictor(fail_marker=None), max_files_per_trigger=4,
    )
    q.awaitTermination()
    sc = scan_score_store(spark, f"{root}/scores", with_file=False)
    return sc.select("image_id", F.size("brain_activity").cast("bigint").alias("n_activity"), vector_sum().alias("activity_sum"), region_text().alias("regions"))


def marked_blobs(spark: SparkSession, d: str) -> DataFrame:
    """Contents with a JPEG's marker; every seventh is without it, every eleventh fails in the model."""
    number = F.col("image_id").cast("bigint")
    marker = F.when(number % 7 == 0, F.unhex(F.lit("00000000"))).otherwise(F.unhex(F.lit("FFD8FFE0")))
    fails = F.when(number % 11 == 0, F.encode(F.lit("FAIL"), "UTF-8")).otherwise(F.unhex(F.lit("")))
    return V.blobs(spark, d).select("image_id", F.concat(marker, fails, F.col("image_blob")).alias("image_blob"))


def landed_run(spark: SparkSession, d: str, land=None):
    """A run's configuration over data landed from the tables: capture pages from events,
    JPEG-marked image files from documents (every seventh without the marker, every eleventh failing
    in the model), fresh stores. ``land``: what lands the images, one file each unless told."""
    from streetscape.plans.pipeline import RunConfig
    from streetscape.session import shared_path
    from streetscape.sinks.files import land_files
    from streetscape.streaming.incremental import land_pages

    root = shared_path(spark, "run")
    land_pages(capture_records(spark, d), f"{root}/pages")
    (land or land_files)(marked_blobs(spark, d), f"{root}/files")
    return RunConfig(
        pages_path=f"{root}/pages",
        images_path=f"{root}/files",
        image_store=f"{root}/images",
        score_store=f"{root}/scores",
        out_path=f"{root}/deliverable",
        atlas=V.atlas(spark),
        score_group=500,
        predictor_factory=lambda: M.ByteProbePredictor(fail_marker=b"\xff\xd8\xff\xe0FAIL"),
    )


def _pipeline(spark: SparkSession, d: str, land=None) -> tuple[str, dict]:
    """The whole incremental run (plans.pipeline.run): the output path and the summary."""
    from streetscape.plans.pipeline import run

    cfg = landed_run(spark, d, land)
    return cfg.out_path, run(spark, cfg)


def q_pipeline_run(spark: SparkSession, d: str) -> DataFrame:
    """The verified deliverable of a run, read back."""
    return _delivered(spark, _pipeline(spark, d)[0])


def _delivered(spark: SparkSession, path: str) -> DataFrame:
    from streetscape.sources.stores import scan_deliverable

    return scan_deliverable(spark, path).select(
        "image_id",
        "image_mime",
        "captured_at",
        "camera_type",
        F.hex("geom").alias("geom_hex"),
        F.octet_length("image_blob").cast("bigint").alias("blob_bytes"),
        F.size("brain_activity").cast("bigint").alias("n_activity"),
        vector_sum().alias("activity_sum"),
        region_text().alias("regions"),
    )


def q_run_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Everything a run dropped, with the stage and the reason."""
    summary = _pipeline(spark, d)[1]
    return spark.read.parquet(summary["rejects"]).select("stage", "image_id", F.split("reason", ":")[0].alias("reason"))


def q_geo_verify(spark: SparkSession, d: str) -> DataFrame:
    """The verification record of a written deliverable, and its CRS."""
    from streetscape.session import shared_path
    from streetscape.sinks.geoparquet import crs_of, geo_metadata, verify_geo, write_geo

    path = shared_path(spark, "verified")
    write_geo(deliverable(spark, d), path)
    told = verify_geo(spark, path)
    crs = crs_of(geo_metadata(spark, path)).select("crs").distinct()
    return crs.select(*[F.lit(told[k]).alias(k) for k in ("version", "primary_column")], F.lit(",".join(told["geo_types"])).alias("geo_types"), F.lit(told["n_rows"]).cast("bigint").alias("n_rows"), F.lit(told["n_columns"]).cast("bigint").alias("n_columns"), "crs")


# ---------------------------------------------------------------- landed inputs and small steps


def q_scan_segments(spark: SparkSession, d: str) -> DataFrame:
    """Model output landed as files, read with its own schema."""
    from streetscape.session import shared_path
    from streetscape.sources.stores import scan_segments

    path = f"{shared_path(spark, 'segments')}/rows"
    V.segments(spark, d).write.parquet(path)
    return scan_segments(spark, path).select("image_id", "timeline", "segment_idx", vector_sum("activity").alias("activity_sum"))


def q_scan_labels(spark: SparkSession, d: str) -> DataFrame:
    """Label rows landed as CSV."""
    from streetscape.session import shared_path
    from streetscape.sources.stores import scan_parcel_labels

    path = f"{shared_path(spark, 'labels')}/rows"
    V.labels(spark, d).write.option("header", True).csv(path)
    return scan_parcel_labels(spark, path, "csv").select("name", "hemi", F.col("vertex").cast("bigint").alias("vertex"))


def q_drop_sentinel(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth store row turned into a placeholder, every seventh into one without an id."""
    number = F.col("image_id").cast("bigint")
    marked = F.when(number % 5 == 0, F.lit("__sentinel__")).when(number % 7 == 0, F.lit(None)).otherwise(F.col("image_id"))
    return ST.drop_sentinel(V.store(spark, d).withColumn("image_id", marked)).select("image_id", "source_file")


def q_normalize_regions(spark: SparkSession, d: str) -> DataFrame:
    """Region lists given as [name, score] pairs of text."""
    pairs = score_view(spark, d).select("image_id", F.transform("top_regions", lambda r: F.array(r["name"], r["score"].cast("string"))).alias("top_regions"))
    normal = S.normalize_regions(pairs)
    return normal.select("image_id", region_text().alias("regions"), region_sum().alias("region_sum"))


def q_write_alias_atlas(spark: SparkSession, d: str) -> DataFrame:
    """K5: the atlas written as one line of text and read back."""
    from streetscape.session import shared_path
    from streetscape.sinks.text import write_alias_atlas

    path = f"{shared_path(spark, 'atlas')}/json"
    write_alias_atlas(AT.alias_vertices(AT.merge_labels(V.labels(spark, d)), AT.alias_map_df(spark)), path)
    return spark.read.text(path).withColumnRenamed("value", "alias_atlas")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "square_bbox": q_square_bbox,
    "bbox_text": q_bbox_text,
    "bbox_area_guard": q_bbox_area_guard,
    "tile_aoi": q_tile_aoi,
    "within_bbox": q_within_bbox,
    "multi_aoi_join": q_multi_aoi_join,
    "point_wkb": q_point_wkb,
    "parse_captures": q_parse_captures,
    "filter_pano": q_filter_pano,
    "filter_captured": q_filter_captured,
    "cap_candidates": q_cap_candidates,
    "build_image_rows": q_build_image_rows,
    "new_images": q_new_images,
    "cached_images": q_cached_images,
    "id_set_ops": q_id_set_ops,
    "working_set": q_working_set,
    "audit_drops": q_audit_drops,
    "latest_rows": q_latest_rows,
    "store_index": q_store_index,
    "store_stats": q_store_stats,
    "union_by_name": q_union_by_name,
    "collapse_mean": q_collapse_mean,
    "collapse_max": q_collapse_max,
    "parcel_means": q_parcel_means,
    "name_parcels": q_name_parcels,
    "alias_parcels": q_alias_parcels,
    "alias_scores": q_alias_scores,
    "top_regions": q_top_regions,
    "merge_labels": q_merge_labels,
    "label_means": q_label_means,
    "alias_vertices": q_alias_vertices,
    "alias_atlas_json": q_alias_atlas_json,
    "stack_segments": q_stack_segments,
    "attach_timeline": q_attach_timeline,
    "load_scores": q_load_scores,
    "pseudo_clip_plan": q_pseudo_clip_plan,
    "deliverable": q_deliverable,
    "preview": q_preview,
    "geometry_types": q_geometry_types,
    "stage_counts": q_stage_counts,
    "score_images": q_score_images,
    "geo_roundtrip": q_geo_roundtrip,
    "stream_ingest": q_stream_ingest,
    "stream_score": q_stream_score,
    "pipeline_run": q_pipeline_run,
    "run_rejects": q_run_rejects,
    "scan_segments": q_scan_segments,
    "scan_labels": q_scan_labels,
    "drop_sentinel": q_drop_sentinel,
    "normalize_regions": q_normalize_regions,
    "write_alias_atlas": q_write_alias_atlas,
    "geo_verify": q_geo_verify,
}
