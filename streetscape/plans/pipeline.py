"""The whole incremental run as one composition of the package's operators.

AOI -> landed capture pages -> parsed, filtered, capped candidates -> anti join with the image
store -> blobs of new ids from landed image files -> store shard -> working set (audited) ->
hit/miss against the score store -> model on the misses -> score shard -> deliverable join of
both stores inside the AOI -> GeoParquet -> footer verification -> run summary.

Only the per-stage counts and the verify record reach the driver. The candidate list and the
working set are bounded by ``max_images`` and are persisted (memory and disk) because several
stages read them; a lost executor recomputes them from lineage.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.session import shared_path
from streetscape.operators import atlas as AT
from streetscape.operators import captures as C
from streetscape.operators import scoring as M
from streetscape.operators import store as ST
from streetscape.operators.aoi import bbox_text, find_aoi, inside
from streetscape.operators.deliverable import deliverable_rows, run_summary
from streetscape.operators.summary import lookup_of
from streetscape.sinks.geoparquet import verify_geo, write_geo
from streetscape.sinks.stores import append_images, append_scores, init_store
from streetscape.sources.images import read_images_of
from streetscape.sources.layout import buckets_of, new_in
from streetscape.sources.pages import records_and_rejects
from streetscape.sources.stores import scan_image_store, scan_score_store

#: Bytes of images that a task writes down for scoring.
TASK_BYTES = 128 << 20


@dataclass
class RunConfig:
    pages_path: str
    images_path: str
    image_store: str
    score_store: str
    out_path: str
    atlas: DataFrame
    aoi: str = "camden"
    lon0: float | None = None
    lat0: float | None = None
    side_m: float = 300.0
    max_images: int | None = None
    start_captured_at: str | None = None
    end_captured_at: str | None = None
    is_pano: bool | None = False
    dedupe: bool = True
    predictor_factory: Callable = M.ByteProbePredictor
    batch_size: int = 8
    model_repo: str = "test/byte-probe"
    alias_map: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(AT.ALIAS_GLOBS))
    k: int = 10
    rejects_path: str | None = None  # default: out_path + "-rejects"
    score_group: int = 10_000  # images scored before the first append to the score store; each further round is twice as large
    store_buckets: int | None = None  # stores that a run creates are bucketed by id


def round_of(image_id: Column, groups: int) -> Column:
    """The round of an image among ``groups`` groups of images by a hash of the id: round r takes 2^r of them. So the
    rounds, each a scan and an append, grow with the logarithm of the images, and one that dies loses about as many scores
    as are kept, or a first round."""
    return F.length(F.bin(F.pmod(F.xxhash64(image_id), F.lit(groups)) + 1)) - 1


def _written_by_round(items: DataFrame, groups: int) -> str:
    """The folder of the images to be scored, one sub-folder a round, so that each is read once."""
    spark = items.sparkSession
    path = f"{shared_path(spark, 'unscored')}/images"
    rows = items.select("image_id", "image_blob", round_of(F.col("image_id"), max(1, groups)).alias("round"))
    volume = items.agg(F.sum(F.octet_length("image_blob"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-volume // TASK_BYTES))
    rows.coalesce(int(tasks)).write.partitionBy("round").parquet(path)
    return path


def run(spark: SparkSession, cfg: RunConfig) -> dict:
    timings: dict[str, float] = {}
    counts = {k: 0 for k in ("candidates", "cached", "downloaded", "inference_cache_hit", "inferred", "written")}
    held: list[DataFrame] = []
    run_id = uuid.uuid4().hex

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    rejects = cfg.rejects_path or f"{cfg.out_path.rstrip('/')}-rejects"

    def reject(found: DataFrame, stage: str) -> None:
        """Append what a stage dropped to the run's reject table; rows without a reason were kept."""
        lost = found.where("reason IS NOT NULL").select(F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), F.col("image_id").cast("string").alias("image_id"), "reason")
        lost.write.mode("append").parquet(rejects)

    def tick(name: str, t0: float) -> float:
        timings[f"{name}_s"] = round(time.monotonic() - t0, 3)
        return time.monotonic()

    try:
        t = time.monotonic()
        bbox = find_aoi(spark, cfg.aoi, cfg.lon0, cfg.lat0, cfg.side_m)
        init_store(spark, cfg.image_store, "images", cfg.store_buckets)
        init_store(spark, cfg.score_store, "scores", cfg.store_buckets)
        t = tick("resolve_bbox", t)

        records, broken = records_and_rejects(spark, cfg.pages_path)
        if broken is not None:
            reject(broken.select(F.col("request").alias("image_id"), "reason"), "pages")
        every = hold(C.parse_captures(records, is_pano=cfg.is_pano))
        reject(every.select("image_id", F.col("reject_reason").alias("reason")), "parse")
        parsed = hold(C.filter_captured(C.with_captured_at(C.drop_incomplete(every)), cfg.start_captured_at, cfg.end_captured_at))
        reject(parsed.select("image_id", F.when(~F.coalesce(inside("lon", "lat", bbox), F.lit(False)), "out_of_bbox").alias("reason")), "aoi")
        cands = hold(C.select_candidates(parsed, bbox, cfg.max_images, dedupe=cfg.dedupe))
        counts["candidates"] = cands.count()
        t = tick("candidates", t)

        # only files of new ids are opened
        stored = scan_image_store(spark, cfg.image_store)
        buckets = buckets_of(spark, cfg.image_store)
        new = hold(new_in(cands, stored, buckets) if buckets else ST.new_images(cands, stored))
        files = hold(read_images_of(spark, cfg.images_path, new))
        reject(files.select("image_id", F.col("reject_reason").alias("reason")), "download")
        reject(new.join(files.select("image_id"), "image_id", "left_anti").select("image_id", F.lit("download_failed").alias("reason")), "download")
        rows = hold(ST.build_image_rows(new, files.filter(F.col("reject_reason").isNull()), bbox_text(bbox)))
        counts["cached"] = counts["candidates"] - new.count()
        counts["downloaded"] = rows.count()
        append_images(rows, cfg.image_store)
        t = tick("download", t)

        checked = ST.working_set(cands, scan_image_store(spark, cfg.image_store))
        reject(checked.where("drop_reason = 'null_blob'").select("image_id", F.col("drop_reason").alias("reason")), "store")
        working = hold(checked.filter(F.col("drop_reason").isNull()))
        hits, misses = ST.hit_miss(working.select("image_id"), scan_score_store(spark, cfg.score_store))
        counts["inference_cache_hit"] = hits.count()
        # written down: a plan over the score store would change with every append to it
        missing = f"{shared_path(spark, 'misses')}/ids"
        misses.select("image_id").distinct().write.parquet(missing)
        misses = spark.read.schema("image_id string").parquet(missing)
        groups = -(-misses.count() // cfg.score_group)
        todo = _written_by_round(working.join(misses, "image_id", "left_semi"), groups)
        t = tick("working_set", t)

        # Scores are appended round by round, so a run that dies keeps what it has scored: the next one finds
        # those images in the score store.
        amap = AT.alias_map_df(spark, cfg.alias_map)
        lookup = lookup_of(cfg.atlas, amap, list(cfg.alias_map)) if groups else None
        for r in range(groups.bit_length()):
            mine = spark.read.schema("image_id string, image_blob binary, round int").parquet(todo).where(F.col("round") == r)
            seg = M.score_images(mine, cfg.predictor_factory, cfg.batch_size).persist(StorageLevel.MEMORY_AND_DISK)
            fresh = M.postprocess_scores(M.good_segments(seg), cfg.atlas, amap, list(cfg.alias_map), cfg.k, cfg.model_repo, lookup=lookup).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                counts["inferred"] += fresh.count()
                reject(M.scoring_rejects(seg).select("image_id", F.col("drop_reason").alias("reason")), "inference")
                append_scores(fresh, cfg.score_store)
            finally:
                fresh.unpersist()
                seg.unpersist()
        t = tick("inference", t)

        if counts["inferred"] + counts["inference_cache_hit"] == 0:
            raise RuntimeError(f"all {working.count()} items failed scoring and none had a stored score; refusing an empty deliverable")

        # This run's results = stored hits of the working set plus the fresh scores (both now
        # in the score store); earlier runs' images outside this working set are not re-emitted.
        run_scores = scan_score_store(spark, cfg.score_store).join(working.select("image_id"), "image_id", "left_semi")
        out = deliverable_rows(scan_image_store(spark, cfg.image_store), run_scores, bbox)
        write_geo(out, cfg.out_path)
        t = tick("write", t)
        verify = verify_geo(spark, cfg.out_path)
        counts["written"] = int(verify["n_rows"])
        tick("verify", t)
        lost = spark.read.schema("run_id string, stage string, image_id string, reason string").parquet(rejects).where(F.col("run_id") == run_id)
        kind = F.when(F.col("reason").startswith("inference_failed"), "inference_failed").otherwise(F.col("reason"))
        counts |= {f"rejected_{r[0]}": r[1] for r in lost.groupBy(kind.alias("kind")).count().collect()}  # a row for each kind of reason
        return run_summary(counts, timings, verify, cfg.out_path) | {"rejects": rejects, "run_id": run_id}
    finally:
        for df in held:
            df.unpersist()
