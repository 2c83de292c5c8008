"""The incremental pipeline as Structured Streaming jobs.

Each landed page file or store shard is processed once (the checkpoint remembers which), and
every micro-batch anti-joins against the target store before appending, so an id is written
once even when a batch is delivered again after a failure (the store is the dedup state:
exact and unbounded in time). ``trigger(availableNow=True)`` processes what has landed and
stops, which is the reference's run-to-completion model; a processing-time trigger runs it
continuously.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streetscape.operators import captures as C
from streetscape.operators import scoring as M
from streetscape.operators import store as ST
from streetscape.operators.aoi import bbox_text, within_bbox
from streetscape.schemas import IMAGE_SCHEMA, PAGE_DDL, SCORE_COLUMNS
from streetscape.sinks.files import land_files
from streetscape.sinks.stores import append_images
from streetscape.sources.images import read_images_of
from streetscape.sources.pages import explode_pages
from streetscape.sources.stores import scan_image_store, scan_score_store
from streetscape.streaming.ledger import EpochLedger, query_key, reject_rows, scan_rejects


def read_page_stream(spark: SparkSession, pages_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(PAGE_DDL).option("multiLine", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.json(pages_path).withColumn("page", F.col("_metadata.file_path"))
    return explode_pages(pages)


def stream_ingest(
    spark: SparkSession,
    pages_path: str,
    blobs: DataFrame | str,
    store_path: str,
    checkpoint: str,
    bbox: Row,
    is_pano: bool | None = False,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """T1 + T3: landed pages -> parse -> bbox -> new ids only -> store rows -> append.

    ``blobs`` is the folder of landed image files, of which only those of new ids are opened, or any
    (image_id, image_blob), which each micro-batch joins whole. ``stateful.stream_ingest_stateful`` does without the store's ids.
    """
    parsed = C.parse_captures(read_page_stream(spark, pages_path, max_files_per_trigger), is_pano=is_pano)

    def process(batch: DataFrame, epoch_id: int) -> None:
        # The batch is bounded by the trigger; persisting it saves re-parsing for the size
        # check, the empty check and the write. A lost executor recomputes from the source files.
        cand = C.first_arrival(within_bbox(C.drop_incomplete(batch), bbox)).persist(StorageLevel.MEMORY_AND_DISK)
        rows = None
        try:
            store = scan_image_store(spark, store_path)
            new = ST.new_images(cand, store)
            content = read_images_of(spark, blobs, new).where("reject_reason IS NULL") if isinstance(blobs, str) else blobs
            rows = ST.build_image_rows(new, content, bbox_text(bbox)).persist(StorageLevel.MEMORY_AND_DISK)
            append_images(rows, store_path)
        finally:
            cand.unpersist()
            if rows is not None:
                rows.unpersist()

    writer = parsed.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def stream_score(
    spark: SparkSession,
    store_path: str,
    score_path: str,
    checkpoint: str,
    atlas: DataFrame,
    alias_map: DataFrame,
    aliases: Sequence[str],
    predictor_factory: Callable = M.ByteProbePredictor,
    batch_size: int = 8,
    k: int = 10,
    model_repo: str = "test/byte-probe",
    max_files_per_trigger: int | None = 1,
    available_now: bool = True,
) -> StreamingQuery:
    """New image-store shards -> ids without a score -> model -> score rows, published once an epoch.

    ``max_files_per_trigger`` bounds what one failure can lose (the reference flushes every 5 rows); an epoch that is
    delivered again is recognised by the ledger in ``<score store>-ledger`` and writes nothing twice. Items without a
    blob and items that fail in the model are rows of ``<score store>-rejects``; ``retry_rejected`` scores them again."""
    reader = spark.readStream.schema(IMAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    images = reader.parquet(store_path).select("*", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.row_index").alias("row_index"))
    process = score_epochs(spark, score_path, query_key(checkpoint), atlas, alias_map, aliases, predictor_factory, batch_size, k, model_repo)
    writer = images.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def score_epochs(
    spark: SparkSession,
    score_path: str,
    query: str,
    atlas: DataFrame,
    alias_map: DataFrame,
    aliases: Sequence[str],
    predictor_factory: Callable = M.ByteProbePredictor,
    batch_size: int = 8,
    k: int = 10,
    model_repo: str = "test/byte-probe",
) -> Callable[[DataFrame, int], None]:
    """What ``stream_score`` does with a micro-batch of store rows (with file and row) and its epoch."""
    score_path = score_path.rstrip("/")
    ledger = EpochLedger(spark, f"{score_path}-ledger", query)

    def process(batch: DataFrame, epoch_id: int) -> None:
        # the newest row of each id counts, ties by file and row as in the batch path: keys are found
        # first, blobs attached to the winners, and one without a blob is not scored by an older blob
        items = ST.latest_rows(batch).select("image_id", "image_blob").persist(StorageLevel.MEMORY_AND_DISK)
        held: list[DataFrame] = [items]

        def hold(df: DataFrame) -> DataFrame:
            held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return df

        try:
            todo = ST.new_images(items, scan_score_store(spark, score_path))
            scored = hold(M.score_images(todo.where("image_blob IS NOT NULL"), predictor_factory, batch_size))
            rows = M.postprocess_scores(M.good_segments(scored), atlas, alias_map, aliases, k, model_repo)
            failed = M.scoring_rejects(scored).select("image_id", F.col("drop_reason").alias("reason"))
            failed = failed.unionByName(todo.where("image_blob IS NULL").select("image_id", F.lit("null_blob").alias("reason")))
            # rejects first: once the scores are there, a retry of the epoch would find nothing to do
            ledger.publish(hold(reject_rows(failed, query, epoch_id, "inference")), f"{score_path}-rejects", epoch_id, "rejects")
            ledger.publish(rows.select(*SCORE_COLUMNS), score_path, epoch_id)
        finally:
            for df in held:
                df.unpersist()

    return process


def retry_rejected(
    spark: SparkSession,
    store_path: str,
    score_path: str,
    atlas: DataFrame,
    alias_map: DataFrame,
    aliases: Sequence[str],
    predictor_factory: Callable = M.ByteProbePredictor,
    batch_size: int = 8,
    k: int = 10,
    model_repo: str = "test/byte-probe",
) -> int:
    """Score the rejected items that have no score yet from their newest store rows, as one more epoch; returns how many
    were rejected so far. Those that fail again are rejected again."""
    path = f"{score_path.rstrip('/')}-rejects"
    ids = scan_rejects(spark, path).where("stage = 'inference'").select("image_id").distinct()
    query = "retry"
    ledger = EpochLedger(spark, f"{score_path.rstrip('/')}-ledger", query)
    epoch = 0
    while ledger.entry(epoch, "rows"):
        epoch += 1
    rows = scan_image_store(spark, store_path).join(ids, "image_id", "left_semi")
    score_epochs(spark, score_path, query, atlas, alias_map, aliases, predictor_factory, batch_size, k, model_repo)(rows, epoch)
    return ids.count()


def dedupe_within_watermark(stream: DataFrame, event_time: str, delay: str = "1 day", key: str = "image_id") -> DataFrame:
    """T3, bounded variant: drop repeats of ``key`` seen within the watermark delay (state is
    purged as the watermark passes; exact dedup across all time is the store anti join)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def land_pages(records: DataFrame, path: str, page: str = "page", pos: str = "pos", record_text: str = "record_text") -> None:
    """Write capture records as landed page files, one JSON page document per file.

    ``records`` has (page, pos, record_text); a page's records are ordered by pos. Pages are
    bounded by the listing page size. Files are named ``<19 digits>-<landing>.json``, so that file paths
    sort in page order (19 digits hold every page number); the tasks write them into the one folder themselves.
    """
    pages = records.groupBy(page).agg(
        F.concat(
            F.lit('{"data":['),
            F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct(pos, record_text))), lambda s: s[record_text])),
            F.lit('],"paging":{}}'),
        ).alias("value")
    )
    key = F.coalesce(F.lpad(F.col(page).cast("string"), 19, "0"), F.lit("none"))  # records without a page come last
    land_files(pages.select(F.concat(key, F.lit(f"-{uuid.uuid4().hex}")).alias("name"), F.encode("value", "UTF-8").alias("value")), path, "name", "value", ext=".json")
