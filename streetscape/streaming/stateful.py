"""Exact dedup with Spark's own state.

``first_arrivals`` keeps every id that a stream has passed on, in the state store of the query
(RocksDB, checkpointed with it), by ``BUCKETS`` hashes of ids: a micro-batch looks up the buckets of its own ids and nothing else, whatever the size of the
image store, and the Python processor is called, and asks for state, once a bucket instead of once an id. What the store held before the stream began is
its initial state, read once, with the first batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from streetscape.operators import captures as C
from streetscape.operators import store as ST
from streetscape.operators.aoi import bbox_text, within_bbox
from streetscape.schemas import IMAGE_COLUMNS
from streetscape.sources.images import read_images_of
from streetscape.sources.stores import scan_image_store
from streetscape.streaming.incremental import read_page_stream
from streetscape.streaming.ledger import EpochLedger, query_key, reject_rows

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Buckets of ids in the state; a query keeps its number for life.
BUCKETS = 1 << 14


class FirstArrival(StatefulProcessor):
    """Of every id's rows in a bucket the least by ``order``, once in the life of the stream."""

    def __init__(self, key: str, kind: str, order: tuple[str, ...], columns: list[str]) -> None:
        self.key, self.kind, self.order, self.columns = key, kind, order, columns

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", f"ids array<{self.kind}>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.seen.get() if self.seen.exists() else None
        ids = list(known[0]) if known else []
        passed, found = set(ids), {}
        for row in rows:  # one row of an id is held, however many it has
            name = row[self.key]
            if name in passed:
                continue
            at = tuple((row[c] is not None, row[c]) for c in self.order)
            if name not in found or at < found[name][0]:
                found[name] = at, row
        if found:
            self.seen.update((ids + list(found),))
            whole = Row(*self.columns)
            for _, row in found.values():
                yield whole(*(row[c] for c in self.columns))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((list(initialState["ids"]),))

    def close(self) -> None:
        pass


def first_arrivals(stream: DataFrame, order: tuple[str, ...], known: DataFrame | None = None, key: str = "image_id", buckets: int = BUCKETS) -> DataFrame:
    """The first row of every ``key`` that the stream hasn't passed on before and that isn't in ``known``. Rows without
    a key are dropped."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("__bucket")
    initial = None if known is None else known.where(f"{key} IS NOT NULL").select(bucket, key).groupBy("__bucket").agg(F.collect_set(key).alias("ids")).groupBy("__bucket")
    processor = FirstArrival(key, stream.schema[key].dataType.simpleString(), order, stream.columns)
    return stream.where(f"{key} IS NOT NULL").select("*", bucket).groupBy("__bucket").transformWithState(processor, stream.schema, "Append", "None", initialState=initial)


@contextmanager
def state_in_rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which such state needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stream_ingest_stateful(
    spark: SparkSession,
    pages_path: str,
    images: DataFrame | str,
    store_path: str,
    checkpoint: str,
    bbox: Row,
    is_pano: bool | None = False,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """T1 + T3: landed pages -> parse -> box -> ids never seen -> store rows, published once an epoch.

    ``images``: (image_id, image_blob), or the folder of landed image files, of which only those of new ids are opened. New ids
    without an image are rows of ``<store>-rejects``; the ledger lies in ``<store>-ledger``."""
    keep = within_bbox(C.drop_incomplete(C.parse_captures(read_page_stream(spark, pages_path, max_files_per_trigger), is_pano=is_pano)), bbox)
    new = first_arrivals(keep, ("page", "pos"), scan_image_store(spark, store_path, with_file=False))
    query = query_key(checkpoint)
    ledger = EpochLedger(spark, f"{store_path.rstrip('/')}-ledger", query)

    def process(batch: DataFrame, epoch: int) -> None:
        arrived = batch.persist(StorageLevel.MEMORY_AND_DISK)  # the state is gone through once
        try:
            blobs = read_images_of(spark, images, arrived).where("reject_reason IS NULL") if isinstance(images, str) else images
            rows = ST.build_image_rows(arrived, blobs, bbox_text(bbox)).select(*IMAGE_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                lost = arrived.join(rows.select("image_id"), "image_id", "left_anti").selectExpr("image_id", "'no_image' AS reason")
                ledger.publish(rows, store_path, epoch)
                ledger.publish(reject_rows(lost, query, epoch, "download"), f"{store_path.rstrip('/')}-rejects", epoch, "rejects")
            finally:
                rows.unpersist()
        finally:
            arrived.unpersist()

    writer = new.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    with state_in_rocksdb(spark):
        return writer.start()
