"""M1 as a table function: ``SELECT * FROM score_images(TABLE(items) PARTITION BY part)`` from SQL, or in a DataFrame.

The function takes (image_id, image_blob, part) and gives the rows of ``scoring.score_images``. The model is called for at most
``batch_size`` items and about ``batch_bytes`` bytes of images at a time, so that large images don't fill a worker: items are
held only up to that bound. ``part`` deals the items over the tasks; each of its values is one partition of the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.operators.scoring import SEGMENT_OUT_DDL, ByteProbePredictor, Predictor, _score_partition

BATCH_BYTES = 64 << 20
NAME = "score_images"


def _bounded(batches: Iterator[pa.RecordBatch], batch_size: int, batch_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    """Groups of one-row slices with at most ``batch_size`` rows and, unless it is one row, ``batch_bytes`` bytes of images."""
    group: list[pa.RecordBatch] = []
    held = 0
    for b in batches:
        for k in range(b.num_rows):
            one = b.slice(k, 1)
            blob = one.column(1)[0]
            size = blob.as_buffer().size if blob.is_valid else 0
            if group and (len(group) >= batch_size or held + size > batch_bytes):
                yield group
                group, held = [], 0
            group.append(one)
            held += size
    if group:
        yield group


def scorer(predictor_factory: Callable[[], Predictor] = ByteProbePredictor, batch_size: int = 8, batch_bytes: int = BATCH_BYTES):
    """The table function of one model."""

    class ScoreImages:
        def __init__(self) -> None:
            self.predictor = predictor_factory()

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            items = batch.select(["image_id", "image_blob"])
            for group in _bounded(iter([items]), batch_size, batch_bytes):
                for out in _score_partition(iter(group), lambda: self.predictor, len(group)):
                    yield pa.Table.from_batches([out])

    return F.arrow_udtf(ScoreImages, returnType=SEGMENT_OUT_DDL)


def register_scorer(spark: SparkSession, predictor_factory: Callable[[], Predictor] = ByteProbePredictor, name: str = NAME, batch_size: int = 8, batch_bytes: int = BATCH_BYTES) -> None:
    """Make the function callable from SQL."""
    spark.udtf.register(name, scorer(predictor_factory, batch_size, batch_bytes))


def score_by_sql(items: DataFrame, parts: int, name: str = NAME) -> DataFrame:
    """The rows of ``score_images`` by way of the registered function, the items dealt over ``parts`` partitions."""
    spark = items.sparkSession
    dealt = items.select("image_id", "image_blob", F.pmod(F.xxhash64("image_id"), F.lit(parts)).alias("part"))
    return spark.sql(f"SELECT * FROM {name}(TABLE(SELECT * FROM {{items}}) PARTITION BY part)", items=dealt)
