"""Epochs that are published once, whatever is delivered again.

A micro-batch is named by its query and epoch. ``EpochLedger.publish`` writes its rows to a staging folder, notes the names of
the finished files in the ledger (state ``prepared``), moves them into the store under names made of query, part and epoch,
and notes ``published``. An epoch that comes again

- after ``published`` writes nothing;
- after ``prepared`` finishes the moves: files already in place are left, the rest follows;
- before that writes its staging folder anew.

So a store never holds part of an epoch twice. The entries are one small JSON file each, looked up by name: no epoch reads
the ledger whole. Rows that a step couldn't process go to a reject table through the same door, so that nothing is
lost silently when the checkpoint moves on.
"""

from __future__ import annotations

import hashlib
import json
import uuid

import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.sinks.geoparquet import _fs, qualified
from streetscape.sinks.stores import ZSTD_OPTIONS
from streetscape.sources.layout import buckets_of

REJECT_DDL = "query string, epoch long, stage string, image_id string, reason string"
ENTRY_DDL = "query string, epoch long, part string, state string, target string, files array<string>"


def query_key(checkpoint: str) -> str:
    """A query's name in the ledger: its checkpoint's, which it keeps across restarts."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


class EpochLedger:
    def __init__(self, spark: SparkSession, path: str, query: str) -> None:
        self.spark, self.query = spark, query
        self.fs, self.root = _fs(qualified(spark, path))
        self.root = self.root.rstrip("/")
        self.url = qualified(spark, path).rstrip("/")

    def _entry(self, epoch: int, part: str) -> str:
        return f"{self.root}/entries/{self.query}-{part}-{epoch:012d}.json"

    def entry(self, epoch: int, part: str) -> dict | None:
        name = self._entry(epoch, part)
        if self.fs.get_file_info(name).type != pafs.FileType.File:
            return None
        with self.fs.open_input_stream(name) as f:
            return json.loads(f.read())

    def _note(self, epoch: int, part: str, state: str, target: str, files: list[str]) -> None:
        name = self._entry(epoch, part)
        self.fs.create_dir(f"{self.root}/entries", recursive=True)
        draft = f"{self.root}/entries/_{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as out:
            out.write(json.dumps({"query": self.query, "epoch": epoch, "part": part, "state": state, "target": target, "files": files}).encode())
        self.fs.move(draft, name)  # an entry is there whole or not at all

    def _stage(self, rows: DataFrame, target: str, staging: str) -> None:
        buckets = buckets_of(self.spark, target)
        writer = rows.write.mode("overwrite").format("parquet").options(**ZSTD_OPTIONS)
        if buckets is None:
            writer.save(staging)
            return
        rows = rows.hint("rebalance", buckets, F.col("image_id"))
        name = f"streetscape_stage_{uuid.uuid4().hex}"
        rows.write.mode("overwrite").format("parquet").options(**ZSTD_OPTIONS).bucketBy(buckets, "image_id").sortBy("image_id").option("path", staging).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the declaration; the files stay

    def publish(self, rows: DataFrame, target: str, epoch: int, part: str = "rows") -> bool:
        """Make ``rows`` part of the Parquet folder ``target``, once for this epoch and part. False if it was done before."""
        told = self.entry(epoch, part)
        if told and told["state"] == "published":
            return False
        staging = f"staging/{self.query}-{part}-{epoch:012d}"
        if told is None:
            self._stage(rows, target, f"{self.url}/{staging}")
            found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{staging}", allow_not_found=True))
            files = sorted(i.base_name for i in found if i.base_name.endswith(".parquet"))
            self._note(epoch, part, "prepared", target, files)
        else:
            files = told["files"]
        fs, base = _fs(qualified(self.spark, target))
        base = base.rstrip("/")
        fs.create_dir(base, recursive=True)
        for f in files:
            source, place = f"{self.root}/{staging}/{f}", f"{base}/{part}-{self.query}-{epoch:012d}-{f}"
            if fs.get_file_info(place).type == pafs.FileType.NotFound:
                fs.move(source, place)
        self._note(epoch, part, "published", target, files)
        return True

    def entries(self) -> DataFrame:
        """All entries, for inspection."""
        return self.spark.read.schema(ENTRY_DDL).json(f"{self.url}/entries")


def reject_rows(found: DataFrame, query: str, epoch: int, stage: str) -> DataFrame:
    """(image_id, reason) as rows of the reject table."""
    return found.select(F.lit(query).alias("query"), F.lit(epoch).cast("long").alias("epoch"), F.lit(stage).alias("stage"), F.col("image_id").cast("string").alias("image_id"), "reason")


def scan_rejects(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(REJECT_DDL).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REJECT_DDL)
