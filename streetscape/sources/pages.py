"""Landed capture pages ``{"request": ..., "data": [...], "paging": {"next": ...}}`` -> one VARIANT per record.

Arrival order is (page, pos). A page that carries the address it was fetched from (``request``) takes its place along the
``paging.next`` links, whatever its file is called: ``page`` is then its chain's first address and its rank in the chain. A page
without ``request`` sorts by its file's path, as it did when it landed.

Ranks come from pointer doubling: every page points at the one that names it as next, and in each round the pointer
jumps over what it points at, so a chain of n pages takes log2(n) rounds of one join, each round a written table.

Defined cases: the next page hasn't landed: its predecessor is marked ``missing_next`` and kept, the chain ends there; several
pages name the same next one: the least address leads on, the others are marked ``forked`` and kept, their chains end;
a page landed in several files: the first path stands, the others are rejected as ``repeated_page``; pages that lie on
a cycle have no first page and are rejected as ``cyclic``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.schemas import PAGE_DDL
from streetscape.session import shared_path

LINK_DDL = "file string, request string, next string"
REJECTED = ("cyclic", "repeated_page")


def explode_pages(pages: DataFrame, page_col: str = "page") -> DataFrame:
    """(page, data array<variant>) -> (page, pos, record)."""
    return pages.select(page_col, F.posexplode("data").alias("pos", "record"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: file, request, next, data."""
    pages = spark.read.schema(PAGE_DDL).option("multiLine", True).json(path)
    return pages.select(F.col("_metadata.file_path").alias("file"), "request", F.col("paging.next").alias("next"), "data")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder."""
    path = f"{shared_path(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rank_pages(links: DataFrame) -> DataFrame:
    """(file, request, next) -> file, request, chain (address of the first page), rank (from 0), status.

    ``status`` is null for a page in order; the module tells the others. Pages without request are alone in a chain named
    by their file. Chain and rank are null for rejected pages."""
    links = written(links.select("file", "request", "next"), "page-links")
    named = links.where("request IS NOT NULL")
    first = named.groupBy("request").agg(F.min(F.struct("file", "next")).alias("f")).select("request", "f.file", "f.next")
    # of the pages that name the same next one, the least leads on; a page that names itself is a cycle of one
    led = first.where("next IS NOT NULL").groupBy("next").agg(F.min("request").alias("pred"))
    nodes = first.join(led.select(F.col("next").alias("request"), "pred"), "request", "left")
    nodes = nodes.join(led.select("next", F.col("pred").alias("leader")), "next", "left")
    landed = first.select(F.col("request").alias("next"), F.lit(True).alias("landed"))
    nodes = nodes.join(landed, "next", "left")
    status = F.when(F.col("next").isNull(), None).when(F.col("landed").isNull(), F.lit("missing_next")).when(F.col("leader") != F.col("request"), F.lit("forked"))
    nodes = written(nodes.select("file", "request", "pred", status.alias("status")), "page-nodes")

    alone = F.col("pred").isNull()
    at = written(nodes.select("request", F.when(alone, F.col("request")).alias("root"), F.col("pred").alias("jump"), F.when(alone, 0).otherwise(1).cast("long").alias("dist")), "page-ranks")
    for _ in range(math.ceil(math.log2(max(nodes.count(), 1) + 1)) + 1):
        if at.where("jump IS NOT NULL").isEmpty():
            break
        to = at.select(F.col("request").alias("jump"), F.col("root").alias("r"), F.col("jump").alias("j"), F.col("dist").alias("d"))
        at = at.join(to, "jump", "left").select("request", F.coalesce("root", "r").alias("root"), F.col("j").alias("jump"), (F.col("dist") + F.coalesce("d", F.lit(0))).alias("dist"))
        at = written(at, "page-ranks")

    on_cycle = F.col("root").isNull()
    ranked = nodes.join(at.select("request", "root", "dist"), "request").select(
        "file", "request", F.col("root").alias("chain"), F.when(~on_cycle, F.col("dist")).alias("rank"), F.when(on_cycle, F.lit("cyclic")).otherwise(F.col("status")).alias("status")
    )
    none = F.lit(None)
    again = named.join(first.select("request", F.col("file").alias("kept")), "request").where("file <> kept")
    again = again.select("file", "request", none.cast("string").alias("chain"), none.cast("long").alias("rank"), F.lit("repeated_page").alias("status"))
    lone = links.where("request IS NULL").select("file", "request", F.col("file").alias("chain"), F.lit(0).cast("long").alias("rank"), none.cast("string").alias("status"))
    return ranked.unionByName(again).unionByName(lone)


def ordered_pages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(page, data) of the pages in order, and (request, reason) of those rejected and of those whose chain breaks off."""
    pages = read_pages(spark, path)
    ranked = rank_pages(pages)
    place = F.concat("chain", F.lit("#"), F.lpad(F.col("rank").cast("string"), 19, "0"))
    place = F.when(F.col("request").isNull(), F.col("file")).otherwise(place)
    ranked = written(ranked.select("file", "request", place.alias("page"), "status"), "page-order")
    kept = ranked.where(~F.coalesce(F.col("status").isin(*REJECTED), F.lit(False))).select("file", "page")
    rejects = ranked.where("status IS NOT NULL").select("request", F.col("status").alias("reason"))
    return pages.select("file", "data").join(kept, "file").select("page", "data"), rejects


def records_and_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame | None]:
    """(page, pos, record) of all pages, in order of the links where pages carry them, else of the paths; and (request,
    reason) of broken chains, if there are links."""
    pages = read_pages(spark, path)
    if pages.select("request").where("request IS NOT NULL").isEmpty():
        return explode_pages(pages.select(F.col("file").alias("page"), "data")), None
    ordered, rejects = ordered_pages(spark, path)
    return explode_pages(ordered), rejects


def scan_capture_pages(spark: SparkSession, path: str) -> DataFrame:
    """The records of all pages, in order of arrival."""
    return records_and_rejects(spark, path)[0]
