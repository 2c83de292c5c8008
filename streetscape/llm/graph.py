"""Tables in the shared folder, and connected components over edge tables of any size."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetscape.session import checkpoint_root


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _star(edges: DataFrame) -> DataFrame:
    """Every neighbour of a node, and the node, linked to the least of them all; ``edges`` are (u, v) in the
    directions that count as neighbours of u."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(id, root): every node of the edges (a, b) with the least node it reaches, by alternating
    large and small stars (Kiveris et al. 2014), a written table each round."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        now = written(_star(large).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root"))
        seen = state
