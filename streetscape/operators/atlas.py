"""Parcel atlas and functional aliases: label cleanup, hemisphere merge, alias vertex sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.functions.glob import glob_to_regex

# Functional alias -> parcel-name globs, in declaration order (12 aliases).
ALIAS_GLOBS: dict[str, list[str]] = {
    "FFA": ["FFC*"],
    "PPA": ["PHA1*", "PHA2*", "PHA3*"],
    "EBA": ["TE2p*", "PH*"],
    "VWFA": ["VVC*", "TE2p*"],
    "STSdp": ["STSdp*"],
    "STSva": ["STSva*"],
    "Broca45": ["45*"],
    "A5": ["A5*"],
    "MT": ["MT*", "MST*"],
    "V1": ["V1*"],
    "V4": ["V4*"],
    "TPJ": ["TPOJ1*"],
}

# Fixed value: vertices per hemisphere of the mesh; right-side vertices are offset by it.
HEMI_VERTICES = 10242


def alias_map_df(spark: SparkSession, alias_map: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(alias, alias_ord, pattern, pattern_ord, regex). Glob -> regex runs once per pattern."""
    amap = alias_map if alias_map is not None else ALIAS_GLOBS
    rows = [
        (alias, ai, pat, pi, glob_to_regex(pat))
        for ai, (alias, pats) in enumerate(amap.items())
        for pi, pat in enumerate(pats)
    ]
    return spark.createDataFrame(rows, "alias string, alias_ord int, pattern string, pattern_ord int, regex string")


def alias_names(alias_map: Mapping[str, Sequence[str]] | None = None) -> list[str]:
    return list((alias_map if alias_map is not None else ALIAS_GLOBS).keys())


def clean_label_names(labels: DataFrame, name: str = "name") -> DataFrame:
    """Drop the 2-char side prefix (``L_``/``R_``), then ``_ROI``, ``-lh``, ``-rh``."""
    n = F.expr(f"substring({name}, 3)")
    for token in ("_ROI", "-rh", "-lh"):
        n = F.replace(n, F.lit(token), F.lit(""))
    return labels.withColumn("parcel", n)


def hemisphere_vertices(labels: DataFrame, hemi_size: int = HEMI_VERTICES) -> DataFrame:
    """Keep vertices below ``hemi_size``; right-hemisphere ones are offset by it."""
    v = F.col("vertex").cast("bigint")
    return labels.filter(v < hemi_size).withColumn(
        "vertex", F.when(F.col("hemi") == "rh", v + F.lit(hemi_size)).otherwise(v)
    )


def merge_labels(labels: DataFrame) -> DataFrame:
    """Raw labels (name, hemi, vertex) -> long atlas (parcel, ordinal, vertex, hemi), both sides
    merged by clean name; ``ordinal`` is the parcel's rank by name, from 0. Vertices of a parcel stay
    on executors; the distinct names, which the mesh bounds, are ranked."""
    cleaned = hemisphere_vertices(clean_label_names(labels))
    names = cleaned.select("parcel").distinct().agg(F.sort_array(F.collect_list("parcel")).alias("names"))
    ranked = names.select(F.posexplode("names").alias("ordinal", "parcel"))
    return cleaned.join(F.broadcast(ranked), "parcel").select("parcel", "ordinal", F.col("vertex").cast("int").alias("vertex"), "hemi")


def alias_vertex_rows(atlas: DataFrame, alias_map: DataFrame) -> DataFrame:
    """J6 + U3: (alias, alias_ord, parcel, vertex) over all parcels matching the alias's globs; an
    alias without a parcel has one row of NULLs."""
    from streetscape.operators.summary import alias_parcels

    matched = alias_parcels(atlas.select("parcel"), alias_map).join(atlas.select("parcel", "vertex"), "parcel")
    every = alias_map.select("alias", "alias_ord").distinct()
    return every.join(matched.select("alias", "parcel", "vertex"), "alias", "left")


def alias_vertices(atlas: DataFrame, alias_map: DataFrame) -> DataFrame:
    """A10: per alias the sorted distinct vertex list, the number of matched parcels and vertices;
    every alias has its row, without a match an empty list. The vertex list is bounded by the mesh
    (2 x 10242)."""
    rows = alias_vertex_rows(atlas, alias_map)
    return rows.groupBy("alias", "alias_ord").agg(
        F.sort_array(F.collect_set("vertex")).alias("vertices"),
        F.count_distinct("parcel").alias("n_parcels"),
        F.count_distinct("vertex").alias("n_vertices"),
    )


def alias_atlas_json(alias_vertex: DataFrame) -> DataFrame:
    """K5 payload: one row, one compact JSON object alias -> sorted vertices (declaration order).
    The map is bounded by aliases x mesh vertices."""
    return alias_vertex.agg(
        F.to_json(
            F.map_from_entries(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("alias_ord", "alias", "vertices"))),
                    lambda s: F.struct(s["alias"], s["vertices"]),
                )
            )
        ).alias("value")
    )
