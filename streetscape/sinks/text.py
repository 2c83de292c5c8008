"""K5: the alias atlas as one compact JSON text file."""

from __future__ import annotations

from pyspark.sql import DataFrame

from streetscape.operators.atlas import alias_atlas_json


def write_alias_atlas(alias_vertex: DataFrame, path: str) -> None:
    alias_atlas_json(alias_vertex).coalesce(1).write.mode("overwrite").text(path)
