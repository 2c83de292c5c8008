"""Shards whose columns have drifted.

The tasks read the shards' footers; shards with the same columns are read together, under their own schema, and each such
group is brought to the store's schema column by column:

- a column that a shard lacks is null; the order of columns doesn't matter;
- a column of a type that widens without loss (a shorter integer, float to double, date to timestamp, a shorter decimal, ...) is cast;
- a column of any other type is cast value by value; what doesn't fit is null, and its value is kept in ``drift``;
- a column that the store doesn't have is kept in ``drift``.

``drift`` is a VARIANT object of such values by name, null for a row without any. There are as many groups as different
schemas; file names pass through the driver, as in any listing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIFT = "drift"
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def widens(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of one type is a value of the other."""
    if have == want:
        return True
    if isinstance(have, _INTEGERS) and isinstance(want, _INTEGERS):
        return _INTEGERS.index(type(have)) <= _INTEGERS.index(type(want))
    if isinstance(want, T.DoubleType):
        return isinstance(have, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType))
    if isinstance(want, T.FloatType):
        return isinstance(have, (T.ByteType, T.ShortType))
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return want.scale >= have.scale and want.precision - want.scale >= have.precision - have.scale
    if isinstance(have, T.DateType):
        return isinstance(want, T.TimestampNTZType)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return widens(have.elementType, want.elementType)
    return False


def _signatures(batches: Iterator) -> Iterator:
    import pandas as pd
    import pyarrow.parquet as pq

    from streetscape.sinks.geoparquet import _fs

    for frame in batches:
        out = []
        for path in frame["path"]:
            fs, place = _fs(path)
            with fs.open_input_file(place) as f:
                columns = pq.ParquetFile(f).schema_arrow
            out.append((path, "\n".join(f"{c.name}: {c.type}" for c in columns)))
        yield pd.DataFrame(out, columns=["path", "signature"])


def shard_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The shards of a folder, those with the same columns together."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path")
    groups = defaultdict(list)
    for r in files.mapInPandas(_signatures, "path string, signature string").collect():
        groups[r.signature].append(r.path)
    return [sorted(groups[k]) for k in sorted(groups)]


def conform(rows: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` under the store's schema, with ``drift``; columns in ``keep`` pass as they are."""
    have = {f.name: f.dataType for f in rows.schema.fields}
    columns: list[Column] = []
    strays: list[tuple[Column, Column]] = []  # (value that is kept, whether there is one)
    for f in schema.fields:
        at = F.col(f"`{f.name}`")
        if f.name not in have:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif widens(have[f.name], f.dataType):
            columns.append(at.cast(f.dataType).alias(f.name))
        else:
            fits = at.try_cast(f.dataType) if _castable(have[f.name], f.dataType) else F.lit(None).cast(f.dataType)
            columns.append(fits.alias(f.name))
            lost = at.isNotNull() & fits.isNull()
            strays.append((F.when(lost, at).alias(f.name), lost))
    for name in sorted(set(have) - set(schema.fieldNames()) - set(keep)):
        strays.append((F.col(f"`{name}`").alias(name), F.col(f"`{name}`").isNotNull()))
    drift = F.lit(None).cast("variant")
    if strays:
        some = strays[0][1]
        for _, lost in strays[1:]:
            some = some | lost
        drift = F.when(some, F.to_variant_object(F.struct(*[value for value, _ in strays])))
    return rows.select(*columns, *keep, drift.alias(DRIFT))


def _castable(have: T.DataType, want: T.DataType) -> bool:
    atomic = lambda t: not isinstance(t, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))
    return atomic(have) and atomic(want)


def scan_drifted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All shards of ``path`` under ``schema``, with ``source_file`` and ``drift``."""
    out = None
    for files in shard_groups(spark, path):
        rows = spark.read.parquet(*files).select("*", F.col("_metadata.file_name").alias("source_file"))
        rows = conform(rows, schema, ("source_file",))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = spark.createDataFrame([], schema).select("*", F.lit("").alias("source_file"), F.lit(None).cast("variant").alias(DRIFT))
    return out
