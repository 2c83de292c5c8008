"""K1, S3, G6 at scale: shards clustered in space, with a manifest of their boxes.

Rows are range-partitioned by the Morton key of their place, so that a shard covers a small part of the map, and each
append adds one row per shard to a manifest beside the store: file, rows and the box of its points, taken from the
shard's own data. A scan of a box reads the manifest and opens the shards whose boxes meet it; ``within_bbox`` then tests
every point, so the answer is that of a full scan.

The manifest is written after the shards it tells of. A run that dies in between leaves shards that no manifest row
names: they are found by the folder's listing and opened by every scan, until ``complete_manifest`` adds them.

Many rows at one place don't make one task: the range also divides by a hash of the row's id.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetscape.operators.aoi import within_bbox

MANIFEST = "_manifest"
MANIFEST_DDL = "file string, n_rows long, unplaced long, west double, south double, east double, north double"
BITS = 16
#: Rows of a shard, about.
SHARD_ROWS = 1_000_000
#: (shift, mask) that move the 16 bits of a number to every second place.
SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _cell(value: Column, low: float, high: float) -> Column:
    top = (1 << BITS) - 1
    at = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(1 << BITS)))
    return F.when(value.isNotNull(), F.least(F.greatest(at, F.lit(0)), F.lit(top)).cast("long"))


def _spread(bits: Column) -> Column:
    for shift, mask in SPREAD:
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return bits


def morton(lon: Column | str, lat: Column | str) -> Column:
    """The Morton key of a place: the bits of its column and row in a grid of 2^16 by 2^16 cells over the globe, in turn.
    Null without a place; places beyond the globe's edges count as on them."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (lon, lat))
    return _spread(_cell(x, -180.0, 180.0)).bitwiseOR(F.shiftleft(_spread(_cell(y, -90.0, 90.0)), 1))


def _names(spark: SparkSession, path: str) -> list[str]:
    """The data files of the folder, as Spark lists them for any scan."""
    try:
        return sorted(f.rsplit("/", 1)[-1] for f in spark.read.schema("image_id string").parquet(path).inputFiles())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard that is told of; none where there is no manifest yet."""
    try:
        rows = spark.read.schema(MANIFEST_DDL).parquet(f"{path.rstrip('/')}/{MANIFEST}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_DDL)
    return rows.dropDuplicates(["file"])


def _untold(spark: SparkSession, path: str) -> list[str]:
    told = {r.file for r in manifest(spark, path).select("file").collect()}  # a name for each shard, as its listing
    return [f for f in _names(spark, path) if f not in told]


def complete_manifest(spark: SparkSession, path: str, lon: str = "lon", lat: str = "lat") -> int:
    """Add the boxes of shards that the manifest doesn't name; returns their number. Only the two coordinates of those
    shards are read."""
    files = _untold(spark, path)
    if not files:
        return 0
    root = path.rstrip("/")
    places = spark.read.schema(f"`{lon}` double, `{lat}` double").parquet(*[f"{root}/{f}" for f in files])
    x, y = F.col(lon), F.col(lat)
    placed = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    boxes = places.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("n_rows"),
        F.count_if(~placed).alias("unplaced"),
        F.min(F.when(placed, x)).alias("west"),
        F.min(F.when(placed, y)).alias("south"),
        F.max(F.when(placed, x)).alias("east"),
        F.max(F.when(placed, y)).alias("north"),
    )
    empty = spark.createDataFrame([(f,) for f in files], "file string")
    rows = empty.join(boxes, "file", "left").na.fill(0, ["n_rows", "unplaced"])
    rows.coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST}")
    return len(files)


def append_clustered(df: DataFrame, path: str, shards: int | None = None, lon: str = "lon", lat: str = "lat", key: str = "image_id", shard_rows: int = SHARD_ROWS) -> int:
    """Append ``df`` as shards that lie together in space, and tell of them in the manifest; returns their number.
    ``shards``: how many, by default one for every ``shard_rows`` rows (which are then counted first)."""
    if shards is None:
        shards = max(1, -(-df.count() // shard_rows))
    placed = df.withColumn("__key", morton(lon, lat))
    spread = placed.repartitionByRange(shards, F.col("__key"), F.xxhash64(key)).sortWithinPartitions("__key").drop("__key")
    spread.write.mode("append").option("compression", "zstd").parquet(path)
    return complete_manifest(df.sparkSession, path, lon, lat)


def shards_meeting(spark: SparkSession, path: str, box: Row) -> list[str]:
    """The files that may hold a point of the box: those whose box meets it, and those the manifest doesn't name."""
    told = manifest(spark, path)
    meets = (F.col("west") <= box["east"]) & (F.col("east") >= box["west"]) & (F.col("south") <= box["north"]) & (F.col("north") >= box["south"])
    return sorted({r.file for r in told.where(meets).select("file").collect()} | set(_untold(spark, path)))


def scan_box(spark: SparkSession, path: str, box: Row, schema: T.StructType, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Rows inside the box, from the shards that meet it."""
    files = shards_meeting(spark, path, box)
    if not files:
        return spark.createDataFrame([], schema)
    return within_bbox(spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{f}" for f in files]), box, lon, lat)
