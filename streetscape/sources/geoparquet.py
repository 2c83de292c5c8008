"""Reading GeoParquet, native geometry and WKB alike, with pruning by footer boxes.

``format("geoparquet")`` gives a table's columns, the geometry as WKB, and the coordinates of its points as ``geom_x`` and
``geom_y``. Comparisons of these two with numbers are pushed to the reader: the tasks open the footers of their files,
leave those whose box lies outside, and hand on only rows within the bounds. Spark applies every filter again, so the
pushed bounds need only be necessary. A partition is a group of files of about ``GROUP_BYTES``; footers are read by the tasks,
the driver sees file names and sizes only.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from streetscape.functions.geo import _decode_coord
from streetscape.sinks.geoparquet import _fs, qualified, register

X, Y = "geom_x", "geom_y"
GROUP_BYTES = 128 << 20
BATCH_ROWS = 512


def data_files(path: str) -> list[pafs.FileInfo]:
    fs, base = _fs(path)
    found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    return sorted((i for i in found if i.type == pafs.FileType.File and i.base_name.endswith(".parquet") and i.base_name[0] not in "._"), key=lambda i: i.path)


def geo_key(footer: pq.FileMetaData) -> dict:
    told = (footer.metadata or {}).get(b"geo")
    return json.loads(told) if told else {}


def file_box(footer: pq.FileMetaData, geometry: str) -> list[float] | None:
    """west, south, east, north of a file's points, if its footer tells them."""
    box = geo_key(footer).get("columns", {}).get(geometry, {}).get("bbox")
    if not box:
        return None
    half = len(box) // 2  # boxes with heights have six numbers
    return [box[0], box[1], box[half], box[half + 1]]


def schema_of(path: str, geometry: str) -> T.StructType:
    """The columns of the first file, the geometry as binary, and the two coordinates."""
    from pyspark.sql.pandas.types import from_arrow_type

    files = data_files(path)
    if not files:
        raise FileNotFoundError(f"{path} holds no parquet file")
    fs, _ = _fs(path)
    with fs.open_input_file(files[0].path) as f:
        arrow = pq.ParquetFile(f).schema_arrow
    fields = [T.StructField(c.name, T.BinaryType() if c.name == geometry else from_arrow_type(c.type, prefer_timestamp_ntz=True)) for c in arrow]
    return T.StructType([*fields, T.StructField(X, T.DoubleType()), T.StructField(Y, T.DoubleType())])


@dataclass
class Files(InputPartition):
    paths: list[str] = field(default_factory=list)


class GeoReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType) -> None:
        self.path = options["path"].rstrip("/")
        self.geometry = options.get("geometry_column", "geom")
        self.schema = schema
        self.low = {X: -np.inf, Y: -np.inf}
        self.high = {X: np.inf, Y: np.inf}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = ".".join(getattr(f, "attribute", ()))
            if column in self.low:
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.low[column] = max(self.low[column], float(f.value))
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.high[column] = min(self.high[column], float(f.value))
            yield f  # Spark applies it again

    def bounded(self) -> bool:
        return any(np.isfinite([*self.low.values(), *self.high.values()]))

    def partitions(self) -> list[Files]:
        groups, held = [Files()], 0
        for info in data_files(self.path):
            if held and held + (info.size or 0) > GROUP_BYTES:
                groups.append(Files())
                held = 0
            groups[-1].paths.append(info.path)
            held += info.size or 0
        return groups

    def outside(self, box: list[float] | None) -> bool:
        return box is not None and (box[0] > self.high[X] or box[2] < self.low[X] or box[1] > self.high[Y] or box[3] < self.low[Y])

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = _fs(self.path)
        for path in partition.paths:
            with fs.open_input_file(path) as f:
                file = pq.ParquetFile(f)
                if not self.outside(file_box(file.metadata, self.geometry)):
                    yield from self._rows(file)

    def _rows(self, file: pq.ParquetFile) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(self.schema)
        have = set(file.schema_arrow.names)
        wanted = {c for c in target.names if c in have}
        if self.bounded() or {X, Y} & set(target.names):
            wanted |= {self.geometry} & have
        for batch in file.iter_batches(BATCH_ROWS, columns=sorted(wanted)):
            columns = {n: c.storage if isinstance(c, pa.ExtensionArray) else c for n, c in zip(batch.schema.names, batch.columns)}
            if self.geometry in columns:
                points = columns[self.geometry].cast(pa.binary())
                columns |= {self.geometry: points, X: _decode_coord(points, 5), Y: _decode_coord(points, 13)}
            rows = [columns[c.name].cast(c.type) if c.name in columns else pa.nulls(batch.num_rows, c.type) for c in target]
            out = pa.RecordBatch.from_arrays(rows, schema=target)
            if self.bounded():
                if X not in columns:
                    continue  # no geometry, no place: nothing of it can meet a bound
                keep = np.ones(batch.num_rows, bool)
                for c in (X, Y):
                    at = columns[c].to_numpy(zero_copy_only=False)
                    keep &= (at >= self.low[c]) & (at <= self.high[c]) | ~np.isfinite([self.low[c], self.high[c]]).any()
                out = out.filter(pa.array(keep))
            if out.num_rows:
                yield out


def read_geo(spark: SparkSession, path: str, box: Row | None = None, columns: list[str] | None = None, geometry: str = "geom") -> DataFrame:
    """The rows of a GeoParquet table, those in ``box`` if one is given; ``columns``: read only these and the coordinates."""
    register(spark)
    where = qualified(spark, path)
    reader = spark.read.format("geoparquet").option("geometry_column", geometry)
    if columns is not None:
        told = schema_of(where, geometry)
        reader = reader.schema(T.StructType([told[c] for c in columns if c not in (X, Y)] + [told[X], told[Y]]))
    rows = reader.load(where)
    if box is None:
        return rows
    return rows.where(F.col(X).between(box["west"], box["east"]) & F.col(Y).between(box["south"], box["north"]))
