"""WKB point geometry as column functions.

Encoding (lon/lat -> 21-byte little-endian WKB point, x first) and coordinate decoding run as
Arrow UDFs: one NumPy pass per Arrow batch, no per-row Python. Type names and WKT text are
native Spark expressions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINT_DTYPE = np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])

# WKB geometry type codes (ISO, modulo 1000 for Z/M/ZM) -> lower-case names (fixed values).
WKB_TYPE_NAMES = {
    1: "point",
    2: "linestring",
    3: "polygon",
    4: "multipoint",
    5: "multilinestring",
    6: "multipolygon",
    7: "geometrycollection",
}


def _encode_points(x: pa.Array, y: pa.Array) -> pa.Array:
    n = len(x)
    xs = x.to_numpy(zero_copy_only=False)
    ys = y.to_numpy(zero_copy_only=False)
    rec = np.zeros(n, dtype=_POINT_DTYPE)
    rec["order"] = 1
    rec["kind"] = 1
    rec["x"] = xs
    rec["y"] = ys
    mask = pa.compute.or_(pa.compute.is_null(x), pa.compute.is_null(y))
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(21), n, [None, pa.py_buffer(rec.tobytes())])
    out = fixed.cast(pa.binary())
    if mask.true_count:
        out = pa.compute.if_else(mask, pa.scalar(None, pa.binary()), out)
    return out


@F.arrow_udf(T.BinaryType())
def _point_wkb_udf(x: pa.Array, y: pa.Array) -> pa.Array:
    return _encode_points(x.cast(pa.float64()), y.cast(pa.float64()))


def _decode_coord(wkb: pa.Array, offset: int) -> pa.Array:
    """Gather 8 bytes at ``offset`` of every value with NumPy indexing (no per-row Python)."""
    arr = wkb.cast(pa.binary())
    n = len(arr)
    if n == 0:
        return pa.array([], pa.float64())
    _, off_buf, data_buf = arr.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int32, count=n + 1, offset=arr.offset * 4)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    valid = (lengths >= 21) & ~arr.is_null().to_numpy(zero_copy_only=False)
    starts = np.where(valid, offsets[:-1], 0)
    if len(data) < 21:
        data = np.zeros(21, np.uint8)
    order = data[starts]
    raw = data[starts[:, None] + offset + np.arange(8)]
    big = valid & (order == 0)
    raw[big] = raw[big][:, ::-1]
    out = raw.copy().view("<f8").reshape(n)
    return pa.array(out, mask=~valid)


@F.arrow_udf(T.DoubleType())
def _point_x_udf(wkb: pa.Array) -> pa.Array:
    return _decode_coord(wkb, 5)


@F.arrow_udf(T.DoubleType())
def _point_y_udf(wkb: pa.Array) -> pa.Array:
    return _decode_coord(wkb, 13)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point_wkb(lon: Column | str, lat: Column | str) -> Column:
    """WKB point with x = lon, y = lat (axis order pinned). NULL when either is NULL."""
    return _point_wkb_udf(_col(lon), _col(lat))


def point_x(wkb: Column | str) -> Column:
    return _point_x_udf(_col(wkb))


def point_y(wkb: Column | str) -> Column:
    return _point_y_udf(_col(wkb))


def wkb_type_code(wkb: Column | str) -> Column:
    """Geometry type code from the WKB header (byte order aware), ISO Z/M folded (mod 1000)."""
    w = _col(wkb)
    header = F.hex(F.substring(w, 2, 4))
    little = F.hex(F.substring(w, 1, 1)) == F.lit("01")
    le = F.concat(
        F.substring(header, 7, 2), F.substring(header, 5, 2), F.substring(header, 3, 2), F.substring(header, 1, 2)
    )
    code = F.conv(F.when(little, le).otherwise(header), 16, 10).cast("bigint")
    # EWKB sets high flag bits; keep the low 16 bits, then fold ISO Z/M/ZM.
    return F.pmod(F.pmod(code, F.lit(65536)), F.lit(1000))


def geometry_type(wkb: Column | str) -> Column:
    """Lower-case geometry type name (``point``, ``polygon``, ...) or NULL."""
    code = wkb_type_code(wkb)
    expr = F.lit(None).cast("string")
    for k, name in WKB_TYPE_NAMES.items():
        expr = F.when(code == k, F.lit(name)).otherwise(expr)
    return F.when(_col(wkb).isNull(), F.lit(None).cast("string")).otherwise(expr)


def wkb_to_wkt(wkb: Column | str) -> Column:
    """``POINT (x y)`` preview text for point WKB."""
    return F.when(
        geometry_type(wkb) == "point",
        F.format_string("POINT (%s %s)", point_x(wkb).cast("string"), point_y(wkb).cast("string")),
    )
