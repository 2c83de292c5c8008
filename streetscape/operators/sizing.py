"""Size-checked broadcast.

A side is broadcast only when it is proved small in bytes; otherwise it is returned as is and
Spark plans a shuffle join (AQE may still switch to broadcast at run time from real sizes).
The check is a job of its own, so it is used only for lookup-sized inputs (atlas, alias map, AOIs,
candidate id batches), never for fact tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of rows up to which a lookup side is broadcast; far below the executors' memory.
DEFAULT_BROADCAST_BYTES = 64 << 20
ROW_BYTES = 16


def _bytes(name: str, kind: T.DataType):
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) * 16 + 8
    return F.lit(16)


def size_in_bytes(df: DataFrame) -> int:
    """About the bytes of all rows, as a partial aggregate: every task sums its own rows, one
    number a task is shuffled."""
    per_row = reduce(lambda a, b: a + b, [_bytes(f.name, f.dataType) for f in df.schema.fields], F.lit(ROW_BYTES))
    return int(df.agg(F.coalesce(F.sum(per_row.cast("long")), F.lit(0))).first()[0])


def is_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when the rows of ``df`` take at most ``max_bytes``."""
    return size_in_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_bytes) else df
