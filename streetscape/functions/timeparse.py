"""Bounds of the capture-time filter, always in UTC."""

from __future__ import annotations

from datetime import UTC, datetime


def parse_utc_bound(text: str | None) -> datetime | None:
    """The naive UTC time an ISO-8601 text names: a date stands for its midnight, an offset is applied, a time
    without one is UTC. ``None``, "no bound", for an empty text and for one that isn't a time (the caller reports it)."""
    try:
        at = datetime.fromisoformat((text or "").strip())
    except ValueError:
        return None
    return at if at.tzinfo is None else at.astimezone(UTC).replace(tzinfo=None)


def ntz_literal(dt: datetime):
    """A TIMESTAMP_NTZ literal built from text, so the value never passes through the Python
    process's local time zone (``F.lit(naive_datetime)`` does)."""
    from pyspark.sql import functions as F

    return F.lit(dt.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
