"""Column-level helpers."""

from streetscape.functions.geo import geometry_type, point_wkb, point_x, point_y, wkb_to_wkt
from streetscape.functions.glob import glob_to_regex
from streetscape.functions.timeparse import parse_utc_bound

__all__ = [
    "geometry_type",
    "glob_to_regex",
    "parse_utc_bound",
    "point_wkb",
    "point_x",
    "point_y",
    "wkb_to_wkt",
]
