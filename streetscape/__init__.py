"""Incremental analytics over geo-tagged street-level images, as Spark DataFrame operators.

Sub-packages:
    functions  column-level helpers (glob patterns, WKB geometry, time parsing)
    sources    readers: landed capture pages, image files, the two stores, labels
    operators  DataFrame -> DataFrame steps (AOI, captures, stores, atlas, summaries, scoring)
    sinks      writers: store appends, the GeoParquet deliverable, the alias atlas JSON
    plans      whole-pipeline compositions and the driver's test-table queries
    streaming  the same steps as Structured Streaming jobs
"""

__version__ = "0.1.0"
