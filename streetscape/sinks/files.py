"""Land binary payloads as one file per row (the layout ``sources.images.scan_image_files``
reads). Each task writes its own rows straight to the target file system; nothing passes
through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def land_files(df: DataFrame, path: str, id_col: str = "image_id", blob_col: str = "image_blob", ext: str = ".jpg") -> int:
    """Write ``blob_col`` of every row to ``<path>/<id><ext>``; returns the number of files."""
    from streetscape.sinks.geoparquet import qualified

    base = qualified(df.sparkSession, path.rstrip("/"))

    def write(batches):
        import pyarrow as pa

        from streetscape.sinks.geoparquet import _fs

        fs, root = _fs(base)
        fs.create_dir(root, recursive=True)
        for rb in batches:
            ids = rb.column(0).to_pylist()
            blobs = rb.column(1).to_pylist()
            for i, b in zip(ids, blobs):
                if i is None or b is None:
                    continue
                with fs.open_output_stream(f"{root}/{i}{ext}") as out:
                    out.write(b)
            yield pa.RecordBatch.from_arrays([pa.array([rb.num_rows], pa.int64())], names=["n"])

    written = df.select(id_col, blob_col).mapInArrow(write, "n bigint").agg(F.sum("n").alias("n")).first()
    return int(written["n"] or 0)
