"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in the package assumes: naive timestamps are UTC, AQE re-plans joins and
# shuffles at run time, Arrow carries data to Python workers.
SESSION_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # what is persisted gets as many partitions as its size asks for, too
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows that a Python worker holds at once: texts and images are kilobytes to megabytes each
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.parquet.mergeSchema": "false",
    # comparisons reach the GeoParquet reader
    "spark.sql.python.filterPushdown.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "streetscape",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults. The UI stays off."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime part of SESSION_CONF to an existing session and make the package
    importable by the Python workers."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked conf on a managed cluster
            pass
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def _package_zip() -> bytes:
    import io
    import zipfile
    from pathlib import Path

    pkg = Path(__file__).resolve().parent
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(pkg.rglob("*.py")):
            z.write(f, f.relative_to(pkg.parent).as_posix())
    return buf.getvalue()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors' Python workers (``addPyFile``), once per
    application. The zip is written under the shared checkpoint folder, so executors fetch it
    from the driver's file server like any other job file."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001  (Spark Connect: no SparkContext)
        app = None
    if app is not None and app in _SHIPPED:
        return
    data = _package_zip()
    target = f"{checkpoint_root(spark).rstrip('/')}/streetscape/pyfiles-{uuid.uuid4().hex[:12]}/streetscape.zip"
    try:
        from streetscape.sinks.geoparquet import _fs

        fs, p = _fs(target)
        fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(p) as out:
            out.write(data)
    except Exception:  # noqa: BLE001  (file system not reachable from PyArrow here)
        local = tempfile.mkdtemp(prefix="streetscape-pyfiles-")
        target = os.path.join(local, "streetscape.zip")
        with open(target, "wb") as out:
            out.write(data)
    try:
        spark.sparkContext.addPyFile(target)
    except Exception:  # noqa: BLE001
        spark.addArtifacts(target, pyfile=True)
    if app is not None:
        _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset (local tests) a private folder is created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        current = sc.getCheckpointDir()
        if current:
            return current
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir isn't set: on a cluster it names the folder that all executors share")
        root = tempfile.mkdtemp(prefix="streetscape-ckpt-")
        sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/streetscape/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.removeprefix("file:"), exist_ok=True)
    return path
