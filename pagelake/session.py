"""Session-level helpers: the shared folder for job data, and a local session for tests/bench."""

from __future__ import annotations

import io
import logging
import os
import re
import uuid
import zipfile

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Staged pages and landed files go here so that a lost executor never takes
    job data with it.  A local session (tests) that names no such folder gets one
    beside its warehouse; on a cluster a missing setting is an error, since a
    folder of the driver's machine is not one that executors see.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        # the conf cannot change at runtime; the context's checkpoint folder can
        sc.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "_checkpoints")
    return sc.getCheckpointDir().rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path) of a path, resolved as Spark's own readers and writers resolve it."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme (a path without one belongs to ``fs.defaultFS``, as in Spark)."""
    fs, where = hadoop_path(spark, path)
    return fs.makeQualified(where).toString()


_SCRATCH: dict[str, set[str]] = {}


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for a job's written tables, under the shared folder.

    It is registered with the Hadoop FileSystem to be deleted when the
    application ends; :func:`remove_folder` and :func:`release_scratch` delete it sooner.
    """
    folder = f"{shared_dir(spark)}/pagelake/{purpose}-{uuid.uuid4().hex}"
    fs, where = hadoop_path(spark, folder)
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    folder = fs.makeQualified(where).toString()
    _SCRATCH.setdefault(spark.sparkContext.applicationId, set()).add(folder)
    return folder


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder; missing is fine, and a failure is logged, never raised."""
    try:
        fs, where = hadoop_path(spark, path)
        fs.delete(where, True)
    except Exception as exc:  # cleaning up must not fail a finished load
        log.warning("Could not delete %s: %s", path, exc)
    _SCRATCH.get(spark.sparkContext.applicationId, set()).discard(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete every scratch folder of this application; frames that still read one cannot be used afterwards."""
    for folder in sorted(_SCRATCH.get(spark.sparkContext.applicationId, ())):
        remove_folder(spark, folder)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A file on any filesystem that Spark reaches."""
    fs, where = hadoop_path(spark, path)
    out = fs.create(where)
    try:
        for at in range(0, len(data), 1 << 20):
            out.write(bytearray(data[at:at + (1 << 20)]))
    finally:
        out.close()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pagelake") -> SparkSession:
    """A local session configured like the tests and the bench (UTC, AQE on, no UI)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def filesystem_uri(path: str) -> str:
    """A URI pyarrow resolves for a Spark/Hadoop path (``file:/x``, ``hdfs://nn/x``, ``s3a://b/x``).

    Tasks use it; the driver gives them paths from :func:`qualified`, so a path without
    a scheme is a local one here.
    """
    if "://" in path:
        scheme, rest = path.split("://", 1)
        return ("s3://" + rest) if scheme in ("s3a", "s3n") else path  # Hadoop S3 connectors -> pyarrow S3
    m = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):(/.*)$", path)
    if m:
        return filesystem_uri(f"{m.group(1)}://{m.group(2)}")
    return "file://" + os.path.abspath(path)


def resolve_filesystem(path: str):
    """(pyarrow filesystem, path inside it) for a Spark/Hadoop path."""
    from pyarrow import fs as pafs

    filesystem, inner = pafs.FileSystem.from_uri(filesystem_uri(path))
    return filesystem, inner.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers, once per application.

    As ``--py-files`` would, the package is zipped into the shared checkpoint folder
    and added with ``SparkContext.addPyFile``; workers import its functions by name.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    folder = scratch_folder(spark, "code")
    _SCRATCH[sc.applicationId].discard(folder)  # executors that start later fetch it: it stays until the end
    target = f"{folder}/pagelake.zip"
    write_bytes(spark, target, buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
