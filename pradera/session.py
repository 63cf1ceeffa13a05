"""Session and shared-folder helpers.

Nothing here sets cluster-wide settings on an existing session except the
checkpoint folder, and only when the cluster did not name one.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "pradera") -> SparkSession:
    """Session for tests, bench and local runs. On a cluster use the provided session."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          # no Python call-site capture per Column call (a JVM round trip each)
          .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    Where none is named, a session whose driver and executors are one process (a local master) gets a folder of its
    own; any other session is an error, since executors would write to their own disks.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("no shared folder: set spark.checkpoint.dir")
        conf = tempfile.mkdtemp(prefix="pradera-ckpt-")
        atexit.register(shutil.rmtree, conf, ignore_errors=True)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster).

    It lies in a folder of the application's own, which the file system deletes when the driver ends; not before,
    since frames that were built on it are lazy."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not base:
        raise RuntimeError("no shared folder: set spark.checkpoint.dir")
    sc = spark.sparkContext
    own = f"{base}/pradera-{sc.applicationId}"
    path = sc._jvm.org.apache.hadoop.fs.Path(own)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def write_once(df, name: str):
    """Write a frame into the shared folder and read it back: its input is computed once, whoever reads it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per application), as ``--py-files`` does."""
    sc = spark.sparkContext
    if "pradera.zip" in sc._python_includes:
        return
    here = Path(__file__).resolve().parent
    zipped = Path(tempfile.mkdtemp(prefix="pradera-package-")) / "pradera.zip"
    with zipfile.ZipFile(zipped, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    atexit.register(shutil.rmtree, zipped.parent, ignore_errors=True)  # executors fetch it as they start
    sc.addPyFile(str(zipped))


__all__ = ["get_spark", "ensure_checkpoint_dir", "scratch_path", "write_once", "ship_package"]
