"""Session defaults and the shared-folder helpers every operator uses."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "admitta", master: str = "local[*]", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app).master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of a cluster on which it is not installed."""
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="admitta-package-")  # the driver serves it from here as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/admitta.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, f"{root.name}/{path.relative_to(root)}")
    spark.sparkContext.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Only where the session has none, and runs in one JVM, a local folder is set, which goes when the
    process ends.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="admitta-checkpoint-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_path(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system; none where it is not there."""
    at, fs = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def make_path(spark: SparkSession, path: str) -> None:
    at, fs = _file_system(spark, path)
    fs.mkdirs(at)


def delete_path(spark: SparkSession, path: str) -> None:
    at, fs = _file_system(spark, path)
    fs.delete(at, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file on any file system."""
    at, fs = _file_system(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text; null where it is not there."""
    at, fs = _file_system(spark, path)
    if not fs.exists(at):
        return None
    row = spark.read.text(path, wholetext=True).first()
    return row[0] if row else ""


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, computed once."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
