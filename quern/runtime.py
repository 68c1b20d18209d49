"""Session plumbing shared by every layer: settings, module shipping, work tables."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent

#: Bounds what one Arrow batch may hold, so that a run of very long texts cannot fill a worker.
ARROW_BATCH_BYTES = "8m"


def prepare(spark: SparkSession) -> SparkSession:
    """Make ``spark`` ready for Python operators; cheap and safe to call again.

    The package goes to the executors as a zip, so that workers can import it wherever the driver
    was started from, and Arrow batches are bounded by bytes besides rows.
    """
    context = spark.sparkContext
    if getattr(context, "_quern_shipped", None) is None:
        archive = Path(tempfile.mkdtemp(prefix="quern-zip-")) / "quern_package.zip"
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            for source in sorted(PACKAGE.rglob("*.py")):
                z.write(source, Path(PACKAGE.name) / source.relative_to(PACKAGE))
        archive.write_bytes(packed.getvalue())
        context.addPyFile(str(archive))
        context._quern_shipped = str(archive)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees: ``spark.checkpoint.dir``.

    Only a single-machine session (tests) may go without it and gets a temporary folder.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if getattr(spark.sparkContext, "_quern_shared", None) is None:
        spark.sparkContext._quern_shared = "file://" + tempfile.mkdtemp(prefix="quern-shared-")
    return spark.sparkContext._quern_shared


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _delete_late(spark: SparkSession, path: str) -> None:
    try:
        delete_path(spark, path)
    except Exception:  # noqa: BLE001  the session may have ended before: then only its files are left
        if path.startswith("file:"):
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


class Workspace:
    """Tables written to the shared folder to cut lineage; they outlive any executor.

    Used as a context manager: on leaving, everything goes but the table of ``result``, which stays as
    long as the session may read it and goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.root = f"{shared_dir(spark)}/quern-{name}-{uuid.uuid4().hex}"
        self.kept: str | None = None

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *_: object) -> None:
        delete_path(self.spark, self.root)
        if self.kept:
            atexit.register(_delete_late, self.spark, self.kept)

    def save(self, df: DataFrame, table: str) -> DataFrame:
        path = f"{self.root}/{table}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, table: str) -> None:
        delete_path(self.spark, f"{self.root}/{table}")

    def result(self, df: DataFrame) -> DataFrame:
        self.kept = f"{shared_dir(self.spark)}/quern-{self.name}-result-{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(self.kept)
        return self.spark.read.schema(df.schema).parquet(self.kept)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))
