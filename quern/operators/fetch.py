"""Idempotent fetching of image files with retries; the transport is given by the caller."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.schema import FETCH
from quern.sources.sinks import file_system

#: transport(url, timeout) -> (status, body)
Transport = Callable[[str, float], tuple[int, bytes]]


def wanted(images: DataFrame) -> DataFrame:
    """(url, file_name) of rows that have both, without a leading ``image/``."""
    rows = images.filter((F.col("url") != "") & (F.col("file_name") != ""))
    return rows.select("url", F.regexp_replace("file_name", "^image/", "").alias("file_name")).dropDuplicates(["file_name"])


def not_yet_fetched(rows: DataFrame, present: DataFrame) -> DataFrame:
    """Rows whose ``file_name`` is not in ``present`` (a listing with that column)."""
    return rows.join(present.select("file_name"), "file_name", "left_anti")


def available_locally(rows: DataFrame, present: DataFrame) -> DataFrame:
    return rows.join(present.select("file_name"), "file_name", "left_semi")


def _there(system: object, path: str) -> bool:
    return system.get_file_info(path).is_file


def fetch_one(url: str, name: str, folder: str, transport: Transport, reuse: str | None = None, tries: int = 3, timeout: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> tuple[str, str, str | None]:
    """(file_name, status, error); status is exists, copied, success or fail. Folders may be on any file system."""
    from pyarrow import fs

    system, root = file_system(folder)
    if _there(system, target := f"{root}/{name}"):
        return name, "exists", None
    partial = f"{root}/.{name.replace('/', '-')}-{uuid.uuid4().hex}"
    if reuse:
        old_system, old_root = file_system(reuse)
        if _there(old_system, old := f"{old_root}/{name}"):
            fs.copy_files(old, partial, source_filesystem=old_system, destination_filesystem=system)
            system.move(partial, target)
            return name, "copied", None
    error = "no attempt"
    for attempt in range(tries):
        try:
            status, body = transport(url, timeout)
        except OSError as e:
            status, body, error = 0, b"", str(e)
        if status == 200:
            with system.open_output_stream(partial) as out:
                out.write(body)
            system.move(partial, target)
            return name, "success", None
        if status:
            error = f"HTTP {status}"
        if attempt + 1 < tries:
            sleep(3 + 2 * attempt if status == 429 else 0.5)
    return name, "fail", error


def fetch(images: DataFrame, folder: str, transport: Transport, reuse: str | None = None, tasks: int = 15, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(file_name, status, error) of fetching every wanted image into ``folder``, which all executors share.

    Files are written under another name and moved, so that a task can run again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            yield pd.DataFrame([fetch_one(u, n, folder, transport, reuse, sleep=sleep) for u, n in zip(batch["url"], batch["file_name"])], columns=["file_name", "status", "error"])

    return wanted(images).repartition(tasks, "file_name").mapInPandas(run, FETCH)


def failed(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") == "fail").select("file_name")
