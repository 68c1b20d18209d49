"""Sharded JSON outputs, page files and month folders."""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.shards import MEBIBYTE, approximate_parts, assign_parts, json_item, json_line


def file_system(folder: str) -> tuple[object, str]:
    """(file system, path in it) of a folder, by its scheme: a local path, file:, hdfs:, s3: and what else pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), os.path.abspath(folder))


def _write_parts(numbered: DataFrame, folder: str, stem: str, suffix: str, as_array: bool) -> DataFrame:
    """One file for each part, by the task that holds it, lines in order; gives (part_no, file, records).

    A file is written under another name and then moved, so that a task may run again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(folder)
        out, part, records, partial = None, None, 0, ""

        def close() -> pd.DataFrame:
            if as_array:
                out.write(b"\n]")
            out.close()
            name = f"{stem}{part}{suffix}"
            system.move(partial, f"{root}/{name}")
            return pd.DataFrame({"part_no": [part], "file": [f"{folder.rstrip('/')}/{name}"], "records": [records]})

        system.create_dir(root, recursive=True)
        for batch in batches:
            for number, line in zip(batch["part_no"], batch["line"]):
                if number != part:
                    if out is not None:
                        yield close()
                    part, records = number, 0
                    partial = f"{root}/.{stem}{number}{suffix}-{uuid.uuid4().hex}"
                    out = system.open_output_stream(partial)
                    out.write(b"[\n" if as_array else b"")
                out.write(((",\n" if as_array and records else "") + line + ("" if as_array else "\n")).encode())
                records += 1
        if out is not None:
            yield close()

    return numbered.mapInPandas(run, "part_no bigint, file string, records bigint")


def _numbered(lined: DataFrame, order: list[str], most: int, parallel: bool, **rule: object) -> DataFrame:
    """Parts of lines, in order inside each; ``parallel`` packs every partition for itself rather than all rows in one fold."""
    if not parallel:
        return assign_parts(lined, order, "__bytes", most, **rule).repartition("part_no").sortWithinPartitions("part_no", *order).select("part_no", "line")
    return approximate_parts(lined.sortWithinPartitions(*order).select("line", "__bytes"), "__bytes", most).select("part_no", "line")


def write_json_lines(rows: DataFrame, folder: str, stem: str, order: list[str], most: int = 500 * MEBIBYTE, close_after: bool = False, fields: list[str] | None = None, parallel: bool = False) -> DataFrame:
    """``<stem><n>.jsonl`` files of at most ``most`` bytes, but for single larger records; none for no rows.

    ``close_after`` ends a file once it has reached ``most`` rather than before. ``folder`` is one that
    executors share. With ``parallel`` each partition fills files of its own, whose numbers leave gaps; no row
    is shuffled and none waits for another, but order holds inside files only, and ``close_after`` has no effect.
    """
    named = fields or rows.columns
    lined = rows.withColumn("line", json_line(*named)).withColumn("__bytes", F.octet_length("line") + 1)
    return _write_parts(_numbered(lined, order, most, parallel, close_after=close_after), folder, stem, ".jsonl", False)


def write_json_arrays(rows: DataFrame, folder: str, stem: str, order: list[str], most: int = 500 * MEBIBYTE, fields: list[str] | None = None, parallel: bool = False) -> DataFrame:
    """``<stem>_part<n>.json`` files, each one JSON array indented by two blanks.

    A record counts as many bytes as its line has, and 10 for its layout where it may start a file.
    """
    named = fields or rows.columns
    lined = rows.withColumn("line", json_item(*named)).withColumn("__bytes", F.octet_length(json_line(*named)))
    return _write_parts(_numbered(lined, order, most, parallel, overhead=10), folder, f"{stem}_part", ".json", True)


def export_pages(markdown: DataFrame, folder: str, suffix: str = ".md") -> DataFrame:
    """One file a page, ``<page_id>.md``, for tools that want files; gives (page_id, file)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            files = []
            for page, text in zip(batch["page_id"], batch["md"]):
                partial = f"{root}/.{page}{suffix}-{uuid.uuid4().hex}"
                with system.open_output_stream(partial) as out:
                    out.write(text.encode())
                system.move(partial, f"{root}/{page}{suffix}")
                files.append(f"{folder.rstrip('/')}/{page}{suffix}")
            yield pd.DataFrame({"page_id": batch["page_id"], "file": files})

    return markdown.select("page_id", "md").mapInPandas(run, "page_id string, file string")


def prune_months(root: str, current: str, confirm: bool = False) -> list[str]:
    """Month folders (six digits) before ``current``; they are deleted only with ``confirm``."""
    old = sorted(p.name for p in Path(root).iterdir() if p.is_dir() and re.fullmatch(r"\d{6}", p.name) and p.name < current) if Path(root).is_dir() else []
    if confirm:
        for name in old:
            shutil.rmtree(Path(root, name))
    return old


def download_dump(url: str, target: str, open_url: object, expected: int = 0, chunk: int = 8192) -> tuple[int, bool]:
    """Stream ``open_url(url)`` to ``target`` in chunks; (bytes, whether they are as many as expected)."""
    written = 0
    with open_url(url) as source, open(f"{target}.partial", "wb") as out:
        while block := source.read(chunk):
            written += out.write(block)
    os.replace(f"{target}.partial", target)
    return written, expected in (0, written)


def remote_size(url: str, open_head: object) -> int:
    """Bytes that a HEAD request announces, by ``open_head(url)`` (a mapping of headers); 0 if unknown."""
    try:
        return int(open_head(url).get("Content-Length") or 0)
    except (OSError, ValueError):
        return 0
