"""Markdown folders, record files, and choosing the newest of dated folders."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.native import strip
from quern.schema import IMAGE


def read_markdown(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """(source_file, value) of every ``*.md`` below ``folder`` that is not blank, without a byte-order mark.

    ``max_files`` takes the first files by path. Bytes that are no UTF-8 become U+FFFD.
    """
    rows = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    rows = rows.select(F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("value"))
    if max_files:
        rows = rows.orderBy("path").limit(max_files)
    return rows.filter(F.length(strip(F.col("value"))) > 0).select("source_file", "value")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Image records of JSON lines (a glob may name several shards); malformed lines are skipped."""
    return spark.read.schema(IMAGE).option("mode", "DROPMALFORMED").json(path)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name) of the files of a folder; contents are not read."""
    return spark.read.format("binaryFile").load(folder).select(F.col("_metadata.file_name").alias("file_name"))


def newest(names: DataFrame, column: str, digits: int) -> DataFrame:
    """The largest name made of exactly ``digits`` digits, in one row (null if none)."""
    return names.filter(F.col(column).rlike(rf"\A[0-9]{{{digits}}}\z")).agg(F.max(column).alias(column))


def latest_dump_date(index: Column, latest_page: Column) -> Column:
    """``YYYYMMDD`` of a dump index page: the largest dated folder, else the date shown, else today."""
    folders = F.regexp_extract_all(index, F.lit(r"\[([0-9]{8})/\]"), F.lit(1))
    shown = F.nullif(F.regexp_extract(latest_page, r"([0-9]{2}-[A-Z][a-z]{2}-[0-9]{4})", 1), F.lit(""))
    return F.coalesce(F.array_max(folders), F.date_format(F.try_to_date(shown, "dd-MMM-yyyy"), "yyyyMMdd"), F.date_format(F.current_date(), "yyyyMMdd"))


def month_of(day: str) -> str:
    """``YYYYMM`` of a dump date, or of today where the name is no date."""
    return day[:6] if re.fullmatch(r"\d{8}", day) else f"{date.today():%Y%m}"


def dump_state(local_size: int | None, remote_size: int) -> tuple[bool, bool]:
    """(exists, complete) of a local dump; an unknown remote size, 0, is no evidence against it."""
    return local_size is not None, local_size is not None and (remote_size == 0 or local_size == remote_size)


def parse_shown_date(text: str) -> str | None:
    try:
        return f"{datetime.strptime(text, '%d-%b-%Y'):%Y%m%d}"
    except ValueError:
        return None
