"""The text path as a stream: Markdown files that arrive in a folder become records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.records import text_records


def markdown_stream(spark: SparkSession, folder: str, files_a_batch: int = 1000) -> DataFrame:
    """(source_file, value, seen_at) of files as they arrive."""
    source = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.md").option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_a_batch)
    rows = source.load(folder)
    return rows.select(F.col("_metadata.file_name").alias("source_file"), F.regexp_replace("value", "^﻿", "").alias("value"), F.current_timestamp().alias("seen_at"))


def record_stream(docs: DataFrame, lang: str | None = "tw", **options: object) -> DataFrame:
    """Records of a stream of (source_file, value); all steps are stateless."""
    return text_records(docs.select("source_file", "value"), lang, **options)


def distinct_within(docs: DataFrame, key: str = "source_file", time: str = "seen_at", delay: str = "1 hour") -> DataFrame:
    """Documents whose key has not been seen within ``delay``."""
    return docs.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
