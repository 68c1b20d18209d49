"""Whole datasets from a dump: text records and captioned images, for one or both scripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.images import image_records
from quern.operators.pages import to_markdown
from quern.operators.records import text_records
from quern.runtime import Workspace
from quern.sources.dump import read_pages

LANGUAGES = ("tw", "cn")


def markdown_of_dump(spark: SparkSession, dump: str, limit: int | None = None) -> DataFrame:
    return to_markdown(read_pages(spark, dump), limit=limit)


def as_documents(markdown: DataFrame) -> DataFrame:
    """(source_file, value) of (page_id, md) rows."""
    return markdown.select(F.concat("page_id", F.lit(".md")).alias("source_file"), F.col("md").alias("value"))


def text_dataset(markdown: DataFrame, lang: str = "tw", **options: object) -> DataFrame:
    """(title, text, source_file) records of (page_id, md) rows."""
    return text_records(as_documents(markdown), lang, **options)


def image_dataset(spark: SparkSession, dump: str, lang: str | None = "tw", max_images: int | None = None, strict: bool = False, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Image records of a dump; ``strict`` scans escaped sources, so that tags and pages stay escaped."""
    return image_records(read_pages(spark, dump, keep_escaped=strict), lang, max_images, pairs=pairs)


def generate_all(spark: SparkSession, dump: str, out: str, languages: tuple[str, ...] = LANGUAGES, pairs: dict[str, list[tuple[str, str]]] | None = None) -> dict[str, str]:
    """Text and image tables of every language under ``out``; Markdown is rendered once and shared.

    ``pairs`` has conversion tables by language, in place of the seed.
    """
    paths = {}
    with Workspace(spark, "generate-all") as ws:
        markdown = ws.save(markdown_of_dump(spark, dump), "markdown")
        for lang in languages:
            for kind, rows in (("text", text_dataset(markdown, lang, pairs=(pairs or {}).get(lang))), ("images", image_dataset(spark, dump, lang, pairs=(pairs or {}).get(lang)))):
                paths[f"{lang}/{kind}"] = f"{out}/{lang}/{kind}"
                rows.write.mode("overwrite").parquet(paths[f"{lang}/{kind}"])
    return paths
