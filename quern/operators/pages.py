"""Page filters and rendering (dump pages to Markdown)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.wikitext import page_to_markdown
from quern.operators.udf import text_column
from quern.runtime import prepare

DROPPED_NAMESPACES = ("Category", "Draft", "File", "Help", "MediaWiki", "Portal", "Template", "Topic", "Wikipedia", "模块")
MIN_RAW_LENGTH = 30


def in_dropped_namespace(title: Column) -> Column:
    return F.contains(title, F.lit(":")) & F.substring_index(title, ":", 1).isin(*DROPPED_NAMESPACES)


def is_redirect(text: Column) -> Column:
    return F.startswith(text, F.lit("#"))


def articles(pages: DataFrame, min_length: int = MIN_RAW_LENGTH) -> DataFrame:
    """Pages of the article namespace that are no redirect and have ``min_length`` characters of source."""
    return pages.filter(~in_dropped_namespace(F.col("title")) & ~is_redirect(F.col("text")) & (F.length("text") >= min_length))


def to_markdown(pages: DataFrame, strict: bool = False, limit: int | None = None) -> DataFrame:
    """(page_id, md) of the articles of ``pages``; ``limit`` takes the first pages by id, for trials."""
    prepare(pages.sparkSession)
    kept = articles(pages)
    if limit is not None:
        kept = kept.orderBy(F.col("id").cast("bigint"), "id").limit(limit)
    render = text_column(lambda text, title: page_to_markdown(title or "", text, strict), "string", F.col("text"), F.col("title"))
    return kept.select(F.col("id").alias("page_id"), render.alias("md"))
