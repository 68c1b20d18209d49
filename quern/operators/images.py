"""Captioned image references of page sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.captions import caption_of, find_file_tags
from quern.functions.convert import Converter, seed
from quern.functions.native import file_url
from quern.operators.udf import text_column
from quern.runtime import prepare

EXTENSIONS = tuple("apng avif bmp emf gif heic heif ico jfif jpeg jpg pbm pgm png ppm svg tif tiff webp wmf xbm xpm".split())
PLACEHOLDERS = ("no free image", "no image")
SITE = "https://zh.wikipedia.org/wiki"
URL_PREFIX = f"{SITE}/Special:FilePath/"


def has_image_extension(name: Column) -> Column:
    return F.lower(name).rlike(r"\.(?:" + "|".join(EXTENSIONS) + r")\z")


def is_placeholder(name: Column) -> Column:
    lowered = F.lower(name)
    return F.contains(lowered, F.lit(PLACEHOLDERS[0])) | F.contains(lowered, F.lit(PLACEHOLDERS[1]))


def file_name(tag: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(tag, r"\A\[\[File:([^|\]]+)", 1), r"(?U)\A\s+|\s+\z", "")


def tags(pages: DataFrame, text: str = "text") -> DataFrame:
    """One row for each balanced file tag of each line, with ``line_no`` and ``pos``."""
    prepare(pages.sparkSession)
    rest = [F.col(f"`{c}`") for c in pages.columns if c != text]
    lines = pages.filter(F.contains(F.col(text), F.lit("[[File:"))).select(*rest, F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))
    lines = lines.filter(F.contains(F.col("line"), F.lit("[[File:")))
    found = text_column(find_file_tags, "array<string>", F.col("line"))
    return lines.select(*rest, "line_no", F.posexplode(found).alias("pos", "tag"))


def first_with_caption(candidates: DataFrame, order: list[str]) -> DataFrame:
    """The first row of each ``file_name`` by ``order`` among those with a non-empty ``title``."""
    seen = Window.partitionBy("file_name").orderBy(*order)
    return candidates.filter(F.col("title") != "").withColumn("turn", F.row_number().over(seen)).filter("turn = 1").drop("turn")


def image_records(pages: DataFrame, lang: str | None = "tw", max_images: int | None = None, pairs: list[tuple[str, str]] | None = None, prefix: str = URL_PREFIX) -> DataFrame:
    """(url, title, file_name, page, tag) of the first captioned tag of each image of (id, title, text) pages.

    Pages go by numeric id, then id; ``max_images`` takes the first images in that order. Filters come
    before the caption function, and only images with captions count as seen.
    """
    found = tags(pages.select(F.col("id").cast("bigint").alias("page_ord"), "id", F.col("title").alias("page"), "text"))
    found = found.withColumn("file_name", file_name(F.col("tag")))
    found = found.filter(has_image_extension(F.col("file_name")) & ~is_placeholder(F.col("file_name")))
    found = found.withColumn("title", text_column(caption_of, "string", F.col("tag")))
    order = ["page_ord", "id", "line_no", "pos"]
    first = first_with_caption(found, order)
    if max_images is not None:
        first = first.orderBy(*order).limit(max_images)
    if lang:
        first = first.withColumn("title", text_column(Converter(pairs) if pairs is not None else seed(lang), "string", F.col("title")))
    return first.select(file_url(F.col("file_name"), prefix).alias("url"), "title", "file_name", "page", "tag")
