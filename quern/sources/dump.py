"""MediaWiki XML dumps, plain or bz2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PAGE = "title string, ns int, id string, revision struct<text:struct<_VALUE:string>>"


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """One row (``xml``) for each page element, still escaped.

    The text reader splits at the closing tag, so a large dump, compressed or not, is read in
    parallel; a closing tag inside a text is escaped in a well-formed dump.
    """
    chunks = spark.read.option("lineSep", "</page>").text(path).filter(F.contains(F.col("value"), F.lit("<page>")))
    return chunks.select(F.concat(F.regexp_extract("value", r"(?s)<page>.*", 0), F.lit("</page>")).alias("xml"))


def read_pages(spark: SparkSession, path: str, keep_escaped: bool = False) -> DataFrame:
    """(title, ns, id, text) of every page; ``keep_escaped`` leaves entities of title and text undecoded."""
    chunks = read_chunks(spark, path)
    parsed = chunks.select("xml", F.from_xml("xml", _PAGE, {"rowTag": "page", "ignoreSurroundingSpaces": "false"}).alias("page"))
    if keep_escaped:
        title, text = F.regexp_extract("xml", "<title>(.*?)</title>", 1), F.regexp_extract("xml", r"(?s)<text\b[^>]*?(?:/>|>(.*?)</text>)", 1)
    else:
        title, text = F.col("page.title"), F.coalesce(F.col("page.revision.text._VALUE"), F.lit(""))
    return parsed.select(title.alias("title"), F.col("page.ns").alias("ns"), F.trim(F.col("page.id")).alias("id"), text.alias("text"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines, entities undecoded, each with the title of the page that it belongs to."""
    lines = read_chunks(spark, path).select(F.regexp_extract("xml", "<title>(.*?)</title>", 1).alias("page"), F.posexplode(F.split("xml", "\n", -1)).alias("line_no", "line"))
    return lines
