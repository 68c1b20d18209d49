"""Markdown documents to text records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.convert import Converter, seed, space_scripts
from quern.functions.markup import clean_markdown, markdown_to_text
from quern.functions.normalize import normalize
from quern.operators import quality
from quern.operators.sections import explode_sections
from quern.operators.udf import text_column
from quern.runtime import prepare


def prepared(value: Column, lang: str | None = "tw", pairs: list[tuple[str, str]] | None = None, faults: bool = False) -> Column:
    """Script conversion (off with None), spacing and Markdown cleaning of whole documents."""
    convert = (Converter(pairs) if pairs is not None else seed(lang)) if lang else (lambda text: text)
    return text_column(lambda text: clean_markdown(space_scripts(convert(text.removeprefix("\ufeff")))), "string", value, faults=faults)


def normalized(content: Column, faults: bool = False) -> Column:
    """struct(title, text) of a section's content."""

    def run(text: str) -> dict[str, str]:
        title, body = normalize(markdown_to_text(text))
        return {"title": title, "text": body}

    return text_column(run, "struct<title:string,text:string>", content, faults=faults)


def title_has(keywords: list[str] | None) -> Column:
    """Whether ``title`` holds one of the keywords; without keywords always true."""
    words = [F.contains(F.col("title"), F.lit(k)) for k in keywords or []]
    return reduce(lambda a, b: a | b, words) if words else F.lit(True)


def prepare_documents(docs: DataFrame, lang: str | None = "tw", pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """(source_file, value, fault): converted and cleaned documents; ``fault`` says why ``value`` is null."""
    prepare(docs.sparkSession)
    return docs.select("source_file", prepared(F.col("value"), lang, pairs, faults=True).alias("made")).select("source_file", "made.value", "made.fault")


def section_records(ready: DataFrame) -> DataFrame:
    """(title, text, source_file, section_no, fault) of every section of prepared documents, before the gate.

    ``section_no`` counts a document's sections from 0, in order. A section that some rule cannot handle has a
    null text and a ``fault``.
    """
    rows = explode_sections(ready.select("source_file", "value")).withColumn("made", normalized(F.col("content"), faults=True))
    title = F.coalesce(F.nullif(F.col("made.value.title"), F.lit("")), F.col("section_title"))
    return rows.select(title.alias("title"), F.col("made.value.text").alias("text"), "source_file", "section_no", F.col("made.fault").alias("fault"))


def gated_records(rows: DataFrame, min_length: int = 10, keywords: list[str] | None = None, gate: quality.Gate = quality.HAN) -> DataFrame:
    """Section records whose text is long and good enough and whose title holds a keyword, without faults."""
    good = quality.keep_good(rows.filter("fault is null").drop("fault"), gate=gate)
    return good.filter((F.length("text") >= min_length) & title_has(keywords))


def text_records(docs: DataFrame, lang: str | None = "tw", min_length: int = 10, keywords: list[str] | None = None, gate: quality.Gate = quality.HAN, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """(title, text, source_file) records of (source_file, value) documents.

    One row a section: converted and cleaned as part of its document, then split off, turned into plain
    text, normalised and gated. A text that some rule cannot handle gives no record; ``prepare_documents`` and
    ``section_records``, of which this is made, tell which and why.
    """
    return gated_records(section_records(prepare_documents(docs, lang, pairs)), min_length, keywords, gate).drop("section_no")
