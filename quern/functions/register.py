"""Scalar functions under SQL names, for use in ``spark.sql``."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quern.functions import captions, convert, markup, normalize, wikitext
from quern.runtime import prepare

FUNCTIONS: dict[str, Callable[[str], object]] = {
    "clean_markdown": markup.clean_markdown,
    "markdown_to_text": markup.markdown_to_text,
    "decode_entities": markup.decode_entities,
    "clean_wikitext": wikitext.clean_wikitext,
    "normalize_text": lambda text: normalize.normalize(text)[1],
    "clean_caption": captions.clean_caption,
    "image_caption": captions.caption_of,
    "space_scripts": convert.space_scripts,
    "to_traditional": lambda text: convert.seed("tw")(text),
    "to_simplified": lambda text: convert.seed("cn")(text),
}


def _column_function(fn: Callable[[str], object]) -> object:
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((None if v is None else fn(v) for v in batch.to_pylist()), pa.string())

    return run


def register(spark: SparkSession) -> list[str]:
    """Register every function; null gives null. Gives the names."""
    prepare(spark)
    for name, fn in FUNCTIONS.items():
        spark.udf.register(name, _column_function(fn))
    return list(FUNCTIONS)
