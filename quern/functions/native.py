"""Rules as Spark expressions: JVM-side, foldable and open to pushdown. Classes follow Python's ``re`` on text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.markup import ENTITIES

#: What Python's ``str.strip`` takes for blank.
_BLANKS = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def replace(c: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(c, pattern, to)


def chain(c: Column, *rules: tuple[str, str]) -> Column:
    for pattern, to in rules:
        c = replace(c, pattern, to)
    return c


def strip(c: Column) -> Column:
    """Trims what Python's ``str.strip`` does."""
    return F.trim(c, F.lit(_BLANKS))


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def matched(c: Column, pattern: str) -> Column:
    """Characters that the matches of ``pattern`` hold together."""
    return F.length(c) - F.length(replace(c, pattern))


def has(c: Column, *parts: str) -> Column:
    """Whether any of the parts stands in the text; a cheap guard before a pattern that needs it."""
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(p)) for p in parts])


def decode_entities(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def strip_comments(c: Column) -> Column:
    return replace(c, "(?s)<!--.*?-->")


def strip_tags(c: Column) -> Column:
    return replace(c, "<[^>]+>")


def strip_html(c: Column) -> Column:
    """Words of an HTML page: no comments, scripts, styles or tags; entities decoded, blanks collapsed."""
    c = chain(strip_comments(c), ("(?is)<script.*?</script>", " "), ("(?is)<style.*?</style>", " "), ("<[^>]+>", " "))
    return F.trim(chain(decode_entities(c), (r"[ \t\n\r]+", " ")))


def strip_templates(c: Column) -> Column:
    return replace(c, r"(?s)\{\{.*?\}\}")


def strip_tables(c: Column) -> Column:
    return replace(c, r"(?s):*\{\|.*?\|\}")


def strip_references(c: Column) -> Column:
    return chain(c, ("(?s)<ref.*?</ref>", ""), ("(?d)<ref.*?/>", ""))


def unwrap_links(c: Column) -> Column:
    return chain(c, (r"\[{2}[^\]|]+\|([^\]|]+)\]{2}", "$1"), (r"\[{2}([^\]|]+)\]{2}", "$1"))


def collapse_punctuation(c: Column) -> Column:
    return chain(c, *[(f"[{a}{b}]{{2,}}", b) for a, b in (",，", ".。", ";；", "!！", "?？")])


def collapse_space(c: Column) -> Column:
    return strip(replace(c, r"(?U)\s+", " "))


def flatten_lists(c: Column) -> Column:
    """Bullets and numbers at line starts joined to the line before."""
    return chain(c, (r"(?m)^[ \t\n]*[*+-][ \t\n]+([^\n]*?)[ \t]*$", "、$1"), (r"(?m)^[ \t\n]*[0-9]+\.[ \t\n]+([^\n]*?)[ \t]*$", "、$1"), (r"([^\n])\n、", "$1 •"), (r"(?m)^[ \t\n]*、", ""))


def dedupe_stops(c: Column) -> Column:
    return replace(c, r"([。！？])\1+", "$1")


def drop_lone_dots(c: Column) -> Column:
    """Full stops without a digit on either side."""
    return replace(c, r"(?<!\d)\.(?!\d)")


def octets(record: Column) -> Column:
    """UTF-8 bytes of a record as one JSON line with ``", "`` and ``": "`` between items, newline included."""
    return F.octet_length(record) + 1


def file_url(name: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.replace(name, F.lit(" "), F.lit("_")))
