"""Quality gate of normalised text: metric columns first, then one predicate over them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.native import count, has, matched, replace, strip


@dataclass(frozen=True)
class Gate:
    """Thresholds; ``script`` is the character class that must prevail."""

    script: str = r"[\x{4e00}-\x{9fff}]"
    min_length: int = 30
    max_special: float = 0.3
    max_doubled: int = 2
    max_outline: int = 30
    min_script: int = 15
    min_script_share: float = 0.25
    max_bracketed: float = 0.3
    max_short_lines: int = 2


HAN = Gate()
LATIN = Gate(script=r"[A-Za-z\x{c0}-\x{24f}]")

#: What a pattern of left-over markup needs, and the pattern; without one the first alone tells.
_RESIDUE = (
    (("=",), r"[A-Z_a-z]\s*="),
    (("|",), r"\|\s*[A-Za-z]"),
    (("}}",), r"\{\{.*?\}\}|\}\}.*?是"),
    (("##",), r"##\s*\d+\.\d+"),
    (("blank",), r"blank\d*_"),
    (("population_", "pushpin_", "image_", "subdivision_", "settlement_type"), None),
)
_BRACKETED = r"[（(][^）)]*[）)]"

METRICS = ("n_stripped", "n_all", "n_special", "has_residue", "n_doubled_stop", "n_doubled_comma", "n_outline", "n_script", "n_sentences", "n_bracketed", "n_short_lines")


def metrics(text: Column, gate: Gate = HAN) -> dict[str, Column]:
    """Each measure as a column; classes are those of Python's ``re``.

    Characters of a class are counted as what the text loses with their runs, and patterns are tried only on
    texts that hold a part they need.
    """
    pairs = lambda mark: F.when(has(text, mark * 2), (F.length(text) - F.length(F.replace(text, F.lit(mark * 2), F.lit("")))) / 2).otherwise(0).cast("int")
    residue = [has(text, *parts) & text.rlike("(?U)(?d)" + p) if p else has(text, *parts) for parts, p in _RESIDUE]
    return {
        "n_stripped": F.length(strip(text)),
        "n_all": F.length(text),
        "n_special": F.length(replace(text, r"[A-Za-z0-9 \n]++|(?U)[\w\s\x{4e00}-\x{9fff}，。！？；：「」『』（）]++")),
        "has_residue": reduce(lambda a, b: a | b, residue),
        "n_doubled_stop": pairs("。"),
        "n_doubled_comma": pairs("，"),
        "n_outline": F.when(has(text, "."), count(text, r"(?U)\d++\.\d++")).otherwise(0),
        "n_script": matched(text, gate.script + "++"),
        "n_sentences": F.size(F.filter(F.split(text, "[。！？]", -1), lambda p: F.length(strip(p)) > 3)),
        "n_bracketed": F.when(has(text, "(", "（"), matched(text, _BRACKETED)).otherwise(0),
        "n_short_lines": F.size(F.filter(F.split(text, "\n", -1), lambda p: F.length(strip(p)) == 1)),
    }


def with_metrics(df: DataFrame, text: str = "text", gate: Gate = HAN) -> DataFrame:
    return df.withColumns(metrics(F.col(text), gate))


def passes_gate(gate: Gate = HAN) -> Column:
    """Over the columns of ``metrics``."""
    n = F.col("n_all")
    # cheap measures first
    return (
        (F.col("n_stripped") >= gate.min_length)
        & (F.col("n_doubled_stop") <= gate.max_doubled)
        & (F.col("n_doubled_comma") <= gate.max_doubled)
        & (F.col("n_short_lines") <= gate.max_short_lines)
        & (F.col("n_bracketed") <= gate.max_bracketed * n)
        & ~F.col("has_residue")
        & (F.col("n_script") >= F.greatest(F.lit(float(gate.min_script)), gate.min_script_share * n))
        & (F.col("n_sentences") >= 1)
        & (F.col("n_outline") <= gate.max_outline)
        & (F.col("n_special") <= gate.max_special * n)
    )


def keep_good(df: DataFrame, text: str = "text", gate: Gate = HAN) -> DataFrame:
    """Rows whose text passes; the metric columns are dropped again."""
    return with_metrics(df, text, gate).filter(passes_gate(gate)).drop(*METRICS)
