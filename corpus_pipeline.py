"""Corpus pipeline: documents through five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.llm import bpe, minhash, mixing, queries, suffix, toxicity
from quern.runtime import Workspace, delete_path, prepare, read_table

Stage = Callable[[SparkSession, DataFrame | None, str], DataFrame]


def _docs(spark: SparkSession, docs: DataFrame | None, sf_dir: str) -> DataFrame:
    prepare(spark)
    return read_table(spark, sf_dir, "documents") if docs is None else docs


def drop_toxic(spark: SparkSession, docs: DataFrame | None, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; all others stay as they are, with whatever columns.

    Null and empty texts score as texts without words, and stay. Without labels of both kinds nothing tells texts apart:
    see ``toxicity.ToxicityModel.fit``.
    """
    docs = _docs(spark, docs, sf_dir)
    scored = toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")), "__toxicity")
    return scored.filter("__toxicity < 0.5").drop("__toxicity")


def drop_near_copies(spark: SparkSession, docs: DataFrame | None, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the least doc_id, as it is.

    Null ids, null and empty texts stay; of rows with one doc_id and one text one stays.
    """
    return minhash.keep_one(_docs(spark, docs, sf_dir))


def cut_shared_passages(spark: SparkSession, docs: DataFrame | None, sf_dir: str) -> DataFrame:
    """Passages that a document of lesser doc_id holds too are cut out; documents of which nothing is left go.

    Null ids, null, empty and short texts stay as they are; ``n_chars`` follows the text.
    """
    return suffix.cut_repeats(_docs(spark, docs, sf_dir))


def mix_to_targets(spark: SparkSession, docs: DataFrame | None, sf_dir: str) -> DataFrame:
    """Rows are repeated or left out so that expected domain totals meet the target weights.

    Null and empty texts stay once; equal rows are treated alike.
    """
    return mixing.resample(_docs(spark, docs, sf_dir), queries.domain_labels(spark, sf_dir), queries.MIX)


def encode_tokens(spark: SparkSession, docs: DataFrame | None, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, exact): token ids of every text, checked by decoding them; nulls for a null text."""
    return bpe.round_trip(_docs(spark, docs, sf_dir))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_shared_passages),
    ("mix_to_targets", mix_to_targets),
    ("bpe_encode_decode", encode_tokens),
]

#: None: the trained classifiers and sketches of the stages have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are stored and read again.

    A stage's table goes once the next one is written; the last one when the driver ends.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with Workspace(spark, f"pipeline-{name}") as ws:
            docs = ws.result(stage(spark, docs, sf_dir))
        if before:
            delete_path(spark, before)
        before = ws.kept
    return docs
