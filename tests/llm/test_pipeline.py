"""The pipeline, stage by stage, against brute-force versions of what each stage decides."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import bpe, mixing, queries
from tests.llm.test_text_operators import AWKWARD, brute_groups, brute_repeats, frame
from tests.llm.test_token_operators import PATHS, public_encoder

PATH = "/root/testdata/sf0.001"


def test_stages_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    tables = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], PATH).write.parquet(str(tmp_path / str(k)))
        tables.append(spark.read.parquet(str(tmp_path / str(k))))
        assert k == len(corpus_pipeline.STAGES) - 1 or tables[-1].columns == docs.columns
    rows = [[(r.doc_id, r.text) for r in t.collect()] for t in tables[:-1]]

    toxic = {r.doc_id for r in spark.read.parquet(f"{PATH}/labels.parquet").collect() if r.toxic}
    clean = {r.doc_id for r in spark.read.parquet(f"{PATH}/labels.parquet").collect() if not r.toxic}
    gone = {i for i, _ in rows[0]} - {i for i, _ in rows[1]}
    assert len(gone & clean) <= 0.03 * len(clean) and (not gone or len(gone & toxic) > 0)

    later = {i for i, keep in brute_groups(rows[1]) if i != keep}
    assert Counter(rows[2]) == Counter(r for r in rows[1] if r[0] not in later)

    _, cut = brute_repeats(rows[2], 50)
    left = {i: [w for k, w in enumerate(t.split()) if k not in cut.get(i, ())] for i, t in rows[2]}
    assert {i: t.split() for i, t in rows[3]} == {i: w for i, w in left.items() if w}

    copies = {r.doc_id: r.copies for r in mixing.mix(tables[3], queries.domain_labels(spark, PATH), queries.MIX).collect()}
    assert Counter(i for i, _ in rows[4]) == Counter({i: n for i, n in copies.items() if n})

    known, texts = public_encoder(PATHS[0]), dict(rows[4])
    final = tables[5].collect()
    assert len(final) == len(rows[4]) and all(r.exact and list(r.ids) == known.encode_ordinary(texts[r.doc_id]) for r in final)
    assert bpe.vocabulary_path() == PATHS[0]
    assert Counter((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, PATH).collect()) == Counter((r.doc_id, r.n_tokens) for r in final)


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_on_awkward_rows(spark, stage):
    """Null, empty and odd texts stay as they are, as do all columns, whatever they are called."""
    docs = frame(spark, AWKWARD)
    for name in ("toxicity", "toxic", "tag", "cuts", "keep_id", "copies", "rate", "tokens"):
        docs = docs.withColumn(name, F.lit("mine"))
    docs = docs.withColumnRenamed("text", "TEXT").withColumnRenamed("n_chars", "N_Chars")
    got = stage(spark, docs, PATH)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    rows = Counter(tuple(r) for r in got.collect())
    wanted = Counter(tuple(r) for r in docs.collect())
    if stage is corpus_pipeline.mix_to_targets:  # texts with tokens may go or be repeated
        assert set(rows) <= set(wanted) and all(rows[r] == 1 for r in wanted if not (r[1] or "").strip())
    else:
        assert rows == wanted
    assert stage(spark, docs.filter("false"), PATH).count() == 0


def test_repeated_rows_in_stages(spark):
    docs = frame(spark, [(1, "some words here " * 20)] * 3 + [(None, None)] * 2)
    counts = [stage(spark, docs, PATH).count() for _, stage in corpus_pipeline.STAGES[:3]]
    assert counts == [5, 3, 5]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, PATH)
    assert last.count() == 5 and last.filter("exact").count() == 3 and last.filter("doc_id is null").filter("ids is null").count() == 2
