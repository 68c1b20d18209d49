"""Queries of the large-scale text operators, each over its whole tables, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import bpe, exact_topk, minhash, mixing, permutation_index, pseudo_lm, suffix, token_counts, toxicity, wavelet
from quern.runtime import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calibrated probability of every document, and whether it is rejected as toxic."""
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "toxicity", (F.col("toxicity") >= 0.5).alias("rejected"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of a near-duplicate group, with the one that stays."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


#: Target shares of tokens by domain: labelled quality, and for good texts whether they are English.
MIX = {"good-en": 0.5, "good-other": 0.35, "plain": 0.15}


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain) from the labels table and the labelled documents' language."""
    lang = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    good = F.when(F.col("lang") == "en", "good-en").otherwise("good-other")
    return read_table(spark, sf_dir, "labels").join(lang, "doc_id").select("doc_id", F.when(F.col("quality") == 1, good).otherwise("plain").alias("domain"))


def op1_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates and copies of every document that bring the expected domain totals to MIX."""
    return mixing.mix(read_table(spark, sf_dir, "documents"), domain_labels(spark, sf_dir), MIX)


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding them gives the text back."""
    return bpe.round_trip(read_table(spark, sf_dir, "documents"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of every document, by a network trained on all of them."""
    return pseudo_lm.score(read_table(spark, sf_dir, "documents"))


def op4_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids as wavelet matrices: one row, with the whole file, for each shard."""
    return wavelet.shards(read_table(spark, sf_dir, "documents"))


#: The rows that searches take as queries, against all rows.
ASKED = "vec_id % 50 = 0"


def op5_approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten approximately nearest others, by cosine, of every embedding whose id is divisible by 50, among all."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return permutation_index.nearest(vectors, 10, vectors.filter(ASKED))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens of every document."""
    return token_counts.token_counts(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten others of largest inner product, among all, of every embedding whose id is divisible by 50."""
    vectors = read_table(spark, sf_dir, "embeddings")
    found = exact_topk.top_inner_products(vectors, 10, vectors.filter(ASKED))
    return found.select("vec_id", "neighbor_id", F.round("score", 6).alias("score"), "rank")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that documents share."""
    return suffix.repeated_passages(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_mix_to_targets": op1_mix_to_targets,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_lm_scores": op3_lm_scores,
    "op4_wavelet_shards": op4_wavelet_shards,
    "op5_approximate_neighbours": op5_approximate_neighbours,
    "op6_token_counts": op6_token_counts,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_exact_top_k": op10_exact_top_k,
}

#: All windows of 50 words, grouped by their hash; spans of the windows that two documents or more hold.
REPEATS_SQL = r"""
with words as (select doc_id, list_filter(string_split_regex(text, '[\t\n\x0B\f\r ]+'), lambda x: x <> '') as w from documents where text is not null and doc_id is not null),
starts as (select doc_id, w, unnest(range(len(w) - 49)) as s from words where len(w) >= 50),
windows as (select doc_id, s, hash(array_to_string(w[s + 1 : s + 50], ' ')) as h from starts),
classes as (select h, min(doc_id) as f from windows group by h having min(doc_id) < max(doc_id)),
hits as (select doc_id, s, doc_id > f as later from windows join classes using (h)),
marked as (select 'every' as kind, doc_id, s from hits union all select 'cut', doc_id, s from hits where later),
edges as (select *, case when s <= lag(s) over (partition by kind, doc_id order by s) + 50 then 0 else 1 end as fresh from marked),
islands as (select *, sum(fresh) over (partition by kind, doc_id order by s) as island from edges),
spans as (select kind, doc_id, min(s) as a, max(s) + 50 as b from islands group by kind, doc_id, island)
select e.doc_id, e.a as start_word, e.b - e.a as n_words, coalesce(sum(c.b - c.a), 0)::bigint as cut_words
from (select * from spans where kind = 'every') e left join (select * from spans where kind = 'cut') c on c.doc_id = e.doc_id and c.a >= e.a and c.a < e.b
group by e.doc_id, e.a, e.b
"""

TOP_K_SQL = """
with pairs as (
    select a.vec_id, b.vec_id as neighbor_id, list_inner_product(a.embedding::double[], b.embedding::double[]) as s
    from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
ranked as (select vec_id, neighbor_id, s, row_number() over (partition by vec_id order by s desc, neighbor_id)::int as rank from pairs)
select vec_id, neighbor_id, round(s, 6) as score, rank from ranked where rank <= 10
"""

#: All pairs that share a shingle, by exact Jaccard similarity, and what reaches what over the near ones.
NEAR_SQL = r"""
with recursive words as (select distinct doc_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') as w from documents where doc_id is not null and text is not null),
shingles as (select distinct doc_id, array_to_string(w[i : i + 2], ' ') as h from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) as i from words)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.h = b.h and a.doc_id < b.doc_id group by all),
near as (select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where c >= 0.5 * (x.n + y.n - c)),
edges as (select a, b from near union select b, a from near),
reach(doc_id, other) as (select a, b from edges union select r.doc_id, e.b from reach r join edges e on e.a = r.other),
kept as (select doc_id, least(doc_id, min(other)) as keep_id from reach group by doc_id)
select doc_id, keep_id, count(*) over (partition by keep_id) as group_size from kept
"""

SQL: dict[str, str] = {"op9_minhash_near_dedup": NEAR_SQL, "op10_exact_top_k": TOP_K_SQL, "op7_suffix_array_dedup": REPEATS_SQL}
