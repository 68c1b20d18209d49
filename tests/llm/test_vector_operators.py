"""Vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import exact_topk, permutation_index, queries
from tests.oracle import database, expected, rows_of

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def frame(spark, x, ids=None):
    return spark.createDataFrame([(int(i), [float(v) for v in row], 0) for i, row in zip(range(len(x)) if ids is None else ids, x)], SCHEMA)


def brute(x, k, cosine):
    x = x.astype(np.float32).astype(float)
    if cosine:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    return s, np.argsort(-s, axis=1, kind="stable")[:, :k]


def lists(rows):
    out = {}
    for r in rows:
        out.setdefault(r.vec_id, {})[r.rank] = (r.neighbor_id, r.score)
    return {i: [v[k] for k in sorted(v)] for i, v in out.items()}


@pytest.mark.parametrize("skew", [0.0, 1.0])
def test_exact_top_k(spark, monkeypatch, skew):
    monkeypatch.setattr(exact_topk, "BLOCK", 64)
    r = np.random.default_rng(1)
    x = r.normal(size=(500, 12)) * np.exp(skew * r.normal(size=(500, 1))) * np.linspace(2, 0.1, 12)
    s, top = brute(x, 7, False)
    got = lists(exact_topk.top_inner_products(frame(spark, x), 7).collect())
    for i in range(500):
        assert [n for n, _ in got[i]] == top[i].tolist()
        assert np.allclose([v for _, v in got[i]], s[i, top[i]])


def test_walk_prunes_long_tails():
    r = np.random.default_rng(2)
    x = r.normal(size=(3000, 32)) * np.linspace(3, 0.05, 32)
    x *= (np.arange(1, 3001) ** -0.7)[:, None]
    x = x[np.argsort(-np.linalg.norm(x, axis=1))]
    walk = exact_topk.Walk(np.arange(200), x[:200], 5, (8, 16))
    for a in range(0, 3000, 250):
        if not walk.add(np.arange(a, a + 250), x[a : a + 250]):
            break
    assert walk.pairs < 0.3 * 200 * 3000


def test_top_k_sql(spark):
    path = "/root/testdata/sf0.001"
    assert rows_of(queries.QUERIES["op10_exact_top_k"](spark, path)) == expected(database(path), queries.SQL["op10_exact_top_k"])


def test_neighbours_recall(spark, monkeypatch):
    monkeypatch.setattr(permutation_index, "SHARD", 700)
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(size=(1200, 24)), r.normal(size=(30, 24))[r.integers(0, 30, 800)] + 0.2 * r.normal(size=(800, 24))])
    _, top = brute(x, 10, True)
    got = lists(permutation_index.nearest(frame(spark, x), 10).collect())
    assert np.mean([len({n for n, _ in got[i]} & set(top[i].tolist())) / 10 for i in range(2000)]) >= 0.9


def test_neighbours_of_given_embeddings(spark):
    path = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows])
    s, top = brute(x, 10, True)
    got = lists(queries.QUERIES["op5_approximate_neighbours"](spark, path).collect())
    asked = [i for i, r in enumerate(rows) if r.vec_id % 50 == 0]
    assert set(got) == {rows[i].vec_id for i in asked}
    kth = s[np.arange(len(x)), top[:, -1]]
    assert np.mean([sum(v >= kth[i] - 1e-5 for _, v in got[rows[i].vec_id]) / 10 for i in asked]) >= 0.9


def test_footrule_decides_what_is_compared():
    """Of 2,000 vectors 64 are compared exactly: the nearest by footrule over whole orders of those nearest over heads."""
    r = np.random.default_rng(6)
    x = permutation_index.unit(r.normal(size=(2000, 16)) * np.linspace(1, 0.1, 16)).astype(np.float32)
    m, post, prefix = permutation_index.sizes(2000)
    order = permutation_index.orders(x, x[:m], prefix)
    shard, met = permutation_index.Shard(np.arange(2000), x, order, m, post), []
    search = shard.nearest_by_footrule
    shard.nearest_by_footrule = lambda *a: met.append(search(*a)) or met[-1]
    shard.search(np.arange(40), x[:40], order[:40], 10)
    assert all(len(some) == 64 <= 0.05 * 2000 for some in met)

    def shared(a, b, size):
        rank = {p: i for i, p in enumerate(b[:size])}
        return sum(size - max(i, rank[p]) for i, p in enumerate(a[:size]) if p in rank)

    for i in range(3):
        heads = np.array([shared(order[i], order[j], post) for j in range(2000)])
        ranked = np.sort(heads)[-240]  # the share of RANKED
        assert heads[met[i]].min() >= ranked
        whole = np.array([shared(order[i], order[j], prefix) if heads[j] > ranked else -1 for j in range(2000)])
        assert whole[met[i]][whole[met[i]] >= 0].min() >= np.sort(whole)[-64 - int((heads == ranked).sum())]


def test_shards_hold_hot_pivots_in_parts():
    r = np.random.default_rng(8)
    pivots, held = r.normal(size=(60, 8)), r.integers(0, 40, 60)
    held[7] = 1000
    first, many = permutation_index.place(pivots, held, 100)
    assert many[7] == 10 and (np.delete(many, 7) == 1).all()
    for s in set(first):
        mine = np.flatnonzero(first == s)
        assert held[mine].sum() <= 100 or mine.tolist() == [7]
    taken = np.concatenate([np.arange(a, a + n) for a, n in {(int(a), int(n)) for a, n in zip(first, many)}])
    assert sorted(taken) == list(range(len(taken)))


@pytest.mark.parametrize("search", [exact_topk.top_inner_products, permutation_index.nearest])
def test_queries_are_answered_from_all_rows(spark, monkeypatch, search):
    monkeypatch.setattr(exact_topk, "BLOCK", 64)
    monkeypatch.setattr(exact_topk, "GROUP", 2)
    x = np.random.default_rng(9).normal(size=(600, 8))
    df = frame(spark, x)
    asked = df.filter("vec_id % 3 = 0").unionByName(frame(spark, x[:1] * 2, [9000]))
    got, every = lists(search(df, 5, asked).collect()), lists(search(df, 5).collect())
    assert set(got) == {*range(0, 600, 3), 9000} and set(every) == set(range(600))
    assert all(got[i] == every[i] for i in range(0, 600, 3))
    assert [n for n, _ in got[9000] if n][:4] == [n for n, _ in every[0]][:4]
    assert search(df, 5, df.filter("false")).count() == 0


def test_footrule_is_what_shared_ranks_say():
    r = np.random.default_rng(4)
    for _ in range(50):
        a, b = (r.permutation(30)[:8] for _ in range(2))
        rank = lambda o, p: int(np.flatnonzero(o == p)[0]) if p in o else 8
        footrule = sum(abs(rank(a, p) - rank(b, p)) for p in set(a) | set(b))
        shared = sum(8 - max(rank(a, p), rank(b, p)) for p in set(a) & set(b))
        assert footrule == 72 - 2 * shared


@pytest.mark.parametrize("search", [exact_topk.top_inner_products, permutation_index.nearest])
def test_awkward_rows(spark, search):
    x = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [0.0, 0.0], 0), (4, [0.5, 0.5], 0), (4, [9.0, 9.0], 0), (None, [1.0, 1.0], 0), (5, None, 0), (6, [], 0), (7, [1.0], 0), (8, [1.0, None], 0), (9, [float("nan"), 1.0], 0), (1, [1.0, 0.0], 0)]
    df = spark.createDataFrame(x, SCHEMA).withColumn("score", F.lit("mine")).withColumn("block", F.lit(1)).withColumn("rank", F.lit(1))
    got = lists(search(df, 2).collect())
    assert set(got) == {1, 2, 3, 4}
    assert [n for n, _ in got[1]] == [2, 4] and [n for n, _ in got[2]] == [1, 4] and [n for n, _ in got[3]] == [1, 2] and [n for n, _ in got[4]] == [1, 2]
    assert all(len(v) == 3 for v in lists(search(df, 10).collect()).values())
    assert search(df.filter("vec_id = 1"), 3).count() == 0 and search(df.filter("false"), 3).count() == 0
