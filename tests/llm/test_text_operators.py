"""Toxicity, near-dedup, suffix-array dedup and mixing against brute force and on awkward rows."""

import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.llm import minhash, mixing, queries, suffix, toxicity
from quern.llm.common import lower, passes, range_hashes, word_spans
from tests.oracle import database, expected, rows_of

VOCABULARY = [a + b for a in ("ba", "co", "di", "fu", "ge", "ho", "ki", "lu") for b in ("ra", "sel", "tin", "mo", "pex", "vu", "zan", "wy")]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(r, n):
    return [r.choice(VOCABULARY) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)


AWKWARD = [(None, "null id text " * 30), (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "x" * 300_000), (6, "!!! ???"), (7, "é à ü ñ 漢字 😀")]


# ---- shared primitives --------------------------------------------------------------------------


def test_passes_cover_every_row_once():
    texts = ["a" * n for n in (0, 5, 600_000, 1, 0, 499_999, 2)] + [None]
    seen = []
    for column in (pa.array(texts), pa.array(["skip", *texts]).slice(1)):
        got = {}
        for i, j, data, offsets in passes(column):
            for k in range(i, j):
                got[k] = data[offsets[k - i] : offsets[k - i + 1]].tobytes().decode()
        seen.append(got)
    assert seen[0] == seen[1] == {k: t or "" for k, t in enumerate(texts)}


def test_hashes_depend_on_content_only():
    data = np.frombuffer(b"abc abc abd", np.uint8)
    starts, ends, counts = word_spans(data, np.array([0, 7, 11]))
    h = range_hashes(data, starts, ends)
    assert counts.tolist() == [2, 1] and h[0] == h[1] != h[2]
    assert lower(np.frombuffer("ÉÀß×Z".encode(), np.uint8)).tobytes().decode() == "éàß×z"


# ---- toxicity -----------------------------------------------------------------------------------


def toxic_corpus(spark, n=1500):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        text, bad = words(r, r.randint(20, 120)), i % 4 == 0
        if bad:
            for _ in range(max(3, len(text) // 15)):
                text[r.randrange(len(text))] = r.choice(["grimwit", "snorkle", "blech" + r.choice(VOCABULARY), "BLECH" + r.choice(VOCABULARY)])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus(spark)
    scored = toxicity.score(docs, toxicity.train(docs, labels.filter("doc_id < 1000"))).join(labels, "doc_id").filter("doc_id >= 1000")
    wrong = scored.filter((F.col("toxicity") >= 0.5) != (F.col("toxic") > 0)).count()
    assert wrong <= 0.03 * 500
    assert scored.filter("toxicity < 0 or toxicity > 1 or toxicity is null").count() == 0


def test_toxicity_of_given_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels.filter("doc_id % 2 = 0"))
    held = toxicity.score(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    caught = held.filter("toxic = 1 and toxicity >= 0.5").count() / held.filter("toxic = 1").count()
    blamed = held.filter("toxic = 0 and toxicity >= 0.5").count() / held.filter("toxic = 0").count()
    assert caught > 0.9 and blamed < 0.01  # some labels have no mark of any kind in their texts


def test_toxicity_query_scores_every_document(spark, tiny):
    rows = queries.QUERIES["op8_toxicity"](spark, tiny).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{tiny}/documents.parquet").collect())
    assert all(0 <= r.toxicity <= 1 and r.rejected == (r.toxicity >= 0.5) for r in rows) and not all(r.rejected for r in rows)


def test_toxicity_on_awkward_rows(spark):
    docs, labels = toxic_corpus(spark, 300)
    clash = frame(spark, AWKWARD + [(7, "again"), (7, "again")]).withColumn("toxicity", F.lit("mine")).withColumn("toxic", F.lit(9))
    got = toxicity.score(clash, toxicity.train(docs, labels)).collect()
    assert len(got) == len(AWKWARD) + 2 and all(0 <= r.toxicity < 0.5 for r in got) and got[0].toxic == 9
    kept, rejected = toxicity.split(clash, labels.filter("false"))
    assert kept.count() == len(AWKWARD) + 2 and rejected.count() == 0
    assert toxicity.score(clash.filter("false"), toxicity.train(clash.filter("false"), labels)).count() == 0
    twice = labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 1, 1), (1, None, None)], labels.schema))
    assert toxicity.score(docs, toxicity.train(docs, twice)).count() == 300


def test_toxicity_of_few_labels(spark):
    """A model needs two texts of either class; else every text has the share of toxic ones among the labelled."""
    docs, labels = toxic_corpus(spark, 40)
    constant = lambda wanted: {r.toxicity for r in toxicity.score(docs, toxicity.train(docs, labels.filter(wanted))).collect()}
    assert constant("false") == {0.0} and constant("toxic = 0") == {0.0} and constant("toxic = 1") == {1.0}
    assert constant("doc_id < 4") == {0.25}
    model = toxicity.train(docs, labels.filter("doc_id < 12"))
    assert model.constant is None and all(0 <= r.toxicity <= 1 for r in toxicity.score(docs, model).collect())


def test_features_match_brute_force():
    texts = ["You are a SNORKLE, you!!", "", None, "cl3an text? yes", "aaab  ÉCLAT tu snorkles @t", "snorkle one two three four five six you", "x " * 9 + "GRIM grim grimwit"]
    hashed = lambda items: range_hashes(*toxicity._packed(items))
    words = toxicity.Lookup(hashed(["snorkle", "grim"]))
    stems = toxicity.Lookup(hashed(["grim"]) ^ np.uint64(4))
    second = set(toxicity.SECOND_PERSON.split())
    got = toxicity.features(pa.array(texts), words, stems)
    for row, text in zip(got, texts):
        raw, small = (text or "").encode(), lower(np.frombuffer((text or "").encode(), np.uint8)).tobytes()
        spans = [(m.start(), m.end()) for m in re.finditer(rb"[0-9A-Za-z\x80-\xff@$*#%&+_]+", small)]
        token = [small[a:b] for a, b in spans]
        whole = [t in (b"snorkle", b"grim") for t in token]
        stem = [len(t) > 4 and t[:4] == b"grim" for t in token]
        hit = [a or b for a, b in zip(whole, stem)]
        you = [t.decode() in second for t in token]
        near = [any(you[max(0, k - 5) : k + 6]) for k in range(len(token))]
        n, chars, letters = max(len(token), 1), max(len(raw), 1), max(len(re.findall(rb"[A-Za-z\x80-\xff]", small)), 1)
        want = [
            sum(hit) / n, sum(stem) / n, np.log1p(sum(hit)), sum(a and b for a, b in zip(hit, near)) / n, sum(you) / n, len(re.findall(rb"[A-Z]", raw)) / letters,
            sum(b - a > 2 and re.fullmatch(rb"[A-Z]+", raw[a:b]) is not None for a, b in spans) / n, raw.count(b"!") / chars, raw.count(b"?") / chars,
            len(re.findall(rb"[!-/:-@\[-`{-~]", raw)) / chars, sum(bool(re.search(rb"[A-Za-z\x80-\xff]", t)) and bool(re.search(rb"[0-9@$*#%&+_]", t)) for t in token) / n,
            sum(small[k] == small[k - 1] == small[k - 2] and bool(re.match(rb"[A-Za-z\x80-\xff]", small[k : k + 1])) for k in range(2, len(small))) / chars, np.log1p(len(token)),
        ]
        assert np.allclose(row, want), text


def test_boosted_tree_splits_best():
    """The first tree of depth 1 has the split of largest gain over all features and cuts, and Newton leaves."""
    r = np.random.default_rng(3)
    x = r.integers(0, 12, (400, 4)).astype(float)
    y = ((x[:, 2] > 6) ^ (r.random(400) < 0.1)).astype(float)
    trees = toxicity.Trees(rounds=1, depth=1, rate=0.2).fit(x, y)
    grad, hess = y - y.mean(), np.full(400, y.mean() * (1 - y.mean()))
    gain = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + 1)
    best = max(((gain(x[:, j] <= c) + gain(x[:, j] > c), j, c) for j in range(4) for c in np.unique(x[:, j])[:-1]))
    left = x[:, best[1]] <= best[2]
    value = lambda m: 0.2 * grad[m].sum() / (hess[m].sum() + 1)
    assert np.allclose(trees.raw(x), np.log(y.mean() / (1 - y.mean())) + np.where(left, value(left), value(~left)))
    more = toxicity.Trees(rounds=30).fit(x, y)
    loss = lambda f: np.log1p(np.exp(-np.where(y > 0, f, -f))).mean()
    assert loss(more.raw(x)) < loss(trees.raw(x))


def test_isotonic_is_the_least_squares_monotone_fit():
    score, y = np.array([0.0, 1, 2, 3, 4]), np.array([0.0, 1, 0, 1, 1])
    x, p = toxicity.isotonic(score, y)
    assert (np.diff(x) >= 0).all() and (np.diff(p) >= -1e-12).all()
    assert abs(np.interp(1.5, x, p) - 0.5) < 0.02 and np.interp(4, x, p) > 0.95


# ---- near-duplicates ----------------------------------------------------------------------------


def shingle_set(text, n=3):
    w = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())
    return set(zip(*(w[k:] for k in range(n)))) or ({tuple(w)} if w else set())


def brute_groups(rows, threshold=0.5):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    posts = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            posts[x].append(k)
    common = Counter((a, b) for p in posts.values() for n, b in enumerate(p) for a in p[:n])
    for (a, b), c in common.items():
        if c >= threshold * (len(sets[a][1]) + len(sets[b][1]) - c):
            x, y = find(sets[a][0]), find(sets[b][0])
            parent[max(x, y)] = min(x, y)
    size = Counter(find(i) for i in parent)
    return {(i, find(i)) for i in parent if size[find(i)] > 1}


def copies(seed=2):
    r = random.Random(seed)
    rows = []
    for base in range(40):
        text = words(r, r.choice([6, 30, 80, 400]))
        for _ in range(r.choice([1, 1, 2, 5])):
            variant = list(text)
            for _ in range(r.choice([0, 1, len(text) // 30, len(text) // 12])):
                variant[r.randrange(len(variant))] = r.choice(VOCABULARY) + "q"
            rows.append((len(rows), " ".join(variant)))
    return rows


def test_near_duplicates_match_brute_force(spark):
    rows = copies()
    got = minhash.near_duplicates(frame(spark, rows))
    assert {(r.doc_id, r.keep_id) for r in got.collect()} == brute_groups(rows)
    size = Counter(r.keep_id for r in got.collect())
    assert all(r.group_size == size[r.keep_id] for r in got.collect())


def test_near_duplicates_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    got = {(r.doc_id, r.keep_id) for r in minhash.near_duplicates(docs).collect()}
    assert len(got & want) >= 0.98 * len(want) and len(got - want) <= 0.02 * len(want)


def test_near_duplicates_on_awkward_rows(spark):
    same = " ".join(words(random.Random(9), 60))
    rows = AWKWARD + [(20, same), (21, same), (22, same), (22, same), (30, same + " more"), (40, "other words entirely here"), (40, same), (50, ""), (51, None)]
    docs = frame(spark, rows).withColumn("digest", F.lit(1)).withColumn("band", F.lit("x"))
    got = {(r.doc_id, r.keep_id) for r in minhash.near_duplicates(docs).collect()}
    assert got == {(i, 20) for i in (20, 21, 22, 30, 40)}
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([None, 1, 2, 3, 4, 5, 6, 7, 20, 50, 51])
    again = minhash.keep_one(frame(spark, [(1, "a b c d"), (1, "a b c d"), (1, None), (2, "z")]))
    assert sorted(((r.doc_id, r.text) for r in again.collect()), key=repr) == [(1, "a b c d"), (1, None), (2, "z")]
    assert minhash.near_duplicates(docs.filter("false")).count() == 0
    assert minhash.keep_one(docs.filter("false")).count() == 0


def test_estimate_is_near_jaccard():
    r = random.Random(5)
    for share in (0.3, 0.6, 0.9):
        n = 3000
        a = np.array([r.getrandbits(64) for _ in range(n)], np.uint64)
        b = a.copy()
        fresh = int(n * (1 - share) / (1 + share))
        b[:fresh] = [r.getrandbits(64) for _ in range(fresh)]
        regs = minhash.registers(np.concatenate([a, b]), np.array([n, n]))
        assert abs(minhash.estimate(regs[0], regs[1:])[0] - share) < 0.13


def test_bucket_edges_join_what_all_pairs_join():
    r = np.random.default_rng(3)
    base = r.integers(0, 60000, (5, minhash.REGISTERS))
    regs = np.stack([np.where(r.random(minhash.REGISTERS) < 0.1, r.integers(0, 60000, minhash.REGISTERS), base[k % 5]) for k in range(200)]).astype(np.uint16)
    a, b = minhash.bucket_edges(np.arange(200), regs, 0.4, 0.7)
    assert len(a) == 195 and {(x % 5) == (y % 5) for x, y in zip(a, b)} == {True}


def joined(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(int(a)), find(int(b))
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("noise", [0.05, 0.3, 0.45])
def test_parts_of_a_bucket_join_what_the_bucket_joins(noise):
    r = np.random.default_rng(17)
    base = r.integers(0, 60000, (6, minhash.REGISTERS))
    regs = np.stack([np.where(r.random(minhash.REGISTERS) < noise * r.random(), r.integers(0, 60000, minhash.REGISTERS), base[k % 6]) for k in range(150)]).astype(np.uint16)
    ids, side = np.arange(150), r.integers(0, 3, 150)
    whole = list(zip(*minhash.bucket_edges(ids, regs, 0.4, 0.7)))
    parts = []
    for i in range(3):
        parts += zip(*minhash.bucket_edges(ids[side == i], regs[side == i], 0.4, 0.7))
        for j in range(i + 1, 3):
            some = (side == i) | (side == j)
            cross = list(zip(*minhash.cross_edges(ids[some], regs[some], (side[some] == j).astype(int), 0.4, 0.7)))
            assert all({side[a], side[b]} == {i, j} for a, b in cross)
            parts += cross
    assert joined(150, parts) == joined(150, whole)
    if noise == 0.05:
        assert len(parts) <= 150 - 6 + 2 * 6 * 3


def test_hot_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HOT", 7)
    r = random.Random(31)
    text, rows = words(r, 60), copies(5)
    for k in range(60):
        variant = list(text)
        variant[r.randrange(60)] = f"v{k}"
        rows.append((1000 + k, " ".join(variant)))
    got = minhash.near_duplicates(frame(spark, rows))
    assert {(x.doc_id, x.keep_id) for x in got.collect()} == brute_groups(rows)


@pytest.mark.parametrize("n", [3, 12, 40, 150, 3000])
def test_folded_estimate_is_near_jaccard(n):
    """For texts of any number of shingles, within what the cut-off allows for."""
    r = np.random.default_rng(11)
    for common in (0, n // 3, n // 2, 2 * n // 3, n):
        one, two = r.integers(0, 1 << 63, (2, 200, n), np.int64).astype(np.uint64) * np.uint64(2)
        two[:, :common] = one[:, :common]
        both = minhash.fold(*minhash.own_registers(np.concatenate([one.ravel(), two.ravel()]), np.full(400, n)))
        got, at_most = np.array([[x[0] for x in minhash.folded_estimates(both[k], both[200 + k : 201 + k])] for k in range(200)]).T
        share = common / (2 * n - common)
        assert abs(got.mean() - share) < 0.03 and (share - at_most > minhash.SLACK).mean() <= 0.005 and (got - share > 0.2).mean() <= 0.03


def test_buckets_of_several_documents_at_any_batching():
    r = np.random.default_rng(13)
    rows = sorted({(int(b), int(d)) for b, d in zip(r.integers(0, 400, 900), r.integers(0, 50, 900))})
    rows = sorted([*rows, *rows[:100], *((1000, d) for d in range(40))])
    want = defaultdict(set)
    for b, d in rows:
        want[b].add(d)
    want = {b: d for b, d in want.items() if len(d) > 1}
    told = None
    for size in (1, 3, 64, 5000):
        batches = [pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows[i : i + size]], pa.int64()) for k in (0, 1)], names=["band", "doc_id"]) for i in range(0, len(rows), size)]
        got, who = defaultdict(list), {}
        for out in minhash._buckets(iter(batches)):
            for x in out.to_pylist():
                if x["doc_id"] is None:
                    assert x["band"] not in who
                    who[x["band"]] = x["who"]
                else:
                    got[x["band"]].append(x["doc_id"])
        assert {b: set(d) for b, d in got.items()} == want and all(len(d) == len(set(d)) for d in got.values()) and set(who) == set(want)
        assert told in (None, who)
        told = who
    by = defaultdict(set)
    for b, w in who.items():
        by[w].add(frozenset(want[b]))
    assert all(len(x) == 1 for x in by.values())


def test_short_near_copies_reach_verification():
    """Pairs at Jaccard similarity 0.5 of few shingles pass the estimate."""
    r = np.random.default_rng(7)
    for n in (9, 18, 30, 60):  # shingles of each text; two in three are common
        passed = 0
        for _ in range(300):
            one = r.integers(0, 1 << 63, n, np.int64).astype(np.uint64) * np.uint64(2)
            two = np.concatenate([one[: 2 * n // 3], r.integers(0, 1 << 63, n - 2 * n // 3, np.int64).astype(np.uint64) * np.uint64(2)])
            both, counts = np.concatenate([one, two]), np.array([n, n])
            regs = minhash.fold(*minhash.own_registers(both, counts))
            passed += len(minhash.bucket_edges(np.array([1, 2]), regs, 0.5 - minhash.SLACK, 0.7, minhash.folded_estimates)[0])
        assert passed >= 298


def test_short_near_copies_are_found(spark):
    r = random.Random(12)
    rows = []
    for k in range(600):
        text = [f"w{r.getrandbits(40)}" for _ in range(12)]
        edited = list(text)
        edited[r.randrange(2, 10)] = "edited"
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(edited))]
    want = brute_groups(rows)
    assert len(want) == 1200
    got = {(x.doc_id, x.keep_id) for x in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got <= want and len(got) >= 0.97 * len(want)


# ---- suffix-array dedup -------------------------------------------------------------------------


def brute_repeats(rows, window):
    """{doc: (words in a repeated window, words in a window that an earlier document holds)}"""
    held = {i: t.split() for i, t in rows if i is not None and t}
    where = defaultdict(set)
    for i, w in held.items():
        for s in range(len(w) - window + 1):
            where[tuple(w[s : s + window])].add((i, s))
    every, cut = defaultdict(set), defaultdict(set)
    for found in where.values():
        ids = {i for i, _ in found}
        if len(ids) > 1:
            for i, s in found:
                every[i] |= set(range(s, s + window))
                if i > min(ids):
                    cut[i] |= set(range(s, s + window))
    return every, cut


def passages(seed=1, documents=60):
    r = random.Random(seed)
    shared = [words(r, n) for n in (7, 8, 9, 15, 40, 120)]
    rows = []
    for i in range(documents):
        text = words(r, r.randint(0, 60))
        for _ in range(r.randint(0, 3)):
            p = r.choice(shared)
            a = r.randint(0, len(p) // 2)
            at = r.randint(0, len(text))
            text[at:at] = p[a : a + r.randint(5, len(p))]
        rows.append((i, " ".join(text)))
    return [*rows, (documents, "ha " * 90), (documents + 1, "ha " * 50), (documents + 2, rows[3][1])]


@pytest.mark.parametrize("window", [8, 12])
def test_repeats_match_brute_force(spark, window):
    rows = passages()
    every, cut = brute_repeats(rows, window)
    got_every, got_cut = defaultdict(set), Counter()
    for r in suffix.repeated_passages(frame(spark, rows), window, 4).collect():
        got_every[r.doc_id] |= set(range(r.start_word, r.start_word + r.n_words))
        got_cut[r.doc_id] += r.cut_words
    assert got_every == every
    assert got_cut == Counter({i: len(cut.get(i, ())) for i in every})
    left = {r.doc_id: r for r in suffix.cut_repeats(frame(spark, rows), window, 4).collect()}
    for i, t in rows:
        w = t.split()
        want = [x for k, x in enumerate(w) if k not in cut.get(i, ())]
        assert (left[i].text.split() == want and left[i].n_chars == len(left[i].text)) if want or not w else i not in left
        if i not in cut:
            assert left[i].text == t


def test_merge_equals_sorting_all_suffixes():
    r = np.random.default_rng(2)
    sequences = [r.integers(1, 4, r.integers(1, 30)).astype(np.uint64) for _ in range(12)]
    shards = [sequences[:3], sequences[3:4], sequences[4:]]
    built = [suffix.transform(np.concatenate(s), np.array(list(map(len, s)))) for s in shards]
    depth = 5
    seq, off, rows, interval, prefix = suffix.merge(built, [len(s) for s in shards], depth)
    groups = defaultdict(set)
    for k, s in enumerate(sequences):
        for o in range(len(s) - depth + 1):
            groups[tuple(s[o : o + depth])].add((k, o))
    want = {frozenset(g) for g in groups.values() if len(g) > 1}
    got = defaultdict(set)
    for row, i in zip(rows, interval):
        got[i].add((seq[row], off[row]))
    assert {frozenset(g) for g in got.values()} == want
    assert (prefix[1:] >= depth).sum() == sum(len(g) - 1 for g in want)
    ordered = sorted([[*map(int, s[o:]), -k] for k, s in enumerate(sequences) for o in range(len(s) + 1)])
    lcp = lambda a, b: next((n for n, (x, y) in enumerate(zip(a[:-1], b[:-1])) if x != y), min(len(a), len(b)) - 1)
    wanted = Counter(min(lcp(a, b), depth) for a, b in zip(ordered, ordered[1:]))
    assert Counter(prefix[1:].tolist())[1] == wanted[1] and Counter(prefix[1:].tolist())[2] == wanted[2]


def test_a_passage_in_every_document_is_aggregated_where_it_is(spark):
    r = random.Random(21)
    passage = " ".join(words(r, 80))
    rows = [(i, " ".join(words(r, r.randint(0, 30))) + " " + passage) for i in range(400)]
    every, cut = brute_repeats(rows, 50)
    got, cuts = defaultdict(set), Counter()
    for x in suffix.repeated_passages(frame(spark, rows)).collect():
        got[x.doc_id] |= set(range(x.start_word, x.start_word + x.n_words))
        cuts[x.doc_id] += x.cut_words
    assert got == every and cuts == Counter({i: len(cut.get(i, ())) for i in every})
    source = __import__("inspect").getsource(suffix._repeats)
    assert "Window" not in source and 'repartition("key")' not in source  # no task gets all occurrences of a key


def test_repeats_sql(spark):
    tiny = "/root/testdata/sf0.001"
    assert rows_of(queries.QUERIES["op7_suffix_array_dedup"](spark, tiny)) == expected(database(tiny), queries.SQL["op7_suffix_array_dedup"])


def test_repeats_on_awkward_rows(spark):
    r = random.Random(8)
    p = " ".join(words(r, 60))
    rows = AWKWARD + [(20, p), (21, p), (21, p), (22, "own words then\n" + p), (22, "another text of one id"), (23, p.upper()), (24, (p + " ") * 2)]
    docs = frame(spark, rows).withColumn("cuts", F.lit(1)).withColumn("tag", F.lit("t")).withColumn("start", F.lit(0))
    got = {(x.doc_id, x.start_word, x.n_words) for x in suffix.repeated_passages(docs).collect()}
    assert got == {(20, 0, 60), (21, 0, 60), (22, 3, 60), (24, 0, 60), (24, 60, 60)} or (24, 0, 120) in got
    left = suffix.cut_repeats(docs)
    assert left.columns == docs.columns
    texts = Counter((x.doc_id, x.text) for x in left.collect())
    assert texts[22, "own words then"] == 1 and texts[22, "another text of one id"] == 1 and texts[20, p] == 1
    assert not any(i in (21, 24) for i, _ in texts) and len(texts) == len(AWKWARD) + 4
    assert suffix.repeated_passages(docs.filter("false")).count() == 0 and suffix.cut_repeats(docs.filter("false")).count() == 0


# ---- mixing -------------------------------------------------------------------------------------


def mixed_corpus(spark, n=900):
    r = random.Random(6)
    kinds = ("bread", "stone", "river")
    rows, labels = [], []
    for i in range(n):
        kind = kinds[min(2, r.randrange(6) // 2)] if i % 5 else "bread"
        rows.append((i, " ".join(r.choice([kind + r.choice("abcd"), r.choice(VOCABULARY)]) for _ in range(r.randint(10, 80)))))
        labels.append((i, kind))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, domain string")


WEIGHTS = {"bread": 0.2, "stone": 0.5, "river": 0.3}


def test_mix_meets_targets(spark):
    docs, labels = mixed_corpus(spark)
    got = mixing.mix(docs, labels.filter("doc_id < 500"), WEIGHTS)
    rows = got.join(labels, "doc_id").collect()
    right = sum(list(WEIGHTS)[int(np.argmax(r.posterior))] == r.domain for r in rows if r.doc_id >= 500)
    assert right > 0.95 * 400
    total = sum(r.tokens for r in rows)
    expected_totals = sum(r.rate * r.tokens * np.array(r.posterior) for r in rows)
    assert np.allclose(expected_totals / total, list(WEIGHTS.values()), atol=0.005)
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)
    realised = sum(r.copies * r.tokens * np.array(r.posterior) for r in rows)
    assert np.allclose(realised / total, list(WEIGHTS.values()), atol=0.06)
    assert mixing.resample(docs, labels.filter("doc_id < 500"), WEIGHTS).count() == sum(r.copies for r in rows)


def test_rates_reach_the_constrained_optimum(spark):
    """Targets outside the reachable cone: the residual is that of nonnegative least squares by brute force."""
    r = np.random.default_rng(1)
    p = r.dirichlet([2, 1, 1], 40)
    t = r.integers(5, 50, 40)
    target = np.array([4000.0, 10.0, 0.0])
    df = spark.createDataFrame([(float(a), list(map(float, b))) for a, b in zip(t, p)], "tokens double, posterior array<double>")
    steps = mixing.fit_rates(df, target, rounds=60, tolerance=1e-5)
    rated = df.select("tokens", "posterior", mixing._fold_rates(steps, 3).alias("rate")).collect()
    t, p, rate = (np.array([x[k] for x in rated]) for k in range(3))
    assert (rate >= 0).all()
    a = (t[:, None] * p).T
    best = np.ones(40)
    for _ in range(200_000):
        best = np.maximum(0, best - a.T @ (a @ best - target) / np.linalg.norm(a, 2) ** 2)
    assert np.linalg.norm(a @ rate - target) <= 1.05 * np.linalg.norm(a @ best - target) + 1


@pytest.mark.parametrize("shape", [(8, 0.5, 0.5), (3, 1, 6), (20, 0.3, 3)])
def test_rates_of_skewed_mixtures_are_optimal(spark, shape):
    """By default parameters; no nonnegative rates come nearer than -target . v / |v| for v >= 0 on all posteriors."""
    r = np.random.default_rng(0)
    p, t = r.dirichlet(shape, 2000), np.floor(r.lognormal(4, 1, 2000)) + 1
    t[:5] = 20000
    target = np.array([0.5, 0.35, 0.15]) * t.sum()
    df = spark.createDataFrame([(float(a), list(map(float, b))) for a, b in zip(t, p)], "tokens double, posterior array<double>")
    rated = df.select("tokens", "posterior", mixing._fold_rates(mixing.fit_rates(df, target), 3).alias("rate")).collect()
    off = sum(x.tokens * x.rate * np.array(x.posterior) for x in rated) - target
    v = off - min(0.0, (p @ off).min())
    nearest = max(0.0, -(target @ v) / np.linalg.norm(v))
    assert min(x.rate for x in rated) >= 0
    assert np.linalg.norm(off) <= max(1e-3 * np.linalg.norm(target), 1.002 * nearest)


def test_mix_query_meets_targets(spark, tiny):
    rows = queries.QUERIES["op1_mix_to_targets"](spark, tiny).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts) and all(r.tokens == len((texts[r.doc_id] or "").split()) for r in rows)
    total = sum(r.tokens for r in rows)
    reached = sum(r.rate * r.tokens * np.array(r.posterior) for r in rows) / total
    assert np.allclose(reached, list(queries.MIX.values()), atol=0.005)


def test_domain_model_is_the_same_in_one_pass_and_many(monkeypatch):
    from quern.llm import common

    r = random.Random(14)
    texts = [" ".join(words(r, r.randint(0, 60))) for _ in range(120)]
    domain = np.array([r.randrange(3) for _ in texts])
    one = mixing.DomainModel().fit(pa.array(texts), domain, 3).posteriors(pa.array(texts))
    monkeypatch.setattr(common.passes, "__defaults__", (700,))
    assert np.allclose(one, mixing.DomainModel().fit(pa.array(texts), domain, 3).posteriors(pa.array(texts)), atol=1e-6)


def test_mix_on_awkward_rows(spark):
    docs, labels = mixed_corpus(spark, 200)
    odd = docs.unionByName(frame(spark, AWKWARD + [(7, "bread"), (7, "bread")])).withColumn("tokens", F.lit("mine")).withColumn("rate", F.lit(1)).withColumn("posterior", F.lit(2))
    labels = labels.unionByName(spark.createDataFrame([(None, "bread"), (1, None), (999, "stone"), (2, "unheard")], labels.schema)).unionByName(labels)
    got = mixing.mix(odd, labels, WEIGHTS).collect()
    assert len(got) == 200 + len(AWKWARD) + 2
    blank = [x for x in got if x.tokens == 0]
    assert len(blank) == 3 and all(x.rate == 1 and x.copies == 1 for x in blank)
    back = mixing.resample(odd, labels, WEIGHTS)
    assert back.columns == odd.columns and back.count() == sum(x.copies for x in got)
    assert mixing.mix(odd.filter("false"), labels, WEIGHTS).count() == 0
    assert mixing.mix(odd, labels.filter("false"), WEIGHTS).count() == len(got)
    with pytest.raises(ValueError):
        mixing.mix(odd, labels, {"bread": -1.0})


def test_domain_fit_bounds_rows_where_ids_repeat(spark):
    """An id of many texts counts as ``max_labelled`` rows at most, and a text column that can't be null is one like others."""
    docs = spark.createDataFrame([(1,)] * 40 + [(2,)], "doc_id bigint").withColumn("text", F.lit("the very same words"))
    labels = spark.createDataFrame([(1, "bread"), (2, "stone")], "doc_id bigint, domain string")
    model = mixing.train_domains(docs, labels, ["bread", "stone"], max_labelled=1)
    assert np.allclose(model.posteriors(pa.array(["the very same words"])), 0.5, atol=1e-3)


@pytest.mark.parametrize("block", [1, 3, 4, 1 << 16])
def test_rows_are_repeated_block_by_block(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    wanted = {1: 0, 2: 1, 3: 3, 4: 4, 5: 9, 6: 13, 7: None}
    rows = spark.createDataFrame(list(wanted.items()), "doc_id bigint, n bigint")
    assert Counter(r.doc_id for r in mixing._repeated(rows, "n").collect()) == Counter({i: n for i, n in wanted.items() if n})


def test_copies_beyond_an_int(spark):
    """A short text that makes up for a whole domain: its copies are no int."""
    docs = frame(spark, [(1, "bread"), (2, "stone " * 50)])
    labels = spark.createDataFrame([(1, "bread"), (2, "stone")], "doc_id bigint, domain string")
    found = mixing.mix(docs, labels, {"bread": 0.9, "stone": 0.1}, budget=1e11).collect()
    assert max(r.copies for r in found) > 1 << 32 and all(abs(r.copies - r.rate) < 1 for r in found)


def test_bit_planes_estimate_what_folded_registers_do():
    """The same numbers, and pairs, from far fewer operations."""
    r = np.random.default_rng(3)
    counts, common = r.integers(1, 400, 3000), r.integers(0, 1 << 62, 40).astype(np.uint64)
    hashes = np.concatenate([np.concatenate([common, r.integers(0, 1 << 62, 400).astype(np.uint64)])[:n] for n in counts])
    folded = minhash.fold(*minhash.own_registers(minhash.mix(hashes), counts))
    planes = minhash.Planes.of(minhash.bit_planes(folded))
    for k in range(0, 3000, 500):
        assert np.array_equal(minhash.folded_estimates(folded[k], folded), minhash.plane_estimates(planes[k], planes))
    assert np.array_equal(minhash.folded_estimates(folded[1:], folded[:-1]), minhash.plane_estimates(planes[1:], planes[:-1]))
    found, took = [], []
    for regs, alike_by in ((folded, minhash.folded_estimates), (planes, minhash.plane_estimates)):
        began = time.thread_time()
        found.append(minhash.bucket_edges(np.arange(3000), regs, 0.5 - minhash.SLACK, 0.7, alike_by))
        took.append(time.thread_time() - began)
    assert np.array_equal(*found) and took[1] < took[0] / 2
