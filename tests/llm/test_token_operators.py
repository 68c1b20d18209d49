"""BPE, token counts, wavelet shards and LM scores."""

import base64
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.llm import bpe, pseudo_lm, queries, token_counts, wavelet
from quern.llm.common import range_hashes
from tests.llm.test_text_operators import AWKWARD, frame

PATHS = [bpe.vocabulary_path(), bpe.vocabulary_path("byte_bpe_multi_50k.tiktoken")]
ODD = ["", " ", "  ", "\n\n x", "it's 's'll  'll x'd 'tis don't're", "a\t b  c　", "é’ñ 漢字 12½ ³", "'", "' s", "x'", "''s", "I'll'", "\n'sad", "a" * 700, "<|endoftext|>", "😀 👍🏽", "'ve", " 've", "a\r\nb", " \n ", "'l"]


def public_encoder(path):
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=bpe.PIECE_PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("path", PATHS)
def test_encoding_counts_and_decoding_match_a_public_encoder(path):
    tool, known, r = bpe.merger(path), public_encoder(path), random.Random(3)
    parts = ["a", "b", "s", "t", "'", " ", "  ", "\n", "1", "é", "!", "ll", "re", "　", "漢", "-", "d", "m", "v", "e"]
    texts = ODD + ["".join(r.choices(parts, k=r.randint(1, 25))) for _ in range(3000)]
    column = pa.array([*texts, None])
    ids = bpe.encode_array(column, tool)
    assert ids.to_pylist() == [known.encode_ordinary(t) for t in texts] + [None]
    assert bpe.decode_array(ids, tool).to_pylist() == [*texts, None]
    assert token_counts.count_array(column, token_counts.Counter(tool)).to_pylist() == [len(x) for x in ids.to_pylist()[:-1]] + [None]


@pytest.mark.parametrize("path", PATHS)
def test_every_pair_is_found_alone(path):
    """Pairs that lie far down the hash table are found by a call for one key too, and pieces alone get the public ids."""
    tool, known = bpe.merger(path), public_encoder(path)
    keys = np.array(list(tool.pairs), np.int64)
    far = np.flatnonzero(tool.keys[tool._slot(keys.astype(np.uint64))] != keys.astype(np.uint64))
    for key in keys[far[:20_000]]:
        assert tool.rank(np.array([key >> 32]), np.array([key & 0xFFFFFFFF]))[0] == tool.pairs[int(key)]
    for piece in [" thinly", *(t.decode("utf-8", "ignore") for t in tool.tokens[1000:50_000:40])]:
        data = np.frombuffer(piece.encode(), np.uint8)
        if len(data) and len(bpe.piece_starts(data, np.array([0, len(data)]))) == 1:
            assert tool.merge_pieces(data, np.array([0]), np.array([len(data)]))[0].tolist() == known.encode_ordinary(piece)


@pytest.mark.parametrize("pieces,ids", [(40, 10**6), (10**6, 60), (10**6, 10**6)])
def test_remembered_pieces_give_the_same_ids(monkeypatch, pieces, ids):
    """Whether the cache of pieces starts anew often, by either bound, or never."""
    monkeypatch.setattr(bpe, "CACHE_PIECES", pieces)
    monkeypatch.setattr(bpe, "CACHE_IDS", ids)
    tool, known, r = bpe.Merger(bpe.read_ranks(PATHS[0])), public_encoder(PATHS[0]), random.Random(19)
    for _ in range(60):
        texts = [" ".join("".join(r.choices("abcdestz", k=r.randint(1, 5))) for _ in range(12)) for _ in range(3)]
        assert bpe.encode_array(pa.array(texts), tool).to_pylist() == [known.encode_ordinary(t) for t in texts]
        keys, _, start, count, pool = tool.cache
        assert len(keys) and (keys[1:] > keys[:-1]).all() and (start + count <= len(pool)).all()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_round_trips(text):
    tool = bpe.merger(PATHS[0])
    assert bpe.decode_array(bpe.encode_array(pa.array([text]), tool), tool).to_pylist() == [text]


@pytest.mark.parametrize("power", [10, 11, 12])
def test_words_that_collide_modulo_powers_of_two_are_told_apart(power):
    """Thue-Morse words and their complements, which polynomial hashes modulo 2 ** 64 take for one."""
    bits = [bin(k).count("1") & 1 for k in range(1 << power)]
    one, two = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    tool, known = bpe.Merger(bpe.read_ranks(PATHS[0])), public_encoder(PATHS[0])
    texts = [f"{one} x {two}", two, one, "x " * 40 + one]
    want = [known.encode_ordinary(t) for t in texts]
    assert bpe.encode_array(pa.array(texts), tool).to_pylist() == want
    assert [bpe.encode_array(pa.array([t]), tool).to_pylist()[0] for t in texts] == want
    assert token_counts.count_array(pa.array(texts), token_counts.Counter(tool)).to_pylist() == list(map(len, want))
    data = np.frombuffer((one + two).encode(), np.uint8)
    h = range_hashes(data, np.array([0, len(one)]), np.array([len(one), len(data)]))
    w = range_hashes(np.array(bits + [1 - b for b in bits], np.uint64), np.array([0, len(one)]), np.array([len(one), len(data)]))
    assert h[0] != h[1] and w[0] != w[1]


def test_long_ranges_hash_by_content():
    r = np.random.default_rng(1)
    part = r.integers(0, 256, 1000).astype(np.uint8)
    for size in (127, 128, 129, 700):
        whole = np.concatenate([r.integers(0, 256, 50).astype(np.uint8), part, r.integers(0, 256, 7).astype(np.uint8), part])
        at = np.array([50, 1057, 51])
        h = range_hashes(whole, at, at + size)
        assert h[0] == h[1] != h[2] and h[0] == range_hashes(part, np.array([0]), np.array([size]))[0]


def test_heap_merges_like_repeated_search():
    pairs, r = bpe.merger(PATHS[0]).pairs, random.Random(1)

    def brute(symbols):
        while True:
            ranked = [(pairs[s], i) for i in range(len(symbols) - 1) if (s := symbols[i] << 32 | symbols[i + 1]) in pairs]
            if not ranked:
                return symbols
            rank, i = min(ranked)
            symbols = [*symbols[:i], rank, *symbols[i + 2 :]]

    ids = bpe.merger(PATHS[0]).byte_ids
    for _ in range(300):
        piece = [int(ids[b]) for b in bytes(r.choices(b"abcdetinghou ", k=r.randint(1, 40)))]
        merges, left = token_counts.heap_merge(list(piece), pairs)
        assert left == brute(piece) and merges == len(piece) - len(left)


def test_bpe_queries_over_whole_tables(spark):
    path = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op2_bpe_round_trip"](spark, path).collect()
    counts = {r.doc_id: r.n_tokens for r in queries.QUERIES["op6_token_counts"](spark, path).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    known = public_encoder(PATHS[0])
    assert len(rows) == len(texts) == len(counts)
    for r in rows:
        assert r.exact and list(r.ids) == known.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) == counts[r.doc_id]


def test_bpe_on_awkward_rows(spark):
    docs = frame(spark, [*AWKWARD, (7, "twice"), (7, "twice")]).withColumn("ids", F.lit("mine")).withColumn("n_tokens", F.lit(-1)).withColumn("exact", F.lit(0))
    rows = bpe.round_trip(docs).collect()
    assert len(rows) == len(AWKWARD) + 2 and all(r.exact for r in rows if r.ids is not None)
    assert [r.ids for r in rows if r.doc_id == 1] == [None] and [r.ids for r in rows if r.doc_id == 2] == [[]]
    back = bpe.decode(bpe.encode(docs), into="again")
    assert back.filter("not (text <=> again)").count() == 0 and back.count() == len(rows)
    counted = token_counts.token_counts(docs)
    assert counted.columns == docs.columns and counted.filter("doc_id = 2").first().n_tokens == 0 and counted.filter("doc_id = 1").first().n_tokens is None
    none = docs.filter("false")
    assert bpe.round_trip(none).count() == bpe.encode(none).count() == token_counts.token_counts(none).count() == wavelet.shards(none).count() == pseudo_lm.score(none).count() == 0
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(spark.createDataFrame([([999_999],)], "ids array<int>")).collect()


# ---- wavelet ------------------------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=300), st.integers(0, 41))
def test_wavelet_look_ups(ids, token):
    x = np.array(ids, np.int64)
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(x, np.array([9]), np.array([len(x)])).to_bytes())
    assert m.access(np.arange(len(x))).tolist() == ids and m.document(0).tolist() == ids
    assert m.occurrences(token).tolist() == np.flatnonzero(x == token).tolist()
    for a, b in ((0, len(x)), (len(x) // 3, len(x) // 2)):
        assert m.count(token, a, b) == int((x[a:b] == token).sum())
    with pytest.raises(IndexError):
        m.select(token, [m.count(token)])


def test_shards_hold_every_token(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    shards = wavelet.shards(docs, shard_tokens=100_000).cache()
    assert shards.count() > 3
    ids = {r.doc_id: list(r.ids) for r in bpe.round_trip(docs).collect()}
    seen = {}
    for row in shards.collect():
        m = wavelet.WaveletMatrix.from_bytes(row.payload)
        assert m.size == row.n_tokens
        seen |= {d: m.document(n).tolist() for n, d in enumerate(row.doc_ids)}
    assert seen == ids
    token = max((t for x in ids.values() for t in x), key=lambda t: t % 977)
    want = {(d, k) for d, x in ids.items() for k, t in enumerate(x) if t == token}
    assert {(r.doc_id, r.place) for r in wavelet.occurrences(shards, token).collect()} == want
    assert wavelet.count(shards, token).agg(F.sum("n")).first()[0] == len(want)
    files = wavelet.export(shards, f"file://{tmp_path}/out").collect()
    again = wavelet.WaveletMatrix.from_bytes(open(files[0].file, "rb").read())
    assert again.size > 0 and len(files) == shards.count() == len({f.file for f in files})


def test_wavelet_on_awkward_rows(spark):
    rows = wavelet.shards(frame(spark, [*AWKWARD, (7, "twice"), (7, "twice")]).withColumn("payload", F.lit(1)).coalesce(1)).collect()
    assert len(rows) == 1 and rows[0].doc_ids.count(None) == 1 and sorted(i for i in rows[0].doc_ids if i is not None) == [2, 3, 4, 5, 6, 7, 7, 7]
    m = wavelet.WaveletMatrix.from_bytes(rows[0].payload)
    assert m.names().to_pylist() == rows[0].doc_ids
    real = wavelet.shards(frame(spark, [(-1, "a word"), (None, "a word")]).coalesce(1))
    assert sorted(map(repr, real.first().doc_ids)) == ["-1", "None"]
    token = bpe.encode_array(pa.array(["a word"]), bpe.merger(PATHS[0])).to_pylist()[0][0]
    assert sorted(map(repr, (r.doc_id for r in wavelet.occurrences(real, token).collect()))) == ["-1", "None"]


def test_a_token_costs_a_frame_of_each_plane():
    r = np.random.default_rng(4)
    x = r.integers(0, 50_000, 600_000)
    blob, read = wavelet.WaveletMatrix.build(x, np.arange(3), np.array([200_000] * 3), 16).to_bytes(), []
    m = wavelet.WaveletMatrix.open(lambda a, n: read.append(n) or blob[a : a + n])
    head = sum(read)
    assert head < 0.01 * len(blob)
    for i in (0, 123_456, 599_999):
        before = sum(read), len(read)
        assert m.access(np.array([i]))[0] == x[i]
        assert len(read) - before[1] <= 16 and sum(read) - before[0] <= 16 * (wavelet.FRAME_BYTES + 64)
    before = len(read)
    k = int((x[:300_000] == x[7]).sum()) - 1
    assert m.select(int(x[7]), np.array([k]))[0] == np.flatnonzero(x == x[7])[k] and len(read) - before <= 16 * 3
    assert m.count(int(x[7]), 100, 500_000) == int((x[100:500_000] == x[7]).sum())
    assert (m.document(1) == x[200_000:400_000]).all()


# ---- LM scores ----------------------------------------------------------------------------------


def test_context_predicts(spark):
    """On text where a word tells its neighbours, the network beats word frequencies by far on held-out texts."""
    r = random.Random(2)
    pairs = [(f"left{k}", f"mid{k}", f"right{k}") for k in range(12)]
    rows = [(i, " ".join(w for _ in range(60) for w in r.choice(pairs))) for i in range(600)]
    docs = frame(spark, rows)
    train, held = docs.filter("doc_id < 450"), docs.filter("doc_id >= 450")
    mean = lambda m: pseudo_lm.score(held, m).agg((F.sum("log_likelihood") / F.sum("n_tokens")).alias("x")).first().x
    counts, network = mean(pseudo_lm.train(train, rounds=0)), mean(pseudo_lm.train(train, rounds=4))
    assert counts < -3.4 and network > counts + 1.5


def test_rounds_train_on_every_text_once(spark):
    docs = frame(spark, [*AWKWARD, *((100 + k, f"text {k % 40}") for k in range(80))])
    for rounds in (1, pseudo_lm.ROUNDS, 7):
        parts = [docs.filter(pseudo_lm.of_round(F.col("text"), k, rounds)) for k in range(rounds)]
        assert sum(p.count() for p in parts) == len(AWKWARD) + 80


def test_contexts_stay_inside_documents():
    tokens, counts, pad = np.array([1, 2, 3, 4, 5, 6]), np.array([1, 0, 3, 2]), pseudo_lm.PAD
    assert pseudo_lm.contexts(tokens, counts).tolist() == [[pad, pad, pad, pad], [pad, pad, 3, 4], [pad, 2, 4, pad], [2, 3, pad, pad], [pad, pad, 6, pad], [pad, 5, pad, pad]]
    assert pseudo_lm.contexts(tokens[:0], counts[:0]).shape == (0, 4)


def test_training_step_is_the_gradient_of_the_score():
    """Every weight moves by AdaGrad along the gradient that finite differences of the score give."""
    r, net = np.random.default_rng(5), pseudo_lm.Network()
    net.w = {k: r.normal(0, 0.3, v.shape).astype(np.float32) for k, v in net.w.items()}
    context, target = r.integers(0, pseudo_lm.VOCAB + 1, (40, 4)), r.integers(0, 300, 40)
    context[:20] = context[0]

    def loss(w):
        total = 0.0
        for c, t in zip(context, target):
            h = np.append(np.tanh(sum(w["embed"][k * (pseudo_lm.VOCAB + 1) + x] for k, x in enumerate(c))), 1.0)
            for table, at in ((w["group_out"], t // 64), (w["token_out"][t // 64 * 64 : t // 64 * 64 + 64], t % 64)):
                s = table @ h
                total -= s[at] - np.log(np.exp(s).sum())
        return total / len(target)

    w = {k: v.astype(float) for k, v in net.w.items()}
    assert abs(loss(w) + net.log_probabilities(context, target).mean()) < 1e-4
    before = {k: v.copy() for k, v in net.w.items()}
    net.step(context, target, 0.1)
    for name, row in (("embed", context[0, 0]), ("embed", pseudo_lm.VOCAB + 1 + context[25, 1]), ("group_out", target[3] // 64), ("token_out", target[3]), ("token_out", target[9])):
        grad = np.zeros(w[name].shape[1])
        for j in range(len(grad)):
            for sign in (1, -1):
                w[name][row, j] += sign * 1e-5
                grad[j] += sign * loss(w) / 2e-5
                w[name][row, j] -= sign * 1e-5
        want = -0.1 * grad / np.sqrt(1e-6 + (grad**2).mean())
        assert np.allclose(net.w[name][row] - before[name][row], want, atol=2e-3)
    still = np.setdiff1d(np.arange(pseudo_lm.VOCAB + 1), context[:, 0])
    assert (net.w["embed"][still] == before["embed"][still]).all()


def test_scores_match_brute_force(spark):
    docs = frame(spark, [(1, "b a c a b"), (2, "A, a! zebra")])
    model = vocabulary, net = pseudo_lm.train(docs)
    for r in pseudo_lm.score(docs, model).collect():
        text = {1: "b a c a b", 2: "a a zebra"}[r.doc_id].split()
        tokens = [int(vocabulary(pseudo_lm.word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0])[0]) for w in text]
        total = 0.0
        for i, t in enumerate(tokens):
            near = [tokens[i + d] if 0 <= i + d < len(tokens) else pseudo_lm.PAD for d in (-2, -1, 1, 2)]
            h = np.append(np.tanh(sum(net.w["embed"][k * (pseudo_lm.VOCAB + 1) + c].astype(float) for k, c in enumerate(near))), 1.0)
            for table, at in ((net.w["group_out"], t // 64), (net.w["token_out"][t // 64 * 64 : t // 64 * 64 + 64], t % 64)):
                s = table @ h
                total += s[at] - np.log(np.exp(s).sum())
        assert abs(total - r.log_likelihood) < 1e-3 and r.n_tokens == len(tokens) and abs(r.per_token - total / len(tokens)) < 1e-3


@pytest.mark.parametrize("known", [pseudo_lm.KNOWN, 700, 0])
def test_rare_words_have_their_own_probability(spark, monkeypatch, known):
    """A class's words share its probability by their counts, wherever those are, and one word not seen fills it up to 1."""
    monkeypatch.setattr(pseudo_lm, "KNOWN", known)
    often = [f"often{k}" for k in range(pseudo_lm.VOCAB - pseudo_lm.BUCKETS)]
    times = {f"rare{k}": 1 + k % 7 for k in range(1500)}
    docs = frame(spark, [(k, " ".join(often)) for k in range(8)] + [(9, " ".join(w for w, n in times.items() for _ in range(n)))])
    vocabulary, net = model = pseudo_lm.train(docs)
    asked = [*times, "unheard"]
    got = {r.doc_id: r for r in pseudo_lm.score(frame(spark, list(enumerate(asked))), model).collect()}
    assert (vocabulary.tail is None) == (known > 1500) and len(vocabulary.known) <= known and (len(vocabulary.known) > 0) == (known > 0)
    hashes = [int(pseudo_lm.word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][0]) for w in asked]
    tokens = vocabulary(np.array(hashes))
    assert tokens.min() >= pseudo_lm.VOCAB - pseudo_lm.BUCKETS
    of_class = net.log_probabilities(np.full((len(asked), 4), pseudo_lm.PAD), tokens)
    total = {t: sum(n for w, n in times.items() if vocabulary(np.array([hashes[asked.index(w)]]))[0] == t) for t in set(tokens[:50]) | {tokens[-1]}}
    for k in [*range(50), len(asked) - 1]:
        want = of_class[k] + np.log(times.get(asked[k], 1) / (total[tokens[k]] + 1))
        assert abs(got[k].log_likelihood - want) < 1e-3 and abs(got[k].per_token - want) < 1e-3
    for t in total:
        mine = [k for k in range(len(asked) - 1) if tokens[k] == t]
        shares = sum(np.exp(got[k].log_likelihood - of_class[k]) for k in mine) + 1 / (total[t] + 1)
        assert abs(shares - 1) < 1e-3


def test_scores_are_probabilities():
    r = np.random.default_rng(0)
    net = pseudo_lm.Network()
    net.w = {k: r.normal(0, 0.5, v.shape).astype(np.float32) for k, v in net.w.items()}
    context = np.tile(r.integers(0, pseudo_lm.VOCAB + 1, 4), (pseudo_lm.VOCAB, 1))
    assert abs(np.exp(net.log_probabilities(context, np.arange(pseudo_lm.VOCAB)).astype(float)).sum() - 1) < 1e-3


def test_scores_on_awkward_rows(spark):
    docs = frame(spark, [*AWKWARD, (7, "twice"), (7, "twice")]).withColumn("log_likelihood", F.lit(1)).withColumn("n", F.lit(2))
    rows = pseudo_lm.score(docs).collect()
    assert len(rows) == len(AWKWARD) + 2
    assert all((r.log_likelihood == 0 and r.per_token is None) if r.n_tokens == 0 else r.log_likelihood < 0 for r in rows)
    assert len({r.log_likelihood for r in rows if r.doc_id == 7 and r.n_tokens == 1}) == 1
