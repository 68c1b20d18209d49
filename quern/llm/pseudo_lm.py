"""LM scoring by masked pseudo-likelihood with a bidirectional window network, trained in numpy.

Tokens are words (lower case). The vocabulary is the ``VOCAB - BUCKETS`` most frequent words by counts
over all documents, and BUCKETS classes for all other words, by hash; a word of a class has the class's
probability times its share of the class's occurrences. The counts of the most frequent ``KNOWN`` words at most go to every
task; those of all others stay in a stored table, which grows with the corpus and is joined to the texts to score. The network sees the ``SIDE``
tokens on each side of a place: the sum of their embeddings (one table for each offset) goes through
tanh and predicts the masked token by a two-level softmax, first its class of ``GROUP`` tokens, then the
token. Training is data-parallel: in each round every partition takes gradient steps from the common
weights over its own documents, and partitions' weights are averaged, block by block, in a shuffle.
A document's score is the sum of the log-probabilities of its tokens, each given both sides.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import list_array, lower, passes, plain, range_hashes, spans
from quern.runtime import Workspace, prepare

VOCAB, GROUP, BUCKETS = 4096, 64, 512
SIDE, WIDTH = 2, 24
#: Of R training rounds, round k takes the texts whose hash leaves k: every place of every document is a target once.
ROUNDS = 2
#: Places of a step: the first number until a task has seen FEW of them in its round, then the second.
BATCH, LATE_BATCH, FEW = 1024, 8192, 64 * 1024
#: Places that are scored together.
CHUNK = 16_384
#: Words at most whose counts every task holds, 16 bytes each; and steps of a doubling of the count by which they are picked.
KNOWN, STEPS = 1 << 19, 64
#: Logarithms of counts are added up as whole numbers of this part, which gives the same in any order.
UNIT = float(1 << 32)
#: Weights of a block that one reducer row averages.
BLOCK_ROWS = 512
PAD = VOCAB

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[0x80:] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all rows, words per row); a word is letters, digits and other bytes outside ASCII."""
    small = lower(data)
    starts, ends, counts = spans(_WORD[small], offsets)
    return (range_hashes(small, starts, ends) >> np.uint64(1)).astype(np.int64) if len(starts) else np.zeros(0, np.int64), counts


class Vocabulary:
    """Frequent words by rank, other words by hash.

    ``classes`` holds the occurrences of all words of each class, and ``known`` (word, n) of the most frequent
    words. ``tail`` is the path of a stored table (word, n) of all other words that occur more than once; None where
    there are none.
    """

    def __init__(self, hashes: np.ndarray, classes: np.ndarray | None = None, known: tuple[np.ndarray, np.ndarray] | None = None, tail: str | None = None):
        self.order = np.argsort(hashes)
        self.sorted = np.asarray(hashes, np.int64)[self.order]
        self.classes = np.zeros(BUCKETS) if classes is None else classes
        words, n = known or (np.zeros(0, np.int64), np.zeros(0, np.int64))
        by = np.argsort(words)
        self.known, self.gains, self.tail = words[by], np.rint(np.log(n[by]) * UNIT).astype(np.int64), tail

    def gain(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logarithms of the counts of known words in UNITs, 0 for others; which words are known)."""
        if not len(self.known):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
        hit = self.known[at] == words
        return np.where(hit, self.gains[at], 0), hit

    def least_shares(self, tokens: np.ndarray) -> np.ndarray:
        """Log of the share of a word that occurs once in its class; 0 for frequent words.

        A word of n occurrences has n times that, one that training has not seen as much as one seen
        once, so that the words of a class and one word not seen make up 1.
        """
        return np.where(tokens < VOCAB - BUCKETS, 0.0, -np.log1p(self.classes[np.maximum(tokens - (VOCAB - BUCKETS), 0)]))

    def __call__(self, words: np.ndarray) -> np.ndarray:
        other = VOCAB - BUCKETS + words % BUCKETS
        if not len(self.sorted):
            return other
        at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
        return np.where(self.sorted[at] == words, self.order[at], other)


def contexts(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The 2 * SIDE neighbours of each place, PAD beyond a document's ends."""
    ends = np.cumsum(counts)
    before = np.arange(len(tokens)) - np.repeat(ends - counts, counts)
    after = np.repeat(ends, counts) - 1 - np.arange(len(tokens))
    padded = np.full(len(tokens) + 2 * SIDE, PAD, np.int64)
    padded[SIDE : SIDE + len(tokens)] = tokens
    out = np.empty((len(tokens), 2 * SIDE), np.int64)
    for k, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        out[:, k] = padded[SIDE + d : SIDE + d + len(tokens)]
        out[(before < -d) if d < 0 else (after < d), k] = PAD
    return out


def of_round(text: Column, k: int, rounds: int) -> Column:
    """Whether a text is of round ``k`` of ``rounds``."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(rounds)) == k


class Network:
    """Weights: embeddings by offset, class outputs, outputs of the tokens of each class."""

    NAMES = ("embed", "group_out", "token_out")

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 3):
        r = np.random.default_rng(seed)
        groups = VOCAB // GROUP
        self.squares: dict[str, np.ndarray] = {}
        self.w = weights or {
            "embed": r.normal(0, 0.1, (2 * SIDE * (VOCAB + 1), WIDTH)).astype(np.float32),
            "group_out": np.zeros((groups, WIDTH + 1), np.float32),
            "token_out": np.zeros((VOCAB, WIDTH + 1), np.float32),
        }

    def start_from_counts(self, counts: np.ndarray) -> "Network":
        """Output biases from token counts over the whole corpus."""
        by = counts.reshape(-1, GROUP).astype(np.float64) + 0.5
        self.w["group_out"][:, -1] = np.log(by.sum(axis=1) / by.sum())
        self.w["token_out"][:, -1] = np.log(by / by.sum(axis=1, keepdims=True)).ravel()
        return self

    def hidden(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = context + np.arange(2 * SIDE) * (VOCAB + 1)
        total = np.take(self.w["embed"], at[:, 0], axis=0)
        part = np.empty_like(total)
        for k in range(1, 2 * SIDE):
            total += np.take(self.w["embed"], at[:, k], axis=0, out=part, mode="clip")
        out = np.ones((len(context), WIDTH + 1), np.float32)
        np.tanh(total, out=out[:, :-1])
        return at, out

    @staticmethod
    def _softmax(score: np.ndarray) -> np.ndarray:
        """Softmax of each row, in place, of scores cut to what exp can take."""
        np.clip(score, -80, 80, out=score)
        np.exp(score, out=score)
        score /= (score @ np.ones(score.shape[1], np.float32))[:, None]
        return score

    @staticmethod
    def _log_chosen(score: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Log-softmax of the chosen column of each row; overwrites the scores."""
        score -= score.max(axis=1, keepdims=True)
        out = score[np.arange(len(score)), chosen]
        np.exp(score, out=score)
        return out - np.log(score @ np.ones(score.shape[1], np.float32))

    @staticmethod
    def _by_group(target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order of the targets by token, bounds of the groups in it)."""
        order = np.argsort(target.astype(np.uint16), kind="stable")
        return order, np.searchsorted(target[order], np.arange(0, VOCAB + 1, GROUP))

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        out = np.empty(len(target), np.float32)
        for a in range(0, len(target), CHUNK):
            t = target[a : a + CHUNK]
            order, bounds = self._by_group(t)
            t = t[order]
            _, h = self.hidden(context[a : a + CHUNK][order])
            part = self._log_chosen(h @ self.w["group_out"].T, t // GROUP)
            for g in np.flatnonzero(np.diff(bounds)):
                mine = slice(bounds[g], bounds[g + 1])
                part[mine] += self._log_chosen(h[mine] @ self.w["token_out"][g * GROUP : (g + 1) * GROUP].T, t[mine] - g * GROUP)
            out[a + order] = part
        return out

    def _descend(self, name: str, rows: slice | np.ndarray, grad: np.ndarray, rate: float) -> None:
        """AdaGrad with one running square for each row; rows are distinct. A gradient of zero leaves a row as it is."""
        if name not in self.squares:
            self.squares[name] = np.full(len(self.w[name]), 1e-6, np.float32)
        self.squares[name][rows] += np.einsum("ij,ij->i", grad, grad) / grad.shape[1]
        self.w[name][rows] -= rate * grad / np.sqrt(self.squares[name][rows])[:, None]

    def step(self, context: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One gradient step on the mean negative log-probability of a batch."""
        n = len(target)
        order, bounds = self._by_group(target)
        target, context = target[order], context[order]
        _, h = self.hidden(context)
        p = self._softmax(h @ self.w["group_out"].T)
        p[np.arange(n), target // GROUP] -= 1
        back, grad = p @ self.w["group_out"][:, :-1], p.T @ h
        token_grad = np.zeros_like(self.w["token_out"])
        for g in np.flatnonzero(np.diff(bounds)):
            mine, rows = slice(bounds[g], bounds[g + 1]), slice(g * GROUP, (g + 1) * GROUP)
            q = self._softmax(h[mine] @ self.w["token_out"][rows].T)
            q[np.arange(len(q)), target[mine] - g * GROUP] -= 1
            back[mine] += q @ self.w["token_out"][rows, :-1]
            np.dot(q.T, h[mine], out=token_grad[rows])
        self._descend("token_out", slice(None), token_grad / n, rate)
        self._descend("group_out", slice(None), grad / n, rate)
        back *= (1 - h[:, :-1] ** 2) / n
        columns, grad = np.ascontiguousarray(back.T, np.float64), np.empty((WIDTH, 2 * SIDE, VOCAB + 1))
        for k in range(2 * SIDE):
            for j in range(WIDTH):
                grad[j, k] = np.bincount(context[:, k], columns[j], VOCAB + 1)
        self._descend("embed", slice(None), grad.reshape(WIDTH, -1).T.astype(np.float32), rate)

    def blocks(self) -> Iterator[tuple[str, int, np.ndarray]]:
        for name in self.NAMES:
            for b in range(0, len(self.w[name]), BLOCK_ROWS):
                yield name, b, self.w[name][b : b + BLOCK_ROWS]


def train(docs: DataFrame, rounds: int = ROUNDS, rate: float = 0.2) -> tuple[Vocabulary, Network]:
    """Vocabulary and network from all of ``docs`` (doc_id, text).

    Word counts, and the weights that partitions send to be averaged, grow with the corpus; the driver
    receives the vocabulary and one set of weights. Whatever ``rounds`` is, every place of every document
    is a target once, in the round of its text. The same partitions give the same model.
    """
    spark = prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def settle() -> None:
            words, n = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            distinct, back = np.unique(words, return_inverse=True)
            held[:] = [(distinct, np.bincount(back, n).astype(np.int64))]

        for batch in batches:
            for _, _, data, offsets in passes(batch.column("text")):
                held.append(np.unique(word_hashes(data, offsets)[0], return_counts=True))
            if len(held) > 16:
                settle()
        if held:
            settle()
            yield pa.RecordBatch.from_arrays([pa.array(held[0][0]), pa.array(held[0][1])], names=["word", "n"])

    with Workspace(spark, "pseudo-lm") as ws:
        counted = ws.save(docs.select("text").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "counts")
        frequent = counted.orderBy(F.desc("n"), "word").limit(VOCAB - BUCKETS).collect()
        classes, known, tail = np.zeros(BUCKETS), None, None
        if len(frequent) == VOCAB - BUCKETS:
            last = frequent[-1]
            rest = counted.filter((F.col("n") < last.n) | ((F.col("n") == last.n) & (F.col("word") > last.word)))
            for r in rest.groupBy((F.col("word") % BUCKETS).alias("at")).agg(F.sum("n").alias("n")).collect():
                classes[r["at"]] = r.n
            # the least size of counts from which on there are at most KNOWN words
            sized = rest.filter("n > 1").withColumn("size", F.floor(F.log2("n") * STEPS))
            least, held = None, 0
            for r in sorted(sized.groupBy("size").count().collect(), key=lambda r: -r["size"]):  # at most 64 * STEPS rows
                held += r["count"]
                if held > KNOWN:
                    break
                least = r["size"]
            if least is not None:
                rows = sized.filter(F.col("size") >= least).select("word", "n").toArrow()  # at most KNOWN rows
                known = tuple(rows.column(c).to_numpy() for c in ("word", "n"))
            if held > KNOWN:
                ws.result((sized if least is None else sized.filter(F.col("size") < least)).select("word", "n"))
                tail = ws.kept
    hashes = np.array([r.word for r in frequent], np.int64)
    vocabulary, bare = Vocabulary(hashes, classes, known, tail), Vocabulary(hashes)  # training needs no counts
    counts = np.zeros(VOCAB)
    counts[: len(frequent)] = [r.n for r in frequent]
    counts[VOCAB - BUCKETS :] = classes
    network = Network().start_from_counts(counts)
    for k in range(rounds):
        held = spark.sparkContext.broadcast(pickle.dumps((bare, network)))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, net = pickle.loads(held.value)  # noqa: B023
            context, target, seen = [], [], 0

            def steps(least: int) -> None:
                nonlocal context, target
                c, t = np.concatenate(context), np.concatenate(target)
                by = np.random.default_rng(len(t)).permutation(len(t))
                done = 0
                size = BATCH if seen <= FEW else LATE_BATCH
                while len(t) - done >= min(least, size):
                    some = by[done : done + size]
                    net.step(c[some], t[some], rate / (1 + k))  # noqa: B023
                    done += size
                context, target = [c[by[done:]]], [t[by[done:]]]

            for batch in batches:
                for _, _, data, offsets in passes(batch.column("text")):
                    hashes, per = word_hashes(data, offsets)
                    tokens = words(hashes)
                    seen += len(tokens)
                    context.append(contexts(tokens, per))
                    target.append(tokens)
                    if sum(map(len, target)) >= FEW:
                        steps(LATE_BATCH)
            n = seen
            if target and sum(map(len, target)):
                steps(1)
            if n:
                name, row, values = zip(*net.blocks())
                yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(row, pa.int64()), pa.array([n] * len(name), pa.int64()), pa.array([v.astype(np.float32).tobytes() for v in values])], names=["name", "row", "n", "weights"])

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[str, int], list] = {}
            for batch in batches:
                for name, row, n, weights in zip(*(batch.column(c).to_pylist() for c in ("name", "row", "n", "weights"))):
                    have = sums.setdefault((name, row), [0, 0.0])
                    have[0], have[1] = have[0] + n, have[1] + n * np.frombuffer(weights, np.float32).astype(np.float64)
            if sums:
                yield pa.RecordBatch.from_pydict({"name": [x[0] for x in sums], "row": pa.array([x[1] for x in sums], pa.int64()), "weights": [(v / n).astype(np.float32).tobytes() for n, v in sums.values()]})

        sent = docs.filter(of_round(F.col("text"), k, rounds)).select("text").mapInArrow(learn, "name string, row bigint, n bigint, weights binary")
        merged = sent.repartition("name", "row").mapInArrow(average, "name string, row bigint, weights binary").collect()
        if not merged:
            break
        fresh = {name: np.zeros_like(w) for name, w in network.w.items()}
        for r in merged:
            part = np.frombuffer(r.weights, np.float32).reshape(-1, WIDTH + (r.name != "embed"))
            fresh[r.name][r.row : r.row + len(part)] = part
        network = Network(fresh)
    return vocabulary, network


def score(docs: DataFrame, model: tuple[Vocabulary, Network] | None = None) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, per_token) for every row of ``docs``.

    ``log_likelihood`` sums the log-probability of each word given both sides; ``per_token`` is its mean,
    null without tokens. Null and empty texts have no tokens and a sum of 0. Rows, ties and null ids
    stay as they are; equal texts score alike; other columns are not read. Without ``model`` one is
    trained on ``docs``.
    """
    spark = prepare(docs.sparkSession)
    rows = plain(docs, "doc_id", "text")
    model = model or train(rows)
    held = spark.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, net = pickle.loads(held.value)
        for batch in batches:
            for i, j, data, offsets in passes(batch.column("text")):
                hashes, counts = word_hashes(data, offsets)
                tokens = words(hashes)
                total = np.zeros(len(tokens) + 1)
                np.cumsum(net.log_probabilities(contexts(tokens, counts), tokens) + words.least_shares(tokens), out=total[1:])
                ends = np.cumsum(counts)
                rare = np.flatnonzero(tokens >= VOCAB - BUCKETS)
                gains, hit = words.gain(hashes[rare])
                known = np.zeros(len(tokens) + 1, np.int64)
                known[rare + 1] = gains
                np.cumsum(known, out=known)
                rare = rare[~hit]
                before = np.searchsorted(rare, np.concatenate(([0], ends)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(counts), pa.array(total[ends] - total[ends - counts]), pa.array(known[ends] - known[ends - counts]), list_array(hashes[rare], np.diff(before))], names=["doc_id", "n_tokens", "least", "known", "rare"])

    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    scored = rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, least double, known bigint, rare array<bigint>")
    total = (F.col("least") + F.col("known") / UNIT).alias("log_likelihood")
    if model[0].tail is None:
        return scored.select("doc_id", "n_tokens", total).withColumn("per_token", mean)
    with Workspace(spark, "pseudo-lm") as ws:
        stored = ws.save(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
        tail = spark.read.schema("word bigint, n bigint").parquet(model[0].tail)
        more = F.sum(F.round(F.log("n") * UNIT).cast("bigint"))
        gains = stored.select("row", F.explode("rare").alias("word")).join(tail, "word").groupBy("row").agg(more.alias("more"))
        both = stored.drop("rare").join(gains, "row", "left").withColumn("known", F.col("known") + F.coalesce("more", F.lit(0)))
        return ws.result(both.select("doc_id", "n_tokens", total).withColumn("per_token", mean))
