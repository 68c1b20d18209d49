"""Mixing to target weights by soft membership.

A classifier trained on a labelled table gives every document posteriors over domains. Each document
d has t_d tokens and a posterior p_d; its rate r_d >= 0 says how many times it is to be
used. Rates minimise the squared distance between the expected domain totals, sum of r_d t_d p_d, and
the targets, by one projected gradient step from r = 1, whose gradient is found by Newton's method on the dual.
One round is one small aggregation over a written table; the step is all that rates depend on, so no
state is kept on executors.
"""

from __future__ import annotations

import pickle
import uuid
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import list_array, lower, passes, plain, range_hashes, trimmed, uniform, word_spans
from quern.runtime import Workspace, prepare

HASH_BITS = 16


def word_features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, hashed words and shape marks, words per row) for passes over a column."""
    for i, j, data, offsets in passes(column):
        small = lower(data)
        starts, ends, counts = word_spans(small, offsets)
        words = (range_hashes(small, starts, ends) >> np.uint64(64 - HASH_BITS)).astype(np.int64) if len(starts) else np.zeros(0, np.int64)
        # a word that repeats the one before it, and one in capitals, count as one mark each
        again = np.zeros(len(words), bool)
        again[1:] = words[1:] == words[:-1]
        words[again] = 1
        if len(starts):
            upper = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
            words[~again & (upper[ends] - upper[starts] > 1)] = 2
        yield i, j, words, counts


def training_parts(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashed words, words per row) of one numpy pass each: all that a fit holds of texts, two bytes a word."""
    return [(words.astype(np.uint16), counts) for _, _, words, counts in word_features(column)]


class DomainModel:
    """Multinomial logistic model over length-normalised hashed words, started from smoothed log-odds."""

    def fit(self, column: pa.Array, domain: np.ndarray, n_domains: int, rounds: int = 60, rate: float = 0.05, decay: float = 1e-4) -> "DomainModel":
        return self.fit_parts(training_parts(column), domain, n_domains, rounds, rate, decay)

    def fit_parts(self, parts: list[tuple[np.ndarray, np.ndarray]], domain: np.ndarray, n_domains: int, rounds: int = 60, rate: float = 0.05, decay: float = 1e-4) -> "DomainModel":
        self.k = n_domains
        size = 1 << HASH_BITS
        prior = np.bincount(domain, minlength=n_domains) + 1.0
        self.bias = np.log(prior / prior.sum())
        self.weights = np.zeros((size, n_domains), np.float32)
        seen = np.full((size, n_domains), 0.5)
        at = np.cumsum([0, *(len(counts) for _, counts in parts)])
        for (words, counts), i in zip(parts, at):
            kind = np.repeat(domain[i : i + len(counts)], counts)
            for d in range(n_domains):
                seen[:, d] += np.bincount(words[kind == d], minlength=size)
        used = np.flatnonzero((seen > 0.5).any(axis=1))
        if not len(used):
            return self
        start = np.log(seen / seen.sum(axis=0))
        start -= start.mean(axis=1, keepdims=True)
        where = np.zeros(size, np.int32)
        where[used] = np.arange(len(used))
        parts = [(where[words], counts) for words, counts in parts]
        target = np.eye(n_domains)[domain]
        w, b = start[used] * 1.0, self.bias.copy()
        g2 = np.full(w.shape, 1e-12)
        for _ in range(rounds):
            grad, drift = decay * w / len(used), np.zeros(n_domains)
            for (words, counts), i in zip(parts, at):
                scale, full = 1.0 / np.maximum(counts, 1), counts > 0
                score = np.tile(b, (len(counts), 1))
                if full.any():
                    score[full] += np.add.reduceat(w[words], (np.cumsum(counts) - counts)[full], axis=0) * scale[full, None] * 10
                p = np.exp(score - score.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                off = (p - target[i : i + len(counts)]) / len(domain)
                drift += off.sum(axis=0)
                for d in range(n_domains):
                    grad[:, d] += np.bincount(words, np.repeat(off[:, d] * scale, counts), len(used)) * 10
            g2 += grad**2
            w -= rate * grad / np.sqrt(g2)
            b -= 0.5 * drift
        self.weights[used], self.bias = w, b
        return self

    def posteriors(self, column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), self.k))
        for i, j, words, counts in word_features(column):
            total = np.zeros((len(words) + 1, self.k))
            np.cumsum(self.weights[words], axis=0, out=total[1:], dtype=np.float64)
            ends = np.cumsum(counts)
            out[i:j] = (total[ends] - total[ends - counts]) / np.maximum(counts, 1)[:, None] * 10 + self.bias
        out = np.exp(out - out.max(axis=1, keepdims=True)) if len(out) else out
        return out / out.sum(axis=1, keepdims=True) if len(out) else out


def train_domains(docs: DataFrame, labelled: DataFrame, domains: list[str], max_labelled: int = 4000, seed: int = 1) -> DomainModel:
    """Fit on at most ``max_labelled`` labelled rows of each domain, picked by a hash of doc_id and, where an id has
    several texts, by one of the text. Of the texts, the task that fits holds one batch at a time.

    ``labelled`` has (doc_id, domain). Nulls, domains not listed and labels of absent documents are
    ignored; of several labels of an id the least domain holds. Without labels the posteriors are even.
    """
    prepare(docs.sparkSession)
    marked = labelled.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("domain").cast("string").alias("domain")).dropna().filter(F.col("domain").isin(domains))
    marked = marked.groupBy("doc_id").agg(F.min("domain").alias("domain")).join(plain(docs, "doc_id").dropna(), "doc_id", "left_semi")
    chosen = None
    for name in domains:
        part = marked.filter(F.col("domain") == name).orderBy(uniform(F.col("doc_id"), seed), "doc_id").limit(max_labelled)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = plain(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_labelled ids a domain

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, numbers, room = [], [], dict.fromkeys(domains, max_labelled)
        for batch in batches:
            names, some = batch.column("domain").to_pylist(), []
            for i, name in enumerate(names):
                if room[name] > 0:
                    room[name] -= 1
                    some.append(i)
            parts += training_parts(batch.column("text").take(pa.array(some, pa.int64())))
            numbers += [domains.index(names[i]) for i in some]
        if not numbers:
            return
        model = DomainModel().fit_parts(parts, np.array(numbers, np.int64), len(domains))
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    found = rows.repartition(1).sortWithinPartitions(uniform(F.col("doc_id"), seed), "doc_id", F.xxhash64("text")).select("text", "domain").mapInArrow(trimmed(fit), "model binary").collect()
    return pickle.loads(bytes(found[0][0])) if found else DomainModel().fit(pa.array([], pa.string()), np.zeros(0, np.int64), len(domains))


def _fold_rates(steps: list[np.ndarray], k: int, tokens: str = "tokens", posterior: str = "posterior", ahead: bool = False) -> Column:
    """The rate after ``steps`` (or, ``ahead``, the point extrapolated from it), as one fold over a literal array.

    A step holds k numbers g and a momentum b: from the point y the rate becomes max(0, y - p . g), and the
    next point lies b times the change beyond it. A text without tokens keeps rate 1.
    """
    if not steps:
        return F.lit(1.0)
    literal = F.array(*[F.array(*[F.lit(float(x)) for x in g]) for g in steps])

    def go(state: Column, g: Column) -> Column:
        drop = sum((F.col(posterior)[i] * g[i] for i in range(1, k)), F.col(posterior)[0] * g[0])
        rate = F.greatest(F.lit(0.0), state["y"] - drop)
        return F.struct(rate.alias("r"), (rate + g[k] * (rate - state["r"])).alias("y"))

    state = F.aggregate(literal, F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y")), go)
    return F.when(F.col(tokens) > 0, state["y" if ahead else "r"]).otherwise(F.lit(1.0))


#: Weights of the distance from rate 1, tried one after the other, and parts of a Newton step tried in one aggregation.
PULLS, PARTS = (1e-6, 1e-8, 1e-10, 1e-12), (1.0, 0.5, 0.2, 0.05, 0.01)


def solve_dual(evaluate, targets: np.ndarray, rounds: int, tolerance: float) -> tuple[np.ndarray, bool]:
    """(g, whether it is optimal): rates max(0, 1 - p_d . g) bring the totals nearest to ``targets``.

    These rates minimise |totals - targets|^2 + pull * sum of t_d (r_d - 1)^2, of which g is the dual, where
    pull * g is the residual; Newton steps solve for it with ever smaller pulls. ``evaluate`` gives for each of
    several g the totals, the Gram matrix of the documents in use, the sum of t_d r_d^2 and the least p_d . g.
    For every v with p_d . v >= 0 for all d no rates come nearer than -targets . v / |v|; posteriors add
    up to 1, so a residual lifted by its least p_d . v is such a v, and shows how near the optimum is.
    """
    k, g = len(targets), np.zeros(len(targets))
    totals, gram, square, least = evaluate([g])[0]
    for pull in PULLS:
        while True:
            off = totals - targets
            size = float(np.linalg.norm(off))
            v = off - min(0.0, pull * least)  # of g as it is when solved; any v that is nonnegative on all p_d bounds
            bound = max(0.0, -float(targets @ v) / max(float(np.linalg.norm(v)), 1e-300)) if np.allclose(off, pull * g, rtol=1e-3, atol=1e-12) else 0.0
            if size <= tolerance * np.linalg.norm(targets) or size - bound <= tolerance * size:
                return g, True
            slope = targets - totals + pull * g
            if np.linalg.norm(slope) <= 1e-6 * size:
                break
            if rounds <= 0:
                return g, False
            rounds -= 1
            step = -np.linalg.solve(gram + pull * np.eye(k), slope)
            tried = [g + part * step for part in PARTS]
            found = evaluate(tried)
            value = [0.5 * f[2] + targets @ x + pull / 2 * x @ x for x, f in zip(tried, found)]
            here = 0.5 * square + targets @ g + pull / 2 * g @ g
            best = int(np.argmin(value))
            if not value[best] < here:
                break  # as exact as numbers are
            g, (totals, gram, square, least) = tried[best], found[best]
    return g, False


def fit_rates(table: DataFrame, targets: np.ndarray, rounds: int = 60, tolerance: float = 1e-3) -> list[np.ndarray]:
    """One step from rate 1 for a stored table of (tokens, posterior), in the form that ``_fold_rates`` takes.

    The step is found by Newton's method, one aggregation a round. It ends at a residual of ``tolerance`` of
    the targets' length, or where no rates leave less than the residual by ``tolerance`` of itself; that it ends after
    ``rounds`` without either is warned of.
    """
    k = len(targets)
    pairs = [(i, j) for i in range(k) for j in range(k)]
    p = [F.col("posterior")[i] for i in range(k)]
    sum_of = lambda x: F.coalesce(F.sum(x), F.lit(0.0))
    total = float(table.filter("tokens > 0").agg(F.sum("tokens")).first()[0] or 0)
    if total <= 0:
        return []
    tokens = F.col("tokens") / F.lit(total)

    def evaluate(tried: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float, float]]:
        sums = []
        for g in tried:
            drop = sum((p[i] * float(g[i]) for i in range(1, k)), p[0] * float(g[0]))
            rate = F.greatest(F.lit(0.0), 1 - drop)
            used = F.when(rate > 0, tokens).otherwise(0.0)
            sums += [*[sum_of(tokens * rate * x) for x in p], *[sum_of(used * p[i] * p[j]) for i, j in pairs], sum_of(tokens * rate * rate), F.min(drop)]
        row = np.array(table.filter("tokens > 0").agg(*sums).first(), float).reshape(len(tried), -1)
        return [(r[:k], r[k : k + k * k].reshape(k, k), float(r[-2]), float(r[-1])) for r in row]

    g, optimal = solve_dual(evaluate, np.asarray(targets, float) / total, rounds, tolerance)
    if not optimal:
        warnings.warn(f"rates are not shown to be optimal after {rounds} rounds", stacklevel=2)
    return [np.append(g, 0.0)]


def _placed(text: Column, held: object) -> Column:
    """array(posteriors ..., tokens) of a text by the broadcast model."""

    @F.arrow_udf("array<double>")
    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = pickle.loads(held.value)
        for texts in batches:
            tokens = np.zeros(len(texts))
            for i, j, data, offsets in passes(texts):
                tokens[i:j] = word_spans(data, offsets)[2]
            both = np.concatenate([model.posteriors(texts), tokens[:, None]], axis=1)
            yield list_array(both.ravel(), np.full(len(both), both.shape[1]))

    return place(text)


def _draw(seed: int) -> Column:
    """A number in [0, 1) of a row's id and text."""
    return uniform(F.xxhash64(F.col("doc_id").cast("bigint"), F.xxhash64(F.col("text").cast("string"))), seed)


def _with_copies(df: DataFrame, steps: list[np.ndarray], k: int) -> DataFrame:
    """``df`` (with columns __placed and __draw) with __tokens, __posterior, __rate and __copies."""
    out = df.withColumn("__tokens", F.col("__placed")[k].cast("bigint")).withColumn("__posterior", F.slice("__placed", 1, k))
    out = out.withColumn("__rate", _fold_rates(steps, k, "__tokens", "__posterior"))
    draw = F.col("__draw")
    return out.withColumn("__copies", (F.floor("__rate") + (draw < F.col("__rate") - F.floor("__rate")).cast("bigint")))


#: Rows that ``_repeated`` makes at a time.
BLOCK = 1 << 10


def _repeated(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as the bigint column ``copies`` says, block by block.

    Generated code holds all rows that come of one input row, and all that come of those in the same code; ``observe``
    parts the code of blocks from that of rows, so that no more than a block is held.
    """
    up_to = lambda n: F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), n))  # noqa: E731  nothing comes of null
    blocks = df.withColumn("__block", F.explode(up_to(F.ceil(F.col(copies) / BLOCK)))).observe(f"blocks-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n"))
    left = F.col(copies) - (F.col("__block") - 1) * BLOCK
    return blocks.withColumn("__copy", F.explode(up_to(F.least(left, F.lit(BLOCK).cast("bigint"))))).drop("__block", "__copy")


def _fit(ws: Workspace, docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float | None, max_labelled: int, seed: int):
    """(broadcast model, gradient steps, stored (doc_id, __placed, __draw) of all rows)."""
    if not weights or min(weights.values()) < 0 or sum(weights.values()) <= 0:
        raise ValueError("weights must be nonnegative and not all zero")
    domains = list(weights)
    k = len(domains)
    held = ws.spark.sparkContext.broadcast(pickle.dumps(train_domains(docs, labelled, domains, max_labelled, seed)))
    placed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _draw(seed).alias("__draw"), _placed(F.col("text").cast("string"), held).alias("__placed"))
    stored = ws.save(placed, "placed")
    table = stored.select(F.col("__placed")[k].alias("tokens"), F.slice("__placed", 1, k).alias("posterior"))
    total = float(table.agg(F.sum("tokens")).first()[0] or 0) if budget is None else float(budget)
    share = np.array([weights[d] for d in domains], float)
    return held, fit_rates(table, share / share.sum() * total), stored


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float | None = None, max_labelled: int = 4000, seed: int = 1) -> DataFrame:
    """(doc_id, tokens, posterior, rate, copies) for every row of ``docs``.

    ``weights`` gives each domain's target share of ``budget`` tokens (all tokens of ``docs`` if
    None). ``tokens`` are words, ``posterior`` follows the order of ``weights``, ``copies`` is the rate
    rounded up or down at random by a hash of id and text, so that expected totals hold. Null and
    empty texts have no tokens and keep rate 1; null ids are rows like others; equal rows get equal
    answers. Other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    with Workspace(spark, "mixing") as ws:
        _, steps, stored = _fit(ws, docs, labelled, weights, budget, max_labelled, seed)
        rated = _with_copies(stored, steps, len(weights))
        return ws.result(rated.select("doc_id", *[F.col(f"__{c}").alias(c) for c in ("tokens", "posterior", "rate", "copies")]))


def resample(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float | None = None, max_labelled: int = 4000, seed: int = 1) -> DataFrame:
    """``docs`` with each row as often as its ``copies`` in ``mix`` say, same columns. No row is shuffled."""
    spark = prepare(docs.sparkSession)
    with Workspace(spark, "mixing") as ws:
        held, steps, _ = _fit(ws, docs, labelled, weights, budget, max_labelled, seed)
    rows = docs.withColumn("__draw", _draw(seed)).withColumn("__placed", _placed(F.col("text").cast("string"), held))
    rated = _with_copies(rows, steps, len(weights))
    return _repeated(rated, "__copies").select(*[F.col(f"`{c}`") for c in docs.columns])
