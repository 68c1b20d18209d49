"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

Features of a text: densities of a lexicon of words and of word stems (learned from labelled texts,
so that it serves any language the labels cover), second-person proximity to lexicon words,
capitals, punctuation, shouting, obfuscation (letters mixed with digits or symbols) and letter
repetition rates. Trees, lexicon and calibration are fitted on a bounded, label-stratified sample
of the labelled rows (``max_labelled`` a class); scoring reads every text whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import lower, passes, plain, range_hashes, spans, trimmed, uniform
from quern.runtime import prepare

STEM_BYTES = (4, 5, 6, 7, 8)
SECOND_PERSON = "you your yours yourself u ur tu toi te ton ta tes vous votre vos du dich dir dein deine ihr euch euer tú ti usted ustedes tus su vosotros"
FEATURES = ("lexicon_density", "stem_density", "hits", "near_second_person", "second_person", "capitals", "shouted", "exclaims", "asks", "punctuation", "obfuscated", "repeats", "words")

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0x80:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MASK = np.zeros(256, bool)  # symbols that stand in for letters
_MASK[[ord(c) for c in "@$*#%&+_"]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not (_LETTER[c] or _DIGIT[c])]] = True
_WORDISH = _LETTER | _DIGIT | _MASK


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Tokens of letters, digits and masking symbols in lower case, with their hashes and stems' hashes."""
    small = lower(data)
    starts, ends, counts = spans(_WORDISH[small], offsets)
    whole = range_hashes(small, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return small, starts, ends, counts, whole


def _stems(small: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(indices of tokens longer than ``width`` bytes, hashes of their first ``width`` bytes, apart from words' hashes)."""
    long = np.flatnonzero(ends - starts > width)
    return long, range_hashes(small, starts[long], starts[long] + width) ^ np.uint64(width) if len(long) else np.zeros(0, np.uint64)


class Lookup:
    """Membership of hashes in a small set: a 64k-bit filter before the exact search."""

    def __init__(self, members: np.ndarray):
        self.members = np.unique(np.asarray(members, np.uint64))
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.members & np.uint64(0xFFFF)).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = self.filter[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
        some = np.flatnonzero(out)
        if len(some) and len(self.members):
            at = np.minimum(np.searchsorted(self.members, hashes[some]), len(self.members) - 1)
            out[some] = self.members[at] == hashes[some]
        return out


def _sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def features(column: pa.Array, words: Lookup, stems: Lookup) -> np.ndarray:
    """One row of FEATURES for each text; a null or empty text is all zeros."""
    second = Lookup(range_hashes(*_packed(SECOND_PERSON.split())))
    out = np.zeros((len(column), len(FEATURES)))
    for i, j, data, offsets in passes(column):
        sizes = np.diff(offsets)
        small, starts, ends, counts, whole = _tokens(data, offsets)
        n, chars = np.maximum(counts, 1), np.maximum(sizes, 1)
        hit_word, hit_stem = words(whole), np.zeros(len(whole), bool)
        for width in STEM_BYTES:
            long, hashed = _stems(small, starts, ends, width)
            hit_stem[long] |= stems(hashed)
        you, hit = second(whole), hit_word | hit_stem
        running = np.concatenate(([0], np.cumsum(you)))
        index, of = np.arange(len(whole)), np.repeat(np.cumsum(counts) - counts, counts)
        stop = of + np.repeat(counts, counts)
        near = running[np.minimum(stop, index + 6)] > running[np.maximum(of, index - 5)]
        upper, letter = np.concatenate(([0], np.cumsum(_UPPER[data]))), np.concatenate(([0], np.cumsum(_LETTER[small])))
        other = np.concatenate(([0], np.cumsum(_DIGIT[small] | _MASK[small])))
        letters_in, others_in = letter[ends] - letter[starts], other[ends] - other[starts]
        shouted = (upper[ends] - upper[starts] == ends - starts) & (ends - starts > 2)
        same = np.zeros(len(small), bool)
        same[2:] = (small[2:] == small[1:-1]) & (small[2:] == small[:-2]) & _LETTER[small[2:]]
        span = lambda flags: _sum(flags, sizes)
        all_letters = np.maximum(letter[offsets[1:]] - letter[offsets[:-1]], 1)
        cols = (
            _sum(hit, counts) / n, _sum(hit_stem, counts) / n, np.log1p(_sum(hit, counts)), _sum(hit & near, counts) / n, _sum(you, counts) / n,
            (upper[offsets[1:]] - upper[offsets[:-1]]) / all_letters, _sum(shouted, counts) / n, span(data == 33) / chars, span(data == 63) / chars,
            span(_PUNCT[data]) / chars, _sum((letters_in > 0) & (others_in > 0), counts) / n, span(same) / chars, np.log1p(counts),
        )
        out[i:j] = np.stack(cols, axis=1)
    return out


def _packed(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    blobs = [w.encode() for w in words]
    ends = np.cumsum([len(b) for b in blobs])
    return np.frombuffer(b"".join(blobs), np.uint8), ends - [len(b) for b in blobs], ends


def term_counts(column: pa.Array, toxic: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For words (0) and stems of each width: the distinct hashes, and in how many (other, toxic) texts each is."""
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {kind: [] for kind in (0, *STEM_BYTES)}
    rows = np.arange(len(column))
    for i, j, data, offsets in passes(column):
        small, starts, ends, counts, whole = _tokens(data, offsets)
        doc = np.repeat(rows[i:j], counts)
        for kind, parts in found.items():
            of, terms = doc, whole
            if kind:
                long, terms = _stems(small, starts, ends, kind)
                of = doc[long]
            by = np.lexsort((terms, of))
            of, terms = of[by], terms[by]
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (terms[1:] != terms[:-1])
            parts.append((terms[new], toxic[of[new]].astype(np.int64)))
    return {kind: merge_counts([_count(*(np.concatenate(x) for x in zip(*parts)))] if parts else []) for kind, parts in found.items()}


def _count(terms: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, back = np.unique(terms, return_inverse=True)
    n_bad = np.bincount(back, bad, len(distinct)).astype(np.int64)
    return distinct, np.stack([np.bincount(back, minlength=len(distinct)) - n_bad, n_bad], axis=1)


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
    terms, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    out = np.zeros((len(terms), 2), np.int64)
    np.add.at(out, back, np.concatenate([p[1] for p in parts]))
    return terms, out


def choose_lexicon(counts: dict[int, tuple[np.ndarray, np.ndarray]], n_clean: int, n_toxic: int, evidence: float = 10.0, ratio: float = 6.0, least_share: float = 0.025) -> tuple[np.ndarray, np.ndarray]:
    """Words and stems that mark toxic texts.

    A term must be in ``least_share`` of toxic texts (which words that only copies of one text share
    are not), ``ratio`` times its share of others, and so often that chance (a binomial at the share of toxic texts, by its Chernoff bound) is less likely than
    exp(-``evidence``).
    """
    base = n_toxic / max(1, n_clean + n_toxic)
    found = []
    for terms, n in counts.values():
        total = n.sum(axis=1)
        q = n[:, 1] / np.maximum(total, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(q > 0, q * np.log(q / base), 0) + np.where(q < 1, (1 - q) * np.log((1 - q) / (1 - base)), 0)
        often = n[:, 1] / max(1, n_toxic) >= ratio * n[:, 0] / max(1, n_clean)
        common = n[:, 1] >= least_share * n_toxic
        found.append(terms[(q > base) & often & common & (total * gain >= evidence)])
    return found[0], np.concatenate(found[1:])


class Trees:
    """Histogram gradient boosting with logistic loss: depth-limited regression trees over quantile bins."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, least: float = 5.0):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = self._binned(x)
        p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base, self.trees = float(np.log(p / (1 - p))), []
        f = np.full(len(y), self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-f))
            grad, hess = y - q, np.maximum(q * (1 - q), 1e-6)
            tree: dict[int, tuple[int, int] | float] = {}
            node = np.ones(len(y), np.int64)
            for level in range(self.depth + 1):
                for k in range(1 << level, 2 << level):
                    inside = np.flatnonzero(node == k)
                    if not len(inside) and k != 1:
                        continue
                    best = self._split(binned[inside], grad[inside], hess[inside]) if level < self.depth else None
                    if best is None:
                        tree[k] = self.rate * float(grad[inside].sum() / (hess[inside].sum() + 1.0))
                        f[inside] += tree[k]
                        node[inside] = 0
                    else:
                        tree[k] = best
                        node[inside] = 2 * k + (binned[inside, best[0]] > best[1])
            self.trees.append(tree)
        return self

    def _split(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, int] | None:
        best, gain = None, 1e-6
        for j in range(b.shape[1]):
            gs, hs = np.cumsum(np.bincount(b[:, j], g, self.bins + 1)), np.cumsum(np.bincount(b[:, j], h, self.bins + 1))
            ok = (hs[:-1] > self.least / 20) & (hs[-1] - hs[:-1] > self.least / 20)
            gains = np.where(ok, gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1) - gs[-1] ** 2 / (hs[-1] + 1), 0)
            k = int(np.argmax(gains))
            if gains[k] > gain:
                best, gain = (j, k), gains[k]
        return best

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, col, "left") for c, col in zip(self.cuts, x.T)], axis=1) if len(x) else np.zeros((0, len(self.cuts)), np.int64)

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, out = self._binned(x), np.full(len(x), self.base)
        for tree in self.trees:
            todo = [(1, np.arange(len(x)))]
            while todo:
                k, inside = todo.pop()
                at = tree.get(k, 0.0)
                if isinstance(at, tuple):
                    right = b[inside, at[0]] > at[1]
                    todo += [(2 * k, inside[~right]), (2 * k + 1, inside[right])]
                else:
                    out[inside] += at
        return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (score, probability) of the nondecreasing fit, by block."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # weight, mean, lowest and highest score
    for s, v in zip(score[order], y[order]):
        blocks.append([1.0, float(v), s, s])
        while len(blocks) > 1 and (blocks[-2][1] >= blocks[-1][1] or blocks[-2][3] == blocks[-1][2]):
            w, m, _, hi = blocks.pop()
            b = blocks[-1]
            b[1], b[0], b[3] = (b[1] * b[0] + m * w) / (b[0] + w), b[0] + w, hi
    ends = [(x, (b[1] * b[0] + 0.5 * (0.02)) / (b[0] + 0.02)) for b in blocks for x in dict.fromkeys((b[2], b[3]))]
    return np.array([e[0] for e in ends]), np.array([e[1] for e in ends])


class ToxicityModel:
    """Lexicon, trees and calibration in one picklable object."""

    def fit(self, column: pa.Array, toxic: np.ndarray, folds: int = 5) -> "ToxicityModel":
        """Cross-fitted: a text's features come from a lexicon, and its score for calibration from trees,
        that were fitted without its fold. The final lexicon and trees then use all texts.

        Each fold needs a text of either class, so there are at most as many folds as the smaller class has texts.
        With under two texts of a class nothing tells the classes apart, and every text's probability is the
        share of toxic texts among the labelled ones, 0 without any.
        """
        toxic = np.asarray(toxic, bool)
        self.constant, folds = None, min(folds, int(toxic.sum()), int((~toxic).sum()))
        if folds < 2:
            self.constant = float(toxic.mean()) if len(toxic) else 0.0
            return self
        fold = np.empty(len(toxic), np.int64)
        for kind in (False, True):  # both classes in every fold
            fold[toxic == kind] = np.arange((toxic == kind).sum()) % folds
        parts = [column.take(pa.array(np.flatnonzero(fold == k))) for k in range(folds)]
        counts = [term_counts(parts[k], toxic[fold == k]) for k in range(folds)]

        def lexicon(keep: list[int]) -> tuple[Lookup, Lookup]:
            inside = np.isin(fold, keep)
            merged = {kind: merge_counts([counts[k][kind] for k in keep]) for kind in (0, *STEM_BYTES)}
            return tuple(map(Lookup, choose_lexicon(merged, int((inside & ~toxic).sum()), int((inside & toxic).sum()))))

        x, raw = np.zeros((len(toxic), len(FEATURES))), np.zeros(len(toxic))
        for k in range(folds):
            x[fold == k] = features(parts[k], *lexicon([f for f in range(folds) if f != k]))
        for k in range(folds):
            raw[fold == k] = Trees().fit(x[fold != k], toxic[fold != k].astype(float)).raw(x[fold == k])
        self.knots = isotonic(raw, toxic.astype(float))
        self.trees = Trees().fit(x, toxic.astype(float))
        self.words, self.stems = lexicon(list(range(folds)))
        return self

    def probability(self, column: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(column), self.constant)
        return np.interp(self.trees.raw(features(column, self.words, self.stems)), *self.knots)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 4000, seed: int = 8) -> ToxicityModel:
    """Fit on at most ``max_labelled`` labelled documents of each class, picked by a hash of doc_id.

    One task fits the model; the driver receives only the model. Labels of absent documents, null
    labels and null ids are ignored; of conflicting labels of one id the largest holds; equal texts count once. How few
    labels are treated is told by ``ToxicityModel.fit``. Capitals are those of ASCII.
    """
    spark = prepare(docs.sparkSession)
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = uniform(F.col("doc_id"), seed)
    # exact for any share of absent ids: absent ones are dropped before the bound applies
    present = marked.join(plain(docs, "doc_id").dropna(), "doc_id", "left_semi")
    chosen = None
    for kind in (0, 1):
        part = present.filter((F.col("toxic") > 0) == F.lit(bool(kind))).orderBy(order, "doc_id").limit(max_labelled)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = plain(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * max_labelled ids

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema([("text", pa.string()), ("toxic", pa.int32())]))
        texts = table.column("text").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        table = table.take(pa.array(np.sort(np.unique(texts, return_index=True)[1])))  # a copied text counts once
        model = ToxicityModel().fit(table.column("text").combine_chunks(), table.column("toxic").to_numpy() > 0)
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    one = rows.repartition(1).sortWithinPartitions(uniform(F.col("doc_id"), seed + 1), "doc_id").select("text", "toxic")
    found = one.mapInArrow(trimmed(fit), "model binary").collect()
    return pickle.loads(bytes(found[0][0])) if found else ToxicityModel().fit(pa.array([], pa.string()), np.zeros(0, bool))


def score(docs: DataFrame, model: ToxicityModel, column: str = "toxicity") -> DataFrame:
    """``docs`` with the calibrated probability of each text in ``column``.

    Null or empty text scores as a text without words; rows, ties and other columns stay as they
    are. A column that already has the name of ``column`` is replaced.
    """
    prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    @F.arrow_udf("double")
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ready = pickle.loads(held.value)
        for texts in batches:
            yield pa.array(ready.probability(texts), pa.float64())

    # as nondeterministic, so that a filter on the column is not worked out a second time below it
    return docs.withColumn(column, probability.asNondeterministic()(F.col("text").cast("string")))


def split(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) documents; a rejected one scores at least ``threshold``."""
    scored = score(docs, train(docs, labels))
    return scored.filter(F.col("toxicity") < threshold), scored.filter(F.col("toxicity") >= threshold)
