"""Toxicity by nearest labelled examples.

Exact TF-IDF cosine against a bounded sample of labelled texts, searched with a
block-max inverted index: postings are cut into blocks of examples, each with
the largest weight of every term, so a block whose upper bound is below the
k-th best similarity is never opened and the neighbours are still exact.
Similarity-weighted votes of the neighbours, corrected for the sample's class
balance, are calibrated by a monotone fit on the examples' own leave-one-out
votes. The neighbours are the evidence.

Terms are lower-case words and their first four and five bytes (inflected
languages share stems); those that say something about the class in the
sample (a G-test, which holds for terms seen in one class only) are the
vocabulary, counts and weights cover the whole text.

Defined results: a null or empty text, and any text without a term of the
vocabulary, has no neighbour and gets the calibrated share of toxic examples
among such texts; ties in similarity go to the example of smaller position;
repeated rows get equal scores; without labelled examples every score is 0.
Only the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.llm.common import stored
from procura.llm.textops import letter_words, slices, span_hashes, text_bytes, word_spans

#: Labelled examples per class that the model is fitted on: the bound of the sample.
EXAMPLES_PER_CLASS = 4000
#: Neighbours that vote.
NEIGHBOURS = 16
#: Examples per block of the index.
BLOCK = 64
#: A term enters the vocabulary if it is in so many examples, with a G-test of term and class of so many standard
#: errors, squared, and so many times likelier in one class than in the other.
MIN_EXAMPLES, MIN_Z, MIN_LIFT = 4, 4.5, 3.0
#: Bytes of the word starts that are terms as well.
STEMS = (4, 5)


def _terms(column) -> tuple[np.ndarray, np.ndarray]:
    """(text index, term hash) of every word and word start, in any order."""
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets, letter_words)
    text = np.repeat(np.arange(len(column)), np.diff(first))
    where, terms = [text], [span_hashes(data, starts, ends)]
    for n in STEMS:
        longer = ends - starts > n
        where.append(text[longer])
        terms.append(span_hashes(data, starts[longer], starts[longer] + n) ^ np.uint64(n))
    return np.concatenate(where), np.concatenate(terms)


class Model:
    """Vocabulary, TF-IDF weights, block-max index and calibration; small and bounded, made on the driver."""

    def __init__(self, vocabulary: np.ndarray, idf: np.ndarray):
        self.vocabulary, self.idf = vocabulary, idf
        self.prior = 0.0
        self.ids, self.knots = np.zeros(0, np.int64), (np.zeros(0), np.zeros(0))
        self.index([], np.zeros(0), self.ids, np.zeros(2))

    def vectors(self, column) -> list[tuple[np.ndarray, np.ndarray]]:
        """(vocabulary positions, unit weights) of every text."""
        where, terms = _terms(column)
        out = [(np.zeros(0, np.int64), np.zeros(0))] * len(column)
        if not len(self.vocabulary) or not len(terms):
            return out
        at = np.searchsorted(self.vocabulary, terms)
        at[at == len(self.vocabulary)] = 0
        hit = self.vocabulary[at] == terms
        pairs, counts = np.unique(where[hit] * len(self.vocabulary) + at[hit], return_counts=True)
        text, term = np.divmod(pairs, len(self.vocabulary))
        weight = (1 + np.log(counts)) * self.idf[term]
        for i, a, b in _runs(text):
            out[i] = (term[a:b], weight[a:b] / np.sqrt(np.sum(weight[a:b] ** 2)))
        return out

    def index(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: np.ndarray, class_weight: np.ndarray) -> list[int]:
        """Build the block-max inverted index of the examples that have terms, alike examples side by side.

        Returns the examples' order in the index.
        """
        full = [i for i, (t, _) in enumerate(vectors) if len(t)]
        full.sort(key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), tuple(vectors[i][0].tolist()), i))
        self.labels, self.ids = labels[full].astype(float), ids[full]
        self.class_weight = class_weight[labels[full].astype(int)]
        blank = np.array([len(t) == 0 for t, _ in vectors])
        share = class_weight[labels.astype(int)]
        self.prior = float((share * labels)[blank].sum() / share[blank].sum()) if blank.any() else 0.0
        blocks = max(1, -(-len(full) // BLOCK))
        self.block_max = np.zeros((len(self.vocabulary), blocks))
        postings: list[list[tuple[int, float]]] = [[] for _ in range(len(self.vocabulary))]
        for at, i in enumerate(full):
            for t, w in zip(*vectors[i], strict=True):
                postings[t].append((at, w))
                self.block_max[t, at // BLOCK] = max(self.block_max[t, at // BLOCK], w)
        self.posting_at = np.zeros(len(postings) + 1, np.int64)
        np.cumsum([len(p) for p in postings], out=self.posting_at[1:])
        flat = [x for p in postings for x in p]
        self.posting_example = np.array([x[0] for x in flat], np.int64)
        self.posting_weight = np.array([x[1] for x in flat])
        return full

    def nearest(self, terms: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(positions, cosines) of the exact nearest examples of positive similarity, best first.

        ``without`` leaves one example out. Blocks are opened by falling upper
        bound until the bound is below the worst of the neighbours held.
        """
        bounds = weights @ self.block_max[terms]
        best_at, best = np.zeros(0, np.int64), np.zeros(0)
        lists = [slice(self.posting_at[t], self.posting_at[t + 1]) for t in terms]
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or (len(best) == NEIGHBOURS and bounds[block] < best[-1] - 1e-12):
                break
            low = block * BLOCK
            got = np.zeros(BLOCK)
            for part, w in zip(lists, weights, strict=True):
                examples = self.posting_example[part]
                a, b = np.searchsorted(examples, (low, low + BLOCK))
                got[examples[a:b] - low] += w * self.posting_weight[part][a:b]
            if low <= without < low + BLOCK:
                got[without - low] = 0
            hit = np.flatnonzero(got > 0)
            best_at, best = np.concatenate([best_at, low + hit]), np.concatenate([best, got[hit]])
            order = np.lexsort((best_at, -best))[:NEIGHBOURS]
            best_at, best = best_at[order], best[order]
        return best_at, best

    def vote(self, at: np.ndarray, cosine: np.ndarray) -> float:
        share = cosine * self.class_weight[at]
        return float(share @ self.labels[at] / share.sum())

    def calibrate(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Monotone fit (pool adjacent violators) of labels on leave-one-out votes of the examples."""
        votes, truth, weight = [], [], []
        for i, v in enumerate(vectors):
            at, cosine = self.nearest(*v, without=i)
            if len(at):
                votes.append(self.vote(at, cosine))
                truth.append(self.labels[i])
                weight.append(self.class_weight[i])
        pools: list[list[float]] = []
        for i in np.argsort(votes, kind="stable"):
            pools.append([truth[i] * weight[i], weight[i], votes[i], votes[i]])
            while len(pools) > 1 and (pools[-1][2] == pools[-2][3] or pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]):
                s, w, _, high = pools.pop()
                pools[-1][0] += s
                pools[-1][1] += w
                pools[-1][3] = high
        self.knots = np.array([(p[2] + p[3]) / 2 for p in pools]), np.array([p[0] / p[1] for p in pools])

    def score(self, terms: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(calibrated score, neighbours' ids, cosines)."""
        if not len(terms):
            return self.prior, np.zeros(0, np.int64), np.zeros(0)
        at, cosine = self.nearest(terms, weights)
        if not len(at):
            return self.prior, np.zeros(0, np.int64), np.zeros(0)
        vote = self.vote(at, cosine)
        fitted = float(np.interp(vote, *self.knots)) if len(self.knots[0]) else vote
        return min(1.0, max(0.0, fitted)), self.ids[at], cosine


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    edges = np.flatnonzero(np.diff(values)) + 1
    for a, b in zip([0, *edges], [*edges, len(values)], strict=True):
        if b > a:
            yield int(values[a]), int(a), int(b)


def fit(docs: DataFrame, labels: DataFrame, key: str, text: Column, label: str, eligible: Column) -> Model:
    """Fit on at most ``EXAMPLES_PER_CLASS`` labelled texts a class, those of least key hash.

    The sample's keys are a top-n per class, so the join that fetches the
    texts has a side of proven size (broadcast); a key of several texts gives
    one. A key labelled twice is toxic if any of its labels is. The class balance comes from all eligible labels.
    """
    known = labels.where(eligible & F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).alias("label"))
    totals = {int(r[0]): r[1] for r in known.groupBy("label").count().collect()}
    parts = [known.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(EXAMPLES_PER_CLASS) for c in (0, 1)]
    sample = F.broadcast(parts[0].unionByName(parts[1]))
    rows = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text")).join(sample, "id").select("id", F.col("label").cast("int").alias("label"), "text")
    # one text a key, that of least hash: partial minima, however many rows share the key
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    rows = stored(rows.groupBy("id", "label").agg(one.alias("one")).select("id", "label", "one.text"), "toxicity-examples")
    per_class = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    n = [per_class.get(c, 0) for c in (0, 1)]
    counts = rows.select("label", "text").mapInArrow(_document_counts, "term long, label int, n long")
    table = counts.groupBy("term").agg(*[F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)])
    table = table.where(F.col("n0") + F.col("n1") >= MIN_EXAMPLES)
    p0, p1 = [(F.col(f"n{c}") + 0.5) / (n[c] + 1.0) for c in (0, 1)]
    lift = F.greatest(p1 / p0, p0 / p1)
    chosen = table.where((_g_test(F.col("n0"), F.col("n1"), *n) >= MIN_Z**2) & (lift >= MIN_LIFT)).select("term", (F.col("n0") + F.col("n1")).alias("df"))
    # bounded by the sample: the terms of at most 2 x EXAMPLES_PER_CLASS texts that pass the tests above
    terms = sorted((int(r[0]) & _ALL, r[1]) for r in chosen.collect())
    model = Model(np.array([t for t, _ in terms], np.uint64), np.log1p(sum(n) / np.array([d for _, d in terms], float)))
    vectors = rows.mapInArrow(_vectors_with(model), "id long, label int, at array<long>, weight array<double>")
    found = sorted((r["id"], r["label"], r["at"], r["weight"]) for r in vectors.collect())
    if not found:
        return model
    shares = np.array([totals.get(c, 0) / n[c] if n[c] else 0.0 for c in (0, 1)])
    made = [(np.array(a, np.int64), np.array(w)) for _, _, a, w in found]
    order = model.index(made, np.array([f[1] for f in found]), np.array([f[0] for f in found], np.int64), shares)
    model.calibrate([made[i] for i in order])
    return model


def _g_test(a: Column, b: Column, all_a: int, all_b: int) -> Column:
    """G of a term in ``a`` of ``all_a`` texts of one class and ``b`` of ``all_b`` of the other; a count of 0 adds nothing."""

    def x(c: Column) -> Column:
        return F.when(c > 0, c * F.log(c)).otherwise(0.0)

    one, other = F.lit(all_a), F.lit(all_b)
    return 2 * (x(a) + x(b) + x(one - a) + x(other - b) + x(one + other) - x(a + b) - x(one + other - a - b) - x(one) - x(other))


_ALL = (1 << 64) - 1


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, label, texts that have it) of each run of rows."""
    for batch in batches:
        for i, n in slices(batch.column(1)):
            part = batch.slice(i, n)
            labels = np.asarray(part.column(0).to_numpy(zero_copy_only=False), np.int64)
            where, terms = _terms(part.column(1))
            order = np.lexsort((terms, where))
            where, terms = where[order], terms[order]
            new = np.ones(len(terms), bool)
            new[1:] = (terms[1:] != terms[:-1]) | (where[1:] != where[:-1])
            where, terms = where[new], terms[new]
            for label in (0, 1):
                found, counts = np.unique(terms[labels[where] == label], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.full(len(found), label, np.int32)), pa.array(counts.astype(np.int64))], names=["term", "label", "n"])


def _vectors_with(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, n in slices(batch.column(2)):
                part = batch.slice(i, n)
                made = model.vectors(part.column(2))
                at = pa.array([m[0] for m in made], pa.list_(pa.int64()))
                weight = pa.array([m[1] for m in made], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(1), at, weight], names=["id", "label", "at", "weight"])

    return run


SCHEMA = "score double, evidence array<struct<id: bigint, cosine: double>>"
_EVIDENCE = pa.list_(pa.struct([("id", pa.int64()), ("cosine", pa.float64())]))
#: Neighbours named as evidence.
SHOWN = 3


def score(df: DataFrame, text: Column | str, model: Model) -> DataFrame:
    """``df`` with its toxicity ``score`` (0 to 1) and the nearest examples as ``evidence``: a narrow map.

    Columns of those names in ``df`` are replaced. ``text`` as the name of a
    column of ``df`` sends every text to Python once, an expression beside the
    columns of ``df``. A null text scores as an empty one.
    """
    df = df.drop("score", "evidence")
    held = df.sparkSession.sparkContext.broadcast(model)  # bounded by EXAMPLES_PER_CLASS
    names = df.columns
    fields = "".join(f"`{c}` {t}, " for c, t in df.dtypes)
    named = isinstance(text, str)
    at = names.index(text) if named else len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = held.value
        for batch in batches:
            for i, n in slices(batch.column(at)):
                part = batch.slice(i, n)
                found = [fitted.score(*v) for v in fitted.vectors(part.column(at))]
                shown = [[{"id": int(e), "cosine": float(c)} for e, c in zip(ids[:SHOWN], cosine[:SHOWN], strict=True)] for _, ids, cosine in found]
                made = [pa.array([f[0] for f in found], pa.float64()), pa.array(shown, _EVIDENCE)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], *made], names=[*names, "score", "evidence"])

    source = df if named else df.select(*names, F.coalesce(text, F.lit("")).alias("__text"))
    return source.mapInArrow(run, fields + SCHEMA)
