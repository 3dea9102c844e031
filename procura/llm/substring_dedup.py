"""Substring deduplication by sliding sentence spans.

Every text is cut into sentences; from each sentence on, the run of at least
``SPAN_SENTENCES`` sentences and ``SPAN_WORDS`` words is hashed by its words.
The hashes of all documents are joined globally: the first document (least
id) with a span keeps it, every other one loses all sentences that a repeated
span covers. Within a document only the first of equal spans stays.

Sentences end at ``.``, ``!`` or ``?`` before white space and at line ends.
A sentence of more than ``LONG_SENTENCE`` words is cut further after words
chosen by their hash, so that equal passages are cut alike wherever they
begin.

Per span one (hash, id) pair is shuffled, with partial counts and minima
before; hot spans are split by the join. Texts meet their own lists of
repeated spans once.

Defined results: null and empty texts stay as they are; ids that are null or
equal count as one document for who is first (a span they share stays in all
of them, unless another document has it first; null ids come last); a text
that loses every sentence is empty, no row is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.llm.common import stored
from procura.llm.textops import mix, slices, space_words, span_hashes, text_bytes, word_spans

#: A span has at least so many sentences and words; longer sentences than LONG_SENTENCE words are cut
#: after one word in CUT_ONE_IN on average.
SPAN_SENTENCES, SPAN_WORDS = 2, 16
LONG_SENTENCE, CUT_ONE_IN = 24, 8


class Sentences:
    """Sentences and span hashes of the texts of an Arrow column."""

    def __init__(self, column):
        self.data, self.offsets = text_bytes(column)
        starts, ends, first = word_spans(self.data, self.offsets, space_words)
        words = span_hashes(self.data, starts, ends)
        n = len(words)
        text = np.repeat(np.arange(len(column)), np.diff(first))
        closing = np.isin(self.data[ends - 1], np.frombuffer(b".!?", np.uint8)) if n else np.zeros(0, bool)
        if n:
            lines = np.zeros(len(self.data) + 1, np.int64)
            np.cumsum(self.data == 0x0A, out=lines[1:])
            following = np.append(starts[1:], len(self.data))
            closing |= lines[following] > lines[ends]
            closing[first[1:][first[1:] > first[:-1]] - 1] = True
        opening = np.ones(n, bool)
        opening[1:] = closing[:-1]
        sentence = np.cumsum(opening) - 1
        length = np.bincount(sentence, minlength=0)
        cut = (length[sentence] > LONG_SENTENCE) & (mix(words) % np.uint64(CUT_ONE_IN) == 0) if n else closing
        closing |= cut
        opening[1:] = closing[:-1]
        #: First word of every sentence, and first sentence of every text.
        self.word_at = np.append(np.flatnonzero(opening), n)
        self.first = np.searchsorted(self.word_at[:-1], first)
        self.words, self.starts, self.text = words, starts, text[self.word_at[:-1]]
        self._spans()

    def _spans(self) -> None:
        """Per sentence: hash of the span that starts there and the sentence after its end (none: 0 and itself)."""
        n = len(self.word_at) - 1
        at = np.arange(n)
        # a span ends with the first sentence that gives it enough words and sentences
        enough = np.searchsorted(self.word_at, self.word_at[:-1] + SPAN_WORDS, "left")
        end = np.maximum(enough, at + SPAN_SENTENCES)
        fits = end <= self.first[self.text + 1]
        end = np.where(fits, end, at)
        a, b = self.word_at[at], self.word_at[end]
        # words of a span are hashed by a polynomial prefix sum, modulo 2**64
        power, inverse = _powers(len(self.words) + 1)
        sums = np.zeros(len(self.words) + 1, np.uint64)
        np.cumsum(self.words * power[: len(self.words)], out=sums[1:])
        self.hash = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        self.end, self.fits = end, fits

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of the distinct spans of every text."""
        at = np.flatnonzero(self.fits)
        order = at[np.lexsort((self.hash[at], self.text[at]))]
        text, own = self.text[order], self.hash[order]
        new = np.ones(len(order), bool)
        new[1:] = (text[1:] != text[:-1]) | (own[1:] != own[:-1])
        return text[new], own[new]

    def kept(self, t: int, repeated: np.ndarray) -> tuple[bytes, int, int]:
        """(text without the covered sentences, sentences, removed) of text ``t``; ``repeated`` is sorted."""
        low, high = int(self.first[t]), int(self.first[t + 1])
        begin, stop = int(self.offsets[t]), int(self.offsets[t + 1])
        at = low + np.flatnonzero(self.fits[low:high])
        own = self.hash[at]
        order = np.argsort(own, kind="stable")
        again = np.zeros(len(at), bool)
        again[order[1:]] = own[order[1:]] == own[order[:-1]]  # not the first in this text
        if len(repeated) and len(at):
            place = np.minimum(np.searchsorted(repeated, own), len(repeated) - 1)
            again |= repeated[place] == own
        cover = np.zeros(high - low + 1, np.int64)
        np.add.at(cover, at[again] - low, 1)
        np.add.at(cover, self.end[at[again]] - low, -1)
        gone = np.cumsum(cover[:-1]) > 0
        if not gone.any():
            return self.data[begin:stop].tobytes(), high - low, 0
        edges = self.starts[self.word_at[low:high]].tolist()
        edges[0] = begin
        edges.append(stop)
        parts = [self.data[edges[i] : edges[i + 1]].tobytes() for i in np.flatnonzero(~gone)]
        return b"".join(parts).rstrip(b" \t\r\n"), high - low, int(gone.sum())


_BASE = 0xF1357AEA2E62A9C5
_held: tuple[np.ndarray, np.ndarray] = (np.ones(0, np.uint64), np.ones(0, np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the span hash's base and of its inverse modulo 2**64."""
    global _held
    if len(_held[0]) < n:
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(max(n, 1 << 20), base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        _held = (made[0], made[1])
    return _held


def spans_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """(hash, id): the distinct spans of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, n in slices(batch.column(1)):
                part = batch.slice(i, n)
                where, own = Sentences(part.column(1)).distinct()
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), part.column(0).take(pa.array(where))], names=["hash", "id"])

    source = df.select(df[key].cast("bigint").alias("id"), df[text].alias("text"))
    return source.mapInArrow(run, "hash long, id long")


def repeated_spans(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, hashes): the spans that each document has but another one had first, packed and sorted."""
    spans = spans_of(df, key, text)
    first = spans.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1 and first is not null").select("hash", "first")
    later = spans.join(first, "hash").where(~F.col("id").eqNullSafe(F.col("first"))).select("id", "hash")
    return later.groupBy("id").agg(F.collect_set("hash").alias("hashes"))


_NEW = ("text", "n_sentences", "n_removed")


def remove_repeats(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` with its ``text`` column cleaned, and ``n_sentences`` and ``n_removed`` per row.

    Columns of the latter names in ``df`` are replaced.
    """
    df = df.drop("n_sentences", "n_removed")
    repeated = stored(repeated_spans(df, key, text), "substring-repeats").withColumnRenamed("id", "__id")
    others = [c for c in df.columns if c != text]
    joined = df.join(repeated, df[key].cast("bigint").eqNullSafe(F.col("__id")), "left").select(df[text].alias("__text"), F.col("hashes").alias("__hashes"), *[df[c] for c in others])
    fields = "".join(f"`{c}` {t}, " for c, t in df.select(*others).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for batch in batches:
            for i, n in slices(batch.column(0)):
                part = batch.slice(i, n)
                sentences, lists = Sentences(part.column(0)), part.column(1)
                made = []
                for t in range(n):
                    known = np.sort(lists[t].values.to_numpy(zero_copy_only=False).view(np.uint64)) if lists[t].is_valid else none
                    made.append(sentences.kept(t, known))
                valid = part.column(0).is_valid().to_pylist()
                texts = pa.array([m[0].decode() if ok else None for m, ok in zip(made, valid, strict=True)], pa.string())
                counts = [pa.array([m[k] for m in made], pa.int32()) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays([*part.columns[2:], texts, *counts], names=[*others, "__new", "n_sentences", "n_removed"])

    out = joined.mapInArrow(run, f"{fields}`__new` string, n_sentences int, n_removed int").withColumnRenamed("__new", text)
    return out.select(*df.columns, "n_sentences", "n_removed")
