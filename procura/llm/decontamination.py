"""Benchmark decontamination by SimHash windows.

For every item a window of at most a third of its words slides over the texts
in steps, and the item itself has a window at each of its words. Windows are
compared by 64-bit SimHash of their words: a multi-index over four 16-bit
blocks holds every fingerprint, and all values within two bits of a window's
block are looked up, so that each fingerprint within ``RADIUS`` =
4 * (2 + 1) - 1 bits is found (it has at most two wrong bits in some block). A
window that agrees tells the item and where its copy would start; a copy
edited in one place has whole windows before it or behind it, and few
scattered edits leave windows that differ by fewer bits than the radius.

Candidates are verified exactly: of the item's five-word shingles, weighted by
how rare they are among all items, the passage of the item's size must hold a
weight share of ``SIMILARITY``. Windows that tell starts a few words apart
(words were put in or left out between them) have every start between
verified. Before it is fingerprinted, a window must have as many of the items'
shingles around it as any item of its size needs for that share, which leaves
out no passage that could match.

Words are runs of letters, digits and non-ASCII characters, ASCII case folded.
The items are the stated query set: they are taken in blocks of bounded items
and words, whose index is broadcast, and each block passes over the texts as a
narrow map, so nothing is shuffled and a passage that a third of all documents
share costs no more than any other. Rarity is counted over the items of all
blocks, so the result does not depend on how they are cut.

Defined results: null and empty texts and items, and items without words,
match nothing; an item of fewer than five words has one shingle, its whole
sequence, and matches wherever its words follow each other, however long the
text; equal items each match; every row of a repeated document is judged by
itself; ids may be null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from procura.llm.common import stored
from procura.llm.textops import letter_words, mix, shingles_of, slices, words_of

SHINGLE = 5
SIMILARITY = 0.8
#: What sums of weights may be off by: a share of just ``SIMILARITY`` matches.
ROUNDING = 1e-9
BLOCK_BITS, BLOCKS = 16, 4
BITS_OFF = 2
RADIUS = BLOCKS * (BITS_OFF + 1) - 1
#: Most items of a block, and most words: its index takes about 150 bytes a word. A longer item is a block of its own.
ITEMS_PER_BLOCK, WORDS_PER_BLOCK = 1024, 1 << 18
#: Window sizes grow by this ratio; texts are sampled at a step of a fifteenth of the shortest item of a size.
SIZE_RATIO, STEPS = 1.5, 15
#: Words of a text whose bit counts are held at a time, and windows that are looked up at a time.
HELD_WORDS, HELD_WINDOWS = 1 << 11, 1 << 12
#: Starts of an item's passages at most this share of the item apart have those between them verified.
GAP = 0.25

_SIGN_BYTES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int16) * 2 - 1


def _signs(words: np.ndarray) -> np.ndarray:
    """(words, 64) of +1 and -1: the bits of every word's hash."""
    return _SIGN_BYTES[mix(words).astype("<u8").view(np.uint8)].reshape(len(words), 64)


_ROWS = 128


def _sums(words: np.ndarray) -> np.ndarray:
    """Running sums of the signs, with a leading row of zeros: inside blocks of rows side by side, then over the blocks."""
    blocks = -(-len(words) // _ROWS)
    kind = np.int16 if len(words) < 1 << 15 else np.int32
    part = np.zeros((blocks * _ROWS, 64), kind)
    part[: len(words)] = _signs(words)
    part = part.reshape(blocks, _ROWS, 64)
    for i in range(1, _ROWS):
        part[:, i] += part[:, i - 1]
    part[1:] += np.cumsum(part[:-1, -1], axis=0, dtype=kind)[:, None]
    out = np.zeros((len(words) + 1, 64), kind)
    out[1:] = part.reshape(-1, 64)[: len(words)]
    return out


def _pack(counts: np.ndarray) -> np.ndarray:
    return np.packbits(counts > 0, axis=1, bitorder="little").view("<u8").ravel()


def window_size(n: int) -> int:
    """The largest window of the grid 1, 2, 3, 4, 6, 9, ... of at most a third of n words."""
    size = 1
    while (following := max(size + 1, int(size * SIZE_RATIO))) * 3 <= n:
        size = following
    return size


#: What differs from a 16-bit value by at most BITS_OFF bits, as masks.
_BIT = 1 << np.arange(BLOCK_BITS)
_NEAR = np.unique(np.concatenate([[0], _BIT, (_BIT[:, None] | _BIT[None, :]).ravel()]))


def _table(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per block of bits: where each value's fingerprints start, and the fingerprints by value."""
    out = []
    for b in range(BLOCKS):
        values = (prints >> np.uint64(BLOCK_BITS * b)).astype(np.int64) & 0xFFFF
        order = np.argsort(values, kind="stable").astype(np.int32)
        out.append((np.searchsorted(values[order], np.arange((1 << BLOCK_BITS) + 1)).astype(np.int32), order))
    return out


class ItemIndex:
    """The windows of a block of items, by window size, and the items' weighted shingles.

    ``items`` are (id, text), or (id, text, holders): how many items hold each
    of its distinct shingles, in the order of their hashes. Without holders,
    and without ``total``, the block is all items.
    """

    def __init__(self, items: list[tuple], total: int | None = None):
        self.ids = [i[0] for i in items]
        words, first = words_of(pa.array([i[1] or "" for i in items], pa.string()), letter_words)
        shingles, at = shingles_of(words, first, SHINGLE)
        self.sizes = np.diff(first)
        own = [np.unique(shingles[a:b], return_counts=True) for a, b in zip(at[:-1], at[1:], strict=True)]
        if total is None:
            every, n = np.unique(np.concatenate([u for u, _ in own]) if own else np.zeros(0, np.uint64), return_counts=True)
            holders, total = [n[np.searchsorted(every, u)] for u, _ in own], len(items)
        else:
            holders = [np.asarray(i[2], np.int64) for i in items]
        #: Per item: its distinct shingles, how often it has each, and their weights.
        self.shingles = [(u, c, np.log1p(total / n)) for (u, c), n in zip(own, holders, strict=True)]
        long = np.flatnonzero(self.sizes >= SHINGLE)
        self.every = np.unique(np.concatenate([np.zeros(0, np.uint64), *[own[i][0] for i in long]]))
        #: Per number of words under SHINGLE: the sorted sequences of such items, and the items.
        self.short = []
        for k in range(1, SHINGLE):
            some = np.flatnonzero(self.sizes == k)
            if len(some):
                order = some[np.argsort(shingles[at[some]], kind="stable")]
                self.short.append((k, shingles[at[order]], order))
        groups: dict[int, list[int]] = {}
        for i in long.tolist():
            groups.setdefault(window_size(int(self.sizes[i])), []).append(i)
        self.groups = []
        for size, members in sorted(groups.items()):
            step = max(1, int(min(self.sizes[members])) // STEPS)
            needs = min(self._needs(i) for i in members)
            offsets = [np.arange(self.sizes[i] - size + 1) for i in members]
            prints = np.concatenate([self._prints(words[first[i] : first[i + 1]], size) for i in members])
            entries = np.repeat(np.array(members), [len(o) for o in offsets])
            self.groups.append((size, step, needs, int(max(self.sizes[members])), prints, entries, np.concatenate(offsets), _table(prints)))

    @staticmethod
    def _prints(words: np.ndarray, size: int) -> np.ndarray:
        """Fingerprints of all windows of an item."""
        out, held = [], max(HELD_WORDS, size)
        for low in range(0, len(words) - size + 1, held):
            sums = _sums(words[low : low + held + size - 1])
            out.append(_pack(sums[size:] - sums[:-size]))
        return np.concatenate(out)

    def _needs(self, item: int) -> int:
        """The fewest shingles of an item that can hold the share."""
        _, counts, weight = self.shingles[item]
        held = np.cumsum(np.sort(np.repeat(weight, counts))[::-1])
        return int(np.searchsorted(held, (SIMILARITY - 2 * ROUNDING) * held[-1])) + 1

    def similarity(self, item: int, passage: np.ndarray) -> float:
        """Share of the item's shingle weight, with multiplicity, that the passage's shingles hold."""
        own, counts, weight = self.shingles[item]
        got, found = np.unique(passage, return_counts=True)
        at = np.minimum(np.searchsorted(got, own), max(len(got) - 1, 0))
        there = np.where(got[at] == own, found[at], 0) if len(got) else np.zeros(len(own))
        return float((np.minimum(there, counts) * weight).sum() / (counts * weight).sum())

    def matches(self, words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, float, int]]:
        """(text, item, best similarity, word where the passage starts) of every text and item that match."""
        best: dict[tuple[int, int], tuple[float, int]] = {}
        n_words = np.diff(first)
        for k, sequences, items in self.short:
            runs, at = shingles_of(words, first, k)
            low, high = (np.searchsorted(sequences, runs, side=x) for x in ("left", "right"))
            for p in np.flatnonzero(high > low).tolist():
                t = int(np.searchsorted(at, p, side="right")) - 1
                for i in items[low[p] : high[p]].tolist():
                    best.setdefault((t, i), (1.0, p - int(at[t])))
        shingles, at = shingles_of(words, first, SHINGLE)
        found: dict[tuple[int, int], set[int]] = {}
        for text, start, item, offset in self._candidates(words, first, shingles, at):
            last = np.maximum(n_words[text] - self.sizes[item], 0)
            begins = np.clip(start - first[text] - offset, 0, last)
            for t, i, a in zip(text.tolist(), item.tolist(), begins.tolist(), strict=True):
                found.setdefault((t, i), set()).add(a)
        for (t, i), begins in found.items():
            score, word = self._best(i, sorted(begins), shingles[at[t] : at[t + 1]])
            if score >= SIMILARITY - ROUNDING:
                best[t, i] = score, word
        return [(t, i, score, word) for (t, i), (score, word) in sorted(best.items())]

    def _best(self, item: int, begins: list[int], shingles: np.ndarray) -> tuple[float, int]:
        """(similarity, start) of the best passage of a text, the first of several, at the given starts and inside small gaps between them."""
        size, top, before = int(self.sizes[item]), (-1.0, 0), None
        for a in begins:
            near = before is not None and a - before <= max(1, int(GAP * size))
            for word in range(before + 1 if near else a, a + 1):
                score = self.similarity(item, shingles[word : word + size - SHINGLE + 1])
                if score > top[0]:
                    top = score, word
            if top[0] >= 1:
                break
            before = a
        return top

    def _candidates(self, words: np.ndarray, first: np.ndarray, shingles: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(texts, windows' first words, items, windows' offsets in the items) of the windows within RADIUS."""
        if not len(self.every) or not len(shingles):
            return
        place = np.minimum(np.searchsorted(self.every, shingles), len(self.every) - 1)
        known = np.zeros(len(shingles) + 1, np.int64)
        np.cumsum(self.every[place] == shingles, out=known[1:])
        n_words = np.diff(first)
        for size, step, needs, longest, prints, item, offset, table in self.groups:
            counts = np.where(n_words >= size, (n_words - size) // step + 1, 0)
            text = np.repeat(np.arange(len(counts)), counts)
            word = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * step
            # the shingles of every passage of at most the longest size that holds the window
            low = at[text] + np.maximum(word - (longest - size), 0)
            high = np.minimum(at[text] + np.maximum(word + longest - SHINGLE + 1, 1), at[text + 1])
            some = np.flatnonzero(known[np.maximum(high, low)] - known[np.minimum(low, high)] >= needs)
            text, starts = text[some], first[text[some]] + word[some]
            i = 0
            while i < len(starts):
                j = min(int(np.searchsorted(starts, starts[i] + max(HELD_WORDS, size))), i + HELD_WINDOWS)
                sums = _sums(words[starts[i] : starts[j - 1] + size])
                own = starts[i:j] - starts[i]
                for window, entry in self._look_up(_pack(sums[own + size] - sums[own]), prints, table):
                    yield text[i + window], starts[i + window], item[entry], offset[entry]
                i = j

    @staticmethod
    def _look_up(found: np.ndarray, prints: np.ndarray, table: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(windows, entries) within RADIUS of each other, by one block after the other."""
        for b, (bucket, entries) in enumerate(table):
            values = (found >> np.uint64(BLOCK_BITS * b)).astype(np.int64) & 0xFFFF
            for low in range(0, len(found), 256):
                near = (values[low : low + 256, None] ^ _NEAR).ravel()
                a, n = bucket[near], bucket[near + 1] - bucket[near]
                some = np.flatnonzero(n)
                n = n[some]
                window = low + np.repeat(some // len(_NEAR), n)
                entry = entries[np.repeat(a[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                close = np.bitwise_count(found[window] ^ prints[entry]) <= RADIUS
                yield window[close], entry[close]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, words, shingles): each item's words, and its distinct shingles in order of their hashes."""
    for batch in batches:
        words, first = words_of(batch.column(1), letter_words)
        shingles, at = shingles_of(words, first, SHINGLE)
        own = [pa.array(np.unique(shingles[a:b]).view(np.int64)) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(first), pa.int64()), pa.array([o.to_pylist() for o in own], pa.list_(pa.int64()))], names=["n", "words", "shingles"])


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[ItemIndex]:
    """The index of the items' blocks, one after the other: at most ITEMS_PER_BLOCK items and WORDS_PER_BLOCK words, or one longer item, are on the driver."""
    numbered = items.select(items[key].alias("id"), items[text].alias("text")).where("text is not null")
    numbered = stored(numbered.withColumn("n", F.monotonically_increasing_id()), "benchmark-items")
    counted = stored(numbered.select("n", "text").mapInArrow(_counted, "n long, words long, shingles array<long>"), "benchmark-words")
    total, words = counted.agg(F.count("n"), F.coalesce(F.sum("words"), F.lit(0))).first()
    if not total:
        return
    if total <= ITEMS_PER_BLOCK and words <= WORDS_PER_BLOCK:
        yield ItemIndex([tuple(r) for r in numbered.select("id", "text").orderBy("id", "text").collect()])
        return
    # blocks inside parts, so that no task numbers all items; a hash of the row number spreads them evenly
    parts = max(-(-total // ITEMS_PER_BLOCK), -(-words // WORDS_PER_BLOCK))
    order = Window.partitionBy("part").orderBy("n")
    placed = counted.select("n", "words", F.pmod(F.xxhash64("n"), F.lit(parts)).alias("part"))
    placed = placed.withColumn("row", F.row_number().over(order)).withColumn("before", F.sum("words").over(order) - F.col("words"))
    placed = placed.select("n", "part", F.floor((F.col("row") - 1) / ITEMS_PER_BLOCK).alias("nth"), F.floor(F.col("before") / WORDS_PER_BLOCK).alias("filled"))
    each = counted.select("n", F.explode("shingles").alias("shingle"))
    holders = each.join(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")), "shingle")
    # an item's list is as long as its text; in unsigned order, as the index has its hashes
    unsigned = F.struct((F.col("shingle") < 0).alias("high"), "shingle", "holders")
    held = holders.groupBy("n").agg(F.array_sort(F.collect_list(unsigned))["holders"].alias("holders"))
    whole = stored(numbered.join(placed, "n").join(held, "n", "left").select("part", "nth", "filled", "id", "text", F.coalesce("holders", F.array().cast("array<long>")).alias("holders")), "benchmark-blocks")
    blocks = whole.select("part", "nth", "filled").distinct().orderBy("part", "nth", "filled").collect()  # a row per pass over the texts
    for b in blocks:
        same = (F.col("part") == b["part"]) & (F.col("nth") == b["nth"]) & (F.col("filled") == b["filled"])
        yield ItemIndex([tuple(r) for r in whole.where(same).select("id", "text", "holders").collect()], total)


def _batches(batches: Iterator[pa.RecordBatch], index: ItemIndex, at: int = 0):
    """(part, its matches) of every run of rows; column ``at`` holds the texts."""
    for batch in batches:
        for i, n in slices(batch.column(at), 1 << 20):
            part = batch.slice(i, n)
            yield part, index.matches(*words_of(part.column(at), letter_words))


def contaminated_pairs(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """(``key``, ``item_key``, similarity, start_word): every document and item that match."""
    spark = docs.sparkSession
    source = docs.select(docs[text].alias("text"), docs[key].alias("key"))
    kinds = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"key {kinds[0]}, item {kinds[1]}, similarity double, start_word long"
    out = None
    for block in item_blocks(items, item_key, item_text):
        held = spark.sparkContext.broadcast(block)  # bounded by ITEMS_PER_BLOCK and WORDS_PER_BLOCK

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held.value
            for part, found in _batches(batches, index):
                keys = part.column(1).take(pa.array([f[0] for f in found], pa.int64()))
                ids = pa.array([index.ids[f[1]] for f in found])
                made = [ids if found else pa.array([], pa.int64()), pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int64())]
                if found:
                    yield pa.RecordBatch.from_arrays([keys, *made], names=["key", "item", "similarity", "start_word"])

        one = source.mapInArrow(run, schema)
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.select(F.col("key").alias(key), F.col("item").alias(item_key), "similarity", "start_word")


def decontaminate(docs: DataFrame, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """The rows of ``docs`` that match no item, unchanged: a narrow map per block of items."""
    spark = docs.sparkSession
    names, schema = docs.columns, docs.schema
    at = names.index(text)
    for block in item_blocks(items, item_key, item_text):
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for part, found in _batches(batches, held.value, at):
                clean = np.ones(part.num_rows, bool)
                clean[[f[0] for f in found]] = False
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(clean)) for c in part.columns], names=names)

        docs = docs.mapInArrow(run, schema)
    return docs
