"""Vectorised word and shingle hashing over Arrow string columns.

Texts are handled as the UTF-8 bytes of an Arrow batch, never as Python
strings: words are found with a byte table and hashed with a polynomial prefix
sum (modulo 2**64), so a task spends a few nanoseconds a byte. All functions
are pure and deterministic; hashes are equal on every executor.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_LEN = _U(0xD6E8FEB86659FD93)
#: Odd multipliers of the words of a shingle, by position.
_PLACE = [_U(pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64)) for i in range(64)]
#: _LOW_BYTES[r] keeps the r lowest bytes of a 64-bit load.
_LOW_BYTES = np.array([(1 << (8 * r)) - 1 for r in range(9)], _U)
#: Longer words are hashed one by one; text has few of them.
LONG_WORD = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x ^= x >> _U(27)
    x = x * _U(0x81DADEF4BC2DD44D)
    x ^= x >> _U(33)
    return x


def space_words(data: np.ndarray) -> np.ndarray:
    """True on bytes of words: runs of bytes other than 0x20 and 0x09-0x0D."""
    return (data != 0x20) & ((data - np.uint8(9)) > 4)


def letter_words(data: np.ndarray) -> np.ndarray:
    """True on ASCII letters, digits and every byte of a non-ASCII character."""
    return (data >= 0x80) | (((data | 0x20) - np.uint8(0x61)) < 26) | ((data - np.uint8(0x30)) < 10)


def folded(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return data + (((data - np.uint8(0x41)) < 26).view(np.uint8) << np.uint8(5))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column, at_most: int = 1 << 21):
    """(start, length) of consecutive runs of rows of about ``at_most`` bytes, so that temporaries stay small."""
    _, offsets = text_bytes(column)
    i = 0
    while i < len(column):
        j = max(int(np.searchsorted(offsets, offsets[i] + at_most, "left")), i + 1)
        yield i, min(j, len(column)) - i
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word_byte) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte positions of every word, and each text's first word index.

    A word never crosses from one text into the next.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    is_word = is_word_byte(data)
    edge = offsets[:-1][(offsets[:-1] > 0) & (offsets[:-1] < n)]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    before[edge] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    after[edge - 1] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span, ASCII case folded if asked.

    Spans are read eight bytes at a time; the loop runs over the eighths of
    the longest span of at most ``LONG_WORD`` bytes.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = folded(data) if lower else data
    loads = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))
    size = ends - starts
    out = size.astype(_U) * _LEN
    at, left, which = starts, size, None
    while len(at):
        part = loads[at] & _LOW_BYTES[np.minimum(left, 8)]
        if which is None:
            out = mix(out ^ part)
        else:
            out[which] = mix(out[which] * _PLACE[1] ^ part)
        more = np.flatnonzero((left > 8) & (left <= LONG_WORD)) if which is None else np.flatnonzero(left > 8)
        which = more if which is None else which[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG_WORD):
        raw = padded[starts[i] : ends[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    return out


def words_of(column, is_word_byte) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of an Arrow string column, and each text's first word index."""
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets, is_word_byte)
    return span_hashes(data, starts, ends), first


def shingles_of(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles in order, and each text's first shingle index.

    A text with fewer than k words (but at least one) has one shingle, its
    whole word sequence; a text without words has none.
    """
    n_words = np.diff(first)
    counts = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    where = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=where[1:])
    out = np.empty(where[-1], _U)
    starts = np.repeat(first[:-1] - where[:-1], counts) + np.arange(where[-1])
    full = max(len(words) - k + 1, 0)
    if full:
        acc = np.full(full, k, _U) * _LEN
        for i in range(k):
            acc += words[i : i + full] * _PLACE[i]
        whole = np.repeat(n_words >= k, counts)
        out[whole] = mix(acc)[starts[whole]]
    for t in np.flatnonzero((n_words > 0) & (n_words < k)):
        seq = words[first[t] : first[t + 1]]
        acc = np.full(1, len(seq), _U) * _LEN
        for i in range(len(seq)):
            acc += seq[i : i + 1] * _PLACE[i]
        out[where[t]] = mix(acc)[0]
    return out, where


def distinct_of(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and each text's first index."""
    values = values.copy()
    for a, b in zip(first[:-1], first[1:], strict=True):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    if len(values):
        keep[1:] = values[1:] != values[:-1]
        keep[first[:-1][first[:-1] < len(values)]] = True
    counted = np.zeros(len(values) + 1, np.int64)
    np.cumsum(keep, out=counted[1:])
    return values[keep], counted[first]


def digest(raw: bytes) -> bytes:
    """128-bit digest: two different inputs never share it in practice."""
    return hashlib.blake2b(raw, digest_size=16).digest()
