"""Byte-level BPE through a sentencepiece model written from the vocabulary.

The rank file's tokens become the pieces of a BPE ``ModelProto``: each byte is
mapped to one printable character, the score of a piece is its negative rank
(so the best merge is the one of least rank), and the normaliser is the
identity without dummy prefix or white-space escaping. The protobuf is written
here field by field; nothing is trained.

Each match of the split pattern is encoded by itself and decoded again by the
inverse mapping. A null text is empty; an empty text has no ids. Equal rows
give equal results. Memory is bounded: a worker's cache of encoded pre-tokens
is emptied when it is full, and texts are handled a few megabytes at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from procura.llm.textops import slices

#: Characters (plus 100 a string) of the strings a worker remembers before it starts afresh.
CACHE_CHARS = 100 << 20


def byte_chars() -> list[str]:
    """One printable character per byte: itself if printable Latin-1, else the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file, by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value) -> bytes:
    """One protobuf field: bytes and text by length, float fixed, int and bool as varint."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(int(value))
    raw = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


def model_proto(tokens: list[bytes]) -> bytes:
    """Serialised sentencepiece model: piece 0 is the unknown one, piece rank + 1 the token of that rank.

    Field numbers (fixed values of the public sentencepiece_model.proto):
    ModelProto pieces 1, trainer_spec 2, normalizer_spec 3; SentencePiece
    piece 1, score 2, type 3 (2: unknown); TrainerSpec model_type 3 (2: BPE),
    vocab_size 4, treat_whitespace_as_suffix 24, unk_id 40, bos_id 41, eos_id
    42, pad_id 43; NormalizerSpec name 1, add_dummy_prefix 3,
    remove_extra_whitespaces 4, escape_whitespaces 5.
    """
    chars = byte_chars()
    pieces = [_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2))]
    pieces += [_field(1, _field(1, "".join(chars[b] for b in t)) + _field(2, -float(r))) for r, t in enumerate(tokens)]
    off = (1 << 64) - 1  # -1 as a varint
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(24, False) + _field(40, 0) + _field(41, off) + _field(42, off) + _field(43, off)
    normalizer = _field(1, "identity") + _field(3, False) + _field(4, False) + _field(5, False)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteBpe:
    """Encoder and decoder of one worker.

    A space after a visible character always starts a new match of the split
    pattern, so a text is cut there and the ids of " word" are remembered;
    texts with a space after other white space are matched as a whole.
    """

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.tokens = tokens
        self.whole = {t: struct.pack("<I", r) for r, t in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.odd = re.compile(r"\s ").search
        self.chars = dict(enumerate(byte_chars()))
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(tokens))
        self.words: dict[str, bytes] = {}
        self.held = 0

    def pre_tokens(self, texts: list[str]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit integers; a token of the vocabulary is itself."""
        raw = [t.encode() for t in texts]
        out = list(map(self.whole.get, raw))
        unknown = [i for i, ids in enumerate(out) if ids is None]
        mapped = [raw[i].decode("latin-1").translate(self.chars) for i in unknown]
        for i, ids in zip(unknown, self.model.encode(mapped, num_threads=1) if mapped else [], strict=True):
            out[i] = (np.array(ids, "<u4") - 1).astype("<u4").tobytes()
        return out

    def _learn(self, words: set[str]) -> None:
        split = [self.split(w) for w in words]
        ids = iter(self.pre_tokens([t for ts in split for t in ts]))
        self.words.update((w, b"".join([next(ids) for _ in ts])) for w, ts in zip(words, split, strict=True))
        self.held += sum(map(len, words)) + 100 * len(words)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text. New strings of all the texts are encoded in one call."""
        if self.held > CACHE_CHARS:
            self.words.clear()
            self.held = 0
        parts = [self.split(t) if self.odd(t) else t.replace(" ", "\0 ").split("\0") if "\0" not in t else self.split(t) for t in texts]
        new = set().union(*parts).difference(self.words)
        if new:
            self._learn(new)
        get = self.words.__getitem__
        return [b"".join(map(get, p)) for p in parts]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


_made: dict[tuple[str, str], ByteBpe] = {}


def worker_bpe(rank_path: str, pattern: str) -> ByteBpe:
    """The coder of this Python worker, built once for all its tasks."""
    if (rank_path, pattern) not in _made:
        _made[rank_path, pattern] = ByteBpe(read_ranks(rank_path), pattern)
    return _made[rank_path, pattern]


SCHEMA = "n_tokens long, ids binary, decoded binary"


def encode_decode(df: DataFrame, text: str, rank_path: str, pattern: str, keep: list[str], digests: bool = False) -> DataFrame:
    """Columns ``keep`` of ``df`` with ``n_tokens``, the ``ids`` (packed unsigned 32-bit, little-endian) and the ``decoded`` bytes.

    With ``digests``, the lower-case SHA-256 of both (``ids_sha256``,
    ``decoded_sha256``) instead. One narrow map over the rows, without a
    shuffle. ``rank_path`` must be readable where the tasks run.
    """
    fields = ", ".join(f"`{c}` {t}" for c, t in df.select(*keep).dtypes)
    out = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(rank_path, pattern)
        for batch in (b.slice(*part) for b in batches for part in slices(b.column(0))):
            n, ids, decoded = [], [], []
            for packed in bpe.encode_all([t or "" for t in batch.column(0).to_pylist()]):
                raw = bpe.decode(packed)
                n.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest() if digests else packed)
                decoded.append(hashlib.sha256(raw).hexdigest() if digests else raw)
            kind = pa.string() if digests else pa.binary()
            names = out.replace(",", "").split()[::2]
            made = [pa.array(n, pa.int64()), pa.array(ids, kind), pa.array(decoded, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names=[*keep, *names])

    source = df.select(df[text].alias("__text"), *[df[c] for c in keep])
    return source.mapInArrow(run, f"{fields}, {out}" if keep else out)
