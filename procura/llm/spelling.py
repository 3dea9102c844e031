"""Spelling variants by permuterm rotations.

The rotations of a word are the cyclic shifts of the word with a terminator.
Two words of one length that differ in one character share the rotation that
starts behind it, up to that character; and a word without one of its
characters has that very string as a whole rotation. So every word puts down,
for each of its characters, the rotation that skips it (an ``edited`` entry),
and each of its whole rotations once (a ``whole`` entry); sorted, the entries
of a near pair lie together in the range of one prefix. A range holds one whole
entry at most, and one edited entry for each character of the alphabet, so its
size is bounded by the alphabet, whatever the words are.

A near pair lies in exactly one range: two words of one length differ at one
place only, and where a character of a run of equal ones is left out, only the
entry of the run's first character meets whole entries. The scan of a range
therefore emits, for each entry, how many neighbours it has there and which of
them is best; no pairs are made. Sums and minima of these over a word's entries
are its neighbours.

A word's form is its near word of largest count (ties: smallest in code-point
order) if that count is ``ratio`` times its own or more. Counts grow along
forms, so chains end; they are followed by doubling, each step over all words.

Words are counted with map-side sums, so a hot word, text or source is one row
a task before the shuffle. Entries name their word by its number in the order
of all words; the join that gives a form or root its text has one row per word,
and rows without a form join nothing.

Defined results: null and empty texts have no words; a null key counts as an
empty text in a run's checksum; rows of equal key each count; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from procura.llm.common import stored

#: Ends every word in its rotations; no character of a word sorts below it.
END = "\x01"
#: Rotations of longer words are held as digests, so that a word of a million characters costs as many entries but not a square of bytes.
LONG = 64
#: A digest's polynomials: modulus and evaluation points (124 bits); entries of a batch of them.
PRIME, BASES = (1 << 31) - 1, (1180591621, 1475739526, 2096286707, 739391407)
ENTRIES = 10000
_P, _END = np.uint64(PRIME), np.uint64(ord(END))
#: Letters of a run, after A-Z became a-z.
LETTERS = "a-z\\u00C0-\\u00FF"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(df: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """(key, run): every maximal run of at least ``least`` letters, A-Z in lower case, once per occurrence."""
    found = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"[{LETTERS}]{{{least},}}+"), F.lit(0))
    return df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(found).alias("run"))


def miswritten(one_in: int) -> Column:
    """The run, without its character at h % length if ``one_in`` divides h, the CRC-32 of ``<key>:<run>``."""
    h = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))).otherwise(F.col("run"))


def vocabulary(df: DataFrame, word: Column, min_length: int, min_count: int) -> DataFrame:
    """(word, n): words of at least ``min_length`` characters that occur at least ``min_count`` times."""
    words = df.select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """(rotation, edited, first, id, n): the entries of every word of ``words`` (id, word, n)."""
    size = F.length("word")
    places = words.where(size <= LONG).withColumn("i", F.explode(F.sequence(F.lit(0), size)))
    before, behind = F.substring(F.col("word"), F.lit(1), F.col("i")), F.substring(F.col("word"), F.col("i") + 1, size)
    skipping = F.substring(F.col("word"), F.col("i") + 2, size)
    here, last = F.substring(F.col("word"), F.col("i") + 1, F.lit(1)), F.substring(F.col("word"), F.col("i"), F.lit(1))
    whole = F.struct(F.concat(behind, F.lit(END), before).alias("rotation"), F.lit(False).alias("edited"), F.lit(False).alias("first"))
    edited = F.struct(F.concat(skipping, F.lit(END), before).alias("rotation"), F.lit(True).alias("edited"), ((F.col("i") == 0) | (here != last)).alias("first"))
    entries = F.when(F.col("i") < size, F.array(whole, edited)).otherwise(F.array(whole))
    short = places.select(F.explode(entries).alias("e"), "id", "n").select(F.encode("e.rotation", "UTF-8").alias("rotation"), "e.edited", "e.first", "id", "n")
    long = words.where(size >= LONG).select("id", "word", "n").mapInArrow(_long_rotations, "rotation binary, edited boolean, first boolean, id long, n long")
    return short.unionByName(long)


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo ``PRIME``."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % _P])
    return out[:n]


def _digests(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of a word's whole rotations and of its edited ones, each in linear time: polynomials at ``BASES``."""
    n, whole, edited = len(points), [], []
    for base in BASES:
        up, down = _powers(base, n + 2), _powers(pow(base, -1, PRIME), n + 2)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(points * up[:n] % _P)]) % _P
        i = np.arange(n + 1)
        behind = (sums[n] + _P - sums) % _P  # of the characters from i on
        whole.append((behind * down[i] % _P + _END * up[n - i] + sums * up[n - i + 1] % _P) % _P)
        i = i[:n]
        edited.append((behind[1:] * down[i + 1] % _P + _END * up[n - i - 1] + sums[:n] * up[n - i] % _P) % _P)
    return np.stack(whole, axis=1), np.stack(edited, axis=1)


def _long_rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of words over ``LONG`` characters as digests of their length and characters, and the whole entries of words of ``LONG``."""
    for batch in batches:
        for number, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            points = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
            whole, edited = _digests(points)
            kinds = [(whole, len(points) + 1, False, np.zeros(len(whole), bool))]
            if len(points) > LONG:
                kinds.append((edited, len(points), True, np.concatenate([[True], points[1:] != points[:-1]])))
            for digest, length, is_edited, first in kinds:
                digest = np.concatenate([np.full((len(digest), 1), length), digest], axis=1).astype(">u4")
                for i in range(0, len(digest), ENTRIES):
                    part = digest[i : i + ENTRIES]
                    raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * part.shape[1]), len(part), [None, pa.py_buffer(part.tobytes())]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [raw, *(pa.array(x) for x in (np.full(len(part), is_edited), first[i : i + ENTRIES], np.full(len(part), number), np.full(len(part), n)))],
                        names=["rotation", "edited", "first", "id", "n"],
                    )


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, near_n, near_id) of each word of ``words`` (id, word, n) with a near word: how many there are, and the best.

    Ids are in the order of the words.
    """
    of_range = Window.partitionBy("rotation")
    in_order = of_range.orderBy(F.desc("edited"), F.desc("n"), "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scanned = (
        rotations(words)
        .withColumn("me", F.struct((-F.col("n")).alias("less"), "id"))
        .withColumn("size", F.count(F.lit(1)).over(of_range))
        .where("size > 1")
        .select(
            "id", "edited", "first",
            F.count_if("edited").over(in_order).alias("n_edited"),
            F.count_if("first").over(in_order).alias("n_first"),
            F.max(F.when(~F.col("edited"), F.col("me"))).over(in_order).alias("whole"),
            F.min(F.when(F.col("first"), F.col("me"))).over(in_order).alias("best_first"),
            F.nth_value(F.when(F.col("edited"), F.col("me")), 1).over(in_order).alias("best"),
            F.nth_value(F.when(F.col("edited"), F.col("me")), 2).over(in_order).alias("second"),
        )
    )
    other = F.when(F.col("best.id") != F.col("id"), F.col("best")).otherwise(F.col("second"))
    meets_whole = F.col("first") & F.col("whole").isNotNull()
    seen = scanned.select(
        "id",
        F.when(F.col("edited"), F.col("n_edited") - 1 + meets_whole.cast("int")).otherwise(F.col("n_first")).alias("n_near"),
        F.when(F.col("edited"), F.least(other, F.when(meets_whole, F.col("whole")))).otherwise(F.col("best_first")).alias("best"),
    )
    best = seen.where("n_near > 0").groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return best.select("id", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.id").alias("near_id"))


def roots(links: DataFrame) -> DataFrame:
    """(id, root_id): the end of the chain that starts at each id of ``links`` (id, form_id); chains must not close."""
    chain = stored(links.select("id", F.col("form_id").alias("root_id")), "spelling-chain")
    while True:
        step = chain.select(F.col("id").alias("at"), F.col("root_id").alias("next"))
        longer = chain.join(step, chain["root_id"] == step["at"], "left").select("id", F.coalesce("next", "root_id").alias("root_id"), F.col("next").isNotNull().alias("moved"))
        longer = stored(longer, "spelling-chain")
        chain = longer.select("id", "root_id")
        if longer.where("moved").isEmpty():
            return chain


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of ``words`` (word, n: distinct words and their counts)."""
    words = stored(words.orderBy("word").withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    near = words.join(neighbours(words), "id", "left")
    is_form = F.col("near_n") >= ratio * F.col("n")
    told = stored(
        near.select("id", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(is_form, F.col("near_id")).alias("form_id"), F.when(is_form, F.col("near_n")).alias("form_n")),
        "spelling-near",
    )
    links = told.where("form_id is not null").select("id", "form_id")
    form, root = (words.select(F.col("id").alias(f"{x}_id"), F.col("word").alias(x)) for x in ("form", "root"))
    linked = links.join(roots(links), "id").join(form, "form_id").join(root, "root_id").select("id", "form", "root")
    named = words.select("id", "word").join(told, "id").join(linked, "id", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants_of_texts(df: DataFrame, key: str, text: str, *, min_length: int = 6, min_count: int = 5, ratio: int = 5, one_in: int | None = None) -> DataFrame:
    """``variants`` of the runs of letters of all texts; with ``one_in``, after ``miswritten``."""
    found = runs(df, key, text, min_length)
    return variants(vocabulary(found, F.col("run") if one_in is None else miswritten(one_in), min_length, min_count), ratio)
