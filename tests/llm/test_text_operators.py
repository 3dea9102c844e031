"""Decontamination, toxicity, substring deduplication, n-gram join: brute force and edge cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from procura.llm import decontamination, ngram_join, substring_dedup, toxicity
from procura.llm.textops import distinct_of, letter_words, shingles_of, space_words, words_of

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, ids=None):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text, k):
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near_copies(seed, bases=8, copies=6, size=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(bases):
        base = rnd.choices(vocabulary, k=size + rnd.randint(0, 40))
        out.append(" ".join(base))
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randint(0, 5)):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            out.append(" ".join(w))
    return out


def brute_components(ids, sets, percent):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    groups = {}
    for i in range(len(sets)):
        groups.setdefault(find(i), []).append(i)
    return {i: min((ids[m] for m in g if ids[m] is not None), default=None) for g in groups.values() for i in g}


def test_hashing_matches_python_sets():
    texts = ["Hello  World hello\tworld x", "", None, " \n ", "é É a", "one two", "A" * 300 + " b", "a" * 300 + " B", "abcdefgh" * 3]
    for k in (1, 2, 3, 5):
        values, first = distinct_of(*shingles_of(*words_of(pa.array(texts), space_words), k))
        got = [frozenset(values[a:b].tolist()) for a, b in zip(first[:-1], first[1:], strict=True)]
        want = [shingle_set(t, k) for t in texts]
        assert [len(g) for g in got] == [len(w) for w in want]
        for i in range(len(texts)):
            for j in range(i):
                assert len(got[i] & got[j]) == len(want[i] & want[j])


def test_sliced_arrow_columns_hash_alike():
    column = pa.array(["a b c", None, "d e", "a b c"])
    whole, _ = words_of(column, letter_words)
    part, first = words_of(column.slice(2), letter_words)
    assert part.tolist() == whole[3:].tolist() and first.tolist() == [0, 2, 5]


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_ngram_join_equals_brute_force(spark, k, percent):
    texts = near_copies(k)
    texts += [texts[0], texts[0].upper(), "", None, "  ", "two words", "Two  words", "one", "two words more"]
    ids = [7 * i % 97 for i in range(len(texts))]
    got = ngram_join.jaccard_classes(frame(spark, texts, ids), "doc_id", "text", k, percent).collect()
    sets = [shingle_set(t, k) for t in texts]
    want = brute_components(ids, sets, percent)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == {(ids[i], len(sets[i]), want[i]) for i in range(len(texts))}
    assert len(got) == len(texts)


def test_ngram_join_nulls_repeats_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = frame(spark, [text, text, text, None, "x"], [None, 5, 5, None, 6]).withColumn("sid", F.lit(1)).withColumn("component", F.lit("c"))
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_classes(df, "doc_id", "text", 3, 90).collect())
    assert got == [(-1, 0, None), (-1, 28, 5), (5, 28, 5), (5, 28, 5), (6, 1, 6)]
    kept = ngram_join.one_of_each(df, "doc_id", "text", 3, 90)
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect() if r["text"]) == [(5, text), (6, "x")]
    assert kept.columns == df.columns and kept.count() == 3


def test_ngram_join_empty_table(spark):
    assert ngram_join.jaccard_classes(frame(spark, []), "doc_id", "text", 3, 90).count() == 0
    assert ngram_join.one_of_each(frame(spark, []), "doc_id", "text", 3, 90).count() == 0


def test_one_of_each_keeps_the_least_id_of_every_class(spark):
    texts = near_copies(11)
    ids = list(range(100, 100 + len(texts)))
    want = brute_components(ids, [shingle_set(t, 5) for t in texts], 80)
    kept = {r[0] for r in ngram_join.one_of_each(frame(spark, texts, ids), "doc_id", "text", 5, 80).select("doc_id").collect()}
    assert kept == set(want.values())


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(3)
    vocabulary = [f"v{i}" for i in range(900)] + ["the", "of", "a"] * 60
    items = [(i, " ".join(rnd.choices(vocabulary, k=n))) for i, n in enumerate([5, 8, 11, 15, 16, 21, 30, 34, 47, 59, 80, 120])]
    texts = []
    for i, (_, t) in enumerate(items):
        before, after = (" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 70))) for _ in range(2))
        texts.append(f"{before} {t.upper() if i % 2 else t.replace(' ', ', ')} {after}")
    edited = items[10][1].split()
    edited[40] = "changed"
    texts += [" ".join(rnd.choices(vocabulary, k=40) + edited), "", None, " ".join(rnd.choices(vocabulary, k=500))]
    got = decontamination.contaminated_pairs(frame(spark, texts), "doc_id", "text", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").collect()

    def grams(text):
        w = re.findall(r"[0-9a-z]+", (text or "").lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    docs, queries = [grams(t) for t in texts], {i: grams(t) for i, t in items}
    want = {(d, i) for d, g in enumerate(docs) for i, q in queries.items() if len(g & q) >= 0.8 * len(q)}
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(want) >= len(items)
    clean = decontamination.decontaminate(frame(spark, texts), "text", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")
    assert {r[0] for r in clean.select("doc_id").collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_decontamination_finds_copies_edited_anywhere():
    rnd = random.Random(8)
    items, texts, want = [], [], []
    for i in range(120):
        n = rnd.randint(16, 59)
        item = [f"i{i}w{k}" for k in range(n)]
        cut = int(0.2 * (n - 4))  # shingles that may be lost
        where = (0, n // 2, n)[i % 3]
        run = cut if where in (0, n) else max(0, cut - 4)  # inside, a run of k words costs k + 4 shingles
        copy = list(item)
        for k in range(where if where < n else n - run, min(n, (where if where < n else n - run) + run)):
            copy[k] = f"x{k}"
        lead = [f"t{rnd.randrange(999)}" for _ in range(rnd.randint(0, 90))]
        items.append((i, " ".join(item)))
        texts.append(" ".join([*lead, *copy, "and", "then", "on"]))
        want.append((i, i))
    index = decontamination.ItemIndex(items)
    got = index.matches(*words_of(pa.array(texts), letter_words))
    assert [(t, i) for t, i, *_ in got] == want and all(s >= 0.8 - 1e-9 for _, _, s, _ in got)


def test_multi_index_finds_every_fingerprint_within_the_radius():
    rnd = np.random.default_rng(1)
    prints = rnd.integers(0, 1 << 63, 40).astype(np.uint64)
    index = decontamination.ItemIndex([])
    table = decontamination._table(prints)
    for off in range(decontamination.RADIUS + 1):
        bits = rnd.choice(64, off, replace=False)
        found = prints[:1] ^ np.bitwise_or.reduce(np.append(np.uint64(1) << bits.astype(np.uint64), np.uint64(0)))
        hits = {int(e) for _, entries in index._look_up(found, prints, table) for e in entries}
        assert 0 in hits


def best_passages(text, items, k=5):
    """{item: share} of the best passage of the item's size, by brute force over plain tuples."""
    w = text.lower().split()
    grams = [[tuple(q[i : i + k]) for i in range(max(1, len(q) - k + 1))] for q in (t.split() for t in items)]
    holders = Counter(g for q in grams for g in set(q))
    out, all_grams = {}, {tuple(w[a : a + k]) for a in range(max(1, len(w) - k + 1))}
    for i, q in enumerate(grams):
        if not all_grams & set(q):
            continue
        weight = {g: math.log1p(len(items) / holders[g]) for g in q}
        want, size = Counter(q), len(items[i].split())
        shares = []
        for a in range(max(1, len(w) - size + 1)):
            got = Counter(tuple(w[b : b + k]) for b in range(a, max(a + 1, min(a + size, len(w)) - k + 1)))
            shares.append(sum(min(n, got[g]) * weight[g] for g, n in want.items()) / sum(n * weight[g] for g, n in want.items()))
        out[i] = max(shares)
    return out


def test_decontamination_windows_find_scattered_edits_as_brute_force_does():
    rnd = random.Random(12)
    shared = [f"s{k}" for k in range(12)]  # a template that many items begin with
    items = []
    for i in range(90):
        n = rnd.randint(16, 160)
        items.append(" ".join((shared if i % 3 == 0 else []) + [f"w{rnd.randrange(4000)}" for _ in range(n)]))
    texts = []
    for i, t in enumerate(items * 3):
        w = t.split()
        for _ in range(rnd.randint(0, 1 + len(w) // 30)):
            at = rnd.randrange(len(w))
            w[at : at + rnd.randint(0, 2)] = [f"x{rnd.randrange(99)}"] * rnd.randint(0, 2)
        texts.append(" ".join([f"t{rnd.randrange(999)}" for _ in range(rnd.randint(0, 80))] + w + ["end"] * rnd.randint(0, 9)))
    index = decontamination.ItemIndex(list(enumerate(items)))
    got = {(t, i): s for t, i, s, _ in index.matches(*words_of(pa.array(texts), letter_words))}
    want = {(t, i): s for t, text in enumerate(texts) for i, s in best_passages(text, items).items() if s >= 0.8}
    assert len(want) > 100 and set(got) <= set(want) and len(got) >= 0.99 * len(want)
    assert all(abs(want[p] - s) < 0.1 for p, s in got.items()) and sum(abs(want[p] - s) < 1e-9 for p, s in got.items()) >= 0.99 * len(got)


def test_decontamination_short_items_match_inside_long_texts():
    items = [(0, "alpha beta gamma"), (1, "alpha"), (2, "beta alpha"), (3, "a b c d"), (4, "a b c d"), (5, "one two three four five")]
    texts = ["x y Alpha, beta gamma z z z z z", "alpha beta gamma", "gamma beta alpha", "a b c d", "p q r s a b c d t", "a b c", "one two three four", None, "gamma beta"]
    got = decontamination.ItemIndex(items).matches(*words_of(pa.array(texts), letter_words))
    assert {(t, i): w for t, i, _, w in got} == {(0, 0): 2, (0, 1): 2, (1, 0): 0, (1, 1): 0, (2, 1): 2, (2, 2): 1, (3, 3): 0, (3, 4): 0, (4, 3): 4, (4, 4): 4}
    assert all(s == 1.0 for _, _, s, _ in got)


def test_decontamination_long_item_and_very_long_text_of_few_words():
    rnd = random.Random(4)
    item = " ".join(f"w{rnd.randrange(9000)}" for _ in range(6000))
    edited = item.split()
    edited[700:900], edited[4000:4100] = ["x"] * 200, []
    texts = ["lead in " + " ".join(edited) + " tail", "again and again " * 200_000, item[: len(item) // 2]]
    index = decontamination.ItemIndex([(0, item), (1, "again and again again and again again and again")])
    got = index.matches(*words_of(pa.array(texts), letter_words))
    assert [(t, i, w) for t, i, _, w in got] == [(0, 0, 0), (1, 1, 0)] and 0.9 < got[0][2] < 1


@pytest.mark.parametrize("limits", [(6, 1 << 18), (1024, 300), (50, 90)])
def test_decontamination_does_not_depend_on_the_blocks(spark, monkeypatch, limits):
    rnd = random.Random(5)
    shared = " ".join(f"s{k}" for k in range(14))
    items = [(i, f"{shared} " * (i % 2) + " ".join(f"w{rnd.randrange(300)}" for _ in range(rnd.choice([2, 4, 9, 16, 25])))) for i in range(60)] + [(60, None), (61, ""), (3, "equal id " + shared)]
    texts = []
    for i, (_, t) in enumerate(items[:60]):
        w = t.split()
        w[len(w) - max(0, (len(w) - 4) // (4 + i % 3)) :] = ["edited"]
        texts.append(" ".join(["before"] * (i % 5) + w + ["after"] * 30))
    docs, table = frame(spark, [*texts, shared, None]), spark.createDataFrame(items, "item_id long, text string")

    def found():
        return sorted(tuple(r) for r in decontamination.contaminated_pairs(docs, "doc_id", "text", table, "item_id", "text").withColumn("similarity", F.round("similarity", 9)).collect())

    whole = found()
    monkeypatch.setattr(decontamination, "ITEMS_PER_BLOCK", limits[0])
    monkeypatch.setattr(decontamination, "WORDS_PER_BLOCK", limits[1])
    blocks = list(decontamination.item_blocks(table, "item_id", "text"))
    assert len(blocks) > 1 and sum(len(b.ids) for b in blocks) == 62 and max(len(b.ids) for b in blocks) <= limits[0]
    assert all(b.sizes.sum() <= limits[1] + b.sizes.max() for b in blocks)
    assert found() == whole and 20 < len(whole)
    kept = decontamination.decontaminate(docs, "text", table, "item_id", "text")
    assert {r["doc_id"] for r in kept.collect()} == set(range(62)) - {r[0] for r in whole}


def test_decontamination_empty_sides_and_blocks(spark, monkeypatch):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, ["a b c d e f g h", None], [None, 2])
    assert decontamination.contaminated_pairs(docs, "doc_id", "text", none, "item_id", "text").count() == 0
    assert decontamination.decontaminate(docs, "text", none, "item_id", "text").count() == 2
    monkeypatch.setattr(decontamination, "ITEMS_PER_BLOCK", 2)
    items = [(i, t) for i, t in enumerate(["a b c d e", None, "", "x y z w v", "c d e f g", "a b c d e", "b c d e f"])]
    got = decontamination.contaminated_pairs(docs, "doc_id", "text", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")
    assert sorted(r["item_id"] for r in got.collect()) == [0, 4, 5, 6]


def passage(seed, sentences):
    rnd = random.Random(seed)
    return " ".join(" ".join(rnd.choices([f"p{seed}x{i}" for i in range(200)], k=rnd.randint(6, 12))).capitalize() + "." for _ in range(sentences))


def test_substring_repeats_stay_only_in_the_first_document(spark):
    shared = passage(1, 6)
    texts = [passage(2, 4) + " " + shared + " " + passage(3, 4), passage(4, 5) + "\n" + shared + "\n" + passage(5, 3), passage(6, 9), shared, None, ""]
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(frame(spark, texts), "doc_id", "text").collect()}
    assert got[0]["text"] == texts[0] and got[2]["text"] == texts[2] and got[4]["text"] is None and got[5]["text"] == ""
    assert got[1]["text"] == passage(4, 5) + "\n" + passage(5, 3) and got[1]["n_removed"] == 6
    assert got[3]["text"] == "" and got[3]["n_removed"] == got[3]["n_sentences"] == 6


def test_substring_spans_without_sentence_ends_and_inside_one_document(spark):
    rnd = random.Random(8)
    run = " ".join(rnd.choices([f"q{i}" for i in range(300)], k=120))
    own = [" ".join(rnd.choices([f"r{j}x{i}" for i in range(300)], k=40)) for j in range(4)]
    texts = [f"{own[0]} {run} {own[1]}", f"{own[2]} {run} {own[3]}", passage(9, 5) + " " + passage(9, 5)]
    got = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(frame(spark, texts), "doc_id", "text").collect()}
    assert got[0] == texts[0]
    left = [w for w in got[1].split() if w.startswith("q")]
    assert len(left) < 50 and set(own[2].split()[:10]) <= set(got[1].split())
    assert got[2].startswith(passage(9, 5))  # what is left of the second copy is shorter than a span
    assert len(got[2].split()) < len(passage(9, 5).split()) + substring_dedup.SPAN_WORDS


def test_substring_null_and_equal_ids(spark):
    shared = passage(1, 6)
    got = substring_dedup.remove_repeats(frame(spark, [shared, shared, shared, shared], [None, 3, 3, None]).withColumn("n_removed", F.lit("x")), "doc_id", "text").collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in got) == [(-1, ""), (-1, ""), (3, shared), (3, shared)]
    assert substring_dedup.remove_repeats(frame(spark, []), "doc_id", "text").count() == 0


def toxic_corpus(n=240):
    rnd = random.Random(5)
    plain = [f"word{i}" for i in range(300)]
    bad = ["vile", "nasty", "rotten", "gross"]
    texts, labels = [], []
    for i in range(n):
        toxic = i % 3 == 0
        w = rnd.choices(plain, k=40)
        if toxic:
            for b in rnd.sample(bad, 3):
                w.insert(rnd.randrange(40), b)
        texts.append(" ".join(w))
        labels.append((i, int(toxic)))
    return texts, labels


def test_toxicity_separates_held_out_texts(spark):
    texts, labels = toxic_corpus()
    docs = frame(spark, texts)
    labelled = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, labelled, "doc_id", F.col("text"), "toxic", F.col("doc_id") < 160)
    got = {r["doc_id"]: r for r in toxicity.score(docs, F.col("text"), model).collect()}
    held = [(got[i]["score"], t) for i, t in labels if i >= 160]
    assert all((s >= 0.7) == bool(t) for s, t in held) and all(0 <= s <= 1 for s, _ in held)
    assert all(e["id"] < 160 for r in got.values() for e in r["evidence"])


def test_block_max_search_is_exact(spark):
    texts, labels = toxic_corpus()
    model = toxicity.fit(frame(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id", F.col("text"), "toxic", F.lit(True))
    dense = np.zeros((len(model.ids), len(model.vocabulary)))
    for t in range(len(model.vocabulary)):
        part = slice(model.posting_at[t], model.posting_at[t + 1])
        dense[model.posting_example[part], t] = model.posting_weight[part]
    for terms, weights in model.vectors(pa.array(texts[:60])):
        if len(terms):
            cosine = dense[:, terms] @ weights
            order = np.lexsort((np.arange(len(cosine)), -np.round(cosine, 12)))[: toxicity.NEIGHBOURS]
            at, found = model.nearest(terms, weights)
            assert np.allclose(found, cosine[order][cosine[order] > 0])


def test_toxicity_keeps_words_of_one_class_only(spark):
    rnd = random.Random(5)
    plain = [f"p{i}" for i in range(300)]
    texts = [" ".join(rnd.choices(plain, k=30)) + (f" z{i // 12}" if i < 120 else "") for i in range(600)]
    labelled = spark.createDataFrame([(i, int(i < 120)) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.fit(frame(spark, texts), labelled, "doc_id", F.col("text"), "toxic", F.col("doc_id") % 3 != 1)
    marks = model.vectors(pa.array([f"z{k}" for k in range(10)]))  # each in 8 toxic examples and no clean one
    assert all(len(t) for t, _ in marks)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame(spark, texts), F.col("text"), model).collect()}
    assert all(got[i] >= 0.7 for i in range(1, 120, 3))


def test_toxicity_sample_holds_one_text_a_key(spark):
    texts, labels = toxic_corpus()
    docs = frame(spark, texts).unionByName(frame(spark, [f"{texts[0]} vile only{i}" for i in range(300)], [labels[0][0]] * 300))
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id", F.col("text"), "toxic", F.lit(True))
    assert len(model.ids) == len(set(model.ids.tolist()))


def test_toxicity_edges(spark):
    docs = frame(spark, [None, "", "vile nasty", "  "], [None, 1, 2, 2]).withColumn("score", F.lit("clash"))
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, empty, "doc_id", F.col("text"), "toxic", F.lit(True))
    got = toxicity.score(docs, F.col("text"), model)
    assert [r["score"] for r in got.collect()] == [0.0] * 4 and got.schema["score"].dataType.simpleString() == "double"
    one = spark.createDataFrame([(2, 1), (2, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, one, "doc_id", F.col("text"), "toxic", F.lit(True))
    assert toxicity.score(docs.limit(0), F.col("text"), model).count() == 0
    assert toxicity.score(docs, F.col("text"), model).count() == 4
