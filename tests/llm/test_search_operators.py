"""Hard negatives, nearest neighbours and spelling variants against brute force, and edge cases."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from procura.llm import hard_negatives, nearest_neighbours, queries, spelling, vectors

SF = "/root/testdata/sf0.001"
VEC_SCHEMA = "vec_id long, label int, embedding array<double>"


def floored(x):
    return [math.floor(256 * c) for c in x]


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


# hard negatives


def brute_negatives(rows, positives=5, negatives=10, low=30, high=90, every=100):
    rows = [(i, l, floored(v)) for i, l, v in rows if i is not None and l is not None and usable(v)]
    out = Counter()
    for i, label, a in rows:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), j, l) for j, l, v in rows if j != i and len(v) == len(a))
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            inside = [(n, t) for t, n, l in scored if l != label and low * -s <= 100 * -t <= high * -s][:negatives]
            out.update((i, j, rank, n, -s, -t) for rank, (n, t) in enumerate(inside, 1))
    return out


def mined(spark, rows, schema=VEC_SCHEMA, **kw):
    df = spark.createDataFrame(rows, schema)
    out = hard_negatives.mine(df, "vec_id", F.col("label"), "embedding", F.col("vec_id") % 100 == 0, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(map(tuple, out.collect()))


def clustered(seed, n, dim, spread=0.4, labels=3):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((5, dim))
    return [(i, int(rnd.integers(labels)), (centres[i % 5] + spread * rnd.standard_normal(dim)).round(2).tolist()) for i in range(n)]


@pytest.mark.parametrize("dim, depths", [(3, (1 / 16, 1 / 4, 1.0)), (12, (1 / 16, 1 / 4, 1.0)), (3, (1 / 2, 4.0))])
def test_negatives_equal_brute_force(spark, monkeypatch, dim, depths):
    monkeypatch.setattr(hard_negatives, "DEPTHS", depths)
    rows = clustered(dim, 900, dim)
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_of_few_queries_a_pass_are_the_same(spark, monkeypatch):
    rows = clustered(5, 700, 4)
    want = mined(spark, rows)
    monkeypatch.setattr(vectors.query_blocks, "__defaults__", (1024,))  # two anchors a pass
    assert mined(spark, rows) == want == brute_negatives(rows)


def test_negatives_with_ties_copies_and_signs(spark):
    rows = [(i, i % 2, [1.0, -0.5]) for i in range(60)] + [(100 + i, i % 2, [0.5, -0.25]) for i in range(60)]
    rows += [(200, 0, [-1.0, 0.5]), (300, 1, [0.0, 0.0]), (0, 0, [1.0, -0.5]), (100, 1, [2.0, 0.0])]  # repeated ids
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_edge_rows(spark):
    rows = clustered(2, 120, 4)
    rows += [(200, 0, None), (300, None, [1.0] * 4), (400, 1, [1.0, None, 1.0, 1.0]), (500, 1, [float("nan")] * 4), (600, 1, [float("inf")] * 4), (None, 1, [1.0] * 4)]
    rows += [(700, 0, [1.0, 1.0]), (701, 0, [1.0, 0.5]), (702, 1, [0.5, 0.5]), (800, 0, []), (801, 0, []), (802, 1, [])]  # other lengths
    got = mined(spark, rows)
    assert got == brute_negatives(rows) and any(k[0] == 700 for k in got)


def test_negatives_of_huge_components_are_exact_or_saturate(spark):
    rows = [(0, 0, [2.0**30, 3.0]), (1, 0, [2.0**14, 1.0]), (2, 1, [2.0**13, 5.0]), (3, 1, [2.0**13, 6.0]), (100, 5, [1e300, 1e308]), (101, 5, [1e300, 1.0])]
    got = mined(spark, rows)
    assert {k: n for k, n in got.items() if k[0] == 0} == brute_negatives(rows[:4])  # the sums of the others are beyond 64 bits
    assert all(abs(s) < 2**63 for k in got for s in k)


def test_negatives_of_an_empty_table_and_clashing_columns(spark):
    assert not mined(spark, [])
    rows = [(*r, 1, 2, 3, 4) for r in clustered(3, 210, 3)]
    assert mined(spark, rows, VEC_SCHEMA + ", id int, rank int, anchor int, score int") == brute_negatives([r[:3] for r in rows])


def test_threshold_stops_before_the_ends_of_the_lists(monkeypatch):
    rnd = np.random.default_rng(1)
    x = np.floor(np.exp(3 * rnd.standard_normal((4000, 4))))  # few rows hold the large components
    scored = []
    plain = hard_negatives._exact
    monkeypatch.setattr(hard_negatives, "_exact", lambda a, b: (scored.append(a.shape[0] if a.ndim == 2 and b.ndim == 1 else 0), plain(a, b))[1])
    kept = hard_negatives._Kept(np.array([-hard_negatives.MOST]), np.array([hard_negatives.MOST]), 5)
    anchor = (-1, 0, 0, np.array([1.0, 2.0, 1.0, 3.0]))
    hard_negatives._block(x, np.arange(4000), np.zeros(4000, int), [anchor], [kept], True)
    want = sorted((-int(s), i) for i, s in enumerate(x @ anchor[3]))[:5]
    assert [(-int(s), int(i)) for s, i in zip(*kept.best[0])] == want
    assert sum(scored) < 2000


# nearest neighbours


def brute_nearest(rows, every=50, k=5):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and usable(v) and any(v)]
    out = {}
    for i, q in rows:
        if i % every == 0:
            near = sorted((-float(q @ v) / math.sqrt(float(q @ q)) / math.sqrt(float(v @ v)), j) for j, v in rows if j != i and len(v) == len(q))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def found(spark, rows, schema="vec_id long, embedding array<double>", **kw):
    out = nearest_neighbours.nearest(spark.createDataFrame(rows, schema), "vec_id", "embedding", F.col("vec_id") % 50 == 0, **kw)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    by = {}
    for r in sorted(out.collect()):
        assert r["rank"] == len(by.setdefault(r["query_id"], [])) + 1
        by[r["query_id"]].append((r["vec_id"], r["score"]))
    return by


def recall(got, want):
    assert got.keys() == want.keys() and all(len(got[q]) == len(want[q]) for q in want)
    for q in got:
        known = dict(want[q])
        assert all(abs(s - known[i]) < 1e-12 for i, s in got[q] if i in known)
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))
    return sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))


@pytest.mark.parametrize("spread", [0.1, 0.6, 3.0])
def test_nearest_against_brute_force(spark, spread):
    rows = [(i, v) for i, _, v in clustered(int(spread * 10), 3000, 24, spread)]
    assert recall(found(spark, rows), brute_nearest(rows)) >= 0.97


def test_nearest_of_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {}
    for r in queries.op12_collision_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert recall(got, brute_nearest(rows)) >= 0.97


def test_nearest_of_few_queries_a_pass_are_the_same(spark, monkeypatch):
    rows = [(i, v) for i, _, v in clustered(7, 400, 6)]
    want = found(spark, rows)
    monkeypatch.setattr(vectors.query_blocks, "__defaults__", (1024,))
    assert found(spark, rows) == want


def test_nearest_with_copies_few_rows_and_edges(spark):
    copies = [(i, [0.5, 1.0, 2.0]) for i in range(300)] + [(300 + i, [-1.0, 0.1 * i, 1.0]) for i in range(100)]
    assert recall(found(spark, copies), brute_nearest(copies)) == 1.0
    rows = [(0, [1.0, 2.0]), (1, [2.0, 4.1]), (2, [-1.0, -2.0]), (50, None), (100, [0.0, 0.0]), (150, [float("nan"), 1.0]), (200, [None, 1.0]), (250, []), (None, [1.0, 2.0])]
    rows += [(300, [1.0, 2.0, 3.0]), (301, [1e200, 2e200, 3e200]), (302, [1e-200, 2e-200, -3e-200])]
    got = found(spark, rows)
    assert [i for i, _ in got[300]] == [301, 302] and got.keys() == {0, 300} and recall({0: got[0]}, brute_nearest(rows[:3])) == 1.0
    twice = nearest_neighbours.nearest(spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, 1.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<double>"), "vec_id", "embedding", F.lit(True))
    assert Counter((r["query_id"], r["vec_id"]) for r in twice.collect()) == Counter({(0, 1): 2, (1, 0): 2})  # neither row of id 0 meets the other
    assert found(spark, []) == {}


def test_nearest_finds_equal_copies_after_an_exact_match():
    x = np.tile(np.array([[0.3, 0.4, 0.5]]), (4, 1))
    near = nearest_neighbours._Nearest(9, 2)
    for ids in ([7, 8, 9, 10], [3, 1, 9, 2]):
        block = nearest_neighbours._Block(x, np.array(ids), 128)
        block.search(x[0], near, block.project(x[:1])[0], nearest_neighbours.collisions(), 1.0)
    assert near.id.tolist() == [1, 2]


def test_collision_threshold_is_the_largest_with_that_chance():
    n, p = nearest_neighbours.collisions(64, 1.0, 0.9), math.erf(1 / math.sqrt(2))
    chance = lambda k: sum(math.comb(64, j) * p**j * (1 - p) ** (64 - j) for j in range(k, 65))
    assert chance(n) >= 0.9 > chance(n + 1)


# spelling variants


def is_letter(c):
    return "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ"


def brute_words(rows, one_in):
    count = Counter()
    for key, text in rows:
        for run in "".join(c if is_letter(c) else " " for c in text or "").split():
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words, ratio=5):
    form, out = {}, set()
    close = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(w, v)] for w in words}
    for w, vs in close.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(close[w]), words.get(form[w])))
    return out


def variants_of(spark, rows, one_in=None, schema="doc_id long, text string"):
    out = spelling.variants_of_texts(spark.createDataFrame(rows, schema), "doc_id", "text", one_in=one_in)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("letters, seed", [("ab", 1), ("aé×c", 2)])
def test_variants_equal_brute_force(spark, letters, seed):
    rnd = random.Random(seed)
    words = []
    for times in (180, 30, 5, 6):  # words, variants of words and variants of these
        level = {"".join(rnd.choices(letters, k=rnd.randint(5, 9))) for _ in range(12)}
        level |= {w[:i] + rnd.choice(letters) + w[i + rnd.randint(0, 1) :] for w in set(words) for i in [rnd.randrange(len(w))]}
        words += [w for w in sorted(level) for _ in range(times)]
    rnd.shuffle(words)
    rows = [(i, " ".join(words[i::150])) for i in range(150)]
    want = brute_variants(brute_words(rows, 13), 5)
    assert variants_of(spark, rows, 13) == want
    assert sum(r[1] is not None for r in want) > 5 and any(r[2] not in (r[0], r[1]) for r in want)


def test_variants_equal_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.op13_permuterm_variants(spark, SF)
    want = con.sql(queries.OP13_SQL)
    assert sorted(want.columns) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(want.fetchall())


def test_negatives_equal_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = queries.op11_threshold_negatives(spark, SF)
    want = con.sql(queries.OP11_SQL)
    assert sorted(want.columns) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(want.fetchall())


def test_variants_edges(spark):
    rows = [(1, None), (2, ""), (None, "Aaaaaa " * 5), (3, "aaaaaaa_" * 30), (3, "aaaaaaaaß9aaaaaaaaß " * 3), (4, "x" * 300000), (5, "É" * 6 + " 中" + "É" * 6), (5, "ÉÉÉÉÉÉ " * 3)]
    rows += [(6, "hunderd hundred " * 5 + "hundred " * 40 + "hundreds " * 6)]
    assert variants_of(spark, rows) == brute_variants(brute_words(rows, None))
    assert variants_of(spark, []) == set()
    long = [(i, ("qwe" * 10000 + "z" * (i % 2) + " ") * 3) for i in range(4)]
    assert {(len(r[0]), r[3], r[4]) for r in variants_of(spark, long)} == {(30000, 6, 1), (30001, 6, 1)}


def test_variants_of_words_about_the_length_of_digests(spark):
    rnd = random.Random(4)
    words = {}
    for size in (62, 63, 64, 65, 66, 200):
        word = "".join(rnd.choices("ab", k=size))
        for _ in range(12):
            at = rnd.randrange(size)
            words[word] = 5 ** rnd.randint(1, 4)
            word = rnd.choice([word[:at] + word[at + 1 :], word[:at] + "c" + word[at + 1 :], word[:at] + rnd.choice("ab") + word[at:]])
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variants(df).collect()} == brute_variants(words)


def test_variants_with_clashing_columns(spark):
    rows = [(1, "colour color colour color colour color colour color colour color " + "colour " * 30, "w", 1)]
    got = variants_of(spark, rows, schema="doc_id long, text string, word string, n int")
    assert got == {("colour", None, "colour", 35, 0, None)}
