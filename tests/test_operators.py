"""Operator unit tests on tiny inline rows: NULL, tie, duplicate and empty
edges named in SURVEY §2 (D6–D17, E1–E6, F1, G1)."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from procura.functions import as_of_lit
from procura.operators import (
    anti_exists,
    child_sum,
    dated_join,
    dated_lookup,
    first_event,
    full_outer,
    keyed_join,
    keyed_join_named,
    last_action_rows,
    latest_per_key,
    left_join_splittable,
    lineage_chain,
    ordered_listagg,
    scalar_lookup,
    semi_in,
    union_distinct,
)
from procura.operators.joins import same


def _key(t):
    return tuple((v is None, "" if v is None else v) for v in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_scalar_lookup_zero_one_many(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 30)], "id int, k int")
    dim = spark.createDataFrame([(10, "a"), (20, "b"), (20, "c"), (99, "x"), (99, "y")], "k2 int, v string")
    ok = scalar_lookup(fact.where("id <> 2"), dim, "k", "k2", {"v": "v"})
    # key 99 is duplicated but never met: no error; missing key → NULL
    assert rows(ok, "id", "v") == [(1, "a"), (3, None), (4, None)]
    with pytest.raises(Exception, match="more than one row"):
        scalar_lookup(fact, dim, "k", "k2", {"v": "v"}).collect()
    lenient = scalar_lookup(fact, dim, "k", "k2", {"v": "v"}, strict=False)
    assert lenient.count() == 4


def test_keyed_join_null_keys_kept_and_unmatched(spark):
    left = spark.createDataFrame([(1, 1), (2, None), (3, None)], "id int, k int")
    right = spark.createDataFrame([(1, "a"), (None, "n")], "rk int, v string")
    out = keyed_join(left, right, "k", "rk", "left")
    assert rows(out, "id", "v") == [(1, "a"), (2, None), (3, None)]
    full = keyed_join(left, right, "k", "rk", "full")
    assert rows(full.fillna(-1, ["id"]), "id", "v") == [(-1, "n"), (1, "a"), (2, None), (3, None)]


def test_salt_is_a_join_key_not_a_filter(spark):
    # regression: a literal salt on the right side gets folded away by the
    # optimizer, leaving NULL keys unspread
    left = spark.createDataFrame([(1, 1)], "id int, k int")
    right = spark.createDataFrame([(1, "a")], "rk int, v string")
    plan = keyed_join(left, right, "k", "rk", "left")._jdf.queryExecution().optimizedPlan().toString()
    join = next(ln for ln in plan.splitlines() if "Join LeftOuter" in ln)
    assert "pmod(xxhash64(rk" in join and "CASE WHEN isnull(k" in join


def _skewed(spark):
    """Join settings under which AQE splits a hot partition of a small test; returns the old values."""
    new = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("hot_side", ["receipts", "distributions"])
def test_splittable_left_join_splits_a_hot_key_on_either_side(spark, hot_side):
    old = _skewed(spark)
    try:
        n = 60_000
        key = F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id") % 400)
        loc = spark.range(400).select(F.col("id").alias("loc"), F.col("id").alias("hdr"))
        few = spark.range(300).select(F.col("id").alias("f_loc"), F.col("id").alias("fv"))
        many = spark.range(0, n, 1, 8).select(key.alias("m_loc"), F.col("id").alias("mv"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        no_few = loc.select(F.col("loc").alias("k")).join(few, F.col("k") == F.col("f_loc"), "left_anti")
        no_many = loc.select(F.col("loc").alias("k")).join(many, F.col("k") == F.col("m_loc"), "left_anti")
        first = (few, "f_loc", no_few), (many, "m_loc", no_many)
        out = loc
        for right, k, without in first if hot_side == "distributions" else first[::-1]:
            out = left_join_splittable(out, right, "loc", k, without, {"loc": "k"})
        assert out.where("mv is not null").count() == n
        plain = out.select("loc", "fv", "mv", "pad")
        assert len(plain.collect()) == n + no_many.count()
        assert "skew=true" in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)


def _hot(spark, n, key, value):
    """``n`` rows with a wide column, half of them of key 5, some of no key."""
    k = F.when(F.col("id") % 2 == 0, F.lit(5)).when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.col("id") % 700)
    return spark.range(0, n, 1, 8).select(k.cast("bigint").alias(key), F.col("id").alias(value), F.sha2(F.col("id").cast("string"), 256).alias(f"{value}_pad"))


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_full_outer_splits_a_hot_key_on_either_side(spark, hot_side):
    old = _skewed(spark)
    try:
        n = 60_000
        few = spark.range(300, 1000).select(F.col("id").alias("fk"), F.col("id").alias("fv")).union(spark.createDataFrame([(5, -5), (None, -1)], "fk long, fv long"))
        many = _hot(spark, n, "mk", "mv")
        out = full_outer(many, few, "mk", "fk") if hot_side == "left" else full_outer(few, many, "fk", "mk")
        lonely = few.join(many, F.col("fk") == F.col("mk"), "left_anti").count(), many.join(few, F.col("fk") == F.col("mk"), "left_anti").count()
        assert lonely[0] > 300 and lonely[1] > 10_000
        assert len(out.collect()) == n + lonely[0]
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        assert (out.where("mv is null").count(), out.where("fv is null").count()) == lonely
    finally:
        _restore(spark, old)


def test_lineage_chain_splits_many_rfq_lines_of_one_requisition_distribution(spark):
    old = _skewed(spark)
    try:
        n = 60_000
        po = spark.range(100, 300).select(F.col("id").alias("po_key"), F.col("id").alias("po"))
        pr = spark.range(0, 200).select(F.col("id").alias("pr_key"), F.col("id").alias("pr"))
        out = lineage_chain(po, pr, _hot(spark, n, "rfq_key", "rfq"), "po_key", "pr_key", "rfq_key")
        assert out.where("rfq is not null").count() == n
        assert len(out.collect()) == n + out.where("rfq is null").count()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)


def _null_safe(df, *cols):
    return sorted(map(str, df.select(*cols).collect()))


def test_full_outer_equals_a_full_join_on_nulls_repeats_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"), (9, None)], "lk int, lv string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n"), (3, "z")], "rk int, rv string")
    cols = ["lk", "lv", "rk", "rv"]
    for a in (left, left.limit(0)):
        for b in (right, right.limit(0)):
            assert _null_safe(full_outer(a, b, "lk", "rk"), *cols) == _null_safe(a.join(b, a["lk"] == b["rk"], "full"), *cols)


def test_keyed_join_named_equals_the_residual_or(spark):
    left = spark.createDataFrame([(1, 1, 10), (2, 1, None), (3, 2, 20), (4, None, None), (5, None, 10), (6, 3, 99), (7, 1, 10), (8, 4, None)], "id int, lk int, ln int")
    right = spark.createDataFrame([(1, 10, "a"), (1, 11, "b"), (2, 21, "c"), (None, 10, "d"), (1, None, "e"), (1, 10, "f"), (3, 99, None)], "rk int, rn int, v string")
    want = left.join(right, (left["lk"] == right["rk"]) & ((left["ln"] == right["rn"]) | left["ln"].isNull()), "left")
    got = keyed_join_named(left, right, "lk", "rk", "ln", "rn")
    assert got.columns == want.columns and _null_safe(got, *want.columns) == _null_safe(want, *want.columns)
    inner = keyed_join_named(left, right, "lk", "rk", "ln", "rn", "inner")
    assert _null_safe(inner, *want.columns) == _null_safe(want.where("rk is not null"), *want.columns)


def test_keyed_join_named_compares_no_more_pairs_than_match(spark):
    # one location with n receipts that name one of its n distributions each: a residual OR would compare n * n pairs
    n = 20_000
    left = spark.range(n).select(F.lit(1).alias("lk"), F.col("id").alias("ln"))
    right = spark.range(n).select(F.lit(1).alias("rk"), F.col("id").alias("rn"))
    out = keyed_join_named(left, right, "lk", "rk", "ln", "rn", "inner")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    join = next(ln for ln in plan.splitlines() if "Join Inner" in ln)
    assert " OR " not in join and "<=>" in join
    assert out.count() == n


def test_splittable_left_join_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([(1, 7, None), (2, None, None), (3, None, 4), (4, 8, 5), (5, 8, None), (6, 9, 1)], "id int, k int, n int")
    right = spark.createDataFrame([(7, None, "a"), (8, 5, "b"), (None, 4, "c"), (8, None, "d")], "rk int, rn int, v string")
    on = (left["k"] == right["rk"]) & left["n"].eqNullSafe(right["rn"])
    want = left.join(right, on, "left")
    without = left.select(F.col("k").alias("u"), F.col("n").alias("un")).join(right, (F.col("u") == F.col("rk")) & F.col("un").eqNullSafe(F.col("rn")), "left_anti").distinct()
    got = left_join_splittable(left, right, "k", "rk", without, {"k": "u", "n": "un"}, also={"n": "rn"})
    assert got.columns == want.columns and _null_safe(got, *want.columns) == _null_safe(want, *want.columns)


def test_full_outer_forces_no_join_strategy(spark):
    old = _skewed(spark)
    try:
        a, b = spark.range(10).toDF("k"), spark.range(5, 15).toDF("rk")
        out = full_outer(a, b, "k", "rk")
        assert "ShuffledHashJoin" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 15
    finally:
        _restore(spark, old)


def test_full_outer_and_lineage_chain(spark):
    po = spark.createDataFrame([(1, 100), (2, None), (3, 300)], "po int, pk int")
    pr = spark.createDataFrame([(100, "p1"), (200, "p2"), (None, "p3")], "prk int, prv string")
    rfq = spark.createDataFrame([(200, "q2"), (300, "q3"), (999, "q9")], "qk int, qv string")
    out = lineage_chain(po, pr, rfq, "pk", "prk", "qk")
    got = rows(out.fillna(-1, ["po"]), "po", "prv", "qv")
    # PO 3 has key 300 but no PR: it must not meet RFQ 300 (keyed on PR side)
    assert got == sorted([(1, "p1", None), (2, None, None), (3, None, None), (-1, "p2", "q2"), (-1, "p3", None),
                          (-1, None, "q3"), (-1, None, "q9")], key=_key)
    assert full_outer(po, pr, "pk", "prk").count() == 5


def test_dated_join_restricts_dimension(spark):
    fact = spark.createDataFrame([(1, 5), (2, 6)], "id int, p int")
    dim = spark.createDataFrame(
        [(5, dt.datetime(1990, 1, 1), dt.datetime(2000, 1, 1), "old"), (6, dt.datetime(1990, 1, 1), dt.datetime(1991, 1, 1), "gone")],
        "pid int, s timestamp_ntz, e timestamp_ntz, name string")
    out = dated_join(fact, dim, "p", "pid", as_of_lit("1998-06-15 10:00:00"), "s", "e")
    assert rows(out, "id", "name") == [(1, "old"), (2, None)]


def test_dated_lookup_per_row_and_strict(spark):
    fact = spark.createDataFrame(
        [(1, 5, dt.datetime(1997, 12, 31)), (2, 5, dt.datetime(1998, 1, 1)), (3, 7, dt.datetime(1998, 1, 1))],
        "id int, u int, d timestamp_ntz")
    dim = spark.createDataFrame(
        [(5, dt.datetime(1990, 1, 1), dt.datetime(1997, 12, 31), "A"), (5, dt.datetime(1998, 1, 1), dt.datetime(4712, 12, 31), "B")],
        "uid int, s timestamp_ntz, e timestamp_ntz, name string")
    out = dated_lookup(fact, dim, "u", "uid", "d", "s", "e", {"name": "name"})
    assert rows(out, "id", "name") == [(1, "A"), (2, "B"), (3, None)]
    overlap = dim.union(spark.createDataFrame([(5, dt.datetime(1997, 6, 1), dt.datetime(1998, 6, 1), "C")], dim.schema))
    with pytest.raises(Exception, match="more than one row"):
        dated_lookup(fact, overlap, "u", "uid", "d", "s", "e", {"name": "name"}).collect()


def test_dated_lookup_equals_brute_force(spark):
    day = lambda n: dt.datetime(2000, 1, 1) + dt.timedelta(days=n)
    rnd = random.Random(7)
    versions = [(u, rnd.randrange(60), rnd.randrange(60), f"{u}-{i}") for u in range(12) for i in range(rnd.randrange(5))]
    versions += [(20, 0, 50, "long"), (20, 10, 10, "one day"), (21, 5, 9, "same"), (21, 5, 9, "same again"), (None, 0, 60, "nobody"), (22, None, 9, "no start"), (22, 0, None, "no end")]
    facts = [(i, rnd.choice([*range(12), 20, 21, 22, 23, None]), rnd.choice([*range(-1, 61), None])) for i in range(400)]
    facts += [(1000, 20, 9), (1001, 20, 10), (1002, 20, 11), (1003, 21, 4), (1004, 21, 5), (1005, 21, 9), (1006, 21, 10)]
    as_day = lambda n: None if n is None else day(n)
    dim = spark.createDataFrame([(u, as_day(s), as_day(e), v) for u, s, e, v in versions], "uid int, s timestamp_ntz, e timestamp_ntz, name string")
    fact = spark.createDataFrame([(i, u, as_day(n)) for i, u, n in facts], "id int, u int, d timestamp_ntz")
    valid = {i: [v for w, s, e, v in versions if None not in (u, w, n, s, e) and u == w and s <= n <= e] for i, u, n in facts}
    assert {len(v) for v in valid.values()} >= {0, 1, 2}
    lax = {r["id"]: r["name"] for r in dated_lookup(fact, dim, "u", "uid", "d", "s", "e", {"name": "name"}, strict=False).collect()}
    assert set(lax) == set(valid) and all(lax[i] in v if v else lax[i] is None for i, v in valid.items())
    clear = fact.where(F.col("id").isin([i for i, v in valid.items() if len(v) < 2]))
    got = {r["id"]: r["name"] for r in dated_lookup(clear, dim, "u", "uid", "d", "s", "e", {"name": "name"}).collect()}
    assert got == {i: (v[0] if v else None) for i, v in valid.items() if len(v) < 2}
    for i in (1001, 1004, 1005):
        with pytest.raises(Exception, match="more than one row"):
            dated_lookup(fact.where(F.col("id") == i), dim, "u", "uid", "d", "s", "e", {"name": "name"}).collect()
    assert dated_lookup(fact, dim.limit(0), "u", "uid", "d", "s", "e", {"name": "name"}).where("name is not null").count() == 0
    assert dated_lookup(fact.limit(0), dim, "u", "uid", "d", "s", "e", {"name": "name"}).count() == 0


def test_dated_lookup_compares_no_version_with_all_days(spark):
    # one user with 20,000 versions and 20,000 days: 4e8 pairs if every version met every day
    base = F.lit(dt.datetime(1900, 1, 1))
    n = spark.range(20000).select(F.lit(1).alias("u"), (base + F.make_dt_interval(F.col("id"))).alias("d"), "id")
    dim = n.select(F.col("u").alias("uid"), F.col("d").alias("s"), F.col("d").alias("e"), F.col("id").cast("string").alias("name"))
    out = dated_lookup(n, dim, "u", "uid", "d", "s", "e", {"name": "name"})
    assert out.where(F.col("name") == F.col("id").cast("string")).count() == 20000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "<=" in line]


def test_last_action_rows_max_over_all_types_and_ties(spark):
    h = spark.createDataFrame(
        [(1, "REQ", 1, "x"), (1, "REQ", 3, None), (1, "REL", 3, None), (2, "REQ", 2, None), (2, "REL", 5, "y")],
        "obj int, typ string, seq int, act string")
    last = last_action_rows(h, "obj", "seq")
    assert rows(last, "obj", "typ", "seq") == [(1, "REL", 3), (1, "REQ", 3), (2, "REL", 5)]
    # filtering the type after the max: object 2 has no pending REQ row
    assert rows(last.where("typ = 'REQ' and act is null"), "obj") == [(1,)]


def test_last_action_rows_reduce_a_hot_key_before_the_one_shuffle(spark, tmp_path):
    # one id holds a third of the rows, and neither null ids nor null numbers have a last action
    h = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 5000).alias("obj"),
        F.when(F.col("id") % 50 == 2, None).otherwise(F.col("id") % 97).cast("int").alias("seq"), F.col("id").alias("row"))
    h.write.parquet(f"{tmp_path}/h")
    h = spark.read.parquet(f"{tmp_path}/h")
    last = last_action_rows(h, "obj", "seq")
    best: dict = {}
    for r in h.collect():
        if r["obj"] is not None and r["seq"] is not None and r["seq"] >= best.get(r["obj"], (-1, []))[0]:
            held = best.get(r["obj"], (-1, []))
            best[r["obj"]] = (r["seq"], (held[1] if held[0] == r["seq"] else []) + [r["row"]])
    assert rows(last, "row") == sorted((i,) for _, ids in best.values() for i in ids) and len(best[7][1]) > 50
    plan = last_action_rows(h, "obj", "seq")._jdf.queryExecution().executedPlan().toString()
    # the limit stands on both sides of the only exchange, over the only scan
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit") < plan.index("FileScan")


def test_first_event_and_child_sum(spark):
    h = spark.createDataFrame([(1, "APPROVE", dt.datetime(2000, 1, 5)), (1, "APPROVE", dt.datetime(2000, 1, 2)), (1, "SUBMIT", dt.datetime(1999, 1, 1))],
                              "obj int, act string, d timestamp_ntz")
    fe = first_event(h, "obj", "d", F.col("act") == "APPROVE", "first")
    assert fe.first()["first"] == dt.datetime(2000, 1, 2)
    kids = spark.createDataFrame([(10, 2, "ACCEPT"), (10, 3, "REJECT"), (10, 9, "DELIVER"), (None, 1, "ACCEPT")], "parent int, q int, t string")
    s = child_sum(kids, "parent", "q", F.col("t").isin("ACCEPT", "REJECT"), "inspected")
    assert rows(s, "parent", "inspected") == [(10, 5)]


def test_semi_and_anti(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (1,)], "bk int")
    assert rows(semi_in(a, b, "k", "bk"), "k") == [(1,)]  # duplicates never multiply
    assert rows(anti_exists(a, b, "k", "bk").fillna(-1), "k") == [(-1,), (2,)]  # NULL key kept by NOT EXISTS


def test_listagg_sorted_skips_nulls_keeps_duplicates(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, e string")
    assert rows(ordered_listagg(df, "k", "e", "l"), "k", "l") == [(1, "a, b, b"), (2, None)]


def test_latest_per_key_desc_nulls_first(spark):
    df = spark.createDataFrame([(1, 1, dt.datetime(2000, 1, 1)), (1, 2, None), (2, 3, dt.datetime(2000, 1, 1)), (2, 4, dt.datetime(2001, 1, 1))],
                               "k int, id int, d timestamp_ntz")
    assert rows(latest_per_key(df, "k", "d", tie_break=["id"]), "k", "id") == [(1, 2), (2, 4)]
    assert rows(latest_per_key(df, "k", "d", nulls_first=False, tie_break=["id"]), "k", "id") == [(1, 1), (2, 4)]


def test_union_distinct_across_and_within(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    b = spark.createDataFrame([(1, None), (3, "y")], "a int, b string")
    assert union_distinct(a, b).count() == 3
