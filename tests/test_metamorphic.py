"""Metamorphic tests: the plan rewrites equal the textbook join order on
random NULL-heavy data, and NULL keys really spread."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from procura.operators import keyed_join, left_join_splittable, lineage_chain
from procura.operators.joins import same

keys = st.one_of(st.none(), st.integers(0, 4))
settings_ = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _same_rows(a, b) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@settings_
@given(st.lists(st.tuples(st.integers(0, 99), keys), max_size=8),
       st.lists(st.tuples(keys, st.integers(0, 99)), max_size=8),
       st.lists(st.tuples(keys, st.integers(0, 99)), max_size=8))
def test_full_joins_associate(spark, po, pr, rfq):
    """(PO ⟗ PR) ⟗ RFQ keyed on the PR side == PO ⟗ (PR ⟗ RFQ)."""
    a = spark.createDataFrame(po, "po_id int, po_k int")
    b = spark.createDataFrame(pr, "pr_k int, pr_v int")
    c = spark.createDataFrame(rfq, "q_k int, q_v int")
    naive = a.join(b, a.po_k == b.pr_k, "full").join(c, b.pr_k == c.q_k, "full")
    ours = lineage_chain(a, b, c, "po_k", "pr_k", "q_k")
    cols = ["po_id", "po_k", "pr_k", "pr_v", "q_k", "q_v"]
    assert _same_rows(naive.select(*cols), ours.select(*cols))


@settings_
@given(st.lists(st.tuples(st.integers(0, 9), keys, keys), max_size=8),
       st.lists(st.tuples(keys, keys, st.integers(0, 9)), max_size=8),
       st.lists(st.tuples(keys, st.integers(0, 9)), max_size=8))
def test_splittable_left_joins_equal_textbook(spark, left, rts, dists):
    """left_join_splittable, twice on one key, == consecutive left joins
    (receipt with its residual condition, then distribution)."""
    l_ = spark.createDataFrame(left, "loc_row int, loc int, hdr int").where("loc is not null")
    r = spark.createDataFrame(rts, "r_loc int, r_hdr int, r_v int")
    d = spark.createDataFrame(dists, "d_loc int, d_v int")
    naive = l_.join(r, (l_.loc == r.r_loc) & (l_.hdr == r.r_hdr), "left").join(d, l_.loc == d.d_loc, "left")
    key = l_.selectExpr("loc as k_loc", "hdr as k_hdr").distinct()
    no_r = key.join(r, (key.k_loc == r.r_loc) & (key.k_hdr == r.r_hdr), "left_anti")
    no_d = key.select("k_loc").distinct().join(d, F.col("k_loc") == d.d_loc, "left_anti")
    ours = left_join_splittable(l_, r, "loc", "r_loc", no_r, {"loc": "k_loc", "hdr": "k_hdr"}, same("hdr", "r_hdr"))
    ours = left_join_splittable(ours, d, "loc", "d_loc", no_d, {"loc": "k_loc"})
    cols = ["loc_row", "loc", "hdr", "r_loc", "r_hdr", "r_v", "d_loc", "d_v"]
    assert _same_rows(naive.select(*cols), ours.select(*cols))


@settings_
@given(st.lists(st.tuples(st.integers(0, 9), keys), max_size=10), st.lists(st.tuples(keys, st.integers(0, 9)), max_size=6))
def test_salted_left_join_equals_plain(spark, left, right):
    l_ = spark.createDataFrame(left, "id int, k int")
    r = spark.createDataFrame(right, "rk int, v int")
    plain = l_.join(r, l_.k == r.rk, "left")
    assert _same_rows(plain, keyed_join(l_, r, "k", "rk", "left").select(*plain.columns))


def test_null_keys_spread_over_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(20000).select(F.col("id"), F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))
        right = spark.range(0, 20000, 10).select(F.col("id").alias("rk"))
        out = keyed_join(left, right, "k", "rk", "left")
        per_part = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        # 90% of the rows have a NULL key; without the salt they would all
        # land in one partition
        assert max(r["count"] for r in per_part) < 0.5 * 20000
        assert out.count() == 20000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
