"""Whole reports in stored steps: the same rows, and the shuffles of one step on disk at a time."""

from __future__ import annotations

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from procura.operators import full_outer, sets, union_distinct, union_distinct_stored
from procura.plans.reports import report_blanket, report_standard, report_union
from procura.queries import OPERATOR_QUERIES, REPORT_QUERIES
from procura.session import Steps, checkpoint_dir
from procura.sources.derived import derived_tables
from tests.p2p_fixture import AS_OF, ROWS, golden_tables


def _same(a, b) -> None:
    assert a.columns == b.columns and [f.dataType for f in a.schema] == [f.dataType for f in b.schema]
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if re.match(r"shuffle_\d+_\d+_\d+\.data", n := files.apply(i).getName())}


def _stored(spark) -> set[str]:
    top = f"{checkpoint_dir(spark).removeprefix('file:')}/procura"
    return set(os.listdir(top)) if os.path.isdir(top) else set()


@pytest.fixture(scope="module")
def odd_tables(spark):
    """The golden tables with rows that come twice and rows without a key."""
    return golden_tables(spark, {
        "po_distributions": [*ROWS["po_distributions"], (1111, 111, 9001, 500, None, None), (1112, 111, None, None, None, None), (7777, None, 9001, None, None, None)],
        "req_distributions": [*ROWS["req_distributions"], (9001, 9000), (None, 9000)],
        "rcv_transactions": [*ROWS["rcv_transactions"], ROWS["rcv_transactions"][1]],
    })


@pytest.mark.parametrize("build,how", [(report_blanket, {}), (report_standard, {}), (report_union, {"variant": "legacy"})])
def test_steps_give_the_same_rows(spark, odd_tables, build, how):
    _same(build(odd_tables, AS_OF, **how), build(odd_tables, AS_OF, keep=Steps(spark), **how))


def test_lines_stored_give_the_same_rows(spark, sf_small):
    own, kept = derived_tables(spark, sf_small), derived_tables(spark, sf_small, keep=Steps(spark))
    for name in ("po_distributions", "rcv_transactions", "req_lines"):
        assert own[name].exceptAll(kept[name]).count() == kept[name].exceptAll(own[name]).count() == 0


def test_a_stored_step_leaves_no_shuffle_and_no_setting(spark):
    before, setting = _shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    kept = Steps(spark)(spark.range(0, 100_000, 1, 4).groupBy((F.col("id") % 5000).alias("k")).count(), "some")
    assert kept.count() == 5000
    until = time.time() + 20
    while (left := {f for f in _shuffle_files(spark) - before if not f.startswith("shuffle_0_")}) and time.time() < until:
        # the count's own shuffle may stay; the large one of the step goes
        if len(left) <= 1:
            break
        time.sleep(0.2)
    assert len(left) <= 1
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting


def test_inner_steps_are_dropped_and_outer_ones_stay(spark):
    before = _stored(spark)
    outer = Steps(spark)
    inner = outer.inner()
    kept = outer(inner(spark.range(5), "inside").where("id > 1"), "outside")
    inner.drop()
    assert [n.partition("-")[0] for n in _stored(spark) - before] == ["outside"] and kept.count() == 3


@pytest.mark.parametrize("name", ["preview_top", "report_union"])
def test_registered_reports_keep_only_what_their_result_reads(spark, sf_small, name):
    before = _stored(spark)
    df = {**OPERATOR_QUERIES, **REPORT_QUERIES}[name](spark, sf_small)
    left = {n.partition("-")[0] for n in _stored(spark) - before}
    assert left == ({"lines", "blanket", "standard", "repeated"} if "union" in name else {"lines", "orders", "requisitions"})
    read = df.inputFiles()
    assert read and all("/procura/" in f for f in read)


def test_rows_without_a_key_are_not_moved(spark):
    steps = Steps(spark)
    a = steps(spark.sql("select * from values (1, 'a'), (1, 'b'), (2, 'c'), (null, 'd'), (null, 'd') as t(ka, va)"), "a")
    b = steps(spark.sql("select * from values (1, 'x'), (3, 'y'), (null, 'z') as t(kb, vb)"), "b")
    again = full_outer(a, b, "ka", "kb", reread=True)
    _same(a.join(b, F.col("ka") == F.col("kb"), "full"), again)
    plan = again._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(ka" in plan and "isnull(kb" in plan  # a branch of their own, beside the join


@pytest.mark.parametrize("broadcast", [True, False])
def test_union_by_digest_is_the_distinct_union(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(sets, "BROADCAST_DIGESTS", 0)
    # the digest passes over nulls, so (1, null) and (null, 1) share one and must both stay
    a = spark.sql("select * from values (1, null, 'p'), (null, 1, 'p'), (2, 2, null), (2, 2, null) as t(x, y, z)")
    b = spark.sql("select * from values (1, null, 'p'), (3, 3, 'q'), (null, null, null), (null, null, null) as t(x, y, z)")
    out = union_distinct_stored(a, b, Steps(spark))
    _same(union_distinct(a, b), out)
    assert out.count() == 5
