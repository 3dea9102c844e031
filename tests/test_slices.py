"""Reports in stored steps at size: few shuffles a step, joins of stored sides in slices of their keys, narrowed drill-downs."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from procura import session
from procura.operators import drill, lineage_chain
from procura.operators.joins import lineage_parts
from procura.plans.reports import report_blanket, report_standard, report_union
from procura.queries import OPERATOR_QUERIES, REPORT_QUERIES
from procura.session import MOST_SLICES, Steps, checkpoint_dir, in_slice
from tests.p2p_fixture import AS_OF, ROWS, golden_tables


def _rows(df) -> list[str]:
    return sorted(map(repr, df.collect()))


def _stored(spark) -> set[str]:
    top = f"{checkpoint_dir(spark).removeprefix('file:')}/procura"
    return set(os.listdir(top)) if os.path.isdir(top) else set()


@pytest.fixture(scope="module")
def odd_tables(spark):
    """The golden tables with rows that come twice and rows without a key, on every sliced side."""
    return golden_tables(spark, {
        "po_line_locations": [*ROWS["po_line_locations"], ROWS["po_line_locations"][0], (None, ROWS["po_line_locations"][0][1], *ROWS["po_line_locations"][0][2:])],
        "po_distributions": [*ROWS["po_distributions"], (1111, 111, 9001, 500, None, None), (1112, 111, None, None, None, None), (7777, None, 9001, None, None, None)],
        "req_distributions": [*ROWS["req_distributions"], (9001, 9000), (None, 9000)],
        "rcv_transactions": [*ROWS["rcv_transactions"], ROWS["rcv_transactions"][1]],
    })


@pytest.fixture
def sliced(monkeypatch):
    """Every join of stored sides in as many slices as there are at most."""
    monkeypatch.setattr(session, "SLICE_BYTES", 1)


@pytest.mark.parametrize("build,how", [(report_blanket, {}), (report_standard, {"dedupe_rfq": True}), (report_union, {})])
def test_slices_give_the_same_rows(spark, odd_tables, sliced, build, how):
    before, steps = _stored(spark), Steps(spark)
    whole, cut = build(odd_tables, AS_OF, **how), build(odd_tables, AS_OF, keep=steps, **how)
    assert whole.schema == cut.schema or [(f.name, f.dataType) for f in whole.schema] == [(f.name, f.dataType) for f in cut.schema]
    assert _rows(whole) == _rows(cut)
    tags = sorted(n.partition("-")[0] for n in _stored(spark) - before if "repeated" not in n)
    kinds = {report_blanket: ["blanket"], report_standard: ["standard"], report_union: ["blanket", "standard"]}[build]
    assert tags == sorted(kinds * MOST_SLICES)  # the sides are gone


def test_slices_hold_every_key_once_and_grow_with_the_bytes(spark, monkeypatch):
    df = spark.range(1000).select(F.when(F.col("id") > 5, F.col("id")).alias("k"))
    assert sorted(r[0] or -1 for i in range(3) for r in df.where(in_slice("k", i, 3)).collect()) == sorted(r[0] or -1 for r in df.collect())
    steps = Steps(spark)
    steps(df, "few")
    assert steps.slices() == 1
    size = sum(os.path.getsize(f"{d}/{n}") for d, _, names in os.walk(steps.paths[0].removeprefix("file:")) for n in names if not n.endswith(".crc"))
    monkeypatch.setattr(session, "SLICE_BYTES", size // 2 + 1)
    assert steps.slices() == 2
    monkeypatch.setattr(session, "SLICE_BYTES", 1)
    assert steps.slices() == MOST_SLICES


def test_lineage_parts_are_the_chain(spark, sliced):
    steps = Steps(spark)
    a = spark.sql("select * from values (1, 'a'), (1, 'b'), (2, 'c'), (null, 'd') as t(pk, po)")
    b = spark.sql("select * from values (1, 'x'), (3, 'y'), (3, 'y'), (null, 'z') as t(prk, pr)")
    c = spark.sql("select * from values (1, 'q'), (1, 'r'), (2, 's'), (4, 't'), (null, 'u') as t(qk, rfq)")
    parts = list(lineage_parts(steps(a, "a"), steps(b, "b"), steps(c, "c"), "pk", "prk", "qk", steps))
    assert len(parts) == MOST_SLICES
    cols = ["pk", "po", "prk", "pr", "qk", "rfq"]
    assert sorted(r for p in parts for r in _rows(p.select(*cols))) == _rows(lineage_chain(a, b, c, "pk", "prk", "qk").select(*cols))


@pytest.mark.parametrize("only", [
    {"PO Type (Blanket/Standard)": "BLANKET", "BR Status - Blanket": "APPROVED"}, {"PO ORDER CURRENCY": "USD", "Inspection Flag": "No"},
])
def test_only_makes_the_rows_that_drill_keeps(spark, odd_tables, only):
    narrowed = report_union(odd_tables, AS_OF, keep=Steps(spark), only=only)
    assert _rows(drill(report_union(odd_tables, AS_OF), **only)) == _rows(narrowed)


def test_drill_down_is_made_in_steps_of_the_rows_it_keeps(spark, sf_small):
    before = _stored(spark)
    df = OPERATOR_QUERIES["drill_down"](spark, sf_small)
    read = df.inputFiles()
    assert read and all("/procura/" in f for f in read)
    # no standard order has a release status: that report is not made
    assert {n.partition("-")[0] for n in _stored(spark) - before} == {"lines", "blanket", "repeated"}
    lines = [f for f in read if "/blanket-" in f]
    assert spark.read.parquet(*lines).count() >= df.count() > 0
    assert {r[0] for r in spark.read.parquet(*lines).select("PO Type (Blanket/Standard)").distinct().collect()} == {"BLANKET"}


@pytest.mark.parametrize("name,most", [("report_blanket", 18), ("preview_top", 18)])
def test_a_step_has_few_shuffles(spark, sf_small, monkeypatch, name, most):
    """All shuffles of a plan are on disk until it ends: no step of a report may have many."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    counts, store = {}, session.stored

    def counted(df, path):
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts[path.rpartition("/")[2].partition("-")[0]] = plan.count("Exchange hash")
        return store(df, path)

    monkeypatch.setattr(session, "stored", counted)
    try:
        {**OPERATOR_QUERIES, **REPORT_QUERIES}[name](spark, sf_small)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert len(counts) > 15 and max(counts.values()) <= most, counts
