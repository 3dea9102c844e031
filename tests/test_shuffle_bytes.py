"""What the reports move between stages: lines once, no idle ids, no rows of the other order type."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from procura.plans.blocks import pr_block, receipt_chain
from procura.plans.reports import report_blanket, report_standard
from procura.sources.derived import derived_tables
from tests.p2p_fixture import AS_OF, golden_tables


@pytest.fixture
def static(spark):
    """Plans as they run, without the adaptive wrapper and without broadcasts."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in keep.items():
        spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _moved(df, key: str) -> list[str]:
    """Columns of the child of every exchange by ``key``."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        if p.nodeName() == "Exchange" and re.search(rf"hashpartitioning\([^,]*\b{key}#", p.toString().splitlines()[0]):
            found.append(p.output().mkString(" "))
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found


def test_line_tables_read_one_shuffle(static, sf_small):
    def exchanges(**how):
        t = derived_tables(static, sf_small, ("po_lines", "req_lines", "rcv_shipment_lines"), **how)
        plan = _plan(t["po_lines"].select("po_line_id").union(t["req_lines"].where("line_num > 2").select("item_id")).union(t["rcv_shipment_lines"].select("item_id")))
        return plan.count("Exchange hash"), plan.count("ReusedExchange")

    assert exchanges() == (3, 0)
    assert exchanges(share_lines=True) == (3, 2)  # a reused one names the one that it reads


def test_shared_lines_give_the_same_rows(spark, sf_small):
    own, shared = derived_tables(spark, sf_small), derived_tables(spark, sf_small, share_lines=True)
    for name in ("po_distributions", "rcv_transactions", "req_lines", "rfq_backing_reqs"):
        assert own[name].schema == shared[name].schema
        assert own[name].exceptAll(shared[name]).count() == shared[name].exceptAll(own[name]).count() == 0


@pytest.mark.parametrize("build", [report_blanket, report_standard])
def test_order_rows_move_without_idle_ids(static, build):
    plan = build(golden_tables(static), AS_OF)
    orders = [c for c in _moved(plan, "plla_line_location_id") if "pha_segment1" in c]
    assert len(orders) == 2
    idle = ("pha_vendor_id", "rt_parent_transaction_id", "rt_organization_id", "rsl_last_updated_by", "rsl_item_id", "rsh_shipment_header_id")
    assert not [c for c in idle if any(c in columns for columns in orders)]


def test_header_columns_move_with_no_requisition_line(static):
    moved = _moved(pr_block(golden_tables(static), AS_OF, sourced=False), "porla_[a-z_]+")
    assert len(moved) == 4 and not [c for c in moved if "porha_" in c]


@pytest.mark.parametrize("kind", ["STANDARD", "BLANKET"])
def test_receipts_of_the_other_order_type_are_left_out(spark, kind):
    t = golden_tables(spark)
    of_kind = t["po_line_locations"].join(t["po_lines"], "po_line_id").join(t["po_headers"].where(F.col("type_lookup_code") == kind), "po_header_id")
    wanted = {r[0] for r in of_kind.select("line_location_id").collect()}
    every = t["rcv_transactions"].select("transaction_id", "po_line_location_id").collect()
    got = receipt_chain(t, AS_OF, kind).select("rt_transaction_id").distinct().collect()
    assert {r[0] for r in got} == {r["transaction_id"] for r in every if r["po_line_location_id"] in wanted} != {r["transaction_id"] for r in every}
