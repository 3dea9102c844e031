"""Physical-plan checks: no Cartesian products or nested-loop
joins anywhere in the reports, and drill-down predicates reach the Parquet
scan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from procura.operators import drill
from procura.plans import drilldown
from procura.plans.blocks import distribution_chain, inspection_pending, po_pending_with, pr_pending_with
from procura.plans.drilldown import narrowed
from procura.plans.reports import report_blanket, report_standard, report_union
from procura.sources.derived import derived_tables
from procura.sources.tables import TABLES, load_tables
from tests.p2p_fixture import AS_OF, golden_tables
from tests.test_operators import _restore, _skewed


@pytest.fixture(scope="module")
def parquet_tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("p2p"))
    for name, df in golden_tables(spark).items():
        df.write.parquet(f"{root}/{name}.parquet")
    return load_tables(spark, root, empty_as_null=False)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("build", [report_blanket, report_standard, report_union])
def test_no_cartesian_or_nested_loop(parquet_tables, build):
    plan = _plan(build(parquet_tables, AS_OF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_drill_down_pushes_to_scan(spark, parquet_tables):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        rep = drill(report_standard(parquet_tables, AS_OF), **{"PO Number": "P1"})
        scans = [ln for ln in _plan(rep).splitlines() if "FileScan" in ln and "po_headers.parquet" in ln]
        assert scans and all("EqualTo(type_lookup_code,STANDARD)" in ln for ln in scans)
        # the narrow key plans read no number; document drill-downs narrow them by id instead
        wide = [ln for ln in scans if "segment1:string" in ln]
        assert wide and all("EqualTo(segment1,P1)" in ln for ln in wide)
        assert rep.count() > 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.maxMetadataStringLength", "100")


def test_scans_read_only_needed_columns(parquet_tables):
    plan = _plan(report_blanket(parquet_tables, AS_OF).select("PO Number", "PR_Number"))
    # the wide invoice/check tables are not needed for these two columns'
    # values, but the joins that shape the rows still read their keys only
    assert "ReadSchema: struct<check_id:bigint,check_date" not in plan


@pytest.mark.parametrize("column,value", [("PO Number", "4000030"), ("PR_Number", "1000054"), ("Invoice Number", "INV-90"), ("DISTRIBUTION_ID", 115111)])
def test_document_drill_down_reduces_the_fact_tables(spark, sf_small, column, value):
    t = derived_tables(spark, sf_small)
    small = narrowed(t, column, value)
    for name in ("rcv_transactions", "invoice_distributions", "po_distributions", "req_distributions", "po_action_history"):
        assert small[name].count() < 0.05 * t[name].count()
    assert "IN (" in _plan(small["rcv_transactions"]) or "=" in _plan(small["rcv_transactions"])


def test_document_drill_down_takes_three_jobs_and_handles_long_id_lists(spark, sf_small, monkeypatch):
    t = derived_tables(spark, sf_small)
    calls, collect = [], drilldown._found
    monkeypatch.setattr(drilldown, "_found", lambda frames: (calls.append(sorted(frames)), collect(frames))[1])
    short = {n: df.count() for n, df in narrowed(t, "PO Number", "4000030").items() if n in ("rcv_transactions", "invoices", "req_headers", "checks")}
    assert len(calls) == 3
    monkeypatch.setattr(drilldown, "LITERAL_IDS", 1)  # id sets stay frames
    assert short == {n: df.count() for n, df in narrowed(t, "PO Number", "4000030").items() if n in short} and min(short.values()) > 0


def test_inspection_lists_never_join_receipts_with_staff(parquet_tables):
    plan = inspection_pending(parquet_tables, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    # the staff branch (e-mail) is aggregated below the join that has the receipts
    top = plan.index("Join")
    assert plan.index("k6_pending_with") > 0 and "email" not in plan[:top]


def test_one_distribution_with_very_many_invoice_rows_is_split(spark):
    t = dict(golden_tables(spark))
    n, inv = 40_000, t["invoice_distributions"]
    some = next(r for r in inv.collect() if r["cancellation_flag"] == "N" and r["po_distribution_id"] is not None)
    given = {"invoice_id": F.col("id") + 10_000_000, "po_distribution_id": F.lit(some["po_distribution_id"]), "cancellation_flag": F.lit("N")}
    pad = F.sha2(F.col("id").cast("string"), 256)
    more = spark.range(0, n, 1, 8).select(*[given.get(f.name, pad if f.dataType.simpleString() == "string" else F.lit(None)).cast(f.dataType).alias(f.name) for f in inv.schema])
    t["invoice_distributions"] = inv.unionByName(more)
    old = _skewed(spark)
    try:
        out = distribution_chain(t, "STANDARD").select("pda_po_distribution_id", "aida_invoice_id", "aida_match_status_flag", "aia_invoice_num")
        got = out.collect()
        assert sum(r["pda_po_distribution_id"] == some["po_distribution_id"] for r in got) >= n
        assert {r["pda_po_distribution_id"] for r in got} == {r[0] for r in t["po_distributions"].select("po_distribution_id").collect()}
        assert "skew=true" in _plan(out)
    finally:
        _restore(spark, old)


def test_no_report_join_has_a_residual_or_on_distributions(parquet_tables):
    plan = report_blanket(parquet_tables, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    joins = [ln for ln in plan.splitlines() if "Join " in ln and "po_distribution_id" in ln and " OR isnull(rt_po_distribution_id" in ln]
    assert not joins


@pytest.mark.parametrize("kind", ["STANDARD", "BLANKET"])
def test_pending_lookups_scan_the_action_history_once(spark, parquet_tables, kind):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for lookup in (pr_pending_with(parquet_tables, AS_OF), po_pending_with(parquet_tables, AS_OF, kind)):
            assert sum("FileScan" in ln and "po_action_history" in ln for ln in _plan(lookup).splitlines()) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_all_tables_known():
    assert len(TABLES) == 38
