"""Registered queries: the operators of SURVEY §2 exercised on the driver
tables, and the reports on the P2P tables Spark derives from them.

Every query reads whole tables of ``sf_dir``; no row caps or id subsets
(the only ``limit`` is the preview operator, where the top-k is the
feature). Modulo expressions below shape semantics (nullable keys, parent
links, rates), never sample rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.functions import as_of_lit, concat_code, convert_amount, day, decode, effective_on, flag_is, norm_text, open_interval_on
from procura.operators import (
    anti_exists,
    child_sum,
    dated_join,
    dated_lookup,
    drill,
    first_event,
    full_outer,
    keyed_join,
    keyed_join_named,
    last_action_rows,
    latest_per_key,
    lineage_chain,
    ordered_listagg,
    preview,
    scalar_lookup,
    semi_in,
    union_distinct,
)
from procura.plans.blocks import BLANKET, STANDARD, inspection_pending, invoice_chain, po_pending_with, pr_block, pr_pending_with, rfq_block
from procura.plans.drilldown import drill_document
from procura.plans.reports import DEFAULT_AS_OF, report_blanket, report_standard, report_union
from procura.session import Steps
from procura.sources.derived import derived_tables
from procura.sources.tables import load_tables

AS_OF = DEFAULT_AS_OF
#: Service notes whose verification note the blanket report leaves out.
EXCLUDED_SRNS = (7059, 7056, 7057)
#: Invented documents, one per kind of drill-down.
DRILL_DOCUMENTS = {
    "drill_po_release": {"PO Number": "4000019", "BR Number - Blanket": 2},
    "drill_po_line": {"PO Number": "4000030", "PO Line": 5},
    "drill_pr_line": {"PR_Number": "1000054", "PR_Line_No": 2},
    "drill_invoice": {"Invoice Number": "INV-90"},
    "drill_distribution": {"DISTRIBUTION_ID": 115111},
}
Query = Callable[[SparkSession, str], DataFrame]


def _report(report, **how) -> Query:
    """A whole report, made in stored steps if the session names a shared folder for them, else as one plan."""
    def run(spark, sf):
        named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
        steps = Steps(spark) if named else None
        return report(derived_tables(spark, sf, share_lines=True, keep=steps), AS_OF, keep=steps, **how)
    return run


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _dec(c, t="decimal(18,6)"):
    return F.col(c).cast(t)


# ---------------------------------------------------------------- projections

def amount_conversion(spark, sf):
    """Amounts, NVL defaults, CASE flags, rate NULL/0/2.6."""
    li = _t(spark, sf, "lineitem")
    rate = F.when(F.col("l_orderkey") % 3 == 0, F.lit(None)).when(F.col("l_orderkey") % 3 == 1, F.lit(0)).otherwise(F.lit(2.6)).cast("decimal(18,9)")
    amount = (_dec("l_extendedprice") * _dec("l_quantity", "decimal(20,6)")).cast("decimal(28,6)")
    cur = F.when(F.col("l_orderkey") % 4 == 0, F.lit(None)).otherwise(F.lit("OMR"))
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        amount.alias("line_amount"),
        F.coalesce(cur, F.lit("USD")).alias("currency"),
        convert_amount(amount, rate).alias("amount_usd"),
        F.when(F.col("l_returnflag") == "R", F.lit("Yes")).otherwise(F.lit("No")).alias("returned"),
        F.lit("LINE").alias("kind"),
    )


def decode_concat(spark, sf):
    """DECODE without default; dotted code where NULL is empty text."""
    p = _t(spark, sf, "part")
    seg2 = F.when(F.col("p_type") == "ECONOMY", F.lit(None)).otherwise(F.col("p_type"))
    seg3 = F.when(F.col("p_size") % 3 == 0, F.lit(None)).otherwise(F.col("p_size").cast("string"))
    return p.select(
        "p_partkey",
        decode("p_type", [("ECONOMY", "ECO"), ("SMALL", "SML")]).alias("type_code"),
        concat_code([F.col("p_brand"), seg2, seg3, F.lit(None).cast("string")]).alias("dotted"),
    )


def flag_filters(spark, sf):
    """Equality, IN, NOT IN and != on nullable columns, per-flag NULL
    policy (keep vs drop), disjunction."""
    li = _t(spark, sf, "lineitem")
    keep_flag = F.when(F.col("l_orderkey") % 3 == 0, F.lit(None)).when(F.col("l_orderkey") % 3 == 1, F.lit("Y")).otherwise(F.lit("N"))
    drop_flag = F.when(F.col("l_partkey") % 3 == 0, F.lit(None)).when(F.col("l_partkey") % 3 == 1, F.lit("Y")).otherwise(F.lit("N"))
    status = F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_linestatus"))
    # != drops NULLs
    ship = F.when(F.col("l_suppkey") % 5 == 0, F.lit(None)).when(F.col("l_suppkey") % 5 == 1, F.lit("SHIP")).otherwise(F.lit("MAIL"))
    cond = (
        ~flag_is(keep_flag, "Y", "N")
        & flag_is(drop_flag, "N", "Y")
        & F.col("l_returnflag").isin("A", "R")
        & (ship != "SHIP")
        & ((~status.isin("O")) | (F.col("l_quantity") > 45))
        & F.col("l_shipdate").isNotNull()
    )
    return li.where(cond).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")


def effective_dates(spark, sf):
    """Validity at the as-of instant (with time) and at its
    day; open-ended lookup intervals at day precision."""
    t = derived_tables(spark, sf, names=("people_f",))
    at = as_of_lit(AS_OF)
    return t["people_f"].select(
        "person_id", "full_name", "effective_end_date",
        effective_on(at, "effective_start_date", "effective_end_date").alias("active_now"),
        effective_on(day(at), "effective_start_date", "effective_end_date").alias("active_today"),
    )


def open_intervals(spark, sf):
    """NULL bound = open, both sides truncated to the day."""
    t = derived_tables(spark, sf, names=("lookup_values",))
    return t["lookup_values"].select(
        "lookup_type", "lookup_code", "tag", "zd_edition_name",
        open_interval_on(as_of_lit(AS_OF), "start_date_active", "end_date_active").alias("active"),
    )


# ---------------------------------------------------------------- joins

def _orders_nullable(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderkey")).alias("k"))


def left_nullable_key(spark, sf):
    """D3: left join on a key that is often NULL (spread, never matched)."""
    li = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("sum_qty"), F.count(F.lit(1)).alias("n_lines"))
    return keyed_join(_orders_nullable(spark, sf), li, "k", "l_orderkey", "left").select("o_orderkey", "k", "sum_qty", "n_lines")


def left_composite(spark, sf):
    """Left join on a composite key."""
    li = _t(spark, sf, "lineitem")
    ln = li.groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").alias("q"))
    ret = li.where(F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("r_orderkey"), F.col("l_linenumber").alias("r_linenumber")) \
        .agg(F.sum("l_quantity").alias("returned_q"))
    return keyed_join(ln, ret, ["l_orderkey", "l_linenumber"], ["r_orderkey", "r_linenumber"], "left") \
        .select("l_orderkey", "l_linenumber", "q", "returned_q")


def left_residual_or(spark, sf):
    """Equi key plus ``a = b OR b IS NULL``, as disjoint equi-joins."""
    o = _t(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise((F.col("o_orderkey") % 7 + 1).cast("int")).alias("pick"),
    )
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return keyed_join_named(o, li, "o_orderkey", "l_orderkey", "pick", "l_linenumber", "left").select("o_orderkey", "pick", "l_linenumber", "l_quantity")


def dated_join_asof(spark, sf):
    """Dimension row valid at the fixed as-of (restricts the dimension,
    so unmatched facts stay with NULLs)."""
    ppl = derived_tables(spark, sf, names=("people_f",))["people_f"].select("person_id", "full_name", "effective_start_date", "effective_end_date")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return dated_join(o, ppl, "o_custkey", "person_id", as_of_lit(AS_OF), "effective_start_date", "effective_end_date") \
        .select("o_orderkey", "o_custkey", "full_name")


def dated_lookup_rows(spark, sf):
    """Per-row as-of lookup at each order's own date (strict)."""
    ppl = derived_tables(spark, sf, names=("people_f",))["people_f"]
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return dated_lookup(o, ppl, "o_custkey", "person_id", "o_orderdate", "effective_start_date", "effective_end_date",
                        {"name_at_order": "full_name"})


def _left_side(spark, sf):
    o = _t(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    return o.select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderkey")).alias("lk"))


def full_outer_join(spark, sf):
    """Full outer join; NULL keys on both sides stay unmatched."""
    li = _t(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    right = li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("r_qty")) \
        .select(F.when(F.col("l_orderkey") % 11 == 0, F.lit(None)).otherwise(F.col("l_orderkey")).alias("rk"), "r_qty")
    return full_outer(_left_side(spark, sf), right, "lk", "rk").select("o_orderkey", "lk", "rk", "r_qty")


def lineage_chain_join(spark, sf):
    """A ⟗ B, then ⟗ C keyed on B's key only."""
    li = _t(spark, sf, "lineitem")
    b = li.where(F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("bk")).agg(F.count(F.lit(1)).alias("b_n"))
    c = li.where(F.col("l_linestatus") == "O").groupBy(F.col("l_orderkey").alias("ck")).agg(F.count(F.lit(1)).alias("c_n"))
    return lineage_chain(_left_side(spark, sf), b, c, "lk", "bk", "ck").select("o_orderkey", "lk", "bk", "b_n", "ck", "c_n")


def scalar_lookup_strict(spark, sf):
    """Strict one-row lookups lineitem → supplier → nation."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    sup = _t(spark, sf, "supplier")
    nat = _t(spark, sf, "nation")
    x = scalar_lookup(li, sup, "l_suppkey", "s_suppkey", {"s_name": "s_name", "s_nationkey": "s_nationkey"}, name="supplier")
    return scalar_lookup(x, nat, "s_nationkey", "n_nationkey", {"n_name": "n_name"}, name="nation").drop("s_nationkey")


def semi_join_in(spark, sf):
    """``key IN (subquery)`` as a left-semi join."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    r = _t(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey")
    return semi_in(o, r, "o_orderkey", "l_orderkey")


def semi_join_correlated(spark, sf):
    """Correlated IN on a normalised text key (duplicates in the
    subquery never multiply)."""
    p = _t(spark, sf, "part")
    left = p.select("p_partkey", "p_size", "p_brand", norm_text("p_brand").alias("nb"))
    right = p.where(F.col("p_retailprice") > 950).select(F.col("p_size").alias("s2"), norm_text("p_brand").alias("nb2"))
    return semi_in(left, right, ["p_size", "nb"], ["s2", "nb2"]).select("p_partkey", "p_size", "p_brand")


def anti_join_not_exists(spark, sf):
    """NOT EXISTS as a left-anti join."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    r = _t(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey")
    return anti_exists(o, r, "o_orderkey", "l_orderkey")


def cross_as_equi(spark, sf):
    """D13, R11, E6: 'every position whose tag is mapped to the row's group'
    — the source's ``ON 1=1`` + ``IN`` — as equi-joins through the lookup.
    The list depends on the group alone: it is built once per group over a
    dimension of fixed size and then given to every row."""
    ev = _t(spark, sf, "events").select("event_id", (F.col("user_id") % 25).alias("grp"))
    nat = _t(spark, sf, "nation")
    tags = nat.select((F.col("n_nationkey") % 25).alias("tg_grp"), F.col("n_regionkey").alias("tg_tag")).distinct()
    members = nat.select(F.col("n_regionkey").alias("st_tag"), "n_name")
    lists = ordered_listagg(tags.join(members, F.col("tg_tag") == F.col("st_tag")), "tg_grp", "n_name", "nations")
    return ev.join(lists, F.col("grp") == F.col("tg_grp")).select("event_id", "nations")


def self_parent(spark, sf):
    """Parent rows whose value exceeds the summed value of
    their children (NULL sum → 0)."""
    ev = _t(spark, sf, "events").select("event_id", F.col("value").cast("decimal(18,2)").alias("value"), "event_type",
                                        (F.col("event_id") - F.col("event_id") % 3).alias("parent_id"))
    kids = ev.where(F.col("event_id") % 3 != 0)
    parents = ev.where(F.col("event_id") % 3 == 0).select("event_id", "value")
    s = child_sum(kids, "parent_id", "value", F.col("event_type").isin("click", "view"), "child_value")
    x = keyed_join(parents, s, "event_id", "parent_id", "left").drop("parent_id")
    return x.where(F.col("value") > F.coalesce(F.col("child_value"), F.lit(0))).select("event_id", "value", "child_value")


def first_event_min(spark, sf):
    """Earliest purchase per user."""
    ev = _t(spark, sf, "events")
    return first_event(ev, "user_id", "ts", F.col("event_type") == "purchase", "first_purchase")


def last_event_max(spark, sf):
    """Latest signup per user, and the maximum value per user."""
    ev = _t(spark, sf, "events")
    signup = F.when(F.col("event_type").isin("signup"), F.col("ts"))
    return ev.groupBy("user_id").agg(F.max(signup).alias("last_signup"), F.max("value").alias("max_value")).where("last_signup is not null")


def last_action_row(spark, sf):
    """Rows at the maximum ts of their user over all types, filtered by
    type afterwards (ties kept)."""
    ev = _t(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return last_action_rows(ev, "user_id", "ts").where(F.col("event_type") == "click")


def listagg_ordered(spark, sf):
    """Ordered list per key (the few lines of an order); NULLs skipped, duplicates kept."""
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linenumber") % 7 == 0, F.lit(None)).otherwise(F.col("l_returnflag")).alias("flag"))
    return ordered_listagg(li, "l_orderkey", "flag", "flags")


def latest_row_per_key(spark, sf):
    """newest row per key, DESC with NULLs first, id tie-break."""
    ev = _t(spark, sf, "events").select(
        "event_id", "user_id", "event_type",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("ts")).alias("ts"))
    return latest_per_key(ev, "user_id", "ts", tie_break=["event_id"])


def latest_filter_noop(spark, sf):
    """``id IN (ids of the rn = 1 rows)`` keeps every non-NULL id."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    latest = latest_per_key(o, "o_custkey", "o_orderdate", tie_break=["o_orderkey"]).select(F.col("o_custkey").alias("lc"))
    return semi_in(o, latest, "o_custkey", "lc")


def union_distinct_padded(spark, sf):
    """UNION of two padded branches (typed NULLs) removes
    duplicates across and within them."""
    li = _t(spark, sf, "lineitem")
    a = li.select("l_returnflag", "l_linestatus", F.lit(None).cast("string").alias("l_tag"))
    b = li.select("l_returnflag", F.lit(None).cast("string").alias("l_linestatus"),
                  F.when(F.col("l_quantity") > 25, F.lit("BIG")).otherwise(F.lit("SMALL")).alias("l_tag"))
    return union_distinct(a, b)


# ---------------------------------------------------------------- blocks

def block_pr_pending(spark, sf):
    """K3 on the derived P2P tables."""
    t = derived_tables(spark, sf)
    return pr_pending_with(t, AS_OF).select(F.col("k3_pr_number").alias("pr_number"), F.col("k3_name").alias("pending_with"))


def block_inspection_corrected(spark, sf):
    """K6 without the link from PO line ids to requisition line ids (D20, corrected)."""
    pending = inspection_pending(derived_tables(spark, sf), AS_OF, corrected=True)
    return pending.select(F.col("k6_transaction_id").alias("transaction_id"), F.col("k6_pending_with").alias("pending_with"))


def block_inspection_pending(spark, sf):
    """K6 on the derived P2P tables."""
    t = derived_tables(spark, sf)
    return inspection_pending(t, AS_OF).select(F.col("k6_transaction_id").alias("transaction_id"), F.col("k6_pending_with").alias("pending_with"))


def block_requisitions(spark, sf):
    """K1 (standard variant: lines without a document type) on derived tables."""
    t = derived_tables(spark, sf)
    cols = ["DISTRIBUTION_ID", "PR_Number", "PR_Description", "PR_Creation_Date", "PR_Status", "PR_Line_No", "PR_Quantity",
            "Unit_Price", "PR_Line_Amount_OMR", "PR Line Currency", "RUSH_FLAG", "NEED_BY_DATE", "PR Latest Approved Date",
            "PR Original Approved Date", "Item Code", "Item Description", "Item Type", "Sourced Or Unsourced", "PR Requestor",
            "PR Approval Pending With"]
    return pr_block(t, AS_OF, sourced=False).select(*[F.col(f"`{c}`") for c in cols])


def block_rfq(spark, sf):
    """K2: RFQ line × requisition distribution with buyer and last submit."""
    return rfq_block(derived_tables(spark, sf), AS_OF)


def block_po_pending(spark, sf):
    """K4 candidates for both order types: last action of an open release."""
    t = derived_tables(spark, sf)
    b = po_pending_with(t, AS_OF, BLANKET).withColumn("kind", F.lit("RELEASE"))
    s = po_pending_with(t, AS_OF, STANDARD).withColumn("kind", F.lit("STANDARD"))
    return b.unionByName(s).select("kind", F.col("k4_key").alias("key_id"), F.col("k4_name").alias("full_name"),
                                   F.col("k4_empno").alias("employee_number"))


def block_invoice_chain(spark, sf):
    """K13/K14 source chain (standard flags) at invoice-distribution grain."""
    inv = invoice_chain(derived_tables(spark, sf), STANDARD)
    return inv.select("aida_po_distribution_id", "aida_invoice_id", "aida_amount", "aila_line_number", "aia_invoice_num",
                      "apsa_payment_num", "aipa_amount", "aca_check_id", "aca_amount")


def drill_down(spark, sf):
    """Equality drill-down on the finished union report (in stored steps it narrows their rows, too)."""
    wanted = {"PO Type (Blanket/Standard)": "BLANKET", "BR Status - Blanket": "IN PROCESS"}
    return drill(_report(report_union, only=wanted, excluded_srns=EXCLUDED_SRNS)(spark, sf), **wanted)


def _document(report, predicate):
    """A drill-down on one document of a report."""
    def run(spark, sf):
        return drill_document(derived_tables(spark, sf), lambda t: report(t, AS_OF), predicate)
    return run


def block_rfq_newest(spark, sf):
    """the RFQ block with only the newest header row of every RFQ."""
    return rfq_block(derived_tables(spark, sf), AS_OF, dedupe_rfq=True)


def load_conformed(spark, sf):
    """A1: canonical tables from a name -> frame map, narrowed and cast, '' read as NULL."""
    raw = _t(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("vendor_id"), F.when(F.col("s_nationkey") % 4 == 0, F.lit("")).otherwise(F.col("s_name")).alias("vendor_name"),
        "s_acctbal")
    return load_tables(spark, {"suppliers": raw}, names=("suppliers",))["suppliers"]


def preview_top(spark, sf):
    """H1: first 10 rows of the standard report under a total order."""
    rep = _report(report_standard)(spark, sf)
    return preview(rep, 10, order=rep.columns)


OPERATOR_QUERIES: dict[str, Query] = {
    "amount_conversion": amount_conversion,
    "decode_concat": decode_concat,
    "flag_filters": flag_filters,
    "effective_dates": effective_dates,
    "open_intervals": open_intervals,
    "left_nullable_key": left_nullable_key,
    "left_composite": left_composite,
    "left_residual_or": left_residual_or,
    "dated_join_asof": dated_join_asof,
    "dated_lookup_rows": dated_lookup_rows,
    "full_outer_join": full_outer_join,
    "lineage_chain_join": lineage_chain_join,
    "scalar_lookup_strict": scalar_lookup_strict,
    "semi_join_in": semi_join_in,
    "semi_join_correlated": semi_join_correlated,
    "anti_join_not_exists": anti_join_not_exists,
    "cross_as_equi": cross_as_equi,
    "self_parent": self_parent,
    "first_event_min": first_event_min,
    "last_event_max": last_event_max,
    "last_action_row": last_action_row,
    "listagg_ordered": listagg_ordered,
    "latest_row_per_key": latest_row_per_key,
    "latest_filter_noop": latest_filter_noop,
    "union_distinct_padded": union_distinct_padded,
    "block_pr_pending": block_pr_pending,
    "block_inspection_corrected": block_inspection_corrected,
    "block_inspection_pending": block_inspection_pending,
    "block_requisitions": block_requisitions,
    "block_rfq": block_rfq,
    "block_po_pending": block_po_pending,
    "block_invoice_chain": block_invoice_chain,
    "block_rfq_newest": block_rfq_newest,
    "load_conformed": load_conformed,
    "drill_down": drill_down,
    "drill_po_release": _document(report_blanket, DRILL_DOCUMENTS["drill_po_release"]),
    "drill_po_line": _document(report_standard, DRILL_DOCUMENTS["drill_po_line"]),
    "drill_pr_line": _document(report_standard, DRILL_DOCUMENTS["drill_pr_line"]),
    "drill_invoice": _document(report_standard, DRILL_DOCUMENTS["drill_invoice"]),
    "drill_distribution": _document(report_blanket, DRILL_DOCUMENTS["drill_distribution"]),
    "preview_top": preview_top,
}

REPORT_QUERIES: dict[str, Query] = {
    "report_blanket": _report(report_blanket, excluded_srns=EXCLUDED_SRNS),
    "report_standard": _report(report_standard),
    "report_union": _report(report_union, excluded_srns=EXCLUDED_SRNS),
    "report_union_legacy": _report(report_union, variant="legacy", excluded_srns=EXCLUDED_SRNS),
}
