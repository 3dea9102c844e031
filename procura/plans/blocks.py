"""Report blocks as DataFrame plans.

Every block takes ``t`` — a mapping of canonical table name to DataFrame —
and returns a lazy DataFrame whose columns carry a block prefix, so the
report can join blocks without ambiguity.

Plan shape decisions (all result-preserving):

* Lookups whose key lives on a header (supplier, first approval, archive
  maximum, pending approver, contract holder/engineer, QS name) are attached
  to the header or release rows *before* the line-level joins, so they run at
  header grain instead of once per fan-out row.
* Left-join chains whose conditions reference only the chain (receipt →
  shipment line → shipment header; distribution → ledger/WO/project →
  invoice distribution → line → invoice → schedule → payment → check) are
  built at their own grain and joined to the order lines once. Left joins
  re-associate this way because each condition is a NULL-rejecting equality
  on the chain's own columns.
* The ledger/project/invoice joins that the source text places after the
  FULL joins are moved before them: their keys are order-side columns that
  are NULL on every requisition-only or RFQ-only row, so they never match
  there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.functions import as_of_lit, day, decode, effective_on, flag_is, norm_text, num_key, open_interval_on
from procura.operators import (
    anti_exists,
    child_sum,
    dated_lookup,
    keyed_join,
    last_action_rows,
    left_join_splittable,
    last_event,
    latest_per_key,
    max_by_key,
    ordered_listagg_expr,
    scalar_lookup,
    semi_in,
)
from procura.operators.joins import by_name_and_all, same
from procura.session import Steps, in_slice

Tables = Mapping[str, DataFrame]

# Fixed values used by the reports (document types, action codes, statuses)
# and defaults of the parameters that name lookup types.
STANDARD, BLANKET = "STANDARD", "BLANKET"
APPROVE = "APPROVE"
OPEN_RELEASE_EXCLUDED = ("APPROVED", "REJECTED", "INCOMPLETE")
INSPECTION_LOOKUP = "INSPECTION_GROUP"
QS_LOOKUP = "QS_MAPPING"
QS_EDITION = "SET1"
INSPECTION_RESULTS = ("ACCEPT", "REJECT")
INSPECTION_CLOSERS = ("RETURN TO VENDOR", "REJECT", "TRANSFER")
BID_VISIBILITY = (("SEALED_AUCTION", "SEALED"), ("SEALED_BIDDING", "BLIND"))


def pfx(df: DataFrame, p: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Select ``cols`` (default all) renamed to ``{p}_{col}``."""
    cols = list(cols or df.columns)
    return (df if cols == df.columns else df.select(*cols)).toDF(*[f"{p}_{c}" for c in cols])


def attach(df: DataFrame, other: DataFrame, left_key: str | Sequence[str], right_key: str | Sequence[str],
           spread_by: Sequence[str] | None = None) -> DataFrame:
    """Left join ``other`` (already one row per key) and drop its key columns."""
    rk = [right_key] if isinstance(right_key, str) else list(right_key)
    return keyed_join(df, other, left_key, rk, "left", spread_by=spread_by).drop(*rk)


def people_active(t: Tables, at: Column) -> DataFrame:
    p = t["people_f"]
    return p.where(effective_on(at, "effective_start_date", "effective_end_date"))


# --------------------------------------------------------------- approvals

def _last_actions(t: Tables) -> DataFrame:
    # maximum sequence over every object type sharing the id; type filter after
    return last_action_rows(t["po_action_history"], "object_id", "sequence_num")


def pr_pending_with(t: Tables, as_of: str) -> DataFrame:
    """K3: approver of the open (NULL action) last step of an IN PROCESS
    requisition, keyed on the requisition **number**."""
    cand = _last_actions(t).where((F.col("object_type_code") == "REQUISITION") & F.col("action_code").isNull())
    hdr = t["req_headers"].where(F.col("authorization_status") == "IN PROCESS")
    ppl = people_active(t, as_of_lit(as_of))
    x = (
        hdr.select(F.col("requisition_header_id").alias("k3_hid"), F.col("segment1").alias("k3_pr_number"))
        .join(cand.select(F.col("object_id").alias("k3_obj"), F.col("employee_id").alias("k3_emp")), F.col("k3_hid") == F.col("k3_obj"))
        .join(ppl.select(F.col("person_id").alias("k3_pid"), F.col("full_name").alias("k3_name")), F.col("k3_emp") == F.col("k3_pid"))
    )
    return x.select("k3_pr_number", "k3_name")


def po_pending_with(t: Tables, as_of: str, kind: str) -> DataFrame:
    """K4: approver name and employee number of the last action of a release
    that is not approved/rejected/incomplete. Blanket: object type RELEASE,
    keyed on the release id. Standard: object type STANDARD, keyed on the
    release's PO header id (as written in the source report)."""
    obj_type = "RELEASE" if kind == BLANKET else STANDARD
    cand = _last_actions(t).where(F.col("object_type_code") == obj_type).select(
        F.col("object_id").alias("k4_obj"), F.col("employee_id").alias("k4_emp")
    )
    rel = t["po_releases"].where(~F.col("authorization_status").isin(*OPEN_RELEASE_EXCLUDED))
    ppl = people_active(t, as_of_lit(as_of)).select(
        F.col("person_id").alias("k4_pid"), F.col("full_name").alias("k4_name"), F.col("employee_number").alias("k4_empno")
    )
    key = "po_release_id" if kind == BLANKET else "po_header_id"
    x = (
        cand.join(rel.select(F.col("po_release_id").alias("k4_rel"), F.col(key).alias("k4_key")), F.col("k4_obj") == F.col("k4_rel"))
        .join(ppl, F.col("k4_emp") == F.col("k4_pid"))
    )
    return x.select("k4_key", "k4_name", "k4_empno")


def first_approvals(t: Tables) -> DataFrame:
    """E1 for every object type at once: earliest APPROVE date per object id
    as a PO, as a RELEASE and as a REQUISITION (one pass, one shuffle; the
    identical subplan is reused by every block that needs it)."""
    h = t["po_action_history"].where(F.col("action_code") == APPROVE)
    typ = F.col("object_type_code")
    return h.groupBy(F.col("object_id").alias("fa_key")).agg(
        F.min(F.when(typ == "PO", F.col("action_date"))).alias("po_first_appr"),
        F.min(F.when(typ == "RELEASE", F.col("action_date"))).alias("br_first_appr"),
        F.min(F.when(typ == "REQUISITION", F.col("action_date"))).alias("pr_first_appr"),
    )


def _first_approval(t: Tables, object_type: str, out: str) -> DataFrame:
    col = {"PO": "po_first_appr", "RELEASE": "br_first_appr", "REQUISITION": "pr_first_appr"}[object_type]
    return first_approvals(t).select(F.col("fa_key").alias(f"{out}_key"), F.col(col).alias(out))


# --------------------------------------------------------------- requisition

def _live_req_lines(t: Tables, sourced: bool) -> DataFrame:
    lines = t["req_lines"].where(~flag_is("cancel_flag", "Y", "N"))
    return lines.where(F.col("document_type_code") == BLANKET) if sourced else lines.where(F.col("document_type_code").isNull())


def pr_block(t: Tables, as_of: str, sourced: bool, keep: Steps | None = None) -> DataFrame:
    """K1: requisition header ⋈ live line (⟕ distribution, item, requestor).

    ``sourced`` keeps BLANKET-sourced lines (blanket report), otherwise lines
    without a document type (standard report); the sourced label is then a
    constant. One row per requisition distribution; a line without
    distributions stays with a NULL id. With ``keep`` headers, lines and
    distributed lines are stored one after the other.
    """
    # a header without an id has no lines; the others are put in order of id once, for the approval and for the lines
    hdr = pfx(t["req_headers"].where(F.col("requisition_header_id").isNotNull()), "porha")
    hdr = scalar_lookup(hdr, _step(keep, pr_pending_with(t, as_of), "pending"), "porha_segment1", "k3_pr_number",
                        {"pr_pending_with": "k3_name"}, name="PR approval pending with")
    hdr = keyed_join(hdr, _first_approval(t, "REQUISITION", "pr_first_appr"), "porha_requisition_header_id", "pr_first_appr_key",
                     "left", spread_nulls=False).drop("pr_first_appr_key")
    hdr = _step(keep, hdr, "req_headers", _REQUISITION_STEP)
    # item and requestor meet the line before its distributions fan out, and the
    # header comes last: its columns never move with the rows of another join
    pr = pfx(_live_req_lines(t, sourced), "porla")
    own = ["porla_requisition_line_id", "porla_requisition_header_id"]
    pr = keyed_join(pr, pfx(t["items"], "msib"), ["porla_item_id", "porla_destination_organization_id"],
                    ["msib_inventory_item_id", "msib_organization_id"], "left", spread_by=own)
    req = pfx(people_active(t, as_of_lit(as_of)).select("person_id", "full_name"), "papf")
    pr = keyed_join(pr, req, "porla_to_person_id", "papf_person_id", "left", spread_by=own)
    pr = _step(keep, pr, "req_lines", _REQUISITION_STEP)
    pr = keyed_join(pr, pfx(t["req_distributions"], "pord"), "porla_requisition_line_id", "pord_requisition_line_id", "left",
                    spread_by=[*own, "porla_line_num"])
    pr = _step(keep, pr, "req_distributions", _REQUISITION_STEP)
    pr = pr.join(hdr, F.col("porla_requisition_header_id") == F.col("porha_requisition_header_id"), "inner")
    qty, price = F.coalesce(F.col("porla_quantity"), F.lit(0)), F.coalesce(F.col("porla_unit_price"), F.lit(0))
    return pr.select(
        F.col("pord_distribution_id").alias("DISTRIBUTION_ID"),
        F.col("porha_segment1").alias("PR_Number"),
        F.col("porha_description").alias("PR_Description"),
        F.col("porha_creation_date").alias("PR_Creation_Date"),
        F.col("porha_authorization_status").alias("PR_Status"),
        F.col("porla_line_num").alias("PR_Line_No"),
        F.col("porla_quantity").alias("PR_Quantity"),
        F.col("porla_unit_price").alias("Unit_Price"),
        (qty * price).cast("decimal(28,6)").alias("PR_Line_Amount_OMR"),
        F.coalesce(F.col("porla_currency_code"), F.lit("USD")).alias("PR Line Currency"),
        F.col("porla_urgent_flag").alias("RUSH_FLAG"),
        F.col("porla_need_by_date").alias("NEED_BY_DATE"),
        F.col("porha_approved_date").alias("PR Latest Approved Date"),
        F.col("pr_first_appr").alias("PR Original Approved Date"),
        F.col("msib_segment1").alias("Item Code"),
        F.col("porla_item_description").alias("Item Description"),
        F.col("msib_item_type").alias("Item Type"),
        F.lit("SOURCED" if sourced else "UNSOURCED").alias("Sourced Or Unsourced"),
        F.col("papf_full_name").alias("PR Requestor"),
        F.col("pr_pending_with").alias("PR Approval Pending With"),
        F.col("porla_item_id").alias("pd_item_id"),
        F.col("porla_attribute2").alias("pd_attribute2"),
        F.col("msib_attribute1").alias("pd_attribute1"),
        F.col("porla_requisition_line_id").alias("__pr_line"),
    )


# --------------------------------------------------------------- sourcing

def buyers(t: Tables, as_of: str) -> DataFrame:
    """User → person active at the truncated as-of date."""
    ppl = people_active(t, day(as_of_lit(as_of))).select("person_id", "full_name")
    u = t["users"]
    return u.join(ppl, u["employee_id"] == ppl["person_id"]).select(
        F.col("user_id").alias("buyer_user_id"), F.col("full_name").alias("buyer_name")
    )


def _sourced_distributions(t: Tables, ph: DataFrame, keep: Steps | None = None) -> DataFrame:
    """RFQ headers ``ph`` ⋈ item line ⋈ backing requisition ⋈ requisition header, line and distribution.

    With ``keep`` the ids alone pass through these joins and are stored; the headers meet them last."""
    if keep is not None:
        every = ph.select(F.col("ph_auction_header_id").alias("__auction")).distinct()
        pairs = _sourced_distributions(t, every.withColumnRenamed("__auction", "ph_auction_header_id"))
        pairs = keep(pairs.select(F.col("ph_auction_header_id").alias("__auction"), "prd_distribution_id"), "sourced")
        return ph.join(pairs, F.col("ph_auction_header_id") == F.col("__auction"))
    phl = pfx(t["rfq_lines"], "phl")
    pbr = pfx(t["rfq_backing_reqs"], "pbr")
    prh = pfx(t["req_headers"].select("requisition_header_id"), "prh")
    prl = pfx(t["req_lines"].select("requisition_line_id", "requisition_header_id"), "prl")
    prd = pfx(t["req_distributions"], "prd")
    return (
        ph.join(phl, F.col("ph_auction_header_id") == F.col("phl_auction_header_id"))
        .join(pbr, (F.col("phl_auction_header_id") == F.col("pbr_auction_header_id")) & (F.col("phl_line_number") == F.col("pbr_line_number")))
        .join(prh, F.col("pbr_requisition_header_id") == F.col("prh_requisition_header_id"))
        .join(prl, (F.col("prh_requisition_header_id") == F.col("prl_requisition_header_id"))
              & (F.col("pbr_requisition_line_id") == F.col("prl_requisition_line_id")))
        .join(prd, F.col("prl_requisition_line_id") == F.col("prd_requisition_line_id"))
    )


def rfq_block(t: Tables, as_of: str, legacy: bool = False, dedupe_rfq: bool = False, keep: Steps | None = None) -> DataFrame:
    """K2: RFQ header ⋈ item line ⋈ backing requisition ⋈ requisition header,
    line and distribution; ⟕ buyer; last SUBMIT date. One row per RFQ line ×
    requisition distribution.

    The source filters headers by ``id IN (ids whose newest row is rn = 1)``,
    which keeps every non-NULL id (a no-op); ``dedupe_rfq=True`` instead
    keeps only the newest header row per id (the stated intent).
    """
    ph = t["rfq_headers"]
    if dedupe_rfq:
        ph = latest_per_key(ph, "auction_header_id", "creation_date", tie_break=["document_number"])
    else:
        ph = ph.where(F.col("auction_header_id").isNotNull())
    ph = pfx(ph, "ph")
    submit = last_event(
        t["rfq_action_history"], "object_id", "action_date",
        (F.col("object_type_code") == "NEGOTIATION") & F.col("action_type").isin("SUBMIT"), "rfq_submit",
    ).withColumnRenamed("object_id", "rfq_submit_key")
    ph = attach(ph, submit, "ph_auction_header_id", "rfq_submit_key")
    ph = keyed_join(ph, buyers(t, as_of), "ph_created_by", "buyer_user_id", "left")
    x = _sourced_distributions(t, _step(keep, ph, "rfq_headers"), keep)
    rfq_type = F.col("ph_auction_origination_code") if legacy else decode("ph_bid_visibility_code", BID_VISIBILITY)
    return x.select(
        F.col("prd_distribution_id").alias("ad_distribution_id"),
        F.col("ph_document_number").alias("ad_number"),
        F.col("ph_auction_status").alias("ad_status"),
        rfq_type.alias("ad_type"),
        F.col("ph_creation_date").alias("ad_creation_date"),
        F.col("ph_close_bidding_date").alias("ad_closed_date"),
        F.col("ph_int_attribute6").alias("ad_strategy"),
        F.col("ph_int_attribute4").alias("ad_te_date"),
        F.col("ph_award_date").alias("ad_award_date"),
        F.col("rfq_submit").alias("ad_submit_date"),
        F.col("ph_publish_date").alias("ad_publish_date"),
        F.col("buyer_name").alias("ad_buyer"),
    )


# --------------------------------------------------------------- orders

def po_header_block(t: Tables, as_of: str, kind: str, qs_lookup: str = QS_LOOKUP, keep: Steps | None = None) -> DataFrame:
    """K15/K16 header part: PO headers of one type with their header-grain
    lookups (first approval, supplier, archive maximum, pending approver for
    standard; release first approval, contract holder/engineer, QS name for
    blanket)."""
    pha = pfx(t["po_headers"].where(F.col("type_lookup_code") == kind), "pha")
    # the release "original approval" is keyed on the PO header id with type
    # RELEASE, as in the source report
    appr = ["po_first_appr"] + (["br_first_appr"] if kind == BLANKET else [])
    pha = attach(pha, _step(keep, first_approvals(t).select("fa_key", *appr), "approvals"), "pha_po_header_id", "fa_key")
    pha = scalar_lookup(pha, t["suppliers"], "pha_vendor_id", "vendor_id", {"supplier_name": "vendor_name"}, name="supplier")
    acv = max_by_key(t["po_headers_archive"], "segment1", "amount_limit", "acv_amount").withColumnRenamed("segment1", "acv_key")
    pha = attach(pha, acv, "pha_segment1", "acv_key")
    if kind == STANDARD:
        pha = scalar_lookup(pha, _step(keep, po_pending_with(t, as_of, STANDARD), "pending"), "pha_po_header_id", "k4_key",
                            {"po_pending_name": "k4_name", "po_pending_empno": "k4_empno"}, name="PO approval pending with")
    else:
        now = people_active(t, as_of_lit(as_of))
        pha = pha.withColumn("pha_attr3_num", num_key("pha_attribute3")).withColumn("pha_attr5_num", num_key("pha_attribute5"))
        pha = scalar_lookup(pha, now, "pha_attr3_num", "person_id", {"ch_name": "full_name"}, name="contract holder")
        pha = scalar_lookup(pha, now, "pha_attr5_num", "person_id", {"ce_name": "full_name"}, name="contract engineer")
        qs = t["lookup_values"].where((F.col("lookup_type") == qs_lookup) & (F.col("zd_edition_name") == QS_EDITION))
        pha = scalar_lookup(pha, qs, "pha_segment1", "lookup_code", {"qs_name": "description"}, name="QS name")
    return pha


def release_block(t: Tables, as_of: str, keep: Steps | None = None) -> DataFrame:
    """Blanket releases with their pending approver (K4, RELEASE)."""
    pra = pfx(t["po_releases"], "pra")
    return scalar_lookup(pra, _step(keep, po_pending_with(t, as_of, BLANKET), "pending"), "pra_po_release_id", "k4_key",
                         {"po_pending_name": "k4_name", "po_pending_empno": "k4_empno"}, name="release approval pending with")


def inspection_pending(t: Tables, as_of: str, inspection_lookup: str = INSPECTION_LOOKUP, corrected: bool = False,
                       keep: Steps | None = None) -> DataFrame:
    """K6: sorted e-mails of the people who can inspect a RECEIVE transaction
    still awaiting inspection; one row per transaction id.

    The source's ``ON 1=1`` product of receipts and positions restricted by
    ``tag IN (lookup)`` is rewritten as equi-joins: receipt → group →
    (group, tag) pairs of the active lookup rows (distinct, so duplicate
    lookup rows never multiply) → active staff holding a position with that
    tag. Duplicate e-mails from one person in two matching positions stay.
    Receipts never meet staff rows: the list is aggregated per group first.

    As written, the receipt's PO line id is looked up among requisition line
    ids, which are numbers of another document. ``corrected`` leaves that link
    out: need and group of an inspection come from the item alone. With
    ``keep`` the receipts that need one are stored before what was done on them.
    """
    rt = t["rcv_transactions"]
    at = as_of_lit(as_of)
    rcv = pfx(rt.where((F.col("transaction_type") == "RECEIVE") & (F.col("routing_header_id") == "2")), "r")
    rcv = rcv.join(t["rcv_shipment_headers"].select(F.col("shipment_header_id").alias("sh_id")), F.col("r_shipment_header_id") == F.col("sh_id"))
    rcv = rcv.join(pfx(t["rcv_shipment_lines"].select("shipment_line_id", "item_id"), "sl"), F.col("r_shipment_line_id") == F.col("sl_shipment_line_id"))
    rcv = keyed_join(rcv, pfx(t["items"].select("inventory_item_id", "organization_id", "attribute1", "inspection_required_flag"), "mi"),
                     ["sl_item_id", "r_organization_id"], ["mi_inventory_item_id", "mi_organization_id"], "left")
    needed, group = F.col("mi_inspection_required_flag") == "Y", F.col("mi_attribute1")
    if not corrected:
        # requisition line joined on the receipt's PO line id, as in the source
        rcv = keyed_join(rcv, pfx(t["req_lines"].select("requisition_line_id", "attribute2"), "rl"), "r_po_line_id", "rl_requisition_line_id", "left")
        needed, group = needed | F.col("rl_attribute2").isNotNull(), F.coalesce(group, F.col("rl_attribute2"))
    rcv = rcv.where(needed)
    if keep is not None:
        rcv, group = keep(rcv.select("r_transaction_id", "r_quantity", group.alias("__grp")), "to_inspect"), F.col("__grp")
    inspected = child_sum(rt, "parent_transaction_id", "quantity", F.col("transaction_type").isin(*INSPECTION_RESULTS), "insp_qty")
    rcv = attach(rcv, inspected.withColumnRenamed("parent_transaction_id", "insp_parent"), "r_transaction_id", "insp_parent")
    rcv = rcv.where(F.col("r_quantity") > F.coalesce(F.col("insp_qty"), F.lit(0)))
    closers = rt.where(F.col("transaction_type").isin(*INSPECTION_CLOSERS)).select(F.col("parent_transaction_id").alias("cl_parent"))
    rcv = anti_exists(rcv, closers, "r_transaction_id", "cl_parent")
    rcv = rcv.select(F.col("r_transaction_id").alias("k6_transaction_id"),
                     F.upper(group).alias("k6_grp"))

    lv = t["lookup_values"]
    tags = lv.where(
        (F.col("lookup_type") == inspection_lookup) & (F.col("language") == "US") & (F.col("enabled_flag") == "Y")
        & open_interval_on(at, "start_date_active", "end_date_active")
    ).select(F.upper("description").alias("tg_grp"), F.upper("tag").alias("tg_tag")).distinct()

    today = day(at)
    asg = t["assignments_f"].where(effective_on(today, "effective_start_date", "effective_end_date"))
    ppl = people_active(t, today)
    staff = (
        t["positions"].join(t["position_definitions"], "position_definition_id")
        .select("position_id", norm_text("segment3").alias("st_tag"))
        .join(asg.select(F.col("position_id").alias("a_pos"), F.col("person_id").alias("a_person")), F.col("position_id") == F.col("a_pos"))
        .join(ppl.select(F.col("person_id").alias("p_person"), F.col("email_address").alias("st_email")), F.col("a_person") == F.col("p_person"))
        .select("st_tag", "st_email")
    )
    # the list depends on the group alone: build it once per group, then give it to every receipt
    lists = tags.join(staff, F.col("tg_tag") == F.col("st_tag")).groupBy("tg_grp").agg(ordered_listagg_expr("st_email").alias("k6_pending_with"))
    return rcv.join(lists, F.col("k6_grp") == F.col("tg_grp")).select("k6_transaction_id", "k6_pending_with")


def receipt_chain(t: Tables, as_of: str, kind: str = STANDARD, legacy: bool = False,
                  excluded_srns: Sequence[int] = (), inspection_lookup: str = INSPECTION_LOOKUP,
                  corrected: bool = False, keep: Steps | None = None) -> DataFrame:
    """K9 source at transaction grain: receipt transaction ⟕ shipment line
    (with "Received By") ⟕ shipment header, plus inspection pending (K6,
    standard) or the service note with its verification note and line
    (K10/K11, blanket).

    The service-note conditions of the source name the order header, release
    and location; inside a matched receipt those equal the receipt's own
    header, release and location ids (the receipt join demands it), and
    without a receipt the shipment header is NULL so nothing matches — hence
    the note can be joined here, at receipt grain.

    Receipts of locations that are not on an order of ``kind`` meet no order
    row; they are left out before the chain. With ``keep`` every part of the
    chain, and the chain after every join of a wide part, is stored.
    """
    rsl = t["rcv_shipment_lines"].select("shipment_line_id", "shipment_header_id", "line_num", "last_updated_by",
                                         day("last_update_date").alias("__upd_day"))
    u = t["users"]
    ppl = t["people_f"]
    link = u["user_id"] if legacy else u["employee_id"]
    who = u.join(ppl, link == ppl["person_id"]).select("user_id", "effective_start_date", "effective_end_date", "full_name")
    rsl = dated_lookup(rsl, who, "last_updated_by", "user_id", "__upd_day", "effective_start_date", "effective_end_date",
                       {"received_by": "full_name"}, name="received by").drop("__upd_day")
    rsl = _step(keep, rsl, "shipment_lines")
    own = ["rt_transaction_id", "rt_po_line_location_id"]
    rt = pfx(t["rcv_transactions"], "rt")
    rt = semi_in(rt, _locations_of_kind(t, kind), "rt_po_line_location_id", "k_loc")
    if kind == STANDARD:
        # before the shipment: the fewer columns a receipt has, the less this join moves
        pending = inspection_pending(t, as_of, inspection_lookup, corrected, keep)
        rt = attach(rt, _step(keep, pending, "inspections"), "rt_transaction_id", "k6_transaction_id", spread_by=own)
    rt = _step(keep, rt, "receipts_of_kind", _CHAIN_STEP)
    rt = keyed_join(rt, pfx(rsl, "rsl"), "rt_shipment_line_id", "rsl_shipment_line_id", "left", spread_by=own)
    rt = keyed_join(rt, pfx(t["rcv_shipment_headers"], "rsh"), "rsl_shipment_header_id", "rsh_shipment_header_id", "left", spread_by=own)
    if kind == BLANKET:
        rt = rt.withColumn("rsh_attr1_num", num_key("rsh_attribute1"))
        rt = _step(keep, rt, "shipped", _CHAIN_STEP)
        rt = keyed_join(rt, _step(keep, srn_block(t, excluded_srns), "notes"), ["rt_po_header_id", "rsh_attr1_num", "rt_po_release_id"],
                        ["srh_po_header_id", "srh_srn_header_id", "srh_po_release_id"], "left", spread_by=own)
        rt = _step(keep, rt, "noted", _CHAIN_STEP)
        rt = keyed_join(rt, pfx(t["srn_lines"], "srl"), ["srh_srn_header_id", "rt_po_line_location_id"],
                        ["srl_srn_header_id", "srl_line_location_id"], "left", spread_by=own)
    return rt


def _live_invoice_distributions(t: Tables) -> DataFrame:
    return t["invoice_distributions"].where(flag_is("cancellation_flag", "N", "Y"))


def invoice_chain(t: Tables, kind: str, keep: Steps | None = None, of: DataFrame | None = None) -> DataFrame:
    """K13/K14 source: live invoice distribution ⟕ line ⟕ invoice ⟕ payment
    schedule ⟕ invoice payment (invoice, instalment) ⟕ check.

    Cancellation flags: a NULL distribution flag drops the row; the line's
    flag is tested (NULL drops) in the standard report only. ``of`` leaves
    invoice rows of other PO distributions out; with ``keep`` the invoices
    and the invoice lines are stored before they meet."""
    aida = pfx(_live_invoice_distributions(t), "aida")
    if of is not None:
        aida = semi_in(aida, of, "aida_po_distribution_id", of.columns[0])
    lines = t["invoice_lines"]
    if kind == STANDARD:
        lines = lines.where(flag_is("cancelled_flag", "N", "Y"))
    # schedule, payment and check meet at invoice grain; the distributions,
    # of which one invoice may have very many, come last and on the left,
    # where a hot key can be split
    paid = keyed_join(pfx(t["invoices"], "aia"), pfx(t["payment_schedules"], "apsa"), "aia_invoice_id", "apsa_invoice_id", "left")
    instalment = ["aia_invoice_id", "apsa_payment_num"]
    paid = keyed_join(paid, pfx(t["invoice_payments"], "aipa"), instalment, ["aipa_invoice_id", "aipa_payment_num"], "left", spread_by=instalment)
    paid = keyed_join(paid, pfx(t["checks"], "aca"), "aipa_check_id", "aca_check_id", "left", spread_by=instalment)
    paid = _step(keep, paid, "paid", _INVOICE_STEP)
    inv = keyed_join(aida, pfx(lines, "aila"), ["aida_invoice_id", "aida_invoice_line_number"],
                     ["aila_invoice_id", "aila_line_number"], "left")
    inv = _step(keep, inv, "invoiced", _INVOICE_STEP)
    return keyed_join(inv, paid, "aida_invoice_id", "aia_invoice_id", "left", spread_by=["aida_po_distribution_id", "aida_invoice_line_number"])


def distribution_chain(t: Tables, kind: str, pda: DataFrame | None = None, keep: Steps | None = None) -> DataFrame:
    """PO distribution ⟕ ledger code ⟕ work order ⟕ project ⟕ invoice chain,
    of ``pda`` (default: every distribution).

    A distribution with very many invoice rows is split over many tasks: the
    distributions without a live invoice row are told by a narrow plan. With
    ``keep`` both sides are stored before they meet, and only invoice rows of
    ``pda`` are read."""
    if pda is None:
        pda = pfx(t["po_distributions"], "pda")
    of = None
    if keep is not None:
        pda = keep(pda, "distributions_of_kind")
        of = pda.select(F.col("pda_po_distribution_id").alias("__of"))
    own = ["pda_po_distribution_id", "pda_line_location_id"]
    pda = keyed_join(pda, pfx(t["wip_entities"], "we"), "pda_wip_entity_id", "we_wip_entity_id", "left", spread_by=own)
    pda = keyed_join(pda, pfx(t["projects"], "ppa"), "pda_project_id", "ppa_project_id", "left", spread_by=own)
    pda = keyed_join(pda, pfx(t["gl_code_combinations"], "gcc"), "pda_code_combination_id", "gcc_code_combination_id", "left", spread_by=own)
    pda = _step(keep, pda, "charged", _DISTRIBUTION_STEP)
    billed = _live_invoice_distributions(t).select(F.col("po_distribution_id").alias("b_dist"))
    unbilled = t["po_distributions"].select(F.col("po_distribution_id").alias("u_dist")) if of is None else of.withColumnRenamed("__of", "u_dist")
    unbilled = unbilled.distinct().join(billed, F.col("u_dist") == F.col("b_dist"), "left_anti")
    unbilled = _step(keep, unbilled, "unbilled")
    invoices = _step(keep, invoice_chain(t, kind, keep, of), "invoices", _INVOICE_STEP)
    return left_join_splittable(pda, invoices, "pda_po_distribution_id", "aida_po_distribution_id", unbilled,
                                {"pda_po_distribution_id": "u_dist"}, spread_by=["pda_line_location_id", "pda_req_distribution_id"])


def srn_block(t: Tables, excluded_srns: Sequence[int] = ()) -> DataFrame:
    """SRN headers with their (single, non-rejected) verification
    note; SRN ids in ``excluded_srns`` (none by default) get NULLs."""
    vrn = t["vrn_headers"].join(t["vrn_lines"].select("vrn_header_id", "srn_header_id", "comments"), "vrn_header_id")
    vrn = vrn.where(F.col("status") != "REJECTED")
    if excluded_srns:
        vrn = vrn.where(~F.col("srn_header_id").isin(*excluded_srns))
    srh = pfx(t["srn_headers"], "srh")
    return scalar_lookup(srh, vrn, "srh_srn_header_id", "srn_header_id", {
        "vrn_number": "vrn_number", "vrn_desc": "description", "vrn_created": "creation_date",
        "vrn_decided": "apprv_reject_date", "vrn_status": "status", "vrn_amount": "vrn_verified_amt",
        "vrn_comments": "comments",
    }, name="verification note")


def _locations(t: Tables, kind: str) -> DataFrame:
    """Locations of the orders of one kind, with their line, header and release ids."""
    pha = t["po_headers"].where(F.col("type_lookup_code") == kind).select(F.col("po_header_id").alias("k_hdr"))
    pla = t["po_lines"].select(F.col("po_line_id").alias("k_line"), F.col("po_header_id").alias("k_line_hdr"))
    plla = t["po_line_locations"].select(F.col("line_location_id").alias("k_loc"), F.col("po_line_id").alias("k_loc_line"),
                                          F.col("po_release_id").alias("k_loc_rel"))
    return plla.join(pla, F.col("k_loc_line") == F.col("k_line")).join(pha, F.col("k_line_hdr") == F.col("k_hdr"))


#: Under this name ``po_parts`` puts the stored ``_order_locations`` of its kind beside the tables.
_KEPT_LOCATIONS = "order_locations"


def _locations_of_kind(t: Tables, kind: str) -> DataFrame:
    """(k_loc): the location ids of the orders of one kind; receipts and distributions elsewhere meet no order row."""
    return (t[_KEPT_LOCATIONS] if _KEPT_LOCATIONS in t else _locations(t, kind)).select("k_loc")


def _order_locations(t: Tables, kind: str) -> DataFrame:
    """Narrow order side at location grain: the key columns of ``po_block``'s rows before any fan-out."""
    if _KEPT_LOCATIONS in t:
        return t[_KEPT_LOCATIONS]
    core = _locations(t, kind)
    if kind == BLANKET:
        core = keyed_join(core, t["po_releases"].select(F.col("po_release_id").alias("k_rel")), "k_loc_rel", "k_rel", "left")
        return core.select("k_loc", "k_hdr", "k_line", "k_rel")
    return core.select("k_loc", "k_hdr", "k_line")


def _raw_receipts(t: Tables) -> DataFrame:
    return t["rcv_transactions"].select(
        F.col("po_line_location_id").alias("r_loc"), F.col("po_header_id").alias("r_hdr"), F.col("po_line_id").alias("r_line"),
        F.col("po_release_id").alias("r_rel"), F.col("po_distribution_id").alias("r_dist"))


def _received(kind: str) -> Column:
    """Full receipt condition between ``_order_locations`` and ``_raw_receipts``."""
    cond = (F.col("k_loc") == F.col("r_loc")) & (F.col("k_hdr") == F.col("r_hdr")) & (F.col("k_line") == F.col("r_line"))
    return cond & (F.col("k_rel") == F.col("r_rel")) if kind == BLANKET else cond


def _unreceived(t: Tables, kind: str) -> DataFrame:
    """Locations that no receipt matches."""
    return _order_locations(t, kind).join(_raw_receipts(t), _received(kind), "left_anti").distinct()


def _wanted_distributions(t: Tables, kind: str, unreceived: DataFrame | None = None) -> DataFrame:
    """(k_loc, r_dist): what the order rows ask of a location's distributions (NULL: every one).

    ``unreceived``: ``_unreceived``, where it is stored already."""
    if kind == STANDARD:
        return _order_locations(t, kind).select("k_loc", F.lit(None).cast("bigint").alias("r_dist")).distinct()
    named = _order_locations(t, kind).join(_raw_receipts(t), _received(kind)).select("k_loc", "r_dist")
    none = (_unreceived(t, kind) if unreceived is None else unreceived).select("k_loc", F.lit(None).cast("bigint").alias("r_dist"))
    return named.unionByName(none).distinct()


def _raw_distributions(t: Tables, kind: str) -> DataFrame:
    """(d_loc, d_asked, ...): every distribution as an order row can ask for it: by location alone (``d_asked`` NULL)
    and, on the blanket side, by its own id."""
    d = t["po_distributions"].select(F.col("line_location_id").alias("d_loc"), F.col("po_distribution_id").alias("d_id"),
                                     F.col("req_distribution_id").alias("po_key"))
    return by_name_and_all(d, "d_id", "d_asked") if kind == BLANKET else d.withColumn("d_asked", F.lit(None).cast("bigint"))


def _asks(kind: str) -> Column:
    """Equi-join condition between ``_wanted_distributions`` and ``_raw_distributions``."""
    at = F.col("k_loc") == F.col("d_loc")
    return at & F.col("r_dist").eqNullSafe(F.col("d_asked")) if kind == BLANKET else at


# Columns that the reports take from each part of ``po_block``, with the keys
# of its joins: what a stored step holds (in one plan Catalyst prunes the rest).
_RECEIPT_STEP = {
    "rt": ("transaction_id", "po_line_location_id", "po_header_id", "po_line_id", "po_release_id", "po_distribution_id", "quantity",
           "currency_code", "currency_conversion_rate", "transaction_type", "transaction_date"),
    "rsl": ("line_num", "received_by"),
    "rsh": ("receipt_num", "creation_date"),
    "k6": ("pending_with",),
    "srh": ("srn_number", "description", "creation_date", "apprv_reject_date", "status"),
    "srl": ("comments", "requester_quantity", "supplier_quantity", "qs_quantity"),
    "vrn": ("number", "desc", "created", "decided", "status", "amount", "comments"),
}
_ORDER_STEP = _RECEIPT_STEP | {
    "plla": ("line_location_id", "quantity", "price_override", "receiving_routing_id"),
    "pla": ("po_line_id", "line_num", "item_description"),
    "pha": ("po_header_id", "segment1", "comments", "type_lookup_code", "creation_date", "approved_date", "authorization_status",
            "currency_code", "rate"),
    "pra": ("po_release_id", "release_num", "approved_date", "authorization_status"),
    "po": ("first_appr", "pending_name", "pending_empno"),
    "br": ("first_appr",),
    "acv": ("amount",),
    "supplier": ("name",),
    "ch": ("name",),
    "ce": ("name",),
    "qs": ("name",),
}
_DISTRIBUTION_STEP = {
    "pda": ("po_distribution_id", "line_location_id", "req_distribution_id", "asked"),
    "we": ("wip_entity_name",),
    "ppa": ("segment1",),
    "gcc": tuple(f"segment{i}" for i in range(1, 8)),
    "aida": ("invoice_id", "amount", "line_type_lookup_code", "match_status_flag"),
    "aila": ("line_number",),
    "aia": ("invoice_num", "invoice_date", "creation_date", "payment_status_flag", "approval_ready_flag", "exchange_rate", "invoice_currency_code"),
    "apsa": ("payment_num", "due_date", "payment_status_flag"),
    "aipa": ("amount",),
    "aca": ("check_date", "currency_code", "exchange_rate", "amount"),
}


def _with_keys(step: Mapping[str, Sequence[str]], keys: Mapping[str, Sequence[str]]) -> dict[str, tuple[str, ...]]:
    return {p: (*step.get(p, ()), *keys.get(p, ())) for p in {**step, **keys}}


# The same for the steps that lead there, with the keys of the joins still to come.
_CHAIN_STEP = _with_keys(_RECEIPT_STEP, {"rt": ("shipment_line_id",), "rsh": ("attr1_num",), "srh": ("srn_header_id",)})
_INVOICE_STEP = _with_keys(_DISTRIBUTION_STEP, {"aida": ("po_distribution_id", "invoice_line_number"), "aia": ("invoice_id",)})
_REQUISITION_STEP = {
    "porha": ("requisition_header_id", "segment1", "description", "creation_date", "authorization_status", "approved_date"),
    "pr": ("first_appr", "pending_with"),
    "porla": ("requisition_line_id", "requisition_header_id", "line_num", "quantity", "unit_price", "currency_code", "urgent_flag",
              "need_by_date", "item_description", "item_id", "attribute2"),
    "msib": ("segment1", "item_type", "attribute1"),
    "papf": ("full_name",),
    "pord": ("distribution_id",),
}


def _step(keep: Steps | None, df: DataFrame, tag: str, columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``df``, or, with ``keep``, those of its columns that are named (prefix -> columns; default all), stored."""
    if keep is None:
        return df
    return keep(df if columns is None else _named(df, columns), tag)


def _named(df: DataFrame, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    wanted = {f"{p}_{c}" for p, cols in columns.items() for c in cols}
    return df.select(*[c for c in df.columns if c in wanted])


def po_block(t: Tables, as_of: str, kind: str, legacy: bool = False, **how) -> DataFrame:
    """K5 + K9–K16 at order grain: location [⟕ release] ⋈ line ⋈ header,
    then ⟕ receipt chain and ⟕ distribution chain (standard: every
    distribution of the location; blanket: the receipt's distribution, or
    all when the receipt names none).

    Narrow rows meet first (release at location grain, header lookups at
    header grain). Both fan-out joins are written as inner joins with
    placeholders for the rows without a match, so a location with very many
    receipts or distributions is split over many tasks.
    """
    return next(iter(po_parts(t, as_of, kind, legacy, **how)))


def po_parts(t: Tables, as_of: str, kind: str, legacy: bool = False, excluded_srns: Sequence[int] = (),
             inspection_lookup: str = INSPECTION_LOOKUP, qs_lookup: str = QS_LOOKUP, corrected: bool = False,
             keep: Steps | None = None) -> Iterator[DataFrame]:
    """``po_block`` as one frame, or, with ``keep``, as frames that hold its rows by slices of their location.

    With ``keep`` the receipts, the rows they meet and the distributions are
    stored one after the other, with the columns that a report takes, and so
    are the parts that lead to each of them, which are dropped after it.
    """
    if keep is not None:
        t = {**t, _KEPT_LOCATIONS: keep(_order_locations(t, kind), "locations")}

    def led(build: Callable[[Steps | None], DataFrame], into: Steps | None, tag: str, columns: Mapping[str, Sequence[str]]) -> DataFrame:
        """What ``build`` makes, stored ``into`` these steps; the inner ones that led to it are dropped."""
        inner = None if into is None else into.inner()
        df = _step(into, build(inner), tag, columns)
        if inner is not None:
            inner.drop()
        return df

    def orders(inner: Steps | None) -> DataFrame:
        pha = _step(inner, po_header_block(t, as_of, kind, qs_lookup, inner), "headers", _ORDER_STEP)
        plla = pfx(t["po_line_locations"], "plla")
        if kind == BLANKET:
            plla = keyed_join(plla, _step(inner, release_block(t, as_of, inner), "releases", _ORDER_STEP), "plla_po_release_id", "pra_po_release_id", "left")
        lines = pfx(t["po_lines"], "pla").join(plla, F.col("pla_po_line_id") == F.col("plla_po_line_id"))
        return _step(inner, lines, "order_lines", _with_keys(_ORDER_STEP, {"pla": ("po_header_id",)})).join(
            pha, F.col("pla_po_header_id") == F.col("pha_po_header_id"))

    told = {"plla_line_location_id": "k_loc", "pha_po_header_id": "k_hdr", "pla_po_line_id": "k_line"}
    rt_cond = same("pha_po_header_id", "rt_po_header_id") & same("pla_po_line_id", "rt_po_line_id")
    asked, also = {"plla_line_location_id": "k_loc"}, {}
    unreceived = _step(keep, _unreceived(t, kind), "unreceived")
    wanted, pda = _step(keep, _wanted_distributions(t, kind, unreceived), "wanted"), pfx(t["po_distributions"], "pda")
    if kind == BLANKET:
        told["pra_po_release_id"] = "k_rel"
        rt_cond = rt_cond & same("pra_po_release_id", "rt_po_release_id")
        # a receipt that names a distribution meets it by (location, id), the others meet all of
        # their location by (location, NULL); distributions that no row asks for so are left out
        asked["rt_po_distribution_id"], also = "r_dist", {"rt_po_distribution_id": "pda_asked"}
        pda = by_name_and_all(pda, "pda_po_distribution_id", "pda_asked")
        pda = pda.join(wanted, (F.col("pda_line_location_id") == F.col("k_loc")) & F.col("pda_asked").eqNullSafe(F.col("r_dist")), "left_semi")
    else:
        pda = semi_in(pda, _locations_of_kind(t, kind), "pda_line_location_id", "k_loc")
    # the ids that spread rows without a location; every further one would have to move with the row
    own = ["pla_po_line_id", "pha_po_header_id"]

    def received(inner: Steps | None) -> Iterator[DataFrame]:
        receipts = led(lambda steps: receipt_chain(t, as_of, kind, legacy, excluded_srns, inspection_lookup, corrected, steps), inner, "receipts", _RECEIPT_STEP)
        po = led(orders, inner, "order_rows", _ORDER_STEP)
        n = 1 if inner is None else inner.slices()
        for i in range(n):
            yield left_join_splittable(
                po.where(in_slice("plla_line_location_id", i, n)), receipts.where(in_slice("rt_po_line_location_id", i, n)), "plla_line_location_id",
                "rt_po_line_location_id", unreceived.where(in_slice("k_loc", i, n)), told, rt_cond, spread_by=own)

    without = _step(keep, wanted.join(_raw_distributions(t, kind), _asks(kind), "left_anti"), "without")
    if keep is None:
        po = next(received(None))
    else:
        inner = keep.inner()
        po = keep.parts((_named(x, _ORDER_STEP) for x in received(inner)), "received")
        inner.drop()
    dist = led(lambda steps: distribution_chain(t, kind, pda, steps), keep, "distributions", _DISTRIBUTION_STEP)
    n = 1 if keep is None else keep.slices()
    for i in range(n):
        yield left_join_splittable(
            po.where(in_slice("plla_line_location_id", i, n)), dist.where(in_slice("pda_line_location_id", i, n)), "plla_line_location_id",
            "pda_line_location_id", without.where(in_slice("k_loc", i, n)), asked, also=also, spread_by=[*own, "rt_transaction_id"])


def po_distribution_keys(t: Tables, kind: str) -> DataFrame:
    """Requisition-distribution ids that occur on the order side of a report
    (column ``po_key``), computed without the wide chains.

    Exact: the order side is ``core ⟕ receipts ⟕ distributions``. Receipt
    fan-out and the shipment/inspection/note/invoice joins never change
    which distributions appear, so the standard side's keys are the
    distributions of its locations. On the blanket side a distribution
    appears when the location has no matching receipt, or a matching receipt
    names it or names none — decided from the raw receipt rows.
    """
    return _raw_distributions(t, kind).join(_wanted_distributions(t, kind), _asks(kind), "left_semi").select("po_key")


def pr_distribution_keys(t: Tables, sourced: bool) -> DataFrame:
    """Requisition-distribution ids of ``pr_block``'s rows, without its lookups."""
    return _live_req_lines(t, sourced).select(F.col("requisition_line_id").alias("y_line"), F.col("requisition_header_id").alias("y_hdr")).join(
        t["req_headers"].select(F.col("requisition_header_id").alias("y_id")), F.col("y_hdr") == F.col("y_id")
    ).join(
        t["req_distributions"].select(F.col("requisition_line_id").alias("y_of"), F.col("distribution_id").alias("pr_dist")), F.col("y_line") == F.col("y_of")
    ).select("pr_dist")


def rfq_distribution_keys(t: Tables) -> DataFrame:
    """Requisition-distribution ids of ``rfq_block``'s rows, without its lookups."""
    return _sourced_distributions(t, t["rfq_headers"].where(F.col("auction_header_id").isNotNull()).select(F.col("auction_header_id").alias("ph_auction_header_id"))).select(
        F.col("prd_distribution_id").alias("rfq_dist"))
