"""The three lineage reports.

``report_blanket`` / ``report_standard`` flatten the procure-to-pay chain of
one order type into 107 columns; ``report_union`` is their set union
(duplicates removed across and within both). ``legacy=True`` reproduces the
older union layout and links: received-by through ``user_id``, payment
amount of the whole check, raw RFQ origination code, and an always-NULL
"RFQ Stage" column.

Results keep the source's fan-out (receipts × distributions × invoice
distributions × schedules × payments), so amount columns are not additive.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.functions import concat_code, convert_amount, typed_null
from procura.operators import drill, lineage_chain, lineage_parts, union_distinct, union_distinct_stored
from procura.plans.blocks import (
    BLANKET,
    INSPECTION_LOOKUP,
    QS_LOOKUP,
    STANDARD,
    po_block,
    po_distribution_keys,
    po_parts,
    pr_block,
    pr_distribution_keys,
    rfq_block,
    rfq_distribution_keys,
)
from procura.plans.schema import LEGACY_SCHEMA, REPORT_SCHEMA
from procura.session import Steps

Tables = Mapping[str, DataFrame]

DEFAULT_AS_OF = "1998-06-15 10:00:00"

_PR_COLS = [
    "DISTRIBUTION_ID", "PR_Number", "PR_Description", "PR_Creation_Date", "PR_Status", "PR_Line_No", "PR_Quantity",
    "Unit_Price", "PR_Line_Amount_OMR", "PR Line Currency", "RUSH_FLAG", "NEED_BY_DATE", "PR Latest Approved Date",
    "PR Original Approved Date", "Item Code", "Item Description", "Item Type", "Sourced Or Unsourced", "PR Requestor",
    "PR Approval Pending With",
]

_RFQ = [
    ("RFQ Number", "ad_number"), ("RFQ Status", "ad_status"), ("RFQ Type", "ad_type"),
    ("RFQ Creation Date", "ad_creation_date"), ("RFQ Closed Date", "ad_closed_date"), ("RFQ Strategy", "ad_strategy"),
    ("TE Date", "ad_te_date"), ("RFQ Award Date", "ad_award_date"), ("RFQ Submit Date", "ad_submit_date"),
    ("RFQ Publish Date", "ad_publish_date"), ("Buyer Name", "ad_buyer"),
]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# Columns that are non-NULL even on requisition-/RFQ-only rows: their default
# is applied after the FULL joins (order-side rows already carry a value).
_AFTER_JOIN_DEFAULTS = {
    "PO ORDER CURRENCY": "USD",
    "Receipt Currency": "USD",
    "Payment Currency": "USD",
    "Inspection Flag": "No",
    "Match Status Flag": "Never Validated",
    "GL Code Combination": "......",
}

_PO_KEY = "__po_req_distribution_id"
# hash of an order-side row's identity (location × receipt × distribution ×
# invoice distribution × instalment), of NULL-keyed rows alone: spreads them
_PO_SPREAD = ["__po_spread"]
_PR_SPREAD = ["__pr_line"]


def _po_outputs(kind: str, legacy: bool) -> dict[str, Column]:
    """Order-side report columns, evaluated before the FULL joins so only
    output-sized rows are shuffled (defaults of ``_AFTER_JOIN_DEFAULTS`` are
    left NULL here)."""
    blanket = kind == BLANKET
    price = F.col("plla_price_override")
    order_amt = price * F.col("plla_quantity")
    rcv_amt = price * F.col("rt_quantity")
    ttype = F.col("rt_transaction_type")
    inspected = ttype.isin("ACCEPT", "REJECT")
    delivered = ttype == "DELIVER"
    pay_amt = F.col("aca_amount") if legacy else F.col("aipa_amount")
    c = {
        "PO Number": F.col("pha_segment1"),
        "RID": F.col("pda_req_distribution_id"),
        "PO Line": F.col("pla_line_num"),
        "PO Header Description": F.col("pha_comments"),
        "PO Line Description": F.col("pla_item_description"),
        "PO Type (Blanket/Standard)": F.col("pha_type_lookup_code"),
        "PO Creation Date": F.col("pha_creation_date"),
        "PO Latested Approved Date": F.col("pha_approved_date"),
        "PO Original Approved Date": F.col("po_first_appr"),
        "PO Status": F.col("pha_authorization_status"),
        "Supplier Name": F.col("supplier_name"),
        "GL Code Combination": concat_code([F.col(f"gcc_segment{i}") for i in range(1, 8)]),
        "WO Number": F.col("we_wip_entity_name"),
        "Project Number": F.col("ppa_segment1"),
        "ACV AMOUNT": F.col("acv_amount"),
        "PO Order Qty": F.col("plla_quantity"),
        "PO Order Amount": order_amt,
        "PO ORDER CURRENCY": F.col("pha_currency_code"),
        "PO Order Amount (USD)": convert_amount(order_amt, "pha_rate"),
        "PO approval Pending with": F.col("po_pending_name"),
        "PO approval Pending with Employee Id": F.col("po_pending_empno"),
        "Receipt Number": F.col("rsh_receipt_num"),
        "Receipt Date": F.col("rsh_creation_date"),
        "Receipt line No": F.col("rsl_line_num"),
        "Receipt Qty": F.col("rt_quantity"),
        "Receipt Amount": rcv_amt,
        "Receipt Currency": F.col("rt_currency_code"),
        "Receipt Amount (USD)": convert_amount(rcv_amt, "rt_currency_conversion_rate"),
        "Received By": F.col("rsl_received_by"),
        "Inspection Flag": F.when(F.col("plla_receiving_routing_id") == 2, F.lit("Yes")).otherwise(F.lit("No")),
        "Inspection Date": F.when(inspected, F.col("rt_transaction_date")),
        "Inspection STATUS": F.when(inspected, ttype),
        "Delivery Date": F.when(delivered, F.col("rt_transaction_date")),
        "Delivery Status": F.when(delivered, ttype),
        "Invoice Number": F.col("aia_invoice_num"),
        "Invoice Line": F.col("aila_line_number"),
        "Invoice Line Type": F.col("aida_line_type_lookup_code"),
        "Invoice Approved date": F.col("aia_invoice_date"),
        "Invoice create date": F.col("aia_creation_date"),
        "Invoice Status": F.when(F.col("aia_payment_status_flag") == "Y", F.lit("Paid"))
        .when(F.col("aia_approval_ready_flag") == "Y", F.lit("Ready for Approval"))
        .when(F.col("aia_approval_ready_flag") == "N", F.lit("Not Ready for Approval")),
        "Match Status Flag": F.when(F.col("aida_match_status_flag") == "A", F.lit("Validated"))
        .when(F.col("aida_match_status_flag") == "R", F.lit("Needs Revalidation"))
        .otherwise(F.lit("Never Validated")),
        "Exchange Rate": F.col("aia_exchange_rate"),
        "Invoice Amount": F.col("aida_amount"),
        "Invoice Currency": F.col("aia_invoice_currency_code"),
        "Invoice Amount USD": convert_amount("aida_amount", "aia_exchange_rate"),
        "Payment Date": F.col("aca_check_date"),
        "Payment Currency": F.col("aca_currency_code"),
        "Payment Amount": pay_amt,
        "Payment Amount (USD)": convert_amount(pay_amt, "aca_exchange_rate"),
        "Payment Due Date": F.col("apsa_due_date"),
        "Payment Status": F.col("apsa_payment_status_flag"),
    }
    if blanket:
        c.update({
            "BR Number - Blanket": F.col("pra_release_num"),
            "BR Approved Date - Blanket": F.col("pra_approved_date"),
            "BR_ORIGINAL_APPROVED_DATE": F.col("br_first_appr"),
            "BR Status - Blanket": F.col("pra_authorization_status"),
            "CH Name (Contract Holder) - Blanket": F.col("ch_name"),
            "CE Name (Contract Engineer) - Blanket": F.col("ce_name"),
            "SRN Number": F.col("srh_srn_number"),
            "SRN Desc": F.col("srh_description"),
            "SRN Creation Date": F.col("srh_creation_date"),
            "SRN Approved/Reject Date": F.col("srh_apprv_reject_date"),
            "SRN Status": F.col("srh_status"),
            "SRN Comments": F.col("srl_comments"),
            "Requestor Qty": F.col("srl_requester_quantity"),
            "Supplier Qty": F.col("srl_supplier_quantity"),
            "QS Qty": F.col("srl_qs_quantity"),
            "VRN Number": F.col("vrn_number"),
            "VRN Desc": F.col("vrn_desc"),
            "VRN Creation Date": F.col("vrn_created"),
            "VRN Approved/Reject Date": F.col("vrn_decided"),
            "VRN Status": F.col("vrn_status"),
            "VRN Verified Amount": F.col("vrn_amount"),
            "QS NAME": F.col("qs_name"),
            "QS COMMENTS": F.col("vrn_comments"),
        })
    else:
        c["Inspection Pending With"] = F.col("k6_pending_with")
    return c


def _narrow_po(po: DataFrame, kind: str, legacy: bool) -> DataFrame:
    schema = LEGACY_SCHEMA if legacy else REPORT_SCHEMA
    types = {f.name: f.dataType for f in schema.fields}
    outs = _po_outputs(kind, legacy)
    ident = ["plla_line_location_id", "rt_transaction_id", "pda_po_distribution_id", "aida_invoice_id", "apsa_payment_num"]
    return po.select(F.col("pda_req_distribution_id").alias(_PO_KEY),
                     F.when(F.col("pda_req_distribution_id").isNull(), F.xxhash64(*ident)).alias(_PO_SPREAD[0]),
                     *[e.cast(types[n]).alias(n) for n, e in outs.items()])


def _project(df: DataFrame, kind: str, legacy: bool) -> DataFrame:
    """Final report columns after the FULL joins: order-side columns as
    computed by ``_narrow_po`` (plus their defaults), requisition and RFQ
    columns from their blocks, typed NULLs for the other report's columns."""
    c = {n: _c(n) for n in _po_outputs(kind, legacy)}
    for n, d in _AFTER_JOIN_DEFAULTS.items():
        c[n] = F.coalesce(_c(n), F.lit(d))
    c.update({n: _c(n) for n in _PR_COLS})
    if kind == STANDARD:
        for out, src in _RFQ:
            c[out] = F.col(src)
        c["Inspection Group"] = F.when(F.col("pd_item_id").isNull() & F.col("pd_attribute2").isNotNull(), F.col("pd_attribute2")) \
            .otherwise(F.col("pd_attribute1"))
    schema = LEGACY_SCHEMA if legacy else REPORT_SCHEMA
    return df.select(*[
        c[f.name].cast(f.dataType).alias(f.name) if f.name in c else typed_null(f.name, f.dataType) for f in schema.fields
    ])


def _made(t: Tables, as_of: str, kind: str, legacy: bool, keep: Steps, stored: bool, only: Mapping[str, object] | None,
          dedupe_rfq: bool = False, **how) -> DataFrame:
    """A report in stored steps: order side, requisition side, and the rows where both meet.

    These rows are stored too, and the sides dropped, if ``stored`` asks for
    it or if they are made in several slices. ``only`` (column -> value)
    narrows as Catalyst narrows one plan: a column that the report does not
    fill leaves no row, one of the order side is tested there (without an
    order it is NULL), and the rows made are tested for all."""
    only = only or {}
    filled = {*_po_outputs(kind, legacy), *_PR_COLS, *([n for n, _ in _RFQ] + ["Inspection Group"] if kind == STANDARD else [])}
    if not filled.issuperset(only):
        schema = LEGACY_SCHEMA if legacy else REPORT_SCHEMA
        return keep.spark.range(0).select(*[typed_null(f.name, f.dataType) for f in schema.fields])
    early = {c: v for c, v in only.items() if c in _po_outputs(kind, legacy) and c not in _AFTER_JOIN_DEFAULTS}
    sides = keep.inner()
    leads = sides.inner()
    po = sides.parts((drill(_narrow_po(x, kind, legacy), **early) for x in po_parts(t, as_of, kind, legacy, keep=leads, **how)), "orders")
    leads.drop()
    if kind == BLANKET:
        pr, rfq = pr_block(t, as_of, True, keep=leads), None
    else:
        pr = _led(lambda inner: pr_block(t, as_of, False, keep=inner), leads, "unsourced")
        rfq = _led(lambda inner: rfq_block(t, as_of, legacy, dedupe_rfq, keep=inner), leads, "rfqs")
    parts = lineage_parts(po, pr, rfq, _PO_KEY, "DISTRIBUTION_ID", "ad_distribution_id", sides)
    first = next(parts)  # the requisition side is stored by now
    leads.drop()
    frames = [drill(_project(x, kind, legacy), **only) for x in (first, *parts)]
    if len(frames) == 1 and not stored:
        return frames[0]
    rows = keep.parts(frames, kind.lower())
    sides.drop()
    return rows


def _led(build: Callable[[Steps], DataFrame], into: Steps, tag: str) -> DataFrame:
    inner = into.inner()
    df = into(build(inner), tag)
    inner.drop()
    return df


def report_blanket(t: Tables, as_of: str = DEFAULT_AS_OF, legacy: bool = False, excluded_srns: Sequence[int] = (),
                   qs_lookup: str = QS_LOOKUP, keep: Steps | None = None, stored: bool = False,
                   only: Mapping[str, object] | None = None) -> DataFrame:
    """Blanket orders and releases ⟗ BLANKET-sourced requisitions.

    Service notes in ``excluded_srns`` show no verification note. With
    ``keep`` the report is made in steps, each stored, so that only the
    shuffles of one step are on disk at a time (``stored``: the report itself
    is, too), and ``only`` makes the rows alone whose columns have these
    values; without it, it is one plan that a filter on the report narrows as
    a whole (``drill``)."""
    how = {"excluded_srns": excluded_srns, "qs_lookup": qs_lookup}
    if keep is not None:
        return _made(t, as_of, BLANKET, legacy, keep, stored, only, **how)
    po = _narrow_po(po_block(t, as_of, BLANKET, legacy, **how), BLANKET, legacy)
    pr = pr_block(t, as_of, sourced=True)
    chained = lineage_chain(po, pr, None, _PO_KEY, "DISTRIBUTION_ID", po_spread=_PO_SPREAD, pr_spread=_PR_SPREAD,
                            po_keys=po_distribution_keys(t, BLANKET), pr_keys=pr_distribution_keys(t, True))
    return _project(chained, BLANKET, legacy)


def report_standard(t: Tables, as_of: str = DEFAULT_AS_OF, legacy: bool = False, dedupe_rfq: bool = False,
                    inspection_lookup: str = INSPECTION_LOOKUP, corrected: bool = False, keep: Steps | None = None,
                    stored: bool = False, only: Mapping[str, object] | None = None) -> DataFrame:
    """Standard orders ⟗ unsourced requisitions ⟗ RFQs (keyed on the
    requisition side). ``corrected`` takes "Inspection Pending With" from the
    item alone (see ``blocks.inspection_pending``); ``keep``, ``stored`` and
    ``only`` as in ``report_blanket``."""
    how = {"inspection_lookup": inspection_lookup, "corrected": corrected}
    if keep is not None:
        return _made(t, as_of, STANDARD, legacy, keep, stored, only, dedupe_rfq, **how)
    po = _narrow_po(po_block(t, as_of, STANDARD, legacy, **how), STANDARD, legacy)
    pr = pr_block(t, as_of, sourced=False)
    rfq = rfq_block(t, as_of, legacy=legacy, dedupe_rfq=dedupe_rfq)
    chained = lineage_chain(po, pr, rfq, _PO_KEY, "DISTRIBUTION_ID", "ad_distribution_id",
                            po_spread=_PO_SPREAD, pr_spread=_PR_SPREAD, rfq_spread=["ad_distribution_id"],
                            po_keys=po_distribution_keys(t, STANDARD), pr_keys=pr_distribution_keys(t, False), rfq_keys=rfq_distribution_keys(t))
    return _project(chained, STANDARD, legacy)


def report_union(t: Tables, as_of: str = DEFAULT_AS_OF, variant: str = "final", excluded_srns: Sequence[int] = (),
                 inspection_lookup: str = INSPECTION_LOOKUP, qs_lookup: str = QS_LOOKUP, corrected: bool = False, keep: Steps | None = None,
                 only: Mapping[str, object] | None = None) -> DataFrame:
    """Blanket UNION standard (distinct over all columns). ``corrected`` as in ``report_standard``,
    ``keep`` and ``only`` as in ``report_blanket``."""
    legacy = variant == "legacy"
    schema = LEGACY_SCHEMA if legacy else REPORT_SCHEMA
    blanket = report_blanket(t, as_of, legacy, excluded_srns, qs_lookup, keep, True, only)
    standard = report_standard(t, as_of, legacy, inspection_lookup=inspection_lookup, corrected=corrected, keep=keep, stored=True, only=only)
    return union_distinct(blanket, standard, schema) if keep is None else union_distinct_stored(blanket, standard, keep, schema)
