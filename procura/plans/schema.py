"""Output contract of the lineage reports.

Fixed values: the report column names and their order must equal the
reference reports' output exactly (107 columns; the legacy layout adds
"RFQ Stage" after "Buyer Name").
"""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, TS, I, L = StringType(), TimestampNTZType(), IntegerType(), LongType()
QTY, PRICE, AMT, RATE = DecimalType(20, 6), DecimalType(18, 6), DecimalType(28, 6), DecimalType(18, 9)

# Report column names, in output order, with their types.
REPORT_COLUMNS: list[tuple[str, object]] = [
    # requisition
    ("DISTRIBUTION_ID", L), ("PR_Number", S), ("PR_Description", S), ("PR_Creation_Date", TS),
    ("PR_Status", S), ("PR_Line_No", I), ("PR_Quantity", QTY), ("Unit_Price", PRICE),
    ("PR_Line_Amount_OMR", AMT), ("PR Line Currency", S), ("RUSH_FLAG", S), ("NEED_BY_DATE", TS),
    ("PR Latest Approved Date", TS), ("PR Original Approved Date", TS), ("Item Code", S),
    ("Item Description", S), ("Item Type", S), ("Sourced Or Unsourced", S), ("PR Requestor", S),
    ("PR Approval Pending With", S),
    # sourcing
    ("RFQ Number", S), ("RFQ Status", S), ("RFQ Type", S), ("RFQ Creation Date", TS),
    ("RFQ Closed Date", TS), ("RFQ Strategy", S), ("TE Date", S), ("RFQ Award Date", TS),
    ("RFQ Submit Date", TS), ("RFQ Publish Date", TS), ("Buyer Name", S),
    # order
    ("PO Number", S), ("RID", L), ("PO Line", I), ("PO Header Description", S),
    ("PO Line Description", S), ("PO Type (Blanket/Standard)", S), ("PO Creation Date", TS),
    ("PO Latested Approved Date", TS), ("PO Original Approved Date", TS), ("PO Status", S),
    ("BR Number - Blanket", I), ("BR Approved Date - Blanket", TS), ("BR_ORIGINAL_APPROVED_DATE", TS),
    ("BR Status - Blanket", S), ("CH Name (Contract Holder) - Blanket", S),
    ("CE Name (Contract Engineer) - Blanket", S), ("Supplier Name", S), ("GL Code Combination", S),
    ("WO Number", S), ("Project Number", S), ("ACV AMOUNT", AMT), ("PO Order Qty", QTY),
    ("PO Order Amount", AMT), ("PO ORDER CURRENCY", S), ("PO Order Amount (USD)", AMT),
    ("PO approval Pending with", S), ("PO approval Pending with Employee Id", S),
    # receipt
    ("Receipt Number", S), ("Receipt Date", TS), ("Receipt line No", I), ("Receipt Qty", QTY),
    ("Receipt Amount", AMT), ("Receipt Currency", S), ("Receipt Amount (USD)", AMT), ("Received By", S),
    # inspection
    ("Inspection Flag", S), ("Inspection Date", TS), ("Inspection STATUS", S), ("Inspection Group", S),
    ("Inspection Pending With", S),
    # delivery
    ("Delivery Date", TS), ("Delivery Status", S),
    # service receipt note
    ("SRN Number", S), ("SRN Desc", S), ("SRN Creation Date", TS), ("SRN Approved/Reject Date", TS),
    ("SRN Status", S), ("SRN Comments", S), ("Requestor Qty", QTY), ("Supplier Qty", QTY), ("QS Qty", QTY),
    # verification note
    ("VRN Number", S), ("VRN Desc", S), ("VRN Creation Date", TS), ("VRN Approved/Reject Date", TS),
    ("VRN Status", S), ("VRN Verified Amount", AMT), ("QS NAME", S), ("QS COMMENTS", S),
    # invoice
    ("Invoice Number", S), ("Invoice Line", I), ("Invoice Line Type", S), ("Invoice Approved date", TS),
    ("Invoice create date", TS), ("Invoice Status", S), ("Match Status Flag", S), ("Exchange Rate", RATE),
    ("Invoice Amount", AMT), ("Invoice Currency", S), ("Invoice Amount USD", AMT),
    # payment
    ("Payment Date", TS), ("Payment Currency", S), ("Payment Amount", AMT), ("Payment Amount (USD)", AMT),
    ("Payment Due Date", TS), ("Payment Status", S),
]

REPORT_SCHEMA = StructType([StructField(n, t, True) for n, t in REPORT_COLUMNS])

_legacy = list(REPORT_COLUMNS)
_legacy.insert([n for n, _ in _legacy].index("Buyer Name") + 1, ("RFQ Stage", S))
LEGACY_SCHEMA = StructType([StructField(n, t, True) for n, t in _legacy])

assert len(REPORT_SCHEMA.fields) == 107 and len(LEGACY_SCHEMA.fields) == 108


def duck_type(t) -> str:
    """DuckDB spelling of a report column type (used by the SQL oracle)."""
    if isinstance(t, DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return {StringType: "VARCHAR", TimestampNTZType: "TIMESTAMP", IntegerType: "INTEGER", LongType: "BIGINT"}[type(t)]
