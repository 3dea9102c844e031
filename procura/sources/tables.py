"""Canonical P2P tables and the loader (operator A1).

``load_tables`` accepts either a folder of Parquet files named after the
canonical tables, or a mapping ``{name: DataFrame}`` (catalog tables, views,
or frames derived elsewhere). Each table is narrowed to the columns the
reports read and cast to the canonical types. Column selection is explicit
so Parquet scans read only those columns.

The source dialect stores empty text as NULL, so data exported from it never
holds ''. For other sources ``empty_as_null=True`` maps '' to NULL; it is
off by default because the wrapped column (``nullif``) hides string
predicates from Parquet filter pushdown.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Types: ts = timestamp_ntz, qty = decimal(20,6), price = decimal(18,6),
# rate = decimal(18,9), id = bigint.
_T = {
    "id": LongType(),
    "int": IntegerType(),
    "str": StringType(),
    "ts": TimestampNTZType(),
    "qty": DecimalType(20, 6),
    "price": DecimalType(18, 6),
    "rate": DecimalType(18, 9),
}

_SPEC: dict[str, str] = {
    "po_headers": "po_header_id id, segment1 str, type_lookup_code str, comments str, creation_date ts, approved_date ts, authorization_status str, currency_code str, rate rate, vendor_id id, attribute3 str, attribute5 str",
    "po_lines": "po_line_id id, po_header_id id, line_num int, item_description str",
    "po_line_locations": "line_location_id id, po_line_id id, po_release_id id, quantity qty, price_override price, receiving_routing_id int",
    "po_releases": "po_release_id id, po_header_id id, release_num int, approved_date ts, authorization_status str",
    "po_distributions": "po_distribution_id id, line_location_id id, req_distribution_id id, code_combination_id id, wip_entity_id id, project_id id",
    "po_headers_archive": "segment1 str, amount_limit price",
    "po_action_history": "object_id id, object_type_code str, sequence_num int, action_code str, action_date ts, employee_id id",
    "rcv_transactions": "transaction_id id, parent_transaction_id id, transaction_type str, transaction_date ts, quantity qty, currency_code str, currency_conversion_rate rate, po_header_id id, po_line_id id, po_line_location_id id, po_release_id id, po_distribution_id id, shipment_header_id id, shipment_line_id id, organization_id id, routing_header_id str",
    "rcv_shipment_lines": "shipment_line_id id, shipment_header_id id, line_num int, item_id id, last_update_date ts, last_updated_by id",
    "rcv_shipment_headers": "shipment_header_id id, receipt_num str, creation_date ts, attribute1 str",
    "req_headers": "requisition_header_id id, segment1 str, description str, creation_date ts, authorization_status str, approved_date ts",
    "req_lines": "requisition_line_id id, requisition_header_id id, line_num int, quantity qty, unit_price price, rate rate, currency_code str, urgent_flag str, need_by_date ts, document_type_code str, cancel_flag str, item_id id, item_description str, attribute2 str, destination_organization_id id, to_person_id id",
    "req_distributions": "distribution_id id, requisition_line_id id",
    "items": "inventory_item_id id, organization_id id, segment1 str, item_type str, attribute1 str, inspection_required_flag str",
    "people_f": "person_id id, effective_start_date ts, effective_end_date ts, full_name str, employee_number str, email_address str",
    "assignments_f": "person_id id, position_id id, effective_start_date ts, effective_end_date ts",
    "positions": "position_id id, position_definition_id id",
    "position_definitions": "position_definition_id id, segment3 str",
    "users": "user_id id, employee_id id",
    "lookup_values": "lookup_type str, lookup_code str, tag str, description str, language str, enabled_flag str, start_date_active ts, end_date_active ts, zd_edition_name str",
    "suppliers": "vendor_id id, vendor_name str",
    "gl_code_combinations": "code_combination_id id, segment1 str, segment2 str, segment3 str, segment4 str, segment5 str, segment6 str, segment7 str",
    "wip_entities": "wip_entity_id id, wip_entity_name str",
    "projects": "project_id id, segment1 str",
    "srn_headers": "srn_header_id id, po_header_id id, po_release_id id, srn_number str, description str, creation_date ts, apprv_reject_date ts, status str",
    "srn_lines": "srn_header_id id, line_location_id id, comments str, requester_quantity qty, supplier_quantity qty, qs_quantity qty",
    "vrn_headers": "vrn_header_id id, vrn_number str, description str, creation_date ts, apprv_reject_date ts, status str, vrn_verified_amt price",
    "vrn_lines": "vrn_header_id id, srn_header_id id, comments str",
    "invoices": "invoice_id id, invoice_num str, invoice_date ts, creation_date ts, payment_status_flag str, approval_ready_flag str, exchange_rate rate, invoice_currency_code str",
    "invoice_lines": "invoice_id id, line_number int, cancelled_flag str",
    "invoice_distributions": "invoice_id id, invoice_line_number int, po_distribution_id id, amount price, line_type_lookup_code str, match_status_flag str, cancellation_flag str",
    "payment_schedules": "invoice_id id, payment_num int, due_date ts, payment_status_flag str",
    "invoice_payments": "invoice_id id, payment_num int, check_id id, amount price",
    "checks": "check_id id, check_date ts, currency_code str, exchange_rate rate, amount price",
    "rfq_headers": "auction_header_id id, document_number str, auction_status str, auction_origination_code str, bid_visibility_code str, creation_date ts, close_bidding_date ts, int_attribute6 str, int_attribute4 str, award_date ts, publish_date ts, created_by id",
    "rfq_lines": "auction_header_id id, line_number int, requisition_number str",
    "rfq_backing_reqs": "auction_header_id id, line_number int, requisition_header_id id, requisition_line_id id",
    "rfq_action_history": "object_id id, object_type_code str, action_type str, action_date ts",
}


def _schema(spec: str) -> StructType:
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(StructField(name, _T[kind], True))
    return StructType(fields)


#: canonical schema per table (names as the reports use them)
SCHEMAS: dict[str, StructType] = {t: _schema(s) for t, s in _SPEC.items()}
TABLES: tuple[str, ...] = tuple(_SPEC)


def conform_table(df: DataFrame, schema: StructType, empty_as_null: bool = False) -> DataFrame:
    """Narrow to ``schema``'s columns and cast; optionally map '' to NULL."""
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if df.schema[f.name].dataType != f.dataType:
            c = c.cast(f.dataType)
        if empty_as_null and isinstance(f.dataType, StringType):
            c = F.nullif(c, F.lit(""))
        out.append(c.alias(f.name))
    return df.select(*out)


def load_tables(
    spark: SparkSession,
    source: str | Mapping[str, DataFrame | str],
    names=TABLES,
    empty_as_null: bool = True,
) -> dict[str, DataFrame]:
    """Load the canonical tables: from a Parquet folder, or from a map of name
    to a DataFrame or a catalog table's name. Empty text is read as NULL, as
    the source database does; switch it off for exports that already did so,
    so that string predicates reach the Parquet scan."""
    tables = {}
    for name in names:
        if isinstance(source, str):
            df = spark.read.parquet(f"{source.rstrip('/')}/{name}.parquet")
        else:
            df = source[name]
            df = spark.table(df) if isinstance(df, str) else df
        tables[name] = conform_table(df, SCHEMAS[name], empty_as_null)
    return tables
