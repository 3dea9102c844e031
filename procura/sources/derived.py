"""P2P-shaped tables derived from the driver's star-schema tables.

The reports need 38 procurement tables; the driver only ships TPC-H-style
tables. Each P2P table is defined here as one SQL ``SELECT`` over the driver
tables (``orders``, ``lineitem``, ``customer``, ``part``, ``nation``,
``supplier``) using only integer modulo, CASE, casts and interval arithmetic,
so the *same text* runs in Spark SQL and in DuckDB: the Spark side gets its
inputs from :func:`derived_tables`, the DuckDB oracle repeats them as CTEs
(:func:`oracle_ctes`). Row counts scale linearly with the driver tables.

Fan-out (several rows per source row) is written as ``UNION ALL`` of
branches, never as a join against a constant table.

Key scheme (h = order key, n = line number, id = h*10+n):
PO header/requisition header/invoice/shipment header = h; PO line,
requisition line, shipment line = id; line location = id*10+1;
distributions = id*100+10+k; receipts = id*10+k; person = customer key;
user = 40 + customer key (so most user ids are some other person's id); position = nation key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.sources.tables import TABLES, conform_table, SCHEMAS

BASE_TABLES = ("orders", "lineitem", "customer", "part", "nation", "supplier")


def _fan(template: str, branches: list[tuple[str, str]]) -> str:
    """UNION ALL of ``template`` with ``{k}`` and ``{w}`` filled per branch."""
    return "\nUNION ALL\n".join(template.replace("{k}", k).replace("{w}", w) for k, w in branches)


def _ts(s: str) -> str:
    return f"CAST('{s}' AS {{TS}})"


FAR = _ts("4712-12-31")

# base view: one row per (order, line number); lineitem repeats that pair.
LN = """
SELECT l_orderkey AS h, l_linenumber AS n, l_orderkey * 10 + l_linenumber AS id,
       MIN(l_partkey) AS pk, MIN(l_suppkey) AS sk,
       CAST(SUM(l_quantity) AS DECIMAL(20,6)) AS q,
       CAST(MIN(l_extendedprice) AS DECIMAL(18,6)) AS p,
       MIN(l_shipdate) AS sd
FROM {lineitem}
GROUP BY l_orderkey, l_linenumber
"""

_REL = "CASE WHEN h % 2 = 1 AND n <> 7 THEN h ELSE NULL END"

SQL: dict[str, str] = {}

SQL["po_headers"] = """
SELECT o_orderkey AS po_header_id,
       CAST(4000000 + o_orderkey AS STRING) AS segment1,
       CASE WHEN o_orderkey % 50 = 49 THEN 'CONTRACT' WHEN o_orderkey % 2 = 0 THEN 'STANDARD' ELSE 'BLANKET' END AS type_lookup_code,
       'PO ' || o_orderpriority AS comments,
       o_orderdate AS creation_date,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + INTERVAL 2 DAY END AS approved_date,
       CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'IN PROCESS' ELSE 'REQUIRES REAPPROVAL' END AS authorization_status,
       CASE o_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'OMR' ELSE 'USD' END AS currency_code,
       CAST(CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 2.6 END AS DECIMAL(18,9)) AS rate,
       CAST(floor(o_custkey / 14) AS BIGINT) AS vendor_id,
       CAST(o_custkey AS STRING) AS attribute3,
       CASE WHEN o_orderkey % 9 = 0 THEN 'TBD' ELSE CAST(o_custkey + 1 AS STRING) END AS attribute5
FROM {orders}
"""

SQL["po_lines"] = """
SELECT id AS po_line_id, h AS po_header_id, n AS line_num, 'item ' || CAST(pk AS STRING) AS item_description
FROM {ln}
"""

SQL["po_line_locations"] = f"""
SELECT id * 10 + 1 AS line_location_id, id AS po_line_id, {_REL} AS po_release_id,
       q AS quantity, p AS price_override,
       CASE WHEN n = 6 THEN NULL ELSE n % 3 END AS receiving_routing_id
FROM {{ln}}
"""

SQL["po_releases"] = """
SELECT o_orderkey AS po_release_id, o_orderkey AS po_header_id, o_orderkey % 9 + 1 AS release_num,
       o_orderdate + INTERVAL 3 DAY AS approved_date,
       CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'IN PROCESS' ELSE NULL END AS authorization_status
FROM {orders}
WHERE o_orderkey % 2 = 1 OR o_orderkey % 10 = 4
"""

SQL["po_distributions"] = _fan("""
SELECT id * 100 + 10 + {k} AS po_distribution_id, id * 10 + 1 AS line_location_id,
       CASE WHEN id % 3 = 0 THEN NULL ELSE id * 100 + 10 + {k} END AS req_distribution_id,
       CASE WHEN h % 6 = 0 THEN -sk - 1 ELSE sk END AS code_combination_id,
       CASE WHEN n % 2 = 0 THEN pk ELSE NULL END AS wip_entity_id,
       sk + h % 2 AS project_id
FROM {ln} WHERE {w}""", [("1", "1 = 1"), ("2", "n = 5")])

SQL["po_headers_archive"] = _fan("""
SELECT CAST(4000000 + o_orderkey AS STRING) AS segment1,
       CAST(CASE WHEN {k} = 2 AND o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,6)) * {k} END AS DECIMAL(18,6)) AS amount_limit
FROM {orders} WHERE {w}""", [("1", "1 = 1"), ("2", "1 = 1")])

# sequence numbers are chosen so that, per object id, sometimes the
# requisition row and sometimes the release/standard row holds the maximum.
SQL["po_action_history"] = "\nUNION ALL\n".join([
    "SELECT o_orderkey AS object_id, 'REQUISITION' AS object_type_code, 1 AS sequence_num, 'SUBMIT' AS action_code, "
    "o_orderdate - INTERVAL 5 DAY AS action_date, o_custkey AS employee_id FROM {orders}",
    "SELECT o_orderkey, 'REQUISITION', 2, 'APPROVE', o_orderdate - INTERVAL 3 DAY, o_custkey + 3 FROM {orders}",
    "SELECT o_orderkey, 'REQUISITION', 3, 'APPROVE', o_orderdate - INTERVAL 1 DAY, o_custkey + 5 FROM {orders} WHERE o_orderstatus <> 'P'",
    "SELECT o_orderkey, 'PO', 4, 'APPROVE', o_orderdate + INTERVAL 2 DAY, o_custkey + 2 FROM {orders}",
    "SELECT o_orderkey, 'PO', 5, 'APPROVE', o_orderdate + INTERVAL 1 DAY, o_custkey + 4 FROM {orders}",
    "SELECT o_orderkey, 'RELEASE', 6, 'APPROVE', o_orderdate + INTERVAL 3 DAY, o_custkey + 6 FROM {orders} WHERE o_orderkey % 2 = 1",
    "SELECT o_orderkey, 'REQUISITION', 10 + o_orderkey % 3, NULL, o_orderdate, o_custkey + 7 FROM {orders} WHERE o_orderstatus = 'O'",
    "SELECT o_orderkey, 'RELEASE', 11, NULL, o_orderdate + INTERVAL 4 DAY, o_custkey + 11 FROM {orders} "
    "WHERE o_orderkey % 2 = 1 AND o_orderstatus = 'O'",
    "SELECT o_orderkey, 'STANDARD', 11, NULL, o_orderdate + INTERVAL 4 DAY, o_custkey + 13 FROM {orders} "
    "WHERE o_orderkey % 10 = 4 AND o_orderstatus = 'O'",
])

SQL["rcv_transactions"] = _fan(f"""
SELECT id * 10 + {{k}} AS transaction_id,
       CASE WHEN {{k}} = 1 THEN NULL ELSE id * 10 + 1 END AS parent_transaction_id,
       CASE {{k}} WHEN 1 THEN 'RECEIVE'
                WHEN 2 THEN CASE WHEN id % 5 = 0 THEN 'REJECT' ELSE 'ACCEPT' END
                ELSE CASE WHEN id % 7 = 0 THEN 'RETURN TO VENDOR' WHEN id % 7 = 1 THEN 'TRANSFER' ELSE 'DELIVER' END END AS transaction_type,
       sd + INTERVAL 1 DAY * {{k}} AS transaction_date,
       CASE WHEN {{k}} = 1 OR ({{k}} = 2 AND id % 4 = 1) THEN q ELSE CAST(floor(q / 2) AS DECIMAL(20,6)) END AS quantity,
       CASE WHEN id % 5 = 1 THEN NULL ELSE 'OMR' END AS currency_code,
       CAST(CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 2.6 ELSE 0.385 END AS DECIMAL(18,9)) AS currency_conversion_rate,
       h AS po_header_id, id AS po_line_id, id * 10 + 1 AS po_line_location_id, {_REL} AS po_release_id,
       CASE WHEN id % 2 = 0 THEN id * 100 + 11 ELSE NULL END AS po_distribution_id,
       h AS shipment_header_id, id AS shipment_line_id, h % 3 AS organization_id,
       CASE WHEN n % 3 = 2 THEN '2' ELSE '1' END AS routing_header_id
FROM {{ln}} WHERE n % 4 <> 0 AND {{w}}""", [("1", "1 = 1"), ("2", "id % 6 < 3"), ("3", "id % 6 < 3")])

SQL["rcv_shipment_lines"] = """
SELECT id AS shipment_line_id, h AS shipment_header_id, n AS line_num, pk AS item_id,
       sd + INTERVAL 2 DAY + INTERVAL 9 HOUR AS last_update_date,
       40 + CAST(floor(h / 10) AS BIGINT) AS last_updated_by
FROM {ln} WHERE n % 4 <> 0
"""

SQL["rcv_shipment_headers"] = """
SELECT o_orderkey AS shipment_header_id, 'RCPT-' || CAST(o_orderkey AS STRING) AS receipt_num,
       o_orderdate + INTERVAL 10 DAY AS creation_date,
       CASE WHEN o_orderkey % 97 = 0 THEN 'junk' ELSE CAST(o_orderkey AS STRING) END AS attribute1
FROM {orders}
"""

SQL["req_headers"] = """
SELECT o_orderkey AS requisition_header_id, CAST(1000000 + o_orderkey AS STRING) AS segment1,
       'PR ' || o_orderpriority AS description, o_orderdate - INTERVAL 6 DAY AS creation_date,
       CASE o_orderstatus WHEN 'O' THEN 'IN PROCESS' WHEN 'F' THEN 'APPROVED' ELSE 'INCOMPLETE' END AS authorization_status,
       o_orderdate - INTERVAL 1 DAY AS approved_date
FROM {orders} WHERE o_orderkey % 7 <> 0
"""

SQL["req_lines"] = """
SELECT id AS requisition_line_id, h AS requisition_header_id, n AS line_num, q AS quantity,
       CASE WHEN id % 17 = 0 THEN NULL ELSE p END AS unit_price,
       CAST(CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 2.6 END AS DECIMAL(18,9)) AS rate,
       CASE WHEN id % 4 = 0 THEN NULL ELSE 'OMR' END AS currency_code,
       CASE id % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END AS urgent_flag,
       sd AS need_by_date,
       CASE WHEN h % 2 = 1 THEN 'BLANKET' WHEN id % 10 = 8 THEN 'CATALOG' ELSE NULL END AS document_type_code,
       CASE id % 11 WHEN 0 THEN 'Y' WHEN 1 THEN NULL ELSE 'N' END AS cancel_flag,
       CASE WHEN id % 9 = 0 THEN NULL ELSE pk END AS item_id,
       'req item ' || CAST(pk AS STRING) AS item_description,
       CASE WHEN id % 9 = 0 OR id % 5 = 2 THEN 'Grp_' || CAST(pk % 25 AS STRING) ELSE NULL END AS attribute2,
       h % 3 AS destination_organization_id,
       sk AS to_person_id
FROM {ln}
"""

SQL["req_distributions"] = _fan("""
SELECT id * 100 + 10 + {k} AS distribution_id, id AS requisition_line_id
FROM {ln} WHERE id % 13 <> 0 AND {w}""", [("1", "1 = 1"), ("2", "n = 5")])

SQL["items"] = _fan("""
SELECT p_partkey AS inventory_item_id, {k} AS organization_id, 'ITM-' || CAST(p_partkey AS STRING) AS segment1,
       p_type AS item_type,
       CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE 'grp_' || CAST(p_partkey % 25 AS STRING) END AS attribute1,
       CASE p_partkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END AS inspection_required_flag
FROM {part} WHERE (p_partkey + {k}) % 4 <> 0 AND {w}""", [("0", "1 = 1"), ("1", "1 = 1"), ("2", "1 = 1")])

_EMAIL = "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE lower(c_name) || '@example.org' END"
SQL["people_f"] = f"""
SELECT c_custkey AS person_id, {_ts('1990-01-01')} AS effective_start_date,
       CASE WHEN c_custkey % 17 = 0 THEN {_ts('1998-06-15')}
            WHEN c_custkey % 2 = 0 THEN {_ts('1997-12-31')}
            ELSE {FAR} END AS effective_end_date,
       CASE WHEN c_custkey % 17 <> 0 AND c_custkey % 2 = 0 THEN c_name || ' (old)' ELSE c_name END AS full_name,
       'E' || CAST(c_custkey AS STRING) AS employee_number,
       {_EMAIL} AS email_address
FROM {{customer}}
UNION ALL
SELECT c_custkey, {_ts('1998-01-01')}, {FAR}, c_name, 'E' || CAST(c_custkey AS STRING), {_EMAIL}
FROM {{customer}} WHERE c_custkey % 2 = 0 AND c_custkey % 17 <> 0
"""

SQL["assignments_f"] = f"""
SELECT c_custkey AS person_id, c_nationkey AS position_id, {_ts('1990-01-01')} AS effective_start_date,
       CASE WHEN c_custkey % 60 = 0 THEN {_ts('1998-01-01')} ELSE {FAR} END AS effective_end_date
FROM {{customer}} WHERE c_custkey % 20 = 0
UNION ALL
SELECT c_custkey, (c_nationkey + 1) % 25, {_ts('1995-01-01')}, {FAR}
FROM {{customer}} WHERE c_custkey % 40 = 0
"""

SQL["positions"] = """
SELECT n_nationkey AS position_id, n_nationkey + 100 AS position_definition_id FROM {nation}
"""

SQL["position_definitions"] = """
SELECT n_nationkey + 100 AS position_definition_id,
       CASE WHEN n_nationkey % 5 = 0 THEN '  ' || lower(n_name) || ' '
            WHEN n_nationkey % 7 = 3 THEN '  '
            ELSE n_name END AS segment3
FROM {nation}
"""

SQL["users"] = """
SELECT c_custkey + 40 AS user_id, c_custkey AS employee_id FROM {customer}
"""

_IG = f"""
SELECT 'INSPECTION_GROUP' AS lookup_type, 'IG' || CAST(a.n_nationkey AS STRING) AS lookup_code,
       {{tag}} AS tag, 'GRP_' || CAST(a.n_nationkey AS STRING) AS description,
       CASE WHEN a.n_nationkey % 10 = 9 THEN 'AR' ELSE 'US' END AS language,
       CASE WHEN a.n_nationkey % 8 = 7 THEN 'N' ELSE 'Y' END AS enabled_flag,
       CASE WHEN a.n_nationkey % 4 = 1 THEN NULL ELSE {_ts('1990-01-01')} END AS start_date_active,
       CASE WHEN a.n_nationkey % 6 = 5 THEN {_ts('1997-01-01')}
            WHEN a.n_nationkey % 4 = 2 THEN {_ts('1998-06-15')} ELSE NULL END AS end_date_active,
       'SET1' AS zd_edition_name
FROM {{{{nation}}}} a"""
SQL["lookup_values"] = "\nUNION ALL\n".join([
    _IG.replace("{tag}", "CASE WHEN a.n_nationkey % 3 = 0 THEN lower(a.n_name) ELSE a.n_name END"),
    # exact duplicate rows must not multiply the e-mail list
    _IG.replace("{tag}", "a.n_name") + " WHERE a.n_nationkey % 4 = 0",
    # some groups map to a second tag (the next nation's name)
    _IG.replace("{tag}", "b.n_name") + " JOIN {{nation}} b ON b.n_nationkey = (a.n_nationkey + 1) % 25 WHERE a.n_nationkey % 5 = 2",
    "SELECT 'QS_MAPPING', CAST(4000000 + o_orderkey AS STRING), NULL, 'QS ' || CAST(o_custkey AS STRING), "
    "'US', 'Y', NULL, NULL, 'SET1' FROM {orders} WHERE o_orderkey % 2 = 1 AND o_orderkey % 3 = 0",
    "SELECT 'QS_MAPPING', CAST(4000000 + o_orderkey AS STRING), NULL, 'QS old ' || CAST(o_custkey AS STRING), "
    "'US', 'Y', NULL, NULL, 'SET2' FROM {orders} WHERE o_orderkey % 2 = 1 AND o_orderkey % 9 = 3",
]).replace("{{nation}}", "{nation}")

SQL["suppliers"] = """
SELECT s_suppkey AS vendor_id, s_name AS vendor_name FROM {supplier}
"""

SQL["gl_code_combinations"] = """
SELECT s_suppkey AS code_combination_id, '01' AS segment1, CAST(s_nationkey AS STRING) AS segment2,
       CAST(s_suppkey % 7 AS STRING) AS segment3, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'A' END AS segment4,
       '000' AS segment5, CAST(s_suppkey AS STRING) AS segment6,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE '9' END AS segment7
FROM {supplier}
"""

SQL["wip_entities"] = """
SELECT p_partkey AS wip_entity_id, 'WO-' || CAST(p_partkey AS STRING) AS wip_entity_name FROM {part}
"""

SQL["projects"] = """
SELECT s_suppkey AS project_id, 'PRJ-' || s_name AS segment1 FROM {supplier}
"""

SQL["srn_headers"] = """
SELECT o_orderkey AS srn_header_id, o_orderkey AS po_header_id, o_orderkey AS po_release_id,
       'SRN' || CAST(o_orderkey AS STRING) AS srn_number, 'service ' || o_orderpriority AS description,
       o_orderdate + INTERVAL 12 DAY AS creation_date,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + INTERVAL 15 DAY END AS apprv_reject_date,
       CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'PENDING' ELSE 'REJECTED' END AS status
FROM {orders} WHERE o_orderkey % 6 = 1
"""

SQL["srn_lines"] = """
SELECT h AS srn_header_id, id * 10 + 1 AS line_location_id, 'srn line ' || CAST(n AS STRING) AS comments,
       q AS requester_quantity, q AS supplier_quantity,
       CASE WHEN n % 2 = 0 THEN q ELSE NULL END AS qs_quantity
FROM {ln} WHERE h % 6 = 1 AND n <> 3
"""

# SRN 7057 sits in two live VRNs (it is in the default exclusion list);
# SRNs with key % 12 = 7 get a second, REJECTED VRN.
SQL["vrn_headers"] = """
SELECT o_orderkey AS vrn_header_id, 'VRN' || CAST(o_orderkey AS STRING) AS vrn_number,
       'verification ' || o_orderpriority AS description,
       o_orderdate + INTERVAL 20 DAY AS creation_date, o_orderdate + INTERVAL 25 DAY AS apprv_reject_date,
       CASE WHEN o_orderkey = 7057 THEN 'APPROVED' WHEN o_orderkey % 5 = 0 THEN 'REJECTED'
            WHEN o_orderkey % 7 = 1 THEN NULL WHEN o_orderkey % 8 = 3 THEN 'IN REVIEW' ELSE 'APPROVED' END AS status,
       CAST(o_totalprice AS DECIMAL(18,6)) AS vrn_verified_amt
FROM {orders} WHERE o_orderkey % 6 = 1
UNION ALL
SELECT o_orderkey + 100000000, 'VRN' || CAST(o_orderkey AS STRING) || '-2', 'second verification',
       o_orderdate + INTERVAL 21 DAY, o_orderdate + INTERVAL 26 DAY,
       CASE WHEN o_orderkey = 7057 THEN 'APPROVED' ELSE 'REJECTED' END,
       CAST(o_totalprice AS DECIMAL(18,6))
FROM {orders} WHERE o_orderkey % 6 = 1 AND (o_orderkey % 12 = 7 OR o_orderkey = 7057)
"""

SQL["vrn_lines"] = """
SELECT o_orderkey AS vrn_header_id, o_orderkey AS srn_header_id, 'qs comment ' || CAST(o_orderkey AS STRING) AS comments
FROM {orders} WHERE o_orderkey % 6 = 1
UNION ALL
SELECT o_orderkey + 100000000, o_orderkey, 'qs comment 2'
FROM {orders} WHERE o_orderkey % 6 = 1 AND (o_orderkey % 12 = 7 OR o_orderkey = 7057)
"""

SQL["invoice_distributions"] = _fan("""
SELECT h AS invoice_id, n AS invoice_line_number, id * 100 + 10 + {k} AS po_distribution_id,
       p AS amount,
       CASE WHEN {k} = 2 THEN 'TAX' ELSE 'ITEM' END AS line_type_lookup_code,
       CASE id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'R' ELSE NULL END AS match_status_flag,
       CASE id % 9 WHEN 0 THEN NULL WHEN 1 THEN 'Y' ELSE 'N' END AS cancellation_flag
FROM {ln} WHERE (id + {k}) % 4 <> 0 AND {w}""", [("1", "1 = 1"), ("2", "n = 5")])

SQL["invoices"] = """
SELECT o_orderkey AS invoice_id, 'INV-' || CAST(o_orderkey AS STRING) AS invoice_num,
       o_orderdate + INTERVAL 20 DAY AS invoice_date, o_orderdate + INTERVAL 18 DAY AS creation_date,
       CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' ELSE 'P' END AS payment_status_flag,
       CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END AS approval_ready_flag,
       CAST(CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 2.6 ELSE 0.385 END AS DECIMAL(18,9)) AS exchange_rate,
       CASE WHEN o_custkey % 4 = 2 THEN 'OMR' ELSE 'USD' END AS invoice_currency_code
FROM {orders}
"""

SQL["invoice_lines"] = """
SELECT h AS invoice_id, n AS line_number, CASE id % 10 WHEN 0 THEN 'Y' WHEN 1 THEN NULL ELSE 'N' END AS cancelled_flag
FROM {ln}
"""

SQL["payment_schedules"] = _fan("""
SELECT o_orderkey AS invoice_id, {k} AS payment_num, o_orderdate + INTERVAL 30 DAY * {k} AS due_date,
       CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' ELSE 'P' END AS payment_status_flag
FROM {orders} WHERE {w}""", [("1", "1 = 1"), ("2", "o_orderkey % 5 = 0")])

SQL["invoice_payments"] = _fan("""
SELECT o_orderkey AS invoice_id, {k} AS payment_num, o_custkey AS check_id,
       CAST(CAST(o_totalprice AS DECIMAL(18,6)) - 100 * ({k} - 1) AS DECIMAL(18,6)) AS amount
FROM {orders} WHERE o_orderstatus <> 'P' AND {w}""", [("1", "1 = 1"), ("2", "o_orderkey % 10 = 0")])

SQL["checks"] = f"""
SELECT c_custkey AS check_id, {_ts('1998-01-01')} + INTERVAL 1 DAY * (c_custkey % 300) AS check_date,
       CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'OMR' ELSE 'USD' END AS currency_code,
       CAST(CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 2.6 ELSE 0.385 END AS DECIMAL(18,9)) AS exchange_rate,
       CAST(c_acctbal AS DECIMAL(18,6)) AS amount
FROM {{customer}}
"""

SQL["rfq_headers"] = """
SELECT o_orderkey AS auction_header_id, 'RFQ' || CAST(o_orderkey AS STRING) AS document_number,
       CASE o_orderstatus WHEN 'F' THEN 'AWARDED' WHEN 'O' THEN 'ACTIVE' ELSE 'CLOSED' END AS auction_status,
       CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'CATALOG' ELSE 'REQUISITION' END AS auction_origination_code,
       CASE o_orderkey % 8 WHEN 0 THEN 'SEALED_AUCTION' WHEN 2 THEN 'SEALED_BIDDING' WHEN 4 THEN 'OPEN_BIDDING' ELSE NULL END AS bid_visibility_code,
       o_orderdate - INTERVAL 4 DAY AS creation_date, o_orderdate + INTERVAL 6 DAY AS close_bidding_date,
       CAST(o_orderkey % 5 AS STRING) AS int_attribute6, CAST(o_orderkey % 13 AS STRING) AS int_attribute4,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 8 DAY ELSE NULL END AS award_date,
       o_orderdate - INTERVAL 3 DAY AS publish_date,
       40 + o_custkey AS created_by
FROM {orders} WHERE o_orderkey % 6 IN (0, 2)
UNION ALL
SELECT o_orderkey, 'RFQ' || CAST(o_orderkey AS STRING) || '-R', 'AMENDED', 'REQUISITION', 'SEALED_BIDDING',
       CASE WHEN o_orderkey % 24 = 12 THEN NULL ELSE o_orderdate - INTERVAL 2 DAY END,
       o_orderdate + INTERVAL 7 DAY, '9', '1', NULL, o_orderdate - INTERVAL 1 DAY, 40 + o_custkey + 1
FROM {orders} WHERE o_orderkey % 12 = 0
"""

SQL["rfq_lines"] = """
SELECT h AS auction_header_id, n AS line_number, CAST(1000000 + h AS STRING) AS requisition_number
FROM {ln} WHERE h % 6 IN (0, 2)
"""

SQL["rfq_backing_reqs"] = """
SELECT h AS auction_header_id, n AS line_number, h AS requisition_header_id, id AS requisition_line_id
FROM {ln} WHERE h % 6 IN (0, 2)
"""

SQL["rfq_action_history"] = """
SELECT o_orderkey AS object_id, 'NEGOTIATION' AS object_type_code, 'SUBMIT' AS action_type, o_orderdate - INTERVAL 3 DAY AS action_date
FROM {orders} WHERE o_orderkey % 6 IN (0, 2)
UNION ALL
SELECT o_orderkey, 'NEGOTIATION', 'SUBMIT', o_orderdate - INTERVAL 1 DAY FROM {orders} WHERE o_orderkey % 12 = 0
UNION ALL
SELECT o_orderkey, 'NEGOTIATION', 'PUBLISH', o_orderdate FROM {orders} WHERE o_orderkey % 6 IN (0, 2)
UNION ALL
SELECT o_orderkey, 'OTHER', 'SUBMIT', o_orderdate + INTERVAL 5 DAY FROM {orders} WHERE o_orderkey % 6 = 2
"""

assert set(SQL) == set(TABLES), set(TABLES) ^ set(SQL)

_REFS = ("orders", "lineitem", "customer", "part", "nation", "supplier", "ln")


def _render(sql: str, ts_type: str, names: dict[str, str]) -> str:
    out = sql.replace("{TS}", ts_type)
    for r in _REFS:
        out = out.replace("{" + r + "}", names.get(r, r))
    return out


def _spark_sql(spark: SparkSession, sql: str, frames: dict[str, DataFrame]) -> DataFrame:
    used = {r: frames[r] for r in _REFS if "{" + r + "}" in sql}
    text = sql.replace("{TS}", "TIMESTAMP_NTZ")
    return spark.sql(text, **used)


def derived_tables(spark: SparkSession, sf_dir: str, names=TABLES, share_lines: bool = False,
                   keep: Callable[[DataFrame, str], DataFrame] | None = None) -> dict[str, DataFrame]:
    """All P2P tables derived (lazily) from the driver tables in ``sf_dir``,
    conformed to the canonical schemas.

    ``share_lines`` is for plans that read many line tables: each of them then
    reads one and the same shuffle of all lines, instead of a narrower one of
    its own. ``keep`` is for readers that run in several steps: it stores the
    lines, and each table reads them from there."""
    base = {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in BASE_TABLES}
    frames = dict(base)
    frames["ln"] = _spark_sql(spark, LN, base)
    if keep is not None:
        frames["ln"] = keep(frames["ln"], "lines")
    elif share_lines:
        # taken from one struct, no column or filter of a reader gets below the aggregate, so its exchange is reused
        frames["ln"] = frames["ln"].select(F.inline(F.array(F.struct("*"))))
    return {n: conform_table(_spark_sql(spark, SQL[n], frames), SCHEMAS[n]) for n in names}


def oracle_ctes(names=TABLES) -> str:
    """``WITH`` clause defining the same P2P tables for DuckDB over the
    pre-registered driver views (ends with a comma-free last CTE)."""
    parts = [f"ln AS ({_render(LN, 'TIMESTAMP', {})})"]
    for n in names:
        parts.append(f"{n} AS ({_render(SQL[n], 'TIMESTAMP', {})})")
    return "WITH " + ",\n".join(parts)
