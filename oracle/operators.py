"""DuckDB oracle SQL for the operator queries (``procura.queries``).

Written directly against the driver's pre-registered views; queries over
P2P tables repeat the derivation through ``oracle_ctes``. Subqueries are
kept in their natural correlated / ``IN`` / ``NOT EXISTS`` form.
"""

from __future__ import annotations

from oracle.reports import AS_OF, report_sql_body, with_helpers
from procura.plans.schema import REPORT_SCHEMA
from procura.queries import DRILL_DOCUMENTS
from procura.sources.derived import oracle_ctes

NOW = f"TIMESTAMP '{AS_OF}'"
TODAY = f"date_trunc('day', {NOW})"

_ORDERS_NULLABLE = "SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS k FROM orders"
_LEFT_SIDE = ("SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS lk "
              "FROM orders WHERE o_orderstatus <> 'P'")

OPERATOR_SQL: dict[str, str] = {}

OPERATOR_SQL["amount_conversion"] = """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(CAST(l_extendedprice AS DECIMAL(18,6)) * CAST(l_quantity AS DECIMAL(20,6)) AS DECIMAL(28,6)) AS line_amount,
       coalesce(CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE 'OMR' END, 'USD') AS currency,
       CAST(CASE WHEN coalesce(r, 0) = 0
                 THEN CAST(l_extendedprice AS DECIMAL(18,6)) * CAST(l_quantity AS DECIMAL(20,6))
                 ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,6)) * CAST(l_quantity AS DECIMAL(20,6)) AS DECIMAL(38,12)) * r END
            AS DECIMAL(28,6)) AS amount_usd,
       CASE WHEN l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS returned,
       'LINE' AS kind
FROM (SELECT *, CAST(CASE l_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 2.6 END AS DECIMAL(18,9)) AS r FROM lineitem)
"""

OPERATOR_SQL["decode_concat"] = """
SELECT p_partkey,
       CASE p_type WHEN 'ECONOMY' THEN 'ECO' WHEN 'SMALL' THEN 'SML' END AS type_code,
       coalesce(p_brand, '') || '.' || coalesce(CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_type END, '') || '.'
         || coalesce(CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END, '') || '.' || '' AS dotted
FROM part
"""

OPERATOR_SQL["flag_filters"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus
FROM lineitem
WHERE coalesce(CASE l_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Y' ELSE 'N' END, 'N') <> 'Y'
  AND coalesce(CASE l_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Y' ELSE 'N' END, 'Y') = 'N'
  AND l_returnflag IN ('A', 'R')
  AND CASE l_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'SHIP' ELSE 'MAIL' END <> 'SHIP'
  AND ((CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linestatus END) NOT IN ('O') OR l_quantity > 45)
  AND l_shipdate IS NOT NULL
"""

OPERATOR_SQL["effective_dates"] = oracle_ctes(("people_f",)) + f"""
SELECT person_id, full_name, effective_end_date,
       coalesce({NOW} BETWEEN effective_start_date AND effective_end_date, false) AS active_now,
       coalesce({TODAY} BETWEEN effective_start_date AND effective_end_date, false) AS active_today
FROM people_f
"""

OPERATOR_SQL["open_intervals"] = oracle_ctes(("lookup_values",)) + f"""
SELECT lookup_type, lookup_code, tag, zd_edition_name,
       {TODAY} BETWEEN date_trunc('day', coalesce(start_date_active, {NOW}))
                   AND date_trunc('day', coalesce(end_date_active, {NOW})) AS active
FROM lookup_values
"""

OPERATOR_SQL["left_nullable_key"] = f"""
SELECT o.o_orderkey, o.k, l.sum_qty, l.n_lines
FROM ({_ORDERS_NULLABLE}) o
LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS sum_qty, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) l
       ON o.k = l.l_orderkey
"""

OPERATOR_SQL["left_composite"] = """
SELECT a.l_orderkey, a.l_linenumber, a.q, r.returned_q
FROM (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) a
LEFT JOIN (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS returned_q FROM lineitem
            WHERE l_returnflag = 'R' GROUP BY 1, 2) r
       ON a.l_orderkey = r.l_orderkey AND a.l_linenumber = r.l_linenumber
"""

OPERATOR_SQL["left_residual_or"] = """
SELECT o.o_orderkey, o.pick, l.l_linenumber, l.l_quantity
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderkey % 7 + 1 AS INTEGER) END AS pick FROM orders) o
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND (l.l_linenumber = o.pick OR o.pick IS NULL)
"""

OPERATOR_SQL["dated_join_asof"] = oracle_ctes(("people_f",)) + f"""
SELECT o.o_orderkey, o.o_custkey, p.full_name
FROM orders o
LEFT JOIN people_f p ON p.person_id = o.o_custkey AND {NOW} BETWEEN p.effective_start_date AND p.effective_end_date
"""

OPERATOR_SQL["dated_lookup_rows"] = oracle_ctes(("people_f",)) + """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate,
       (SELECT p.full_name FROM people_f p
         WHERE p.person_id = o.o_custkey AND o.o_orderdate BETWEEN p.effective_start_date AND p.effective_end_date) AS name_at_order
FROM orders o
"""

OPERATOR_SQL["full_outer_join"] = f"""
SELECT a.o_orderkey, a.lk, b.rk, b.r_qty
FROM ({_LEFT_SIDE}) a
FULL OUTER JOIN (SELECT CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_orderkey END AS rk, sum(l_quantity) AS r_qty
                   FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) b
       ON a.lk = b.rk
"""

OPERATOR_SQL["lineage_chain_join"] = f"""
SELECT a.o_orderkey, a.lk, b.bk, b.b_n, c.ck, c.c_n
FROM ({_LEFT_SIDE}) a
FULL OUTER JOIN (SELECT l_orderkey AS bk, count(*) AS b_n FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) b
       ON a.lk = b.bk
FULL OUTER JOIN (SELECT l_orderkey AS ck, count(*) AS c_n FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_orderkey) c
       ON b.bk = c.ck
"""

OPERATOR_SQL["scalar_lookup_strict"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey,
       (SELECT s.s_name FROM supplier s WHERE s.s_suppkey = l.l_suppkey) AS s_name,
       (SELECT n.n_name FROM nation n WHERE n.n_nationkey = (SELECT s.s_nationkey FROM supplier s WHERE s.s_suppkey = l.l_suppkey)) AS n_name
FROM lineitem l
"""

OPERATOR_SQL["semi_join_in"] = """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
"""

OPERATOR_SQL["semi_join_correlated"] = """
SELECT p.p_partkey, p.p_size, p.p_brand FROM part p
WHERE upper(nullif(trim(p.p_brand), '')) IN (
      SELECT upper(nullif(trim(p2.p_brand), '')) FROM part p2 WHERE p2.p_size = p.p_size AND p2.p_retailprice > 950)
"""

OPERATOR_SQL["anti_join_not_exists"] = """
SELECT o.o_orderkey, o.o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
"""

OPERATOR_SQL["cross_as_equi"] = """
SELECT e.event_id, string_agg(m.n_name, ', ' ORDER BY m.n_name) AS nations
FROM events e
CROSS JOIN nation m
WHERE m.n_regionkey IN (SELECT n.n_regionkey FROM nation n WHERE n.n_nationkey = e.user_id % 25)
GROUP BY e.event_id
"""

OPERATOR_SQL["self_parent"] = """
SELECT p.event_id, p.value, c.child_value
FROM (SELECT event_id, CAST(value AS DECIMAL(18,2)) AS value FROM events WHERE event_id % 3 = 0) p
LEFT JOIN (SELECT event_id - event_id % 3 AS parent_id, sum(CAST(value AS DECIMAL(18,2))) AS child_value FROM events
            WHERE event_id % 3 <> 0 AND event_type IN ('click', 'view') GROUP BY 1) c
       ON c.parent_id = p.event_id
WHERE p.value > coalesce(c.child_value, 0)
"""

OPERATOR_SQL["first_event_min"] = """
SELECT user_id, min(ts) AS first_purchase FROM events WHERE event_type = 'purchase' GROUP BY user_id
"""

OPERATOR_SQL["last_event_max"] = """
SELECT a.user_id, a.last_signup, (SELECT max(value) FROM events b WHERE b.user_id = a.user_id) AS max_value
FROM (SELECT user_id, max(ts) AS last_signup FROM events WHERE event_type IN ('signup') GROUP BY user_id) a
"""

OPERATOR_SQL["last_action_row"] = """
SELECT e.event_id, e.user_id, e.ts, e.event_type FROM events e
WHERE e.ts = (SELECT max(x.ts) FROM events x WHERE x.user_id = e.user_id) AND e.event_type = 'click'
"""

OPERATOR_SQL["listagg_ordered"] = """
SELECT l_orderkey, string_agg(flag, ', ' ORDER BY flag) AS flags
FROM (SELECT l_orderkey, CASE WHEN l_linenumber % 7 = 0 THEN NULL ELSE l_returnflag END AS flag FROM lineitem)
GROUP BY l_orderkey
"""

OPERATOR_SQL["latest_row_per_key"] = """
SELECT event_id, user_id, event_type, ts FROM (
  SELECT event_id, user_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts,
         row_number() OVER (PARTITION BY user_id
                            ORDER BY CASE WHEN event_type = 'error' THEN NULL ELSE ts END DESC NULLS FIRST, event_id DESC) AS rn
  FROM events)
WHERE rn = 1
"""

OPERATOR_SQL["latest_filter_noop"] = """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM (
        SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1)
"""

OPERATOR_SQL["union_distinct_padded"] = """
SELECT l_returnflag, l_linestatus, CAST(NULL AS VARCHAR) AS l_tag FROM lineitem
UNION
SELECT l_returnflag, CAST(NULL AS VARCHAR), CASE WHEN l_quantity > 25 THEN 'BIG' ELSE 'SMALL' END FROM lineitem
"""

OPERATOR_SQL["block_pr_pending"] = with_helpers() + """
SELECT pr_number, name AS pending_with FROM requisition_waiting
"""

OPERATOR_SQL["block_inspection_pending"] = with_helpers() + """
SELECT transaction_id, mails AS pending_with FROM inspection_waiting
"""

OPERATOR_SQL["block_inspection_corrected"] = with_helpers() + """
SELECT r.transaction_id, g.mails AS pending_with
FROM rcv_transactions r
JOIN rcv_shipment_lines s USING (shipment_line_id)
JOIN items i ON i.inventory_item_id = s.item_id AND i.organization_id = r.organization_id AND i.inspection_required_flag = 'Y'
JOIN inspectors g ON g.grp = upper(i.attribute1)
LEFT JOIN children c ON c.transaction_id = r.transaction_id
SEMI JOIN rcv_shipment_headers h ON h.shipment_header_id = r.shipment_header_id
WHERE r.routing_header_id = '2' AND r.transaction_type = 'RECEIVE'
  AND c.closed IS NOT TRUE AND r.quantity > ifnull(c.inspected, 0)
"""

OPERATOR_SQL["drill_down"] = with_helpers() + f"""
SELECT * FROM ({report_sql_body('BLANKET', AS_OF)}
UNION
{report_sql_body('STANDARD', AS_OF)}) u
WHERE "PO Type (Blanket/Standard)" = 'BLANKET' AND "BR Status - Blanket" = 'IN PROCESS'
"""

OPERATOR_SQL["preview_top"] = with_helpers() + f"""
SELECT * FROM ({report_sql_body('STANDARD', AS_OF)}) s
ORDER BY {", ".join(f'"{f.name}" ASC NULLS FIRST' for f in REPORT_SCHEMA.fields)}
LIMIT 10
"""

OPERATOR_SQL["block_requisitions"] = with_helpers() + """
SELECT CAST(distribution_id AS BIGINT) AS "DISTRIBUTION_ID", number AS "PR_Number", description AS "PR_Description",
       creation_date AS "PR_Creation_Date", authorization_status AS "PR_Status", CAST(line_num AS INTEGER) AS "PR_Line_No",
       CAST(quantity AS DECIMAL(20,6)) AS "PR_Quantity", CAST(unit_price AS DECIMAL(18,6)) AS "Unit_Price",
       CAST(amount AS DECIMAL(28,6)) AS "PR_Line_Amount_OMR", currency AS "PR Line Currency", urgent_flag AS "RUSH_FLAG",
       need_by_date AS "NEED_BY_DATE", approved_date AS "PR Latest Approved Date", first_approved AS "PR Original Approved Date",
       item_code AS "Item Code", item_description AS "Item Description", item_type AS "Item Type",
       'UNSOURCED' AS "Sourced Or Unsourced", requestor AS "PR Requestor", waiting_for AS "PR Approval Pending With"
FROM requisitions WHERE document_type_code IS NULL
"""

OPERATOR_SQL["block_rfq"] = with_helpers() + """
SELECT CAST(distribution_id AS BIGINT) AS ad_distribution_id, document_number AS ad_number, auction_status AS ad_status,
       visibility AS ad_type, creation_date AS ad_creation_date, close_bidding_date AS ad_closed_date,
       int_attribute6 AS ad_strategy, int_attribute4 AS ad_te_date, award_date AS ad_award_date, submitted AS ad_submit_date,
       publish_date AS ad_publish_date, buyer AS ad_buyer
FROM sourcing
"""

OPERATOR_SQL["block_po_pending"] = with_helpers() + """
SELECT document AS kind, if(document = 'RELEASE', po_release_id, po_header_id) AS key_id, name AS full_name, number AS employee_number
FROM release_waiting WHERE document IN ('RELEASE', 'STANDARD')
"""

OPERATOR_SQL["block_invoice_chain"] = oracle_ctes() + """
SELECT d.po_distribution_id AS aida_po_distribution_id, d.invoice_id AS aida_invoice_id,
       CAST(d.amount AS DECIMAL(18,6)) AS aida_amount, CAST(l.line_number AS INTEGER) AS aila_line_number,
       i.invoice_num AS aia_invoice_num, CAST(s.payment_num AS INTEGER) AS apsa_payment_num,
       CAST(p.amount AS DECIMAL(18,6)) AS aipa_amount, c.check_id AS aca_check_id, CAST(c.amount AS DECIMAL(18,6)) AS aca_amount
FROM invoice_distributions d
LEFT JOIN invoice_lines l ON l.invoice_id = d.invoice_id AND l.line_number = d.invoice_line_number
                         AND coalesce(l.cancelled_flag, 'Y') = 'N'
LEFT JOIN invoices i ON i.invoice_id = d.invoice_id
LEFT JOIN payment_schedules s ON s.invoice_id = i.invoice_id
LEFT JOIN invoice_payments p ON p.invoice_id = i.invoice_id AND p.payment_num = s.payment_num
LEFT JOIN checks c ON c.check_id = p.check_id
WHERE coalesce(d.cancellation_flag, 'Y') = 'N'
"""

OPERATOR_SQL["block_rfq_newest"] = with_helpers() + """
SELECT CAST(distribution_id AS BIGINT) AS ad_distribution_id, document_number AS ad_number, auction_status AS ad_status,
       visibility AS ad_type, creation_date AS ad_creation_date, close_bidding_date AS ad_closed_date,
       int_attribute6 AS ad_strategy, int_attribute4 AS ad_te_date, award_date AS ad_award_date, submitted AS ad_submit_date,
       publish_date AS ad_publish_date, buyer AS ad_buyer
FROM sourcing
JOIN (SELECT auction_header_id, arg_max(document_number, row(creation_date IS NULL, creation_date)) AS newest
      FROM rfq_headers GROUP BY 1) n ON n.newest = document_number
"""

OPERATOR_SQL["load_conformed"] = """
SELECT CAST(s_suppkey AS BIGINT) AS vendor_id, CASE WHEN s_nationkey % 4 <> 0 THEN s_name END AS vendor_name FROM supplier
"""

#: Report that each document drill-down filters; the documents are those of the registered queries.
_DRILLED = {"drill_po_release": "BLANKET", "drill_po_line": "STANDARD", "drill_pr_line": "STANDARD", "drill_invoice": "STANDARD",
            "drill_distribution": "BLANKET"}
for _name, _kind in _DRILLED.items():
    _where = " AND ".join(f'"{c}" = ' + (f"'{v}'" if isinstance(v, str) else str(v)) for c, v in DRILL_DOCUMENTS[_name].items())
    OPERATOR_SQL[_name] = with_helpers() + f"\nSELECT * FROM ({report_sql_body(_kind, AS_OF)}) WHERE {_where}"
