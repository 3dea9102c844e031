"""Hand-written procure-to-pay fixture (canonical tables, FIXTURES.md §2).

Scenario, as-of 2024-06-15 10:00:
* P1 standard order (rate 2.6, no currency) for requisition R900 line 1;
  two partial receipts (4 and 6), the first partly inspected, the second
  fully; distribution 1111 invoiced on INV300 (4840) and INV301 (436, line
  cancelled), both paid by one check of 5276; RFQ 8000 with two header rows
  backs R900 line 1 and the cancelled line 2 (an RFQ-only row).
* P2 standard order without receipt or requisition.
* B3 blanket order with release 3001 (in process, pending with Ann), a
  receipt carrying service note 8001 with one live and one rejected
  verification note; sourced requisition R930.
* C4 of a third type appears in no report.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from procura.sources.tables import SCHEMAS, TABLES

AS_OF = "2024-06-15 10:00:00"


def T(*a):
    return dt.datetime(*a)


FAR = T(4712, 12, 31)

ROWS: dict[str, list[tuple]] = {
    "po_headers": [
        (1, "P1", "STANDARD", "std order", T(2024, 1, 10), T(2024, 1, 12), "APPROVED", None, D("2.6"), 10, None, None),
        (2, "P2", "STANDARD", "no receipt", T(2024, 2, 1), None, "IN PROCESS", "OMR", D("0"), 99, None, None),
        (3, "B3", "BLANKET", "blanket", T(2024, 1, 5), T(2024, 1, 6), "APPROVED", "USD", None, 10, "1", "x9"),
        (4, "C4", "CONTRACT", "other type", T(2024, 1, 5), None, "APPROVED", "USD", None, 10, None, None),
    ],
    "po_lines": [(11, 1, 1, "widget"), (21, 2, 1, "gadget"), (31, 3, 1, "service"), (41, 4, 1, "contract line")],
    "po_line_locations": [
        (111, 11, None, D("10"), D("5"), 2), (211, 21, None, D("3"), D("7"), 1),
        (311, 31, 3001, D("4"), D("100"), None), (411, 41, None, D("1"), D("1"), 1),
    ],
    "po_releases": [(3001, 3, 1, T(2024, 1, 20), "IN PROCESS")],
    "po_distributions": [(1111, 111, 9001, 500, None, None), (2111, 211, None, None, None, None), (3111, 311, 9301, None, None, None)],
    "po_headers_archive": [("P1", D("100")), ("P1", D("250")), ("P1", None)],
    "po_action_history": [
        (1, "PO", 1, "APPROVE", T(2024, 1, 12), 1), (1, "PO", 2, "APPROVE", T(2024, 1, 11), 2),
        (900, "REQUISITION", 1, "SUBMIT", T(2024, 1, 1), 1), (900, "REQUISITION", 2, None, T(2024, 1, 2), 3),
        (3001, "RELEASE", 1, None, T(2024, 1, 21), 1),
    ],
    "rcv_transactions": [
        (5001, None, "RECEIVE", T(2024, 2, 10), D("4"), None, D("0"), 1, 11, 111, None, None, 60, 601, 1, "2"),
        (5002, None, "RECEIVE", T(2024, 2, 11), D("6"), "OMR", D("2.6"), 1, 11, 111, None, None, 60, 602, 1, "2"),
        (5003, 5002, "ACCEPT", T(2024, 2, 12), D("6"), "OMR", None, 1, 11, 111, None, None, 60, 602, 1, "2"),
        (5004, 5001, "ACCEPT", T(2024, 2, 12), D("1"), None, None, 1, 11, 111, None, None, 60, 601, 1, "2"),
        (5005, 5001, "DELIVER", T(2024, 2, 13), D("1"), None, None, 1, 11, 111, None, None, 60, 601, 1, "2"),
        (5301, None, "RECEIVE", T(2024, 2, 15), D("4"), "USD", None, 3, 31, 311, 3001, 3111, 63, 631, 1, "1"),
    ],
    "rcv_shipment_lines": [
        (601, 60, 1, 77, T(2024, 2, 10, 9), 77), (602, 60, 2, 77, T(2024, 2, 11, 9), 77), (631, 63, 1, None, T(2024, 2, 15, 9), 78),
    ],
    "rcv_shipment_headers": [(60, "RC60", T(2024, 2, 10), None), (63, "RC63", T(2024, 2, 15), "8001")],
    "req_headers": [
        (900, "R900", "std pr", T(2024, 1, 1), "IN PROCESS", None),
        (930, "R930", "blanket pr", T(2024, 1, 2), "APPROVED", T(2024, 1, 3)),
    ],
    "req_lines": [
        (9000, 900, 1, D("10"), D("5"), None, None, "Y", T(2024, 2, 1), None, None, 77, "widget", None, 1, 1),
        (9010, 900, 2, D("1"), D("2"), None, "OMR", None, T(2024, 2, 1), None, "Y", None, "cancelled", "grpA", 1, 1),
        (9300, 930, 1, D("4"), None, D("2.6"), "USD", "N", T(2024, 2, 1), "BLANKET", "N", None, "service", None, 1, 2),
    ],
    "req_distributions": [(9001, 9000), (9011, 9010), (9301, 9300)],
    "items": [(77, 1, "ITM77", "GOODS", "grpA", "Y")],
    "people_f": [
        (1, T(2020, 1, 1), T(2023, 12, 31), "Ann Old", "E1", "ann@x"),
        (1, T(2024, 1, 1), FAR, "Ann", "E1", "ann@x"),
        (2, T(2020, 1, 1), T(2024, 6, 15), "Bob", "E2", "bob@x"),
        (3, T(2020, 1, 1), FAR, "Cid", "E3", "cid@x"),
        (77, T(2020, 1, 1), FAR, "Wrong Person", "E77", "wrong@x"),
    ],
    "assignments_f": [(1, 50, T(2020, 1, 1), FAR), (1, 51, T(2020, 1, 1), FAR), (3, 50, T(2020, 1, 1), FAR),
                      (2, 50, T(2020, 1, 1), T(2021, 1, 1))],
    "positions": [(50, 500), (51, 501)],
    "position_definitions": [(500, "  qc1 "), (501, "QC1")],
    "users": [(77, 1), (78, 2)],
    "lookup_values": [
        ("INSPECTION_GROUP", "IG1", "QC1", "GRPA", "US", "Y", None, None, "SET1"),
        ("INSPECTION_GROUP", "IG1", "QC1", "GRPA", "US", "Y", None, None, "SET1"),
        ("INSPECTION_GROUP", "IG2", "OLD", "GRPA", "US", "Y", None, T(2023, 1, 1), "SET1"),
        ("QS_MAPPING", "B3", None, "QS Lady", "US", "Y", None, None, "SET1"),
        ("QS_MAPPING", "B3", None, "QS Other", "US", "Y", None, None, "SET2"),
    ],
    "suppliers": [(10, "Acme")],
    "gl_code_combinations": [(500, "01", "02", None, "04", "05", "06", "07")],
    "wip_entities": [],
    "projects": [],
    "srn_headers": [(8001, 3, 3001, "SRN8001", "service note", T(2024, 2, 16), None, "PENDING")],
    "srn_lines": [(8001, 311, "ok", D("4"), D("4"), D("4"))],
    "vrn_headers": [(9901, "VRN1", "verified", T(2024, 2, 20), T(2024, 2, 21), "APPROVED", D("100")),
                    (9902, "VRN2", "rejected", T(2024, 2, 20), T(2024, 2, 21), "REJECTED", D("1"))],
    "vrn_lines": [(9901, 8001, "fine"), (9902, 8001, "rej")],
    "invoices": [
        (300, "INV300", T(2024, 3, 1), T(2024, 2, 28), "Y", "Y", D("2.6"), "OMR"),
        (301, "INV301", T(2024, 3, 2), T(2024, 2, 28), "N", "Y", None, "USD"),
        (302, "INV302", T(2024, 3, 3), T(2024, 2, 28), "N", "N", None, "USD"),
    ],
    "invoice_lines": [(300, 1, "N"), (301, 1, "Y"), (302, 1, "N")],
    "invoice_distributions": [
        (300, 1, 1111, D("4840"), "ITEM", "A", "N"),
        (301, 1, 1111, D("436"), "ITEM", None, "N"),
        (302, 1, 1111, D("1"), "ITEM", "A", None),
    ],
    "payment_schedules": [(300, 1, T(2024, 4, 1), "Y"), (301, 1, T(2024, 4, 1), "Y")],
    "invoice_payments": [(300, 1, 700, D("4840")), (301, 1, 700, D("436"))],
    "checks": [(700, T(2024, 3, 5), None, None, D("5276"))],
    "rfq_headers": [
        (8000, "RFQ8000", "ACTIVE", "REQUISITION", "SEALED_BIDDING", T(2024, 1, 2), T(2024, 1, 9), "1", "2", None, T(2024, 1, 3), 77),
        (8000, "RFQ8000-R", "AMENDED", "REQUISITION", "SEALED_BIDDING", T(2024, 1, 3), T(2024, 1, 9), "1", "2", None, T(2024, 1, 3), 77),
    ],
    "rfq_lines": [(8000, 1, "R900"), (8000, 2, "R900")],
    "rfq_backing_reqs": [(8000, 1, 900, 9000), (8000, 2, 900, 9010)],
    "rfq_action_history": [(8000, "NEGOTIATION", "SUBMIT", T(2024, 1, 4)), (8000, "NEGOTIATION", "SUBMIT", T(2024, 1, 6)),
                           (8000, "OTHER", "SUBMIT", T(2024, 1, 8))],
}


def golden_tables(spark, overrides: dict[str, list[tuple]] | None = None):
    rows = dict(ROWS)
    rows.update(overrides or {})
    return {n: spark.createDataFrame(rows.get(n, []), SCHEMAS[n]) for n in TABLES}
