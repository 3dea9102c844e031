"""Document drill-downs (C12): the report for one document, from narrowed tables.

A drill-down is a predicate on report columns. Filtering the finished report
gives the right rows but reads every receipt, invoice and requisition. Here
the document is first resolved to line locations and requisition
distributions by narrow joins that start from the predicate's own table; all
fact tables are then reduced to those ids before the blocks are built, and
the predicate is applied to the (small) report. Rows that the narrowing
changes are rows of other documents, which the predicate removes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from procura.operators.drill import drill

Tables = Mapping[str, DataFrame]

#: Up to so many ids become a literal list, which the Parquet scan can use; more are semi-joined.
LITERAL_IDS = 500

#: Report column -> (table, column) that resolves it; further columns only filter the report.
RESOLVERS = {
    "PO Number": ("po_headers", "segment1"),
    "PR_Number": ("req_headers", "segment1"),
    "Invoice Number": ("invoices", "invoice_num"),
    "DISTRIBUTION_ID": ("req_distributions", "distribution_id"),
}


class _Ids:
    """A set of ids: a literal list if it is short, else the distinct values of a one-column frame."""

    def __init__(self, frame: DataFrame, few: list | None):
        self.frame, self.few = frame.toDF("id").where("id is not null").distinct(), few

    def of(self, df: DataFrame, column: str) -> DataFrame:
        if self.few is not None:
            return df.where(F.col(column).isin(self.few)) if self.few else df.where(F.lit(False))
        return df.join(self.frame.withColumnRenamed("id", "__id"), F.col(column) == F.col("__id"), "left_semi")

    def test(self, column: str) -> Column | None:
        return None if self.few is None else (F.col(column).isin(self.few) if self.few else F.lit(False))


def _found(frames: Mapping[str, DataFrame]) -> dict[str, _Ids]:
    """The id sets of several one-column frames, all by one job.

    At most ``LITERAL_IDS`` + 1 ids of a set reach the driver; a longer set
    stays a frame."""
    every = None
    for kind, frame in frames.items():
        one = frame.toDF("id").select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id"))
        every = one if every is None else every.unionByName(one)
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("id"))
    rows = every.where("id is not null").distinct().withColumn("rank", rank).where(F.col("rank") <= LITERAL_IDS + 1).collect()
    out = {}
    for kind, frame in frames.items():
        ids = [r["id"] for r in rows if r["kind"] == kind]
        if not isinstance(frame.schema.fields[0].dataType, StringType):
            ids = [int(x) for x in ids]
        out[kind] = _Ids(frame, ids if len(ids) <= LITERAL_IDS else None)
    return out


def _meeting(df: DataFrame, column: str, other: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in the one column of ``other``."""
    return df.join(other.toDF("__of"), F.col(column) == F.col("__of"), "left_semi")


def _either(df: DataFrame, first: tuple[_Ids, str], second: tuple[_Ids, str]) -> DataFrame:
    """Rows whose one column is in the first ids or whose other column is in the second."""
    tests = [ids.test(column) for ids, column in (first, second)]
    if all(x is not None for x in tests):
        return df.where(tests[0] | tests[1])
    return first[0].of(df, first[1]).unionByName(second[0].of(df, second[1])).distinct()


def narrowed(t: Tables, column: str, value) -> dict[str, DataFrame]:
    """The tables reduced to what the rows of one document can reach.

    Three jobs: the document's line locations; the ids on the rows of these
    locations; the ids that those rows refer to. Each job finds all its id
    sets together, by narrow semi-joins from the sets of the job before."""
    table, field = RESOLVERS[column]
    start = t[table].where(F.col(field) == F.lit(value))
    lines, locations, dists = t["po_lines"], t["po_line_locations"], t["po_distributions"]
    req_dists, req_lines = t["req_distributions"], t["req_lines"]
    # 1: line locations, and the requisition lines of a requisition
    own = None
    if column == "PO Number":
        of_header = _meeting(lines, "po_header_id", start.select("po_header_id"))
        wanted = _meeting(locations, "po_line_id", of_header.select("po_line_id"))
    elif column == "Invoice Number":
        billed = _meeting(t["invoice_distributions"], "invoice_id", start.select("invoice_id"))
        wanted = _meeting(dists, "po_distribution_id", billed.select("po_distribution_id"))
    else:
        if column == "PR_Number":
            start = _meeting(req_dists, "requisition_line_id", _meeting(req_lines, "requisition_header_id", start.select("requisition_header_id")).select("requisition_line_id"))
        own = start.select("requisition_line_id")
        wanted = _meeting(dists, "req_distribution_id", start.select("distribution_id"))
    ids = _found({"location": wanted.select("line_location_id"), **({} if own is None else {"own_line": own})})
    locs = ids["location"]

    # 2: what the rows of the locations name
    out = dict(t)
    out["po_line_locations"] = locs.of(locations, "line_location_id")
    out["po_distributions"] = locs.of(dists, "line_location_id")
    of_location = locs.of(t["rcv_transactions"], "po_line_location_id")
    located = _meeting(lines, "po_line_id", out["po_line_locations"].select("po_line_id"))
    asked = {
        "line": out["po_line_locations"].select("po_line_id"), "release": out["po_line_locations"].select("po_release_id"),
        "header": located.select("po_header_id"), "order": _meeting(t["po_headers"], "po_header_id", located.select("po_header_id")).select("segment1"),
        "distribution": out["po_distributions"].select("po_distribution_id"), "receipt": of_location.select("transaction_id"),
        "shipment_line": of_location.select("shipment_line_id"), "shipment": of_location.select("shipment_header_id"),
    }
    if own is None:
        asked["own_line"] = _meeting(req_dists, "distribution_id", out["po_distributions"].select("req_distribution_id")).select("requisition_line_id")
    ids |= _found(asked)
    out["po_lines"] = ids["line"].of(lines, "po_line_id")
    out["po_headers"] = ids["header"].of(t["po_headers"], "po_header_id")
    out["po_headers_archive"] = ids["order"].of(t["po_headers_archive"], "segment1")
    out["po_releases"] = _either(t["po_releases"], (ids["header"], "po_header_id"), (ids["release"], "po_release_id"))
    # children of a receipt (inspections, returns) are told by their parent
    out["rcv_transactions"] = _either(t["rcv_transactions"], (locs, "po_line_location_id"), (ids["receipt"], "parent_transaction_id"))
    out["rcv_shipment_lines"] = ids["shipment_line"].of(t["rcv_shipment_lines"], "shipment_line_id")
    out["invoice_distributions"] = ids["distribution"].of(t["invoice_distributions"], "po_distribution_id")
    out["srn_headers"] = ids["header"].of(t["srn_headers"], "po_header_id")
    # the receipt's PO line id meets requisition lines in the inspection lookup, as in the source
    out["req_lines"] = _either(req_lines, (ids["own_line"], "requisition_line_id"), (ids["line"], "requisition_line_id"))

    # 3: what these rows refer to
    billed, noted = out["invoice_distributions"].select("invoice_id"), out["srn_headers"].select("srn_header_id")
    named = _meeting(t["req_headers"], "requisition_header_id", out["req_lines"].select("requisition_header_id")).select("segment1")
    asked = {
        "shipment": out["rcv_shipment_lines"].select("shipment_header_id").unionByName(of_location.select("shipment_header_id")),
        "invoice": billed, "check": _meeting(t["invoice_payments"], "invoice_id", billed).select("check_id"),
        "service_note": noted, "verification": _meeting(t["vrn_lines"], "srn_header_id", noted).select("vrn_header_id"),
        "own_line": out["req_lines"].select("requisition_line_id"), "requisition": named,
        "auction": _meeting(t["rfq_backing_reqs"], "requisition_line_id", out["req_lines"].select("requisition_line_id")).select("auction_header_id"),
        # approvers are looked up by requisition number
        "object": _meeting(t["req_headers"], "segment1", named).select("requisition_header_id").union(out["po_releases"].select("po_release_id")).union(
            out["po_headers"].select("po_header_id")),
    }
    ids |= _found(asked)
    for name, kind, key in (
        ("rcv_shipment_headers", "shipment", "shipment_header_id"), ("invoices", "invoice", "invoice_id"), ("invoice_lines", "invoice", "invoice_id"),
        ("payment_schedules", "invoice", "invoice_id"), ("invoice_payments", "invoice", "invoice_id"), ("checks", "check", "check_id"),
        ("srn_lines", "service_note", "srn_header_id"), ("vrn_lines", "service_note", "srn_header_id"), ("vrn_headers", "verification", "vrn_header_id"),
        ("req_distributions", "own_line", "requisition_line_id"), ("req_headers", "requisition", "segment1"), ("po_action_history", "object", "object_id"),
        ("rfq_backing_reqs", "own_line", "requisition_line_id"), ("rfq_headers", "auction", "auction_header_id"), ("rfq_lines", "auction", "auction_header_id"),
        ("rfq_action_history", "auction", "object_id"),
    ):
        out[name] = ids[kind].of(t[name], key)
    return out


def drill_document(t: Tables, build, predicate: Mapping[str, object]) -> DataFrame:
    """``build(tables)`` filtered by ``predicate``, whose first column names the document."""
    column, value = next(iter(predicate.items()))
    return drill(build(narrowed(t, column, value)), **predicate)
