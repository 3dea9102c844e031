"""Loader (A1) and derived-table checks."""

from __future__ import annotations

from procura.sources.derived import derived_tables
from procura.sources.tables import SCHEMAS, TABLES, conform_table, load_tables


def test_conform_narrows_casts_and_optionally_nulls_empty_text(spark):
    raw = spark.createDataFrame([(1, "", "x", 99)], "vendor_id int, vendor_name string, extra string, more int")
    kept = conform_table(raw, SCHEMAS["suppliers"])
    assert kept.columns == ["vendor_id", "vendor_name"]
    assert kept.schema["vendor_id"].dataType.simpleString() == "bigint"
    assert kept.first()["vendor_name"] == ""
    assert conform_table(raw, SCHEMAS["suppliers"], empty_as_null=True).first()["vendor_name"] is None


def test_load_tables_from_mapping(spark):
    frames = {n: spark.createDataFrame([], SCHEMAS[n]) for n in TABLES}
    t = load_tables(spark, frames)
    assert set(t) == set(TABLES) and all(t[n].columns == [f.name for f in SCHEMAS[n].fields] for n in TABLES)


def test_derived_tables_have_canonical_schemas_and_scale(spark, sf_small):
    t = derived_tables(spark, sf_small)
    for n in TABLES:
        assert [(f.name, f.dataType) for f in t[n].schema.fields] == [(f.name, f.dataType) for f in SCHEMAS[n].fields]
    assert t["po_lines"].count() > 1000 and t["rcv_transactions"].count() > t["po_lines"].count()


def test_load_tables_from_catalog_names_reads_empty_text_as_null(spark):
    spark.createDataFrame([(1, "")], "vendor_id int, vendor_name string").createOrReplaceTempView("suppliers_in_catalog")
    row = load_tables(spark, {"suppliers": "suppliers_in_catalog"}, names=("suppliers",))["suppliers"].first()
    assert (row["vendor_id"], row["vendor_name"]) == (1, None)


def test_every_path_of_the_reports_is_reached(sf_small):
    """No column that a report fills is constant or all NULL, fixed labels excepted."""
    from oracle.compare import duck_connect
    from oracle.reports import report_sql

    con = duck_connect(sf_small)
    rows = con.sql(report_sql("union_legacy"))
    names = rows.columns
    values = [set() for _ in names]
    for row in rows.fetchall():
        for seen, v in zip(values, row):
            if v is not None:
                seen.add(v)
    flat = {n for n, seen in zip(names, values) if len(seen) < 2}
    assert flat == {"RFQ Stage", "Delivery Status"}
