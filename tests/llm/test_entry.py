"""Registration of the training-data queries, the SQL oracle of op1 and the pipeline against brute force."""

from __future__ import annotations

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from procura.llm import queries
from tests.llm.test_data_operators import encoders
from tests.llm.test_text_operators import brute_components, passage, shingle_set

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator_and_the_pipeline_are_registered():
    names = set(E.queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "substring_dedup", "decontamination", "byte_bpe"]


def test_op1_matches_its_oracle(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(E.oracle_sql()["op1_extendible_sharding"])
    got = E.queries()["op1_extendible_sharding"](spark, SF)
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


@pytest.fixture
def tables(spark, tmp_path):
    rnd = random.Random(12)
    plain = [f"w{i}" for i in range(500)]
    item = " ".join(rnd.choices([f"b{i}" for i in range(300)], k=30))
    shared = passage(1, 7)
    texts = [" ".join(rnd.choices(plain, k=60)) for _ in range(260)]
    toxic = set(range(0, 90, 2))
    for i in toxic:
        texts[i] += " vile nasty rotten"
    copies = {100: texts[99], 101: texts[99] + " tail", 102: texts[98].upper()}
    for i, t in copies.items():
        texts[i] = t
    for i in (110, 111, 112):
        texts[i] = f"{texts[i]}. {shared} {passage(i, 3)}"
    texts[120] = f"{texts[120]} {item} and words of its own"
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(250)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), {r[0]: r[1] for r in rows}, toxic, item, shared


def test_pipeline_stages_equal_brute_force(spark, tables):
    sf, texts, toxic, item, shared = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf)
    left = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == columns and left == set(texts) - toxic

    one = stages["ngram_join"](spark, clean, sf)
    ids = sorted(left)
    classes = brute_components(ids, [shingle_set(texts[i], 5) for i in ids], 80)
    want = {ids[n] for n, least in classes.items() if least == ids[n] or not shingle_set(texts[ids[n]], 5)}
    assert one.columns == columns and {r["doc_id"] for r in one.collect()} == want and not {100, 101, 102} & want

    cut = stages["substring_dedup"](spark, one, sf)
    cleaned = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert cut.columns == columns and set(cleaned) == want
    assert shared in cleaned[110] and all(re.split(r"(?<=\.) ", shared)[2] not in cleaned[i] for i in (111, 112))
    assert {i for i in want if cleaned[i] != texts[i]} == {111, 112}
    assert cut.where(F.length("text") != F.col("n_chars")).count() == 0

    free = stages["decontamination"](spark, cut, sf)
    assert free.columns == columns and {r["doc_id"] for r in free.collect()} == want - {120} and item in texts[120]

    _, theirs, *_ = encoders()
    coded = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(coded) == want - {120}
    for i, r in coded.items():
        ids_ = theirs.encode_ordinary(cleaned[i] or "")
        assert r["n_tokens"] == len(ids_) and bytes(r["ids"]) == b"".join(x.to_bytes(4, "little") for x in ids_)


def test_pipeline_on_empty_tables(spark, tables, tmp_path):
    sf, *_ = tables
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_learnable_labels_leave_the_held_out_third_alone(spark):
    ids = spark.range(300).withColumnRenamed("id", "doc_id")
    import zlib

    kept = {r[0] for r in ids.where(queries.learnable("doc_id")).collect()}
    assert kept == {i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1}
