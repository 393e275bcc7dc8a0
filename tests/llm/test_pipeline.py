"""The pipeline stage by stage on a small folder, and the SQL of single operators."""

import glob
import os
import re
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    by_name = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, SF)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        by_name[name] = (before, docs)
        if name != "packing":
            assert sorted(docs.columns) == ["doc_id", "lang", "n_chars", "source", "text"]
    before, after = by_name["language_id"]
    assert after.count() == before.filter("text rlike '[A-Za-z]'").count()
    before, after = by_name["near_duplicates"]
    kept, sets = {r.doc_id for r in after.collect()}, {r.doc_id: shingles(r.text) for r in before.collect()}
    linked = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    ids = sorted(sets)
    for k, i in enumerate(ids):
        smaller = any(linked(sets[i], sets[j]) for j in ids[:k])
        assert i in kept or smaller
        assert not (i in kept and smaller)
    before, after = by_name["repeated_strings"]
    assert after.count() == before.count()
    before, after = by_name["benchmark_leaks"]
    kept = {r.doc_id for r in after.collect()}
    for r in before.collect():
        assert not (r.doc_id in kept and any(t in r.text for t in items))
    assert before.count() - after.count() < 0.2 * before.count()
    assert {r.doc_id for r in by_name["packing"][1].collect()} == kept


def test_last_stage_returns_the_ids(spark):
    from tokenizers import Tokenizer

    from floe.llm import packing

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    got = corpus_pipeline.pack_sequences(spark, docs, SF).toPandas()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(got.doc_id) == set(texts)
    for doc_id, parts in got.sort_values("start").groupby("doc_id"):
        ids = tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0]
        assert np.frombuffer(b"".join(parts.ids), "<u4").tolist() == ids
    assert [zlib.crc32(x) for x in got.ids] == got.ids_crc32.tolist()


def test_packing_query_deals_out_the_ids(spark):
    plan = entry.queries()["op7_packing"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"crc32\(ids#\d+\)", plan[: plan.index("Window")])  # the digest is taken above the window, of the ids it has moved


def test_full_pieces_are_no_single_group(spark):
    from floe.llm import packing

    cut = spark.range(5000).selectExpr("id AS doc_id", "0L AS start", "CASE WHEN id % 2 = 0 THEN 8L ELSE 1 + id % 7 END AS length", "id AS ids")
    got = packing.assign(cut, capacity=8, rows_per_bucket=100).toPandas()
    assert sorted(got.ids) == list(range(5000)) and (got.ids == got.doc_id).all()
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert (seq.length.cumsum() - seq.length == seq.offset).all() and seq.length.sum() <= 8


@pytest.mark.parametrize("name", ["op3_fm_index", "op5_warc", "op11_conversation_repair", "op12_sharded_lloyd"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    got = entry.queries()[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(cursor.fetchall(), key=str)


def test_all_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_|pipeline", n)]
    assert len(names) == 14
