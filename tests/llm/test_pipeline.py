"""The corpus pipeline and the registered queries against brute force and SQL."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from conftest import SF_SMALL
from panelkit.llm import common, queries
from panelkit.plans.check import compare, duckdb_connection

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    got = queries.queries()[name](spark, SF_SMALL).toPandas()
    want = duckdb_connection(SF_SMALL).execute(SQL[name]).fetchdf()
    ok, why = compare(got, want)
    assert ok, why


def test_registered():
    import __spark_entry__ as e
    assert {f"op{n}_" for n in range(1, 11)} <= {q.split("_")[0] + "_" for q in e.queries()}
    assert "pipeline" in e.queries()


def stage_inputs(spark):
    docs = common.table(spark, SF_SMALL, "documents").withColumn("copies", F.lit(7)).withColumn("id", F.lit("x"))
    first = docs.limit(3).collect()
    more = [{**r.asDict(), "doc_id": None} for r in first] + [first[0].asDict(), first[0].asDict()]
    more += [{**first[0].asDict(), "doc_id": 90_000, "text": None, "lang": None, "source": None},
             {**first[0].asDict(), "doc_id": 90_001, "text": "", "lang": None},
             {**first[0].asDict(), "doc_id": 90_002, "text": "1 2", "lang": None, "source": None}]
    return docs.unionByName(spark.createDataFrame([tuple(m[c] for c in docs.columns) for m in more], docs.schema))


def test_language_stage_keeps_told_documents(spark):
    docs = stage_inputs(spark)
    out = cp.language_stage(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    gone = docs.exceptAll(out).select("doc_id").collect()
    assert {r[0] for r in gone} <= {90_000, 90_001, 90_002} and {90_000, 90_001} <= {r[0] for r in gone}


@pytest.mark.parametrize("limit", [cp.BROADCAST_DECISIONS, -1])
def test_dedup_stages_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(cp, "BROADCAST_DECISIONS", limit)
    docs = stage_inputs(spark)
    out = cp.exact_stage(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    best = {}
    for i, t in rows:
        best[t] = max(best.get(t, -1), -1 if i is None else i)
    assert sorted((r["doc_id"], r["text"] or "") for r in out.collect()) == sorted((i, t) for t, i in best.items())
    near = cp.near_stage(spark, docs, SF_SMALL)
    from test_small_operators import components, plain_print
    known = {(i, t) for i, t in rows if i is not None}
    prints = {}
    for i, t in known:
        prints.setdefault(plain_print(t), []).append((i, t))
    ks = sorted(prints)
    part = components(ks, [(a, b) for a in ks for b in ks if a < b and (a ^ b).bit_count() <= 3])
    groups = {}
    for k in ks:
        groups.setdefault(part[k], []).extend(prints[k])
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(min(i for i, _ in g) for g in groups.values())


def test_mixing_and_bpe_stages(spark):
    docs = common.table(spark, SF_SMALL, "documents").withColumn("copies", F.lit(7))
    out = cp.mixing_stage(spark, docs, SF_SMALL)
    assert out.columns == docs.columns and 0 < out.count()
    assert out.subtract(docs).count() == 0
    last = cp.bpe_stage(spark, docs, SF_SMALL).collect()
    want = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in docs.collect()}
    assert {r["doc_id"]: r["decoded_sha256"] for r in last} == want


def test_run(spark):
    out = cp.run(spark, SF_SMALL).collect()
    assert out and set(out[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_stages_take_an_empty_table(spark):
    docs = common.table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0
