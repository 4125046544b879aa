"""The registered queries against their SQL, and the pipeline, on the smallest data folder."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from gearledger.llm import pii
from gearledger.llm import queries as llm
from tests.conftest import SMALL
from tests.llm.test_operators import plain_spans

TABLES = ["documents", "embeddings", "pages", "labels"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = llm.queries()[name](spark, SMALL)
    cursor = duck.execute(llm.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert in_order(df.columns, [tuple(r) for r in df.collect()]) == in_order(columns, cursor.fetchall())


def test_every_dealt_operator_is_registered():
    known = entry.queries()
    assert [sum(q.startswith(f"op{n}_") for q in known) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in known


@pytest.mark.parametrize("name", ["op2_best_fit_packing", "op3_private_data", "op6_line_dedup",
                                  "op9_quality_classifier", "op10_url_rules", "op12_periodic_runs"])
def test_query_covers_its_table(spark, name):
    table = "pages" if name.startswith("op10") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    wanted = {r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in llm.queries()[name](spark, SMALL).select(key).collect()} == wanted


def test_private_data_digests(spark):
    """Every column of the query against the plain patterns, on documents that hold all kinds."""
    texts = dict(tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = llm.queries()["op3_private_data"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    seen = set()
    for row in rows:
        base = plain_spans(texts[row["doc_id"]] or "")
        listed = [f"{k}:{s}:{e}" for k, s, e in base]
        seen |= {k for k, _, _ in base}
        for kind in pii.KINDS:
            assert row[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        assert row["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row["spans"].split(","))
    assert seen == set(pii.KINDS)


def test_native_plan(spark):
    plan = llm.queries()["op7_line_rules"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "Pandas", "Exchange"):
        assert word not in plan


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "near_dedup", "source_mixing", "best_fit_packing"]
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, seen, SMALL)
        if name != names[-1]:
            assert after.columns == docs.columns
        # Rows are kept by collecting them, so that the next stage reads a table and not the plan.
        seen = spark.createDataFrame(after.collect(), after.schema)
    packed = seen.toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    ran = corpus_pipeline.run(spark, SMALL).toPandas()
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, ran[key].values.tolist())) == sorted(map(tuple, packed[key].values.tolist()))


def test_pipeline_stages_on_odd_tables(spark):
    """Null ids, texts and sources, empty and long texts, repeated rows, further columns, and an empty table."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, score string, passes int, kept string"
    prose = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(12).collect()]
    texts = [None, "", " \n ", "one", *prose, prose[0], "word " * 60_000, "w" * 50_000]
    rows = [(i, t, "en", f"s{i % 2}" if i % 3 else None, 1, "a", 2, "b") for i, t in enumerate(texts)]
    rows += [rows[5], (None, prose[1], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    for docs in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        empty = docs.isEmpty()
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SMALL)
            found = after.collect()
            if name != "best_fit_packing":
                assert after.columns == docs.columns
                assert name == "source_mixing" or len(found) <= len(rows)
            assert bool(found) != empty
            if not empty and name == "line_dedup":
                assert {r.text for r in found} >= {None, "", "one"}
            if not empty and name == "near_dedup":
                assert sum(r.text == prose[0] for r in found) == 1 and {r.text for r in found} >= {None, ""}
            if not empty and name == "source_mixing":
                assert all(r.text and r.text.strip() for r in found)
            if not empty and name == "best_fit_packing":
                assert {r.doc_id for r in found} == {r[0] for r in rows}
                assert max(r.offset + r.length for r in found) <= 2048
