"""Registered queries against their SQL, and the pipeline stage by stage."""

import importlib

import duckdb
import pytest

import __spark_entry__ as entry
from llm_tables import SF, documents  # noqa: F401
from patronage.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert got == sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries()


def test_pipeline(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    out = pipeline.run(spark, SF)
    rows = out.select("doc_id", "source", "shard", "slot").collect()
    assert out.columns[: len(names)] == names and {r.doc_id for r in rows} <= ids
    assert len({r.doc_id for r in rows} & toxic) <= 0.3 * len(toxic)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_pipeline_stages_by_hand(spark, documents):
    """Each stage on rows whose fate is known; clean documents stay."""
    pipeline = importlib.import_module("corpus_pipeline")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    text = " ".join(f"word{i}" for i in range(70))
    rows = [(1, text), (2, text + " more"), (3, f"before {item} after"), (4, None), (5, ""), (6, "quite another text about something else")]
    docs = documents(rows)
    left = pipeline.drop_near_copies(spark, docs, SF)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 5, 6]
    left = pipeline.drop_leaks(spark, left, SF)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 4, 5, 6]
    mixed = pipeline.mix(spark, left, SF)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= {1, 4, 5, 6}
    done = pipeline.shard(spark, left, SF).collect()
    assert sorted(r.doc_id for r in done) == [1, 4, 5, 6] and all(0 <= r.shard < 16 for r in done)


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_empty_tables(spark, documents, stage):
    pipeline = importlib.import_module("corpus_pipeline")
    assert pipeline.STAGES[stage][1](spark, documents([]), SF).count() == 0
