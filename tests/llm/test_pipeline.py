"""The pipeline stage by stage against brute force on a small corpus, and the oracles of the operators that have SQL."""
import duckdb
import pytest

import corpus_pipeline
from stratum.llm.queries import ORACLE, QUERIES
from tests.llm.test_small import brute_near

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    ids = [[r["doc_id"] for r in docs.select("doc_id").collect()]]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.stage(stage(spark, docs, SF), "test")
        assert docs.columns == before.columns
        ids.append([r["doc_id"] for r in docs.select("doc_id").collect()])
        assert set(ids[-1]) <= set(ids[-2]) and len(set(ids[-1])) == len(ids[-1])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum((d in ids[1]) == bool(q) for d, q in labels.items()) >= 0.95 * len(labels)
    exact = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = [d for d in ids[2]]
    _, comp = brute_near([exact[d] for d in kept], 5)
    assert sorted(ids[3]) == sorted(min(d for d, c in zip(kept, comp) if c == k) for k in set(comp))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(ids[4])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.sql(ORACLE[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda row: tuple(str(v) for v in row)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=key) == \
        sorted((tuple(r[want.columns.index(c)] for c in cols) for r in want.fetchall()), key=key)
