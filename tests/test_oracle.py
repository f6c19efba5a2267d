"""Every registered query against its DuckDB oracle on the smallest test tables."""
import duckdb
import pytest

from stratum.proxies.registry import load_all
from tests.conftest import SMOKE
from tools.check_oracle import TABLES, canon, type_diffs

QUERIES, ORACLE = load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 120


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMOKE)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert type_diffs(df, res.description) == {}
    assert canon(df.columns, rows) == canon(ocols, orows)


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["class_name", "active_risks_rrn_mitigated", "active_risks_rrn"]
    assert df.count() >= 0
