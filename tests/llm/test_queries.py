import duckdb
import pytest
from quirework.llm import queries

SF = "/root/testdata/sf0.001"


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    got = sorted(repr([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    rel = con.sql(queries.ORACLE_SQL[name])
    rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == sorted(repr([plain(r[c]) for c in sorted(rel.columns)]) for r in rows)
