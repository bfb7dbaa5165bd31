import __spark_entry__ as entry
import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(entry.registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    got = sorted(repr([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    rel = db.sql(entry.oracle_sql()[name])
    rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == sorted(repr([plain(r[c]) for c in sorted(rel.columns)]) for r in rows)


def test_flagship(spark):
    assert entry.entry(spark).columns == ["book", "text"]
