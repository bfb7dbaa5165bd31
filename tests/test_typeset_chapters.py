import __spark_entry__ as entry
import duckdb
import pytest

LONG = "a line of so many words that it is no short one, and that ends with a mark of its own。"

CASES = {
    "blank texts": ["", " ", "\n", " \n\t\n "],
    "repeats that cleaning would shorten": ["哈哈哈哈哈\n你好你好你好吗。" + LONG],
    "notes that cleaning would flatten": [f"a<sup>x\n{LONG}\ny</sup>b\n<sup>q\n r</sup>"],
    "other line breaks": [f"ab\r\ncd\r\n{LONG}\r\nef\rgh", "ab\x0bcd\x0cef\x1cgh\x85ij kl mn"],
    "other blanks": [f"\xa0ab\n{LONG}\xa0\n　{LONG}\n　\n{LONG}\x1f"],
    "other digits": [f"x\n１９９９ {LONG}\n1999\xa0{LONG}\n1999\x0b{LONG}"],
    "chains of marks and hyphens": [f"#\n{LONG}\n ##\n{LONG}\n # x\n{LONG}\n#-\n{LONG}-\n-\n #x\n{LONG}\n-"],
}


def compare(spark, tmp_path, rows):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = db.sql(f"SELECT doc_id, file_name, text FROM ({entry.oracle_sql()['typeset_chapters']})").fetchall()
    got = entry.queries()["typeset_chapters"](spark, str(tmp_path)).select("doc_id", "file_name", "text").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    return got


@pytest.mark.parametrize("case", CASES)
def test_odd_texts_as_in_the_sql(spark, tmp_path, case):
    compare(spark, tmp_path, [(10 * k + i, t) for k, t in enumerate(CASES[case]) for i in range(10)])


def test_absent_and_negative_ids_as_in_the_sql(spark, tmp_path):
    rows = [(i, f"{LONG}\nb\n{LONG}-\n\n#\nc-") for i in range(-10, 10)]
    got = compare(spark, tmp_path, [*rows, (None, f"{LONG}\nb"), (77, None)])
    assert len(got) == 21 and any(r.doc_id is None and LONG in r.text for r in got)


def test_copies_under_one_id_as_in_the_sql(spark, tmp_path):
    """Only where any order of lines that tie gives one text; elsewhere the SQL differs from run to run."""
    compare(spark, tmp_path, [(2, f"{LONG}\nb"), (12, f"{LONG}\nb")] * 3)
