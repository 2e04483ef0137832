import duckdb
import pytest
from oracle import assert_same, connect

from turnloom.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert_same(QUERIES[name](spark, sf_dir), con, ORACLES[name])


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())


def test_snapshots_of_odd_texts_match_sql(spark, tmp_path):
    """Nulls, blank texts and languages, white space of other than ASCII at the ends and at the cut, line ends of two characters in the middle."""
    texts = [None, "", " \n\t", "x", "\xa0x\u3000", "\x0bx\x0c", "\x1cx"]
    texts += [(c * 1000)[:n] + end + "b" * 500 for c in ("a", "\u00e9", "e\u0301") for n in (399, 400, 401, 795) for end in ("\n", "\r\n", "\u2028\xa0" * 3, "\x0b\x0c" * 3)]
    langs = ["en", None, "", " en\n", "x" * 1300]
    rows = [(i, text, lang) for i, (text, lang) in enumerate((text, lang) for text in texts for lang in langs)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert_same(QUERIES["q34_snapshots"](spark, str(tmp_path)), con, ORACLES["q34_snapshots"])
