"""The DuckDB SQL of the queries against the queries, on the driver's smallest tables and on rows of odd kinds."""

import duckdb
import pytest

from tandem.llm.queries import ORACLES, QUERIES
from tests.conftest import SF001
from tests.oracle_check import duck, rows_of

WHOLE = ["op6_near_duplicates", "op8_mixing", "op10_decontamination"]


@pytest.mark.parametrize("name", WHOLE)
def test_query_equals_sql(spark, name):
    assert rows_of(QUERIES[name](spark, SF001).toPandas()) == rows_of(duck(SF001).sql(ORACLES[name]).df())


@pytest.mark.parametrize("name", WHOLE)
def test_query_equals_sql_on_odd_rows(spark, name, tmp_path):
    """Null, empty and blank texts, equal texts, a null source, items of fewer than 13 words, of none and of equal text."""
    long = " ".join(f"w{i % 97}x{i}" for i in range(3000))
    texts = [None, "", " \n\t", "one", "One", "a b c d e f", "A b c d eé f", long, long + " more", long[: len(long) * 7 // 10],
             "Hello, Wörld again", "the quick brown fox " * 9, "the quick brown fox " * 9]
    docs = [(i, t, [None, "b", "a", "ä"][i % 4]) for i, t in enumerate(texts)]
    items = [("i1", "quick brown fox"), ("i2", "quick, brown fox!"), ("i3", None), ("i4", "..."), ("i5", long[200:600]),
             ("i6", "fox the quick brown " * 5), ("i7", "absent words only here")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = rows_of(QUERIES[name](spark, str(tmp_path)).toPandas())
    assert len(got[1]) == len(docs) and got == rows_of(con.sql(ORACLES[name]).df())
