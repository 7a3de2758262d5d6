"""A few registered queries against their DuckDB oracle at sf0.001 (the full run is
tests/oracle_check.py at sf0.01)."""

import pytest

from tests.conftest import SF001
from tests.oracle_check import duck, rows_of

KEYS = ["src_pairs_tsv", "strip_pairs", "exact_split", "pretok_words", "greedy_pick", "loss_lines",
        "zh_tokens", "scoreboard", "pretok_bytes", "tokenizer_by_lang", "empty_raw_refs", "unmatched_turns",
        "convert_where_phrases", "evaluate_ids"]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    import __spark_entry__ as E
    sp = E.queries()[key](spark, SF001).toPandas()
    dd = con.sql(E.oracle_sql()[key]).df()
    assert rows_of(sp) == rows_of(dd)


def test_byte_pieces_sql_agrees_on_odd_white_space(spark, con):
    """Runs of white space before words, signs and the end, wide and non-breaking blanks, contractions."""
    from tandem.functions.text import pretok_bytes
    from tandem.plans.catalog import _byte_pieces_sql
    texts = ["", " ", "  ", "a  b", "a \n\tb!  ", "it's we'll don't 'sx", "x y　　z", "\t1 2  ３!?", "é  ñandú c",
             "  lead", "end\n\n", "a\x0b\x0bb", "中文  字"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", pretok_bytes("t").alias("p"))
    got = {r["i"]: list(r["p"]) for r in df.collect()}
    for i, t in enumerate(texts):
        sql = con.execute(f"SELECT {_byte_pieces_sql('t')} FROM (SELECT ?::VARCHAR AS t)", [t]).fetchone()[0]
        assert got[i] == sql, (t, got[i], sql)
