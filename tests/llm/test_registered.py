"""The registered queries over the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def count(name):
    return duckdb.sql(f"SELECT count(*) FROM '{SF_DIR}/{name}.parquet'").fetchall()[0][0]


def test_all_are_registered():
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_like_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    got = queries.queries()[name](spark, SF_DIR)
    want = con.execute(queries.oracle_sql()[name])
    order = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(order)
    assert sorted(map(str, map(tuple, got.select(*order).collect()))) == sorted(map(str, want.fetchall()))


CONTRACT = {
    "op4_toxicity": ("documents", ["doc_id", "held_out", "score", "predicted"]),
    "op5_kneser_ney": ("documents", ["doc_id", "perplexity", "kept"]),
    "op6_fertility": ("documents", ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]),
    "op7_simhash": ("documents", ["doc_id", "fingerprint", "component_id"]),
    "op8_html_crf": ("pages", ["page_id", "url", "text", "n_chars"]),
    "op9_sentencepiece": ("documents", ["doc_id", "n_ids", "ids", "same"]),
    "op13_language": ("documents", ["doc_id", "held_out", "lang_pred", "score"]),
    "op10_suffix_dedup": ("documents", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
}


@pytest.mark.parametrize("name", CONTRACT)
def test_a_row_for_each_input_row(spark, name):
    table, columns = CONTRACT[name]
    got = queries.queries()[name](spark, SF_DIR)
    assert set(columns) <= set(got.columns) and got.count() == count(table)
