"""The registered queries against their SQL, and the contract's columns."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import rows_of, same_type
from winnow.llm.catalog import QUERIES, SQL

from llm_cases import SF, TABLES

COLUMNS = {
    "op1_ngram_join": {"doc_id", "n_shingles", "component_id"},
    "op2_exact_topk": {"query_id", "rank", "vec_id", "score"},
    "op5_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op7_byte_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op8_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op9_secret_scan": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op10_quality": {"doc_id", "held_out", "score", "predicted"},
    "op11_token_alignment": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
    "op12_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
    "op13_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_values_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got, cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want, wanted = rows_of(list(kinds), cur.fetchall())
    assert cols == wanted and got == want
    assert all(same_type(k, kinds[c]) for c, k in df.dtypes)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_of_the_contract(spark, name):
    assert COLUMNS[name] <= set(QUERIES[name](spark, SF).columns)
