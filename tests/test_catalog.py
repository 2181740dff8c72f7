"""A cross-section of the registered queries against SQL; tools/check.py runs all of them."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, rows_of, same_type
from winnow.plans.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "q_funnel", "q_flow", "q_rules_masks", "q_rule_summary", "q_mask_combine_failed", "q_five_num_cut", "q_index_cut",
    "q_frag_score", "q_sediv", "q_similar_texts", "q_min_dist", "q_interactions", "q_complexity", "q_best_by_tool", "q_kde",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_sql_belongs_to_a_query(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(SQL)
    assert entry.entry(spark).columns == ["p_brand", "position", "stage", "count"]


@pytest.mark.parametrize("name", SAMPLE)
def test_same_values_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got, cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want, wanted_cols = rows_of(list(kinds), cur.fetchall())
    assert cols == wanted_cols and got == want
    assert all(same_type(k, kinds[c]) for c, k in df.dtypes)
