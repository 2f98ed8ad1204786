"""The sorted queries compared with their SQL row by row, in the order they come."""

import pytest
from oracle import _norm, connect

from tamarack.plans import REGISTRY

ORDERS = {
    "sort_multi": '"user", item',
    "sort_by_date": "day NULLS LAST, o_orderkey",
    "first_n": "o_totalprice DESC, o_orderkey",
    "distinct_sorted": "loc",
    "group_count_sorted": "loc",
    "topk_count": "n DESC, loc",
    "text_facet": "n DESC, p_name",
    "intersect_sorted": "loc",
    "search_and": "doc_id",
    "search_or": "n_matched DESC, doc_id",
    "bm25_and": "score DESC, doc_id",
    "bm25_or": "score DESC, doc_id",
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_order(spark, root, name):
    q = REGISTRY[name]
    df = q.run(spark, root)
    columns = ", ".join(f'"{c}"' for c in df.columns)
    want = connect(root).execute(f"SELECT {columns} FROM ({q.sql}) ORDER BY {ORDERS[name]}").fetchall()
    assert [tuple(map(_norm, r)) for r in df.collect()] == [tuple(map(_norm, r)) for r in want]
