"""Hosts with many branches."""

from __future__ import annotations

import pytest

from storeglass.llm import urls
from tests.llm.test_operators import WORDS


@pytest.mark.parametrize("width", [50, 51, 65])
def test_wide_nodes_keep_what_differs(spark, width):
    rules = [("block", "s.com", "/bad/x"), ("allow", "s.com", "/")]
    rows = [(k, f"http://s.com/bad/x{k}") for k in range(100)] + [(1000, "http://s.com/bad/other")]
    rows += [(2000 + 10 * k + i, f"http://s.com/{WORDS[k]}/{i}") for k in range(width - 1) for i in range(4)]
    out = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert len(out) == len(rows)
    assert {r["template"].split("/")[1] for k, r in out.items() if k <= 1000} == {"bad"}
    assert {r["template"].split("/")[1] for k, r in out.items() if k >= 2000} == {"*"}
    assert out[5]["purity"] > 0.8 > out[2000]["purity"]
