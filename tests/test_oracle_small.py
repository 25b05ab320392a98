"""Every registered query equals its DuckDB oracle on the smallest data."""

from ledgerline.plans.registry import QUERIES
from scripts.oracle_check import compare_all

from tests.conftest import SF_SMALL


def test_all_queries_match_oracle(spark):
    res = compare_all(spark, SF_SMALL, list(QUERIES), log=lambda *a: None)
    bad = {k: v for k, v in res.items() if v.get("status") not in ("ok", "rows-only")}
    assert not bad, bad
    assert len(res) >= 70
