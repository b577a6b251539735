"""Differential test: every registered query against its reference SQL."""

import pytest

from tests.oracle_check import compare


def test_all_queries_match_reference_sql(spark):
    res = compare(spark, "/root/testdata/sf0.001", verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "rows-only")}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "improvement_tier" in df.columns
