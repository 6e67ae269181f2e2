"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

from tests.oracle_compare import compare

SMALL = "/root/testdata/sf0.001"


def test_all_queries_match_oracle(spark):
    res = compare(spark, SMALL, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "no-oracle")}
    assert not bad, bad


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 1000
