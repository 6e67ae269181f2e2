"""Corpus queries against their SQL."""

from tests.llm.helpers import SMALL
from tests.oracle_compare import compare


def test_queries_match_their_sql(spark):
    from shoal.llm.oracle import oracles
    got = compare(spark, SMALL, sorted(oracles()), verbose=False)
    assert {v[0] for v in got.values()} == {"ok"}, got


def test_every_operator_has_one_query():
    from shoal.llm.queries import registry
    assert sorted(int(k[2:].split("_")[0]) for k in registry()) == list(range(1, 14))
