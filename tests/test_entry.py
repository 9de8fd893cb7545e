"""The driver contract: every oracle names a query, and the entry runs."""

import __spark_entry__ as entry


def test_names():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert "p1_found" in queries
    assert oracles.keys() <= queries.keys()
