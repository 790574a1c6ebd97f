"""Every registered query against its SQL counterpart, rows compared as multisets."""

import pytest

from checks import registry
from checks.compare import differences

QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches(spark, con, folder, name):
    assert differences(QUERIES[name](spark, folder), con, ORACLE[name]) == []
