from __future__ import annotations

import pytest

from ledgerloom.plans import warehouse_queries  # noqa: F401
from ledgerloom.plans.driver_queries import QUERIES, SQL

from .oracle import THERE, assert_matches


@pytest.mark.skipif(not THERE, reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, name):
    assert_matches(spark, QUERIES[name], SQL[name])
