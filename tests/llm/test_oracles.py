from __future__ import annotations

import pytest

from ledgerloom.llm.queries import ORACLE_SQL, QUERIES

from ..oracle import THERE, assert_matches


@pytest.mark.skipif(not THERE, reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    assert_matches(spark, QUERIES[name], ORACLE_SQL[name])
