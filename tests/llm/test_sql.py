"""The operators that SQL can express give the SQL's rows on the driver's tables."""

from __future__ import annotations

import pytest

from stakescope.llm import queries as q
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_matches_sql(spark, sf_dir, name):
    assert compare(spark, sf_dir, q.queries()[name], q.oracle_sql()[name]) == ""
