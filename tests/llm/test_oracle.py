"""The training-data queries that SQL can express agree with DuckDB at sf0.01."""

from __future__ import annotations

import pytest

from casaframe.llm.queries import ORACLE, QUERIES
from conftest import SF01
from oracle import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF01), ORACLE[name], duck(SF01))
    assert ok, msg
