"""Differential check: every registered query with an oracle agrees with DuckDB at sf0.01."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF001, SF01  # noqa: F401
from oracle import compare, duck

from casaframe.registry import QUERIES as REGISTERED

# the training-data queries have tests of their own
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in REGISTERED}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 4158 and len(df.columns) == 12


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(entry.queries()[name](spark, SF01), ORACLE[name], con)
    assert ok, msg


def test_every_query_registered_runs_small(spark):
    names = [n for n in REGISTERED if n not in ORACLE]
    assert set(names) == {"train_models", "score_batch", "stream_score", "metrics_log",
                          "model_info"}
    for n in names:
        assert entry.queries()[n](spark, SF001).count() > 0
