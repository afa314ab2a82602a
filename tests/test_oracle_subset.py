"""A fast cross-section of catalog queries checked against DuckDB at sf0.01.

The whole catalog is checked by ``python tests/oracle.py``; this keeps one
key per family in the regular test run.
"""

import pytest

import __spark_entry__ as E
from conftest import SF01
from oracle import compare

KEYS = ["indicators_batch", "rsi_14", "returns_pct", "drawdown", "rolling_beta_50", "symbol_stats", "return_stats",
        "describe_numeric", "return_corr_matrix", "histogram_returns", "weekday_profile", "typed_cast_reject",
        "flatten_kline_envelope", "fact_dim_star", "dedupe_candles", "indicators_stream_mode",
        "indicators_stream_group", "feature_frame", "standard_scale", "naive_forecast_metrics",
        "quarantine_rejects", "append_unified_stream", "pipeline_counters"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    ok, n, detail = compare(spark, key, E.queries()[key], E.oracle_sql()[key], SF01)
    assert ok, detail
    assert n > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "rsi_14" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
