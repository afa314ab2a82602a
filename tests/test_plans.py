"""Physical-plan shape checks: push-down, pruning, one shuffle for the indicator windows."""

import re

from barlake.operators import indicators as ind
from barlake.sources.adapters import candles_from_events
from barlake.sources.files import new_table_path
from conftest import SF01
from barlake.session import table


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _stored_candles(spark):
    p = new_table_path(spark, "plan_candles")
    candles_from_events(table(spark, SF01, "events")).write.parquet(p)
    return spark.read.parquet(p)


def test_indicator_plan_one_shuffle_and_pushdown(spark):
    c = _stored_candles(spark)
    u = ind.indicators_batch(c)
    plan = _plan(u)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "PushedFilters: [IsNotNull(volume), IsNotNull(open), IsNotNull(close), GreaterThan(volume,0.0)" in plan
    assert plan.count("Window [") <= 4


def test_halo_plan_single_scan_single_data_shuffle(spark):
    c = _stored_candles(spark)
    u = ind.add_indicators(ind.clean_batch(c), chunk_rows=100)      # forces several chunks per symbol
    plan = _plan(u)
    # the data is read once; halo copies come from an explode after a broadcast join
    assert plan.count("Scan parquet") == 1
    assert "BroadcastHashJoin" in plan and "Generate explode" in plan
    # one exchange for the data (symbol, chunk) + one over the tiny checkpointed bucket summary
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_projection_pruned(spark):
    c = _stored_candles(spark)
    plan = _plan(c.where("symbol = 'BTCUSDT'").select("timestamp", "close"))
    assert "ReadSchema: struct<symbol:string,timestamp:timestamp_ntz,close:double>" in plan
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,BTCUSDT)]" in plan


def test_broadcast_checks_bytes_of_texts_and_lists(spark):
    from barlake.plans.joins import broadcast_if_small
    df = spark.createDataFrame([(1, "é" * 1000, ["x" * 500], {"a": 1}, None)], "id long, t string, l array<string>, m map<string,int>, b binary")

    def hinted(**bounds):
        return "broadcast" in broadcast_if_small(df, **bounds)._jdf.queryExecution().logical().toString().lower()

    assert hinted(max_bytes=3000) and not hinted(max_bytes=2500) and not hinted(max_rows=0, max_bytes=3000)
    assert hinted() and not hinted(max_rows=0)
    empty = broadcast_if_small(df.where("id < 0"), max_bytes=0)
    assert "broadcast" in empty._jdf.queryExecution().logical().toString().lower()
