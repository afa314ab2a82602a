import pytest
from pyspark.sql import functions as F

from barlake.plans.quantiles import exact_quantiles
from barlake.sources.adapters import event_candles
from conftest import SF01


@pytest.mark.parametrize("parts,max_buffered", [(1, 0), (3, 0), (8, 0), (8, None)])
def test_exact_quantiles_match_percentile(spark, parts, max_buffered):
    c = event_candles(spark, SF01)
    probs = {"q10": 0.1, "q33": 0.33, "q50": 0.5, "q66": 0.66, "q100": 1.0}
    got = {r["symbol"]: r for r in exact_quantiles(c, ["symbol"], "close", probs, partitions=parts,
                                                   max_buffered=max_buffered).collect()}
    exp = c.groupBy("symbol").agg(*[F.percentile("close", p).alias(k) for k, p in probs.items()]).collect()
    assert len(got) == len(exp)
    for e in exp:
        for k in probs:
            assert got[e["symbol"]][k] == pytest.approx(e[k], rel=1e-12)


def test_exact_quantiles_no_keys(spark):
    c = event_candles(spark, SF01)
    got = exact_quantiles(c, [], "volume", {"med": 0.5}, max_buffered=0).collect()
    exp = c.agg(F.percentile("volume", 0.5).alias("m")).collect()[0]["m"]
    assert got[0]["med"] == pytest.approx(exp, rel=1e-12)


def test_return_stats_large_group_path_matches(spark, monkeypatch):
    import barlake.operators.profiles as P
    import barlake.plans.quantiles as Q
    c = event_candles(spark, SF01)
    small = {r["symbol"]: r.asDict() for r in P.return_stats(c).collect()}
    monkeypatch.setattr(P, "MAX_BUFFERED_GROUP", 0)
    monkeypatch.setattr(Q, "MAX_BUFFERED_GROUP", 0)
    big = {r["symbol"]: r.asDict() for r in P.return_stats(c).collect()}
    assert small.keys() == big.keys()
    for s in small:
        for k, v in small[s].items():
            if isinstance(v, float):
                assert big[s][k] == pytest.approx(v, rel=1e-9, abs=1e-12)
            else:
                assert big[s][k] == v


def test_null_group_ties_and_empty_groups_at_every_limit(spark):
    rows = [(None, float(i % 3)) for i in range(200)] + [("a", 0.0)] * 400 + [("a", float(i)) for i in range(200)] + [("b", None)] * 5 + [("c", 4.5)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(3)
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    runs = [sorted(map(str, exact_quantiles(df, ["g"], "x", probs, max_buffered=m).collect())) for m in (0, 10, 2_000_000)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 3
