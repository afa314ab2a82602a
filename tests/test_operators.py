"""Small hand-made fixtures for aggregations, dedupe, split and features."""

import datetime as dt

from pyspark.sql import functions as F

from barlake.operators import features as FT
from barlake.operators import profiles as P
from barlake.operators import sets as ST

T0 = dt.datetime(2024, 1, 1)


def candles(spark, spec):
    rows = [(s, T0 + dt.timedelta(hours=h), float(c), float(c) + 1, float(c) - 1, float(c), float(v), 1)
            for s, h, c, v in spec]
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, open double, high double, low double, "
                                       "close double, volume double, trades bigint")


def test_daily_volume_empty_day(spark):
    # day 2 has no bars: mean NULL, sum 0
    df = candles(spark, [("A", 0, 1, 2), ("A", 1, 1, 4), ("A", 48, 1, 6)])
    mean = {r["date"].day: r["mean_volume"] for r in P.daily_volume(df, "mean").collect()}
    total = {r["date"].day: r["sum_volume"] for r in P.daily_volume(df, "sum").collect()}
    assert mean == {1: 3.0, 2: None, 3: 6.0} and total == {1: 6.0, 2: 0.0, 3: 6.0}


def test_dedupe_prefers_latest_then_historical(spark):
    t1, t2 = dt.datetime(2024, 2, 1, 1), dt.datetime(2024, 2, 1, 2)
    rows = [("A", T0, 1.0, "historical", t1), ("A", T0, 2.0, "streaming", t2), ("A", T0, 3.0, "historical", t2),
            ("B", T0, 4.0, "streaming", t1)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double, source string, "
                                     "ingestion_timestamp timestamp")
    got = {r["symbol"]: (r["close"], r["source"]) for r in ST.dedupe_candles(df).collect()}
    assert got == {"A": (3.0, "historical"), "B": (4.0, "streaming")}


def test_duplicates_counted(spark):
    df = candles(spark, [("A", 0, 1, 1), ("A", 0, 1, 1), ("A", 0, 2, 1), ("A", 1, 1, 1)])
    assert P.duplicate_full_rows(df).first()[0] == 1
    assert P.duplicate_keys(df).first()[0] == 2


def test_split_seven_three_and_no_leak(spark):
    df = candles(spark, [(s, h, 10 + h, 1) for s in ("A", "B") for h in range(10)])
    sp = FT.temporal_split(df)
    counts = {(r["symbol"], r["split"]): r["n"] for r in sp.groupBy("symbol", "split").agg(F.count("*").alias("n")).collect()}
    assert counts == {("A", "train"): 7, ("A", "test"): 3, ("B", "train"): 7, ("B", "test"): 3}
    eng = FT.engineered_in_split(sp)
    first_test = eng.where((F.col("split") == "test") & (F.col("timestamp") == T0 + dt.timedelta(hours=7)))
    assert all(r["close_lag_1"] is None for r in first_test.collect())   # lag does not reach into train
    bad = (eng.where(F.col("split") == "train").agg(F.max("timestamp")).first()[0]
           < eng.where(F.col("split") == "test").agg(F.min("timestamp")).first()[0])
    assert bad


def test_sample_skew_kurtosis_match_pandas(spark):
    import pandas as pd
    vals = [1.0, 2.0, 2.5, 4.0, 7.5, 8.0, 13.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    from barlake.functions.exprs import sample_kurtosis, sample_skewness
    r = df.agg(sample_skewness(F.col("x")).alias("s"), sample_kurtosis(F.col("x")).alias("k")).first()
    s = pd.Series(vals)
    assert abs(r["s"] - s.skew()) < 1e-12 and abs(r["k"] - s.kurt()) < 1e-12


def test_drawdown_and_base100_invariants(spark):
    from barlake.operators import series as S
    from barlake.sources.adapters import event_candles
    from conftest import SF01
    c = event_candles(spark, SF01)
    dd = S.drawdown(c)
    assert dd.agg(F.max("drawdown_pct")).first()[0] == 0.0
    assert dd.where(F.col("close") == F.col("cummax")).agg(F.max(F.abs("drawdown_pct"))).first()[0] == 0.0
    b = S.normalized_base100(c)
    firsts = b.join(c.groupBy("symbol").agg(F.min("timestamp").alias("timestamp")), ["symbol", "timestamp"])
    assert {r["base100"] for r in firsts.collect()} == {100.0}


def test_packed_order_is_lexicographic(spark):
    from barlake.functions.exprs import packed_order
    pairs = [(0, -2**63), (0, -1), (0, 0), (0, 2**63 - 1), (1, -2**63), (1, 5), (-1, 2**63 - 1),
             (1_700_000_000_000_000, 3), (1_700_000_000_000_000, 4), (-5_000_000_000_000_000, 0)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [(r["a"], r["b"]) for r in df.orderBy(packed_order("a", "b")).collect()]
    assert got == sorted(pairs)
    ints = [(7, -2**31), (7, 2**31 - 1), (6, 0), (8, -1)]
    df2 = spark.createDataFrame(ints, "a long, b int")
    assert [(r["a"], r["b"]) for r in df2.orderBy(packed_order("a", "b", 32)).collect()] == sorted(ints)


def test_checked_broadcast_respects_bound(spark):
    from barlake.plans.joins import checked_broadcast
    small = spark.range(5).withColumnRenamed("id", "k")

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    assert hinted(checked_broadcast(small, max_rows=10))
    assert not hinted(checked_broadcast(small, max_rows=3))
