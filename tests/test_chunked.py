"""chunked plans == plain per-symbol windows (the skew-safe plan is exact)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barlake.operators import indicators as ind
from barlake.plans.chunked import chunked_running, chunked_window, global_row_index
from barlake.sources.adapters import event_candles
from conftest import SF01


def _rows(df, cols):
    return sorted(tuple(None if v is None else (round(v, 9) if isinstance(v, float) else v)
                        for v in r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("chunk_rows,unit,min_rows", [(50, "day", 8), (49, "hour", 0), (49, "hour", 8),
                                                      (120, "day", 8), (1000, "month", 8)])
def test_indicators_chunked_equal_plain(spark, chunk_rows, unit, min_rows):
    from barlake.plans.chunked import plan_chunks
    c = ind.clean_batch(event_candles(spark, SF01))
    cols = ["symbol", "timestamp", *ind.INDICATOR_COLS]
    plain = ind.add_indicators(c, chunked=False)
    lay = plan_chunks(c, ["symbol"], "timestamp", chunk_rows, unit, min_bucket_rows=min_rows)
    if unit == "hour":
        assert (lay.units is None) == (min_rows == 0)                          # sparse hour buckets coarsen
    chunked = ind.add_indicators(c, chunk_rows=chunk_rows, bucket_unit=unit, layout=lay)
    assert chunked.count() == c.count()
    assert _rows(chunked, cols) == _rows(plain, cols)


@pytest.mark.parametrize("chunk_rows", [60, 250_000])
def test_global_row_index(spark, chunk_rows):
    c = event_candles(spark, SF01)
    got = global_row_index(c, ["symbol"], "timestamp", with_count="n", chunk_rows=chunk_rows)
    w = Window.partitionBy("symbol").orderBy("timestamp")
    exp = c.withColumn("row_idx", F.row_number().over(w) - 1).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("symbol")))
    cols = ["symbol", "timestamp", "row_idx", "n"]
    assert _rows(got, cols) == _rows(exp, cols)


@pytest.mark.parametrize("how", ["max", "min", "sum", "first"])
@pytest.mark.parametrize("chunk_rows", [60, 250_000])
def test_chunked_running(spark, how, chunk_rows):
    c = event_candles(spark, SF01)
    got = chunked_running(c, ["symbol"], "timestamp", "close", how, "v", chunk_rows=chunk_rows, bucket_unit="day")
    w = Window.partitionBy("symbol").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    f = {"max": F.max, "min": F.min, "sum": F.sum, "first": F.first}[how]
    exp = c.withColumn("v", f("close").over(w) if how != "first" else F.first("close").over(
        Window.partitionBy("symbol").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    cols = ["symbol", "timestamp", "v"]
    a, b = _rows(got, cols), _rows(exp, cols)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:2] == y[:2] and abs(x[2] - y[2]) < 1e-6


@pytest.mark.parametrize("chunk_rows,unit", [(50, "day"), (49, "hour")])
def test_stream_indicators_chunked_with_index(spark, chunk_rows, unit):
    from barlake.streaming.indicators import STREAM_COLS, stream_indicators
    c = ind.clean_batch(event_candles(spark, SF01))
    cols = ["symbol", "timestamp", *STREAM_COLS]
    assert _rows(stream_indicators(c, chunk_rows=chunk_rows, bucket_unit=unit), cols) == _rows(stream_indicators(c), cols)


def _series(spark):
    """A dense symbol, many one-row symbols, NULL symbols and NULL times."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [("dense", t0 + dt.timedelta(seconds=20 * i), float(i % 37), None if i % 11 == 0 else float(i % 5)) for i in range(3000)]
    rows += [(f"s{i}", t0 + dt.timedelta(days=i), 1.0 * i, 1.0) for i in range(400)]
    rows += [(None, t0 + dt.timedelta(minutes=7 * i), float(i % 13), 2.0) for i in range(700)]
    rows += [("dense", None, 5.0, None), (None, None, 7.0, 1.0)]
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double, v double").repartition(4)


def test_null_keys_and_times_and_a_dense_key_among_sparse_ones(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from barlake.plans.chunked import plan_chunks
    df = _series(spark)

    def step(d, part):
        w = Window.partitionBy(*part).orderBy("timestamp").rowsBetween(-5, 0)
        return d.withColumn("m", F.avg("close").over(w)).withColumn("l", F.lag("close").over(Window.partitionBy(*part).orderBy("timestamp")))

    lay = plan_chunks(df, ["symbol"], "timestamp", chunk_rows=100)
    assert not lay.single_chunk
    biggest = lay.summary.agg(F.max("__n")).first()[0]
    per_chunk = lay.summary.groupBy("symbol", "__chunk").agg(F.sum("__n").alias("n")).agg(F.max("n")).first()[0]
    assert biggest <= 100 and per_chunk <= 200                                  # a 3000-row day is split, others are not
    plain = sorted(map(str, step(df, ["symbol"]).collect()))
    assert sorted(map(str, chunked_window(df, ["symbol"], "timestamp", 5, step, layout=lay).collect())) == plain
    idx = {(r.symbol, r.timestamp): (r.row_idx, r.n) for r in global_row_index(df, ["symbol"], "timestamp", with_count="n", layout=lay).collect()}
    one = {(r.symbol, r.timestamp): (r.row_idx, r.n) for r in global_row_index(df, ["symbol"], "timestamp", with_count="n").collect()}
    assert idx == one and len(one) == df.count()


@pytest.mark.parametrize("how", ["sum", "max", "min", "first"])
def test_running_values_with_nulls_equal_plain(spark, how):
    df = _series(spark)
    key = lambda r: (str(r.symbol), str(r.timestamp), r.close)
    got, want = ({key(r): r.x for r in chunked_running(df, ["symbol"], "timestamp", "v", how, "x", chunk_rows=n).collect()} for n in (90, 10 ** 6))
    assert got == want
