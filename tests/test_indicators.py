"""Indicator fixtures: warm-up positions, degenerate series, three stream forms agree."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.operators import indicators as ind
from barlake.streaming.indicators import STREAM_COLS, indicators_per_group, stream_indicators

T0 = dt.datetime(2024, 1, 1)


def _r2(x: float | None) -> float | None:
    if x is None or not np.isfinite(x):
        return None
    y = float(Decimal(repr(float(x))).quantize(Decimal("1e-10"), ROUND_HALF_UP))
    return float(Decimal(repr(y)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def indicators_at(c: np.ndarray, k: int, i: int) -> dict:
    """Stream indicators of the candle at array position k, series position i."""
    def mean(p, at=k):
        return float(np.sum(c[at - p + 1:at + 1])) / p

    out = dict.fromkeys(STREAM_COLS)
    if i >= 14:
        ch = np.diff(c[k - 14:k + 1])
        ag, al = np.where(ch > 0, ch, 0.0).sum() / 14, np.where(ch > 0, 0.0, np.abs(ch)).sum() / 14
        out["rsi_14"] = 100.0 if al == 0 else _r2(100 - 100 / (1 + ag / al))
    if i >= 19:
        mid = mean(20)
        sd = float(np.sqrt(np.sum((c[k - 19:k + 1] - mid) ** 2) / 20))
        out.update(sma_20=_r2(mid), bb_middle=_r2(mid), bb_upper=_r2(mid + 2 * sd), bb_lower=_r2(mid - 2 * sd))
    if i >= 49:
        out["ema_50"] = _r2(mean(50))

    def macd_at(kk, ii):
        if ii < 25:
            return None
        e12, e26 = _r2(mean(12, kk)), _r2(mean(26, kk))
        return e12 - e26 if e12 and e26 else None

    out["macd"] = macd_at(k, i)
    if i >= 35:
        ms = [macd_at(k - d, i - d) for d in range(8, -1, -1)]
        if all(m is not None for m in ms):
            out["macd_signal"] = _r2(sum(ms) / 9)
    return out


def series(spark, closes, symbol="BTCUSDT"):
    rows = [(symbol, T0 + dt.timedelta(minutes=5 * i), float(c), float(c) + 1, float(c) - 1, float(c), 10.0, 3)
            for i, c in enumerate(closes)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, open double, high double, low double, "
                                     "close double, volume double, trades bigint")
    return df


def by_time(df, cols):
    return [tuple(r) for r in df.orderBy("timestamp").select(*cols).collect()]


@pytest.mark.parametrize("n", [1, 14, 15, 19, 20, 35, 36, 50])
def test_stream_warmup_positions(spark, n):
    closes = [100 + np.sin(i) * 5 + i * 0.1 for i in range(n)]
    out = by_time(stream_indicators(series(spark, closes)), ["rsi_14", "sma_20", "macd_signal", "ema_50"])
    for i, (rsi, sma, sig, ema) in enumerate(out):
        assert (rsi is not None) == (i >= 14)
        assert (sma is not None) == (i >= 19)
        assert (sig is not None) == (i >= 35)
        assert (ema is not None) == (i >= 49)


def test_degenerate_series(spark):
    ramp = by_time(stream_indicators(series(spark, range(1, 61))), ["rsi_14", "bb_upper", "bb_lower"])
    assert all(r[0] == 100.0 for r in ramp[14:])
    const = by_time(stream_indicators(series(spark, [5.0] * 60)), ["rsi_14", "bb_upper", "bb_middle", "bb_lower"])
    assert all(r[0] == 100.0 and r[1] == r[2] == r[3] == 5.0 for r in const[19:])
    alt = by_time(stream_indicators(series(spark, [10.0, 11.0] * 30)), ["rsi_14"])
    assert all(abs(r[0] - 50.0) < 4 for r in alt[14:])


def test_batch_partial_frames_and_bands(spark):
    closes = [100 + (i % 7) for i in range(30)]
    out = by_time(ind.add_indicators(series(spark, closes), chunked=False),
                  ["rsi_14", "sma_20", "bb_upper", "bb_middle", "bb_lower"])
    assert out[0][0] == 100.0 and out[0][1] == 100.0 and out[0][2] is None  # first row: partial frames, no sigma
    for rsi, sma, up, mid, lo in out[1:]:
        assert 0 <= rsi <= 100 and mid == sma and abs((up - mid) - (mid - lo)) < 1e-9 and lo <= mid <= up


def test_three_stream_forms_agree(spark):
    rng = np.random.default_rng(7)
    closes = np.round(100 + np.cumsum(rng.normal(0, 1, 120)), 2)
    df = series(spark, closes)
    win = by_time(stream_indicators(df), ["timestamp", *STREAM_COLS])
    grp = indicators_per_group(df.select("symbol", "timestamp", "close").withColumn("g", F.lit(1)), ["symbol", "g"])
    hof = by_time(grp, ["timestamp", *STREAM_COLS])
    assert win == hof
    for i, row in enumerate(win):
        ref = indicators_at(closes, i, i)
        assert tuple(ref[c] for c in STREAM_COLS) == tuple(row[1:])
