"""Edge fixtures for message validation (malformed, casts, times, envelopes)."""

import json

import pytest

from barlake.operators import parse as PZ

BASE = {"symbol": "BTCUSDT", "start_time": "2024-01-01T10:00:00", "open": 1.5, "high": 2.0, "low": 1.0,
        "close": 1.8, "volume": 10.0, "trades": 3}


def msg(**kw):
    d = dict(BASE)
    for k, v in kw.items():
        if v is ...:
            d.pop(k, None)
        else:
            d[k] = v
    return json.dumps(d)


CASES = [
    ("ok", msg(), None),
    ("malformed", "{not json", "parse"),
    ("empty", "", "parse"),
    ("scalar", "42", "parse"),
    ("array", "[1, 2]", "parse"),
    ("string numbers", msg(open="1.5", volume="10"), None),
    ("trades absent", msg(trades=...), None),
    ("trades null", msg(trades=None), "cast"),
    ("open zero", msg(open=0), "missing"),
    ("close missing", msg(close=...), "missing"),
    ("volume zero", msg(volume=0), "missing"),
    ("volume negative", msg(volume=-1), "missing"),
    ("volume text", msg(volume="abc"), "cast"),
    ("high missing", msg(high=...), "cast"),
    ("high text", msg(high="x"), "cast"),
    ("iso Z", msg(start_time="2024-01-01T10:00:00Z"), None),
    ("iso offset", msg(start_time="2024-01-01T10:00:00+02:00"), None),
    ("plain", msg(start_time="2024-01-01 10:00:00"), None),
    ("garbage time", msg(start_time="yesterday"), "timestamp"),
    ("date only", msg(start_time="2024-01-01"), "timestamp"),
    ("event_time fallback", msg(start_time=..., event_time="2024-01-01T11:00:00"), None),
    ("start_time null", msg(start_time=None, event_time="2024-01-01T11:00:00"), "timestamp"),
]


@pytest.fixture(scope="module")
def validated(spark):
    df = spark.createDataFrame([(name, v) for name, v, _ in CASES], "name string, value string")
    return {r["name"]: r for r in PZ.validate_messages(df).collect()}


@pytest.mark.parametrize("name,payload,reason", CASES, ids=[c[0] for c in CASES])
def test_reject_reason(validated, name, payload, reason):
    assert validated[name]["reject_reason"] == reason


def test_values(validated):
    import datetime as dt
    assert validated["trades absent"]["trades"] == 0
    assert validated["string numbers"]["open"] == 1.5
    assert validated["iso offset"]["timestamp"] == dt.datetime(2024, 1, 1, 8, 0)
    assert validated["iso Z"]["timestamp"] == dt.datetime(2024, 1, 1, 10, 0)
    assert validated["event_time fallback"]["timestamp"] == dt.datetime(2024, 1, 1, 11, 0)


def test_quarantine_preview(spark):
    df = spark.createDataFrame([("x" * 500,)], "value string")
    good, bad = PZ.split_rejects(PZ.validate_messages(df))
    assert good.count() == 0
    row = bad.collect()[0]
    assert row["reject_reason"] == "parse" and len(row["preview"]) == 200 and len(row["payload"]) == 500


def test_envelope_filters(spark):
    k = {"s": "BTCUSDT", "i": "5m", "t": 1704103200000, "T": 1704103499999, "o": "1.0", "h": "2.0", "l": "0.5",
         "c": "1.5", "v": "10", "q": "15", "n": 7, "V": "5", "Q": "7.5", "x": True}
    rows = [(json.dumps({"E": 1704103499999, "k": k}),), (json.dumps({"E": 1, "k": dict(k, x=False)}),),
            (json.dumps({"E": 2}),)]
    df = spark.createDataFrame(rows, "value string")
    out = PZ.flatten_kline_envelope(df).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["start_time"], r["close_time"], r["open"], r["trades"]) == ("2024-01-01T10:00:00", "2024-01-01T10:04:59.999000", 1.0, 7)
    assert PZ.flatten_kline_envelope(df, closed_only=False).count() == 2
