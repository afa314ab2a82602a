"""Streaming: state across micro-batches, late quarantine, redelivery dedupe."""

import datetime as dt
import json

import numpy as np
from pyspark.sql import functions as F

from barlake.sources.files import new_table_path
from barlake.streaming import jobs as J
from barlake.streaming.indicators import STREAM_COLS, stream_indicators
from barlake.streaming.tails import HISTORY, TailIndicators, stream_indicator_rows

T0 = dt.datetime(2024, 1, 1)


def msgs(spark, idx, closes, symbol="BTCUSDT"):
    rows = []
    for i in idx:
        t = T0 + dt.timedelta(minutes=5 * i)
        rows.append((json.dumps({"symbol": symbol, "start_time": t.strftime("%Y-%m-%dT%H:%M:%S"), "open": closes[i],
                                 "high": closes[i] + 1, "low": closes[i] - 1, "close": closes[i], "volume": 5.0,
                                 "trades": 2}),))
    return spark.createDataFrame(rows, "value string")


def test_stateful_across_micro_batches(spark):
    closes = list(np.round(100 + np.cumsum(np.random.default_rng(3).normal(0, 1, 90)), 2))
    src, sink = new_table_path(spark, "t_src"), new_table_path(spark, "t_sink")
    ck = sink + "_ck"

    def run():
        v = J.validated_stream(J.message_stream(spark, src, max_files=1000))
        good = v.where(F.col("reject_reason").isNull()).drop("reject_reason", "value", "timestamp")
        stream_indicator_rows(good, sink, ck)

    J.write_messages(msgs(spark, range(0, 40), closes), src)
    run()
    J.write_messages(msgs(spark, range(40, 90), closes), src)       # second micro-batch continues the history
    J.write_messages(msgs(spark, [10], closes), src)                # a redelivered old candle arrives later
    run()
    out = spark.read.parquet(sink)
    assert out.where("late").count() == 1
    got = [tuple(r) for r in out.where(~F.col("late")).orderBy("event_ts").select(*STREAM_COLS).collect()]
    bdf = spark.createDataFrame([("BTCUSDT", T0 + dt.timedelta(minutes=5 * i), float(c)) for i, c in enumerate(closes)],
                                "symbol string, timestamp timestamp_ntz, close double")
    exp = [tuple(r) for r in stream_indicators(bdf).orderBy("timestamp").select(*STREAM_COLS).collect()]
    assert got == exp


def test_late_rows_quarantined(spark):
    closes = [100.0 + i for i in range(30)]
    src = new_table_path(spark, "late_src")
    good, late, ck = (new_table_path(spark, n) for n in ("late_good", "late_q", "late_ck"))
    splitter = J.LateSplitter(good, late, 30 * 60)
    for part in (range(12, 30), [0, 8, 11]):          # 18:00..., then rows 60, 20 and 5 minutes behind the max
        J.write_messages(msgs(spark, part, closes), src)
        v = J.validated_stream(J.message_stream(spark, src, max_files=1000))
        J.run_foreach_batch(v.where(F.col("reject_reason").isNull()).drop("value"), splitter, ck, "append")
    q = sorted(r["timestamp"] for r in spark.read.parquet(late).collect())
    # max seen = row 29 (145 min); lateness 30 min -> rows before 115 min are late: 0, 8, 11 (0, 40, 55 min)
    assert q == [T0, T0 + dt.timedelta(minutes=40), T0 + dt.timedelta(minutes=55)]


def test_redelivery_dedupe(spark):
    closes = [50.0 + i for i in range(20)]
    src, sink = new_table_path(spark, "dd_src"), new_table_path(spark, "dd_sink")
    m = msgs(spark, range(20), closes)
    J.write_messages(m, src)
    J.write_messages(m, src)
    v = J.validated_stream(J.message_stream(spark, src, max_files=1000))
    J.run_to_parquet(J.dedupe_stream(v.where(F.col("reject_reason").isNull())).select("symbol", "timestamp", "close"), sink)
    assert spark.read.parquet(sink).count() == 20


def test_append_requires_existing_table(spark):
    import pytest
    src = new_table_path(spark, "cn_src")
    J.write_messages(msgs(spark, range(3), [1.0, 2.0, 3.0]), src)
    v = J.validated_stream(J.message_stream(spark, src, max_files=1000))
    missing = new_table_path(spark, "cn_missing")
    with pytest.raises(FileNotFoundError):
        J.append_to_existing_table(v, missing, missing + "_ck")


def test_stream_append_keeps_batch_rows_and_is_idempotent(spark):
    from barlake.operators import parse as PZ
    from barlake.operators.indicators import with_lineage
    closes = [100.0 + i for i in range(40)]
    table_path = new_table_path(spark, "idem_fact")
    src = new_table_path(spark, "idem_src")
    J.write_messages(msgs(spark, range(40), closes), src)
    # batch load of the first 20 candles (historical rows)
    v_batch = PZ.validate_messages(spark.read.text(src)).where("reject_reason IS NULL")
    first = v_batch.where(F.col("timestamp") < T0 + dt.timedelta(minutes=5 * 20))
    from barlake.streaming.indicators import STREAM_COLS
    hist = with_lineage(first.select("timestamp", "symbol", "open", "high", "low", "close", "volume", "trades",
                                     *[F.lit(None).cast("double").alias(c) for c in STREAM_COLS])
                        .withColumn("date", F.to_date("timestamp")).withColumn("hour", F.hour("timestamp"))
                        .withColumn("day_of_week", F.date_format("timestamp", "EEEE")), "historical")
    hist.write.partitionBy("date").parquet(table_path)

    def replay(ck):
        v = J.validated_stream(J.message_stream(spark, src, max_files=1000))
        good = v.where("reject_reason IS NULL").drop("reject_reason", "value", "timestamp")
        tails = TailIndicators(ck + "_tails")
        J.append_to_existing_table(good, table_path, ck, prepare=lambda batch, i: J.stream_unified_rows(tails(batch, i)))

    replay(table_path + "_ck1")
    counts = {r["source"]: r["count"] for r in spark.read.parquet(table_path).groupBy("source").count().collect()}
    assert counts == {"historical": 20, "streaming": 20}
    replay(table_path + "_ck2")                       # full replay from a fresh checkpoint appends nothing
    assert spark.read.parquet(table_path).count() == 40


def test_rows_do_not_depend_on_files_per_batch(spark, monkeypatch):
    from barlake.catalog import QUERIES, stream_queries
    from conftest import SF001
    keys = ["tumbling_5min_by_symbol", "indicators_stream_group", "indicators_stream_stateful", "stream_append_unified",
            "event_time_watermark", "late_data_handling", "stream_dedupe", "stream_health_metrics"]
    for k in keys:
        runs = []
        for n in (1, 10_000):
            monkeypatch.setattr(stream_queries, "FILES_PER_BATCH", n)
            runs.append(sorted(map(str, QUERIES[k](spark, SF001).collect())))
        assert runs[0] == runs[1] and runs[0], k


def test_a_batch_that_runs_again_replaces_its_output(spark):
    closes = [100.0 + i for i in range(30)]
    good, late = new_table_path(spark, "again_good"), new_table_path(spark, "again_late")
    splitter = J.LateSplitter(good, late, 30 * 60)

    def batch(idx):
        v = J.PZ.validate_messages(msgs(spark, idx, closes))
        return v.withColumn("event_ts", F.col("timestamp").cast("timestamp")).drop("value")

    for _ in range(2):
        splitter(batch(range(12, 30)), 0)
    for _ in range(2):
        splitter(batch([0, 8, 28]), 1)
    assert spark.read.parquet(good).count() == 19 and spark.read.parquet(late).count() == 2


def candles(spark, series):
    rows = [(s, T0 + dt.timedelta(minutes=5 * int(i)), float(c)) for s, i, c in series]
    return spark.createDataFrame(rows, "symbol string, event_ts timestamp, close double")


def test_tails_equal_the_batch_form_however_a_series_is_cut(spark, monkeypatch):
    """Many batches of any size, a symbol over many chunks, batches that run again, symbols that rest: the rows of one pass."""
    from barlake.plans import chunked
    from barlake.streaming import tails as T
    monkeypatch.setattr(T, "chunked_window", lambda *a, **k: chunked.chunked_window(*a, chunk_rows=64, bucket_unit="hour", **k))
    rng = np.random.default_rng(11)
    hot = [("HOT", i, c) for i, c in enumerate(np.round(100 + np.cumsum(rng.normal(0, 1, 400)), 2))]
    slow = [("SLOW", 40 * i, c) for i, c in enumerate(np.round(50 + np.cumsum(rng.normal(0, 1, 10)), 2))]
    tails, got = TailIndicators(new_table_path(spark, "tails")), []
    for b, (lo, hi) in enumerate([(0, 3), (3, 200), (200, 201), (201, 330), (330, 400)]):
        batch = candles(spark, [x for x in hot + slow if lo <= x[1] < hi])
        if b % 2:
            tails(batch, b).collect()                     # a run that was lost after its tails were written
        got += [tuple(r) for r in tails(batch, b).where("NOT late").select("symbol", "event_ts", *STREAM_COLS).collect()]
    whole = candles(spark, hot + slow).withColumn("timestamp", F.col("event_ts").cast("timestamp_ntz"))
    want = [tuple(r) for r in stream_indicators(whole).select("symbol", "event_ts", *STREAM_COLS).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = {r["symbol"]: r["count"] for r in spark.read.parquet(f"{tails.path}/batch_id=4").groupBy("symbol").count().collect()}
    assert kept == {"HOT": HISTORY, "SLOW": 10} and not J.table_exists(spark, f"{tails.path}/batch_id=2")


def test_tails_flag_late_and_second_candles_and_forget_old_symbols(spark):
    tails = TailIndicators(new_table_path(spark, "tails_late"), retention="1 day")
    out = tails(candles(spark, [("A", 1, 5), ("A", 1, 5), ("A", 2, 6), ("B", 0, 1)]), 0).collect()
    assert sorted((r.symbol, r.late) for r in out) == [("A", False), ("A", False), ("A", True), ("B", False)]
    out = tails(candles(spark, [("A", 2, 7), ("A", 0, 7), ("A", 2000, 8)]), 1).collect()
    assert sorted(r.late for r in out) == [False, True, True]
    assert {r.symbol for r in spark.read.parquet(f"{tails.path}/batch_id=1").select("symbol").collect()} == {"A"}
    assert tails(candles(spark, []), 2).collect() == []


def test_backlog_files_are_bounded_and_in_order(spark, monkeypatch):
    """A third of the messages share one time; files are written at once, hold a bounded number, and follow each other in time."""
    monkeypatch.setattr(J, "BACKLOG_FILE_ROWS", 100)
    n = 900
    rows = [(json.dumps({"symbol": "S", "start_time": (T0 + dt.timedelta(minutes=5 * (450 if i % 3 == 0 else i))).isoformat(), "close": i}),) for i in range(n)]
    src = new_table_path(spark, "ordered")
    J.write_messages_in_order(spark.createDataFrame(rows, "value string"), src)
    files = sorted(J._files(spark, src), key=lambda f: f[1])
    assert len({m for _, m in files}) == len(files) >= 9
    last, total = "", 0
    for f, _ in files:
        t = [json.loads(r.value)["start_time"] for r in spark.read.text(f).collect()]
        assert len(t) <= 250 and min(t) >= last
        last, total = max(t), total + len(t)
    assert total == n
    J.write_messages_in_order(spark.createDataFrame(rows[:3], "value string"), src)
    new = [m for f, m in J._files(spark, src) if f not in {x for x, _ in files}]
    assert min(new) > files[-1][1]


def test_newest_time_is_read_from_one_row_of_a_log(spark, monkeypatch):
    """A batch reads the log of the batch before, not the sink; gaps in batch ids and batches without rows are no matter."""
    good, late = new_table_path(spark, "log_good"), new_table_path(spark, "log_late")
    splitter = J.LateSplitter(good, late, 30 * 60)

    def batch(idx):
        v = J.PZ.validate_messages(msgs(spark, idx, [100.0 + i for i in range(60)]))
        return v.withColumn("event_ts", F.col("timestamp").cast("timestamp")).drop("value")

    splitter(batch(range(12, 30)), 0)
    splitter(batch([]), 1)
    splitter(batch([40]), 3)
    splitter(batch([0, 38]), 4)
    assert spark.read.parquet(late).count() == 1 and spark.read.parquet(good).count() == 20
    newest = int((T0 + dt.timedelta(minutes=200) - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)
    assert [spark.read.parquet(f"{splitter.log_path}/batch_id={i}").collect()[0].us for i in (3, 4)] == [newest, newest]


def test_running_counters_equal_the_batch_form(spark):
    from barlake.streaming.counters import run_counted, totals
    src, sink = new_table_path(spark, "cnt_src"), new_table_path(spark, "cnt_sink")
    bad = spark.createDataFrame([("no json",), ("{}",)], "value string")
    J.write_messages(msgs(spark, range(30), [1.0 + i for i in range(30)]).repartition(4).unionByName(bad), src)
    v = J.validated_stream(J.message_stream(spark, src))
    out = run_counted(v, lambda b, i: J.write_batch(b.where("reject_reason IS NULL").drop("reject_reason"), i, sink), sink + "_ck", sink + "_c", "cnt").first()
    assert tuple(out) == (32, 1, 30, 2) and spark.read.parquet(sink).count() == 30
    assert len({r.batch_id for r in spark.read.parquet(sink + "_c").collect()}) > 1
    run_counted(v, lambda b, i: None, sink + "_ck", sink + "_c", "cnt")              # nothing new: the totals stay
    assert tuple(totals(spark, sink + "_c").first()) == (32, 1, 30, 2)


def test_a_reload_that_breaks_off_leaves_the_old_table(spark, monkeypatch):
    import pytest
    from barlake.sources import files as FS
    path = new_table_path(spark, "dim")
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,), (3,)], "a int")
    read = lambda: sorted(r.a for r in spark.read.parquet(path).collect())
    FS.overwrite_table(one, path)
    with pytest.raises(Exception):
        FS.overwrite_table(two.select(F.raise_error(F.lit("lost")).cast("int").alias("a")), path)
    assert read() == [1]
    rename, calls = FS._rename, []

    def second_fails(fs, a, b):
        calls.append(a)
        if len(calls) == 2:
            raise OSError("lost between the renames")
        rename(fs, a, b)
    monkeypatch.setattr(FS, "_rename", second_fails)
    with pytest.raises(OSError):
        FS.overwrite_table(two, path)
    monkeypatch.setattr(FS, "_rename", rename)
    FS.recover_table(spark, path)
    assert read() == [1]
    FS.overwrite_table(two, path)
    FS.overwrite_table(two, path)
    assert read() == [2, 3] and not FS._fs(spark, path).exists(FS._path(spark, path + ".old"))


def _groups(spark, parts, **more):
    """Rows of ``WindowIndicators`` over batches of (minute, close) of one symbol, the last version of each."""
    from barlake.streaming.window_groups import WindowIndicators
    groups, sink = WindowIndicators(new_table_path(spark, "wg"), "1 hour", 1800, **more), new_table_path(spark, "wg_sink")
    for i, part in enumerate(parts):
        rows = [("BTCUSDT", T0 + dt.timedelta(seconds=s), float(c)) for s, c in part]
        batch = spark.createDataFrame(rows, "symbol string, event_ts timestamp, close double")
        for _ in range(2 if i == 1 else 1):                                  # the second batch runs again
            J.write_batch(groups(batch, i), i, sink)
    out = J.latest_per_key(spark.read.parquet(sink), ["symbol", "window_start", "timestamp"])
    return groups, sorted(tuple(r) for r in out.select("window_start", "timestamp", "close", *STREAM_COLS).collect())


def _grouped(spark, ticks):
    from barlake.streaming.indicators import indicators_per_group
    df = spark.createDataFrame([("BTCUSDT", T0 + dt.timedelta(seconds=s // 3600 * 3600), T0 + dt.timedelta(seconds=s), float(c)) for s, c in ticks.items()],
                               "symbol string, window_start timestamp_ntz, timestamp timestamp_ntz, close double")
    out = indicators_per_group(df, ["symbol", "window_start"])
    return sorted(tuple(r) for r in out.select("window_start", "timestamp", "close", *STREAM_COLS).collect())


def test_window_groups_equal_the_list_form_in_any_arrival_order(spark):
    g = np.random.default_rng(8)
    at = list(range(0, 7200, 20))
    close = dict(zip(at, np.round(100 + np.cumsum(g.normal(0, 1, len(at))), 2).tolist()))
    late = [s for s in at if s % 7 == 0 and s < 5000]                        # these come in a batch of their own, among older ones
    parts = [[(s, close[s]) for s in at if s < 4000 and s not in late], [(s, close[s]) for s in at if s in late],
             [(40, 1.0)], [(s, close[s]) for s in at if s >= 4000 and s not in late] + [(60, 500.0), (60, 400.0)]]
    expected = _grouped(spark, {**close, 40: 1.0, 60: 500.0})                # delivered again: the latest, then the largest
    _, whole = _groups(spark, parts, chunk_rows=60, bucket_unit="minute")    # windows of 180 candles in three sub-windows
    _, plain = _groups(spark, parts)
    assert plain == expected and whole == expected


def test_window_groups_close_after_the_lateness(spark):
    parts = [[(0, 1.0), (60, 2.0)], [(3600 + 1799, 3.0)], [(120, 4.0)], [(3600 + 1800, 5.0)], [(180, 6.0)], []]
    groups, got = _groups(spark, parts)
    assert got == _grouped(spark, {0: 1.0, 60: 2.0, 120: 4.0, 3600 + 1799: 3.0, 3600 + 1800: 5.0})
    assert sorted(r[0] for r in spark.read.parquet(groups.path).select("closes").distinct().collect()) == [int((T0 + dt.timedelta(hours=2)).replace(tzinfo=dt.timezone.utc).timestamp())]


def test_window_groups_keep_no_list(spark):
    from barlake.streaming.window_groups import WindowIndicators
    batch = spark.createDataFrame([("a", T0, 1.0)], "symbol string, event_ts timestamp, close double")
    plan = WindowIndicators(new_table_path(spark, "wg_plan"))(batch, 0)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
