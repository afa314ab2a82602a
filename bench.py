"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is fully executed into the ``noop`` sink (no driver collect).
Inputs: ``lineitem`` as daily bars of 1000 supplier "symbols" (many keys),
``events`` as hourly bars of 5 hot symbols (few keys) and as raw ticks (five
long series, forced through the chunked halo path).  Two streaming replays
(5-minute windows over tick messages, stateful indicators over candle
messages) run with ``trigger(availableNow=True)``; staging their message
files counts as ingest.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from barlake.functions.exprs import CORE_SYMBOLS  # noqa: E402
from barlake.operators import features as FT  # noqa: E402
from barlake.operators import indicators as ind  # noqa: E402
from barlake.operators import parse as PZ  # noqa: E402
from barlake.operators import profiles as P  # noqa: E402
from barlake.operators import series as S  # noqa: E402
from barlake.plans.chunked import plan_chunks  # noqa: E402
from barlake.session import build_session, table  # noqa: E402
from barlake.sources.adapters import EVENT_SYMBOLS, candles_from_events, candles_from_lineitem  # noqa: E402
from barlake.sources.files import new_table_path  # noqa: E402
from barlake.sources.messages import stream_messages, tick_messages  # noqa: E402
from barlake.streaming import jobs as J  # noqa: E402
from barlake.streaming import tails as T  # noqa: E402
from barlake.streaming.indicators import stream_indicators  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="barlake-bench")

    # Stage 1 (timed): raw rows -> stored candle tables, as the ingest job writes them.
    t0 = time.perf_counter()
    sup_path, ev_path = new_table_path(spark, "bench_sup_candles"), new_table_path(spark, "bench_ev_candles")
    candles_from_lineitem(table(spark, sf_dir, "lineitem")).write.parquet(sup_path)   # ~533k daily bars
    candles_from_events(table(spark, sf_dir, "events")).write.parquet(ev_path)        # hourly, 5 symbols
    ingest = round(time.perf_counter() - t0, 3)
    sup, evc = spark.read.parquet(sup_path), spark.read.parquet(ev_path)
    # hot keys: every event is a tick of its event-type symbol (5 long series), small
    # chunks force the halo path so the skew-safe plan is exercised at bench scale
    ev = table(spark, sf_dir, "events")
    ticks = ev.select(F.create_map(*[F.lit(x) for kv in EVENT_SYMBOLS.items() for x in kv])[F.col("event_type")].alias("symbol"),
                      F.col("ts").alias("timestamp"), *[F.col("value").alias(c) for c in ("open", "high", "low", "close")],
                      F.lit(1.0).alias("volume"), F.lit(1).cast("bigint").alias("trades"))
    monthly = {"bucket_unit": "month"}                                   # daily bars: month buckets

    def sup_unified():
        return ind.indicators_batch(sup, **monthly)

    layouts = {}

    def sup_layout():
        """One chunk layout (month buckets) per stored table, shared by the series operators."""
        if "sup" not in layouts:
            layouts["sup"] = plan_chunks(sup, ["symbol"], "timestamp", bucket_unit="month")
        return layouts["sup"]

    def ev_core():
        return ind.indicators_batch(evc).where(F.col("symbol").isin(CORE_SYMBOLS))

    qs = {
        "indicators_batch_lineitem": sup_unified,
        "indicators_batch_events": lambda: ind.indicators_batch(evc),
        "indicators_hot_symbols_chunked": lambda: ind.indicators_batch(ticks, chunk_rows=5_000, bucket_unit="hour"),
        "stream_mode_indicators_lineitem": lambda: stream_indicators(ind.clean_batch(sup), **monthly),
        "symbol_stats_lineitem": lambda: P.symbol_stats(sup_unified()),
        "return_stats_lineitem": lambda: P.return_stats(sup),
        "drawdown_lineitem": lambda: S.drawdown(sup, layout=sup_layout()),
        "rolling_pv_corr_lineitem": lambda: S.rolling_price_volume_corr(sup, layout=sup_layout()),
        "volatility_regime_lineitem": lambda: S.volatility_regime(sup, layout=sup_layout()),
        "hourly_profile_events": lambda: P.hourly_profile(ev_core()),
        "feature_corr_matrix_events": lambda: P.feature_corr_matrix(ev_core()),
        "describe_numeric_events": lambda: P.describe_numeric(ev_core()),
        "parse_validate_ticks": lambda: PZ.validate_messages(tick_messages(table(spark, sf_dir, "events"))),
        "feature_frame_events": lambda: FT.next_close_target(FT.feature_frame(ev_core())),
    }
    # streaming path: stage message backlogs (ingest), then time the replays
    t0 = time.perf_counter()
    tick_src, candle_src = new_table_path(spark, "bench_ticks"), new_table_path(spark, "bench_candle_msgs")
    J.write_messages_in_order(tick_messages(table(spark, sf_dir, "events")), tick_src)
    J.write_messages_in_order(stream_messages(evc), candle_src)
    stage = time.perf_counter() - t0

    def stream_tumbling():
        v = J.validated_stream(J.message_stream(spark, tick_src))
        agg = (v.where(F.col("reject_reason").isNull()).withWatermark("event_ts", J.DEFAULT_LATENESS)
               .groupBy("symbol", F.window("event_ts", "5 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n")))
        sink = new_table_path(spark, "bench_tumbling")
        J.update_mode_to_parquet(agg.select("symbol", F.col("w.start").alias("window_start"), "n"), sink, sink + "_ck")
        return spark.read.parquet(sink)

    def stream_stateful():
        v = J.validated_stream(J.message_stream(spark, candle_src))
        good = v.where(F.col("reject_reason").isNull()).drop("reject_reason", "value", "timestamp")
        sink = new_table_path(spark, "bench_stateful")
        return spark.read.parquet(T.stream_indicator_rows(good, sink, sink + "_ck"))

    qs["stream_tumbling_5min_ticks"] = stream_tumbling
    qs["stream_stateful_indicators_events"] = stream_stateful
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    times = {"ingest_candles": round(ingest + stage, 3)}
    for name, build in qs.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
