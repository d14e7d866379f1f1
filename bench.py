"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from optiontide.plans.catalogue import QUERIES  # noqa: E402
from optiontide.session import local_session  # noqa: E402

HEADLINE = (
    "fn15_volatility_by_month",
    "fn15_enrich_contracts",
    "fn14_implied_vol_european",
    "fn14_implied_vol_american",
    "fn13_crr_price",
    "fn12_bs_price",
    "prj1_flatten_chain",
    "src2_decode_chain_payload",
    "join1_attach_schedule",
    "join3_attach_dividend_yield",
    "join5_pick_curve",
    "join6_interp_linear",
    "flt4_filter_chain_strike_count",
    "snk3_upsert",
    "agg7_return_covariance",
    "agg9_portfolio_metrics",
    "win1_daily_returns",
    "win3_rolling",
    "win7_ohlcv_minute30",
    "win11_trailing_request_rate",
    "str7_decode_feed_equities",
    "str8_decode_book",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cpus, cpus)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["win4_last_rows"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the engine
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
