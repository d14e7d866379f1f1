"""Seconds of catalogue queries, run twice: python tools/timing.py [--sf 0.1] [--explain] name ..."""

from __future__ import annotations

import argparse
import re
import sys
import time

sys.path.insert(0, ".")

from optiontide.plans.catalogue import QUERIES  # noqa: E402
from optiontide.session import local_session  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="+")
    parser.add_argument("--sf", default="0.1")
    parser.add_argument("--explain", action="store_true")
    args = parser.parse_args()
    spark = local_session("timing", 8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    for name in [q for q in QUERIES if any(q.startswith(n) for n in args.names)]:
        times = []
        for _ in range(2):
            start = time.perf_counter()
            df = QUERIES[name](spark, f"/root/testdata/sf{args.sf}")
            df.write.format("noop").mode("overwrite").save()
            times.append(round(time.perf_counter() - start, 2))
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")))
        print(name, times, "method sizes", sizes, flush=True)
        if args.explain:
            df.explain("formatted")


if __name__ == "__main__":
    main()
