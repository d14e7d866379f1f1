"""Trailing request rates on a stream."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from optiontide.operators.capacity import trailing_request_rate
from optiontide.sources import sinks as SK
from optiontide.streaming.job import epoch_sink, run_stream
from optiontide.streaming.rates import settled, trailing_rate_stream


def test_instants_settle_once_and_in_order():
    rng = random.Random(2)
    times = sorted(rng.choices(range(0, 400_000_000, 500_000), k=300))
    want = {t: sum(t - 60_000_000 <= x <= t for x in times) for t in times}
    at, n, got, until = np.zeros(0, np.int64), np.zeros(0, np.int64), {}, 0
    for begin in range(0, 400_000_000, 30_000_000):
        new, count = np.unique([t for t in times if begin <= t < begin + 30_000_000], return_counts=True)
        at, n = np.concatenate([at, new.astype(np.int64)]), np.concatenate([n, count.astype(np.int64)])
        until = begin + 20_000_000  # the watermark is behind what has come
        ready, number, rates, at, n = settled(at, n, until, 60)
        assert not set(ready.tolist()) & set(got)
        got.update(zip(ready.tolist(), rates.tolist(), strict=True))
        assert all(t >= until - 60_000_000 for t in at.tolist())
    ready, number, rates, at, n = settled(at, n, 10**12, 60)
    got.update(zip(ready.tolist(), rates.tolist(), strict=True))
    assert got == want and not len(at)


def test_stream_equals_the_batch_form_and_goes_on_from_its_checkpoint(spark, tmp_path):
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["a", "b", None]), start + dt.timedelta(seconds=rng.randint(0, 900), milliseconds=rng.randint(0, 3) * 250)) for _ in range(400)]
    rows.sort(key=lambda r: r[1] + dt.timedelta(seconds=rng.randint(0, 50)))  # out of order by less than the delay
    landed, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    kind = "client string, ts timestamp"

    def land(part):
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(landed)

    def go():
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(landed)
        run_stream(trailing_rate_stream(stream, 60, "60 seconds"), epoch_sink(out), checkpoint, trigger=None).awaitTermination()

    land(rows[:150])
    land(rows[150:250])
    go()
    land([*rows[250:], ("a", None)])
    land([("end", start + dt.timedelta(hours=1))])
    go()
    late = [("a", start + dt.timedelta(seconds=5))]  # far behind the watermark: dropped
    land(late)
    go()
    found = sorted((r.client or "", r.ts, r.rate) for r in SK.read_epochs(spark, out).collect())
    batch = trailing_request_rate(spark.createDataFrame(rows, kind).withColumn("client", F.col("client")), 60)
    assert found == sorted((r.client or "", r.ts, r.rate) for r in batch.collect())


def test_a_hot_client_is_spread_over_buckets_of_time(spark, tmp_path):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [("a", start + dt.timedelta(seconds=rng.choice([0, 595, 600, 1195, 1200]) + rng.randint(0, 60))) for _ in range(300)]  # close to the cuts
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    kind = "client string, ts timestamp"
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(landed)
    spark.createDataFrame([("end", start + dt.timedelta(hours=2))], kind).coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(landed)
    job = run_stream(trailing_rate_stream(stream, 60, "0 seconds", bucket_seconds=600), epoch_sink(out), str(tmp_path / "cp"), trigger=None)
    job.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsUpdated"] for p in job.recentProgress) >= 3
    batch = trailing_request_rate(spark.createDataFrame(rows, kind), 60)
    assert sorted((r.ts, r.rate) for r in SK.read_epochs(spark, out).collect()) == sorted((r.ts, r.rate) for r in batch.collect())
