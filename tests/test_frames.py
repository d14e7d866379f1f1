"""Frames of stored text: made and read by built-in functions, as the gzip module makes and reads them."""

import contextlib
import gzip
import zlib

from pyspark.sql import functions as F

from optiontide.plans import queries_records as QR
from optiontide.plans.catalogue import QUERIES
from optiontide.plans.process import process_messages
from optiontide.session import split_bytes
from optiontide.sources import chains as SC
from optiontide.streaming import job as J


def test_published_frames_need_no_python(spark):
    chains = spark.range(3).select(F.concat(F.lit("P"), "id").alias("symbol"))
    plan = SC.encode_chains(chains, deflate=False)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("StructsToJson") == 1
    assert "Python" in SC.encode_chains(chains)._jdf.queryExecution().executedPlan().toString()


def test_stored_frames_of_any_size(spark):
    texts = ["", "a", "ä€😀", "x" * 65_534, "x" * 65_535, "x" * 65_536, "ä" * 65_535, "".join(chr(33 + i * i % 90) for i in range(200_000)), None]
    frames = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", SC._frame(F.col("text")).alias("value"))
    made = [r.value for r in frames.orderBy("i").collect()]
    assert [None if v is None else gzip.decompress(v).decode() for v in made] == texts
    # a frame of one block is read without Python, a longer one by it
    read = SC.gunzip(frames.withColumn("stored", SC._stored_text(F.col("value"))), "value", "text").orderBy("i").collect()
    assert [r.text for r in read] == texts
    assert [r.stored is not None for r in read] == [t is not None and len(t.encode()) <= 65_535 for t in texts]


def test_damaged_and_foreign_frames_are_read_as_the_gzip_module_reads_them(spark):
    frame = bytes(spark.range(1).select(SC._frame(F.lit('{"symbol":"ä"}')).alias("value")).first().value)
    foreign = zlib.compressobj(0, zlib.DEFLATED, 31)
    packed = [frame, foreign.compress(b"foreign") + foreign.flush(), frame + frame, frame + b"\0", frame + b"rest", gzip.compress(b"deflated"), b"", b"no", None]
    packed += [frame[:i] for i in range(len(frame))]
    packed += [frame[:i] + bytes([frame[i] ^ 0x41]) + frame[i + 1:] for i in range(len(frame))]
    latin = b'{"symbol":"\xe4"}'  # whole, but not UTF-8
    packed.append(frame[:11] + len(latin).to_bytes(2, "little") + (65_535 - len(latin)).to_bytes(2, "little") + latin
                  + zlib.crc32(latin).to_bytes(4, "little") + len(latin).to_bytes(4, "little"))
    assert gzip.decompress(packed[-1]) == latin
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(packed)], "i int, value binary")
    read = [r.text for r in SC.gunzip(rows, "value", "text").orderBy("i").collect()]
    assert read == [SC._decoded(SC._unzipped(v)) for v in packed]
    assert read[:2] == ['{"symbol":"ä"}', "foreign"] and read[-1] is None


def test_a_reader_of_stored_frames_sends_python_nulls(spark):
    chains = spark.range(50).select(F.concat(F.lit("P"), "id").alias("symbol"))
    messages = SC.encode_chains(chains, deflate=False).withColumn("__stored", SC._stored_text(F.col("value")))
    assert messages.filter("__stored IS NULL").count() == 0
    plan = SC.with_text(messages.drop("__stored"))._jdf.queryExecution().executedPlan().toString()
    assert "_gunzip(CASE WHEN isnull(__stored" in plan


def test_only_the_columns_asked_for_are_parsed(spark):
    text = '{"symbol":"Q","status":"SUCCESS","underlying":{"symbol":"Q"},"callExpDateMap":{"e":{"1.0":[{"symbol":"c"}]}}}'
    messages = spark.createDataFrame([(SC._zipped(text.encode()),)], "value binary")
    some = SC.decode_chain_payload(messages, columns=("symbol", "callExpDateMap"))
    assert some.columns == ["symbol", "callExpDateMap"]
    assert some.first() == SC.decode_chain_payload(messages).select("symbol", "callExpDateMap").first()


def test_chains_are_counted_from_the_columns_of_the_count(spark):
    texts = [('{"symbol":"Q","underlying":{"symbol":"U"},"callExpDateMap":{"e":{"1.0":[{"symbol":"c"}]}},"putExpDateMap":{}}',)] * 3
    counts = QR._count_by_symbol(spark.createDataFrame(texts, "text string").select(SC._frame(F.col("text")).alias("value")))
    assert [tuple(r) for r in counts.collect()] == [("Q", 3, 3)]
    assert "fiftyTwoWeekHigh" not in counts._jdf.queryExecution().executedPlan().toString()


def test_stored_rows_parse_what_they_take(spark):
    schedule = spark.createDataFrame([("2024-01-19", 0.05, 0.06)], "iso_date string, T_eqo double, T_ind double")
    params = {"beta0": 0.04, "beta1": 0.0, "beta2": 0.0, "beta3": 0.0, "tau1": 1.0, "tau2": 2.0}
    messages = spark.createDataFrame([], "key binary, value binary")
    rows = process_messages(messages, schedule, params, F.lit("2024-01-02 21:00:00"), F.lit("2024-01-02 21:15:00"), solve=False)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "fiftyTwoWeekHigh" not in plan and "optionDeliverablesList" not in plan and "theoreticalOptionValue" in plan


def test_batches_of_large_files_are_cut_small(spark, tmp_path):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    messages = spark.range(0, 20_000, 1, 1).select(F.col("id").cast("string").cast("binary").alias("key"), F.md5(F.col("id").cast("string")).cast("binary").alias("value"))
    messages.write.option("parquet.block.size", 65_536).parquet(str(tmp_path / "in"))
    tasks = []
    for inside in (False, True):
        stream = SC.read_chain_stream(spark, "parquet", str(tmp_path / "in"), 10)
        with split_bytes(spark, 65_536) if inside else contextlib.nullcontext():
            J.run_stream(stream, lambda batch, epoch: tasks.append(batch.rdd.getNumPartitions()), str(tmp_path / f"cp{inside}"), trigger=None).awaitTermination()
    assert tasks[1] >= 8 > tasks[0] and spark.conf.get(name) == before
    with split_bytes(spark, 1 << 40):
        assert spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() <= 128 << 20  # never larger than the session's


def test_sessions_are_found_once_for_all_batches(spark, sf_dir, monkeypatch):
    kept = []
    real = QR.schedule

    def schedule(*args):
        kept.append(real(*args))
        return kept[-1]

    levels = []
    monkeypatch.setattr(QR, "schedule", schedule)
    monkeypatch.setattr(QR, "process_messages", lambda batch, sessions, *args, **options: (levels.append(sessions.storageLevel.useMemory), process_messages(batch, sessions, *args, **options))[1])
    assert QUERIES["str1_contract_job"](spark, sf_dir).count() > 0
    assert levels and all(levels) and not kept[0].storageLevel.useMemory
