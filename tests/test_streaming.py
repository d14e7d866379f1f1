import json

import pytest
from pyspark.sql import functions as F

from optiontide.operators.chain import attach_dividends
from optiontide.operators.quality import malformed_ratio, observe_quality
from optiontide.plans.process import process_messages, run_contract_job
from optiontide.session import shared_dir
from optiontide.sources import sinks as SK
from optiontide.sources import versions as V
from optiontide.sources.chains import decode_chain_payload, parse_chain, publish_chains, read_chain_stream, with_text
from optiontide.streaming.job import MERGE_KEYS, epoch_sink, fallback_sink, run_stream
from optiontide.streaming.listener import ProgressListener, ProgressTable, QualityListener


@pytest.fixture()
def landed(spark, tmp_path):
    path = str(tmp_path / "in")
    for part in range(3):
        rows = [(f"S{i % 4}", f"2024-01-02 10:0{part}:00", i + 100 * part) for i in range(8)]
        spark.createDataFrame(rows, "symbol string, fetchTime string, v int").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("symbol string, fetchTime string, v int").option("maxFilesPerTrigger", 1).parquet(path)


def test_epochs_are_replaced_and_merged(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    sink = epoch_sink(out)

    def replayed(batch, epoch):
        sink(batch, epoch)
        sink(batch, epoch)

    run_stream(landed, replayed, str(tmp_path / "a"), trigger=None).awaitTermination()
    assert SK.read_epochs(spark, out).count() == 24
    run_stream(landed, sink, str(tmp_path / "a"), trigger=None).awaitTermination()  # nothing new below this checkpoint
    assert SK.read_epochs(spark, out).count() == 24
    merged = SK.read_merged(spark, out, list(MERGE_KEYS), ["v"])
    assert merged.count() == 12
    assert {r.v % 100 for r in merged.filter("symbol = 'S0'").collect()} == {4}
    run_stream(landed, sink, str(tmp_path / "b"), trigger=None).awaitTermination()  # a checkpoint of its own: rows of its own
    assert SK.read_epochs(spark, out).count() == 48


def test_merge_into_a_stored_table(spark, tmp_path):
    epochs, table = str(tmp_path / "e"), str(tmp_path / "t")

    def rows(*values):
        return spark.createDataFrame(values, "k string, day string, v int")

    def merge():
        return SK.merge_epochs(spark, epochs, table, ["k", "day"], ["v"], buckets=2)

    SK.write_epoch(rows(("a", "d1", 1), (None, "d1", 5), ("b", "d2", 1)), epochs, 0, "x")
    assert merge() == 1
    SK.write_epoch(rows(("a", "d1", 2), (None, "d1", 4)), epochs, 0, "y")
    SK.write_epoch(rows(("c", "d3", 1)), epochs, 1, "x")
    assert merge() == 2 and merge() == 0
    got = sorted((r.k or "", r.day, r.v) for r in SK.read_table(spark, table).collect())
    assert got == [("", "d1", 5), ("a", "d1", 2), ("b", "d2", 1), ("c", "d3", 1)]


def _rows(spark, *values):
    return spark.createDataFrame(values, "k string, day string, v int")


def _table(spark, table, version=None):
    return sorted((r.k, r.day, r.v) for r in SK.read_table(spark, table, version).collect())


def test_a_key_whose_day_changes_stays_one_row(spark, tmp_path):
    epochs, table = str(tmp_path / "e"), str(tmp_path / "t")
    SK.write_epoch(_rows(spark, ("a", "d1", 1), ("b", "d1", 1)), epochs, 0)
    assert SK.merge_epochs(spark, epochs, table, ["k"], ["v"]) == 1
    SK.write_epoch(_rows(spark, ("a", "d2", 2)), epochs, 1)
    assert SK.merge_epochs(spark, epochs, table, ["k"], ["v"]) == 1
    assert _table(spark, table) == [("a", "d2", 2), ("b", "d1", 1)]
    SK.write_epoch(_rows(spark, ("a", "d3", 2)), epochs, 2)  # equal order: the later epoch holds, as in a merge of everything at once
    assert SK.merge_epochs(spark, epochs, table, ["k"], ["v"]) == 1
    assert _table(spark, table) == [("a", "d3", 2), ("b", "d1", 1)]
    merged = sorted((r.k, r.day, r.v) for r in SK.read_merged(spark, epochs, ["k"], ["v"]).collect())
    assert merged == _table(spark, table)


def test_runs_are_text(spark, tmp_path):
    epochs, table = str(tmp_path / "e"), str(tmp_path / "t")
    for run in ("1", "01", "1.0"):
        SK.write_epoch(_rows(spark, (run, "d", 1)), epochs, 0, run)
    assert sorted(r.run for r in SK.read_epochs(spark, epochs).collect()) == ["01", "1", "1.0"]
    assert SK.merge_epochs(spark, epochs, table, ["k"], ["v"]) == 3
    assert [r[0] for r in _table(spark, table)] == ["01", "1", "1.0"]
    for bad in ("a/b", "", "x=1", "p%2F"):
        with pytest.raises(ValueError):
            SK.write_epoch(_rows(spark, ("a", "d", 1)), epochs, 0, bad)


def test_half_written_epochs_and_versions_wait(spark, tmp_path):
    epochs, table = tmp_path / "e", str(tmp_path / "t")
    SK.write_epoch(_rows(spark, ("a", "d", 1)), str(epochs), 0)
    SK.write_epoch(_rows(spark, ("b", "d", 1)), str(epochs), 1)
    marker = epochs / "run=default" / "epoch=1" / "_SUCCESS"
    marker.unlink()
    assert SK.merge_epochs(spark, str(epochs), table, ["k"], ["v"]) == 1 and _table(spark, table) == [("a", "d", 1)]
    marker.touch()  # its write ends
    broken = tmp_path / "t" / "manifests" / "version=2"  # a merge that broke off before its marker
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"half")
    assert _table(spark, table) == [("a", "d", 1)]
    assert SK.merge_epochs(spark, str(epochs), table, ["k"], ["v"]) == 1
    assert _table(spark, table) == [("a", "d", 1), ("b", "d", 1)] and V.versions(spark, table) == [1, 3]


def test_readers_keep_their_version_until_it_expires(spark, tmp_path):
    epochs, table = str(tmp_path / "e"), str(tmp_path / "t")
    for epoch in range(4):
        SK.write_epoch(_rows(spark, *[(f"k{i}", f"d{epoch}", epoch) for i in range(epoch, 8)]), epochs, epoch)
        SK.merge_epochs(spark, epochs, table, ["k"], ["v"], buckets=3)
    opened = SK.read_table(spark, table, 2)
    assert {r.v for r in opened.collect()} == {0, 1}
    assert V.expire_versions(spark, table, keep=2) == [1, 2] and V.versions(spark, table) == [3, 4]
    assert [(r[0], r[2]) for r in _table(spark, table)] == [(f"k{i}", min(i, 3)) for i in range(8)]
    assert {r[2] for r in _table(spark, table, 3)} == {0, 1, 2}
    with pytest.raises(ValueError):
        SK.read_table(spark, table, 1)
    with pytest.raises(ValueError):
        V.expire_versions(spark, table, keep=0)


def test_epochs_without_rows_and_many_at_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(SK, "MOST_EPOCHS", 2)
    epochs, table = str(tmp_path / "e"), str(tmp_path / "t")
    SK.write_epoch(_rows(spark, ("a", "d", 1)).limit(0), epochs, 0)
    assert SK.merge_epochs(spark, epochs, table, ["k"], ["v"]) == 1 and V.versions(spark, table) == [1]
    with pytest.raises(ValueError):
        SK.read_table(spark, table)
    for epoch in range(1, 6):
        SK.write_epoch(_rows(spark, ("a", "d", epoch), (None, "d", 9 - epoch)), epochs, epoch)
    assert SK.merge_epochs(spark, epochs, table, ["k"], ["v"]) == 5 and V.versions(spark, table) == [1, 2, 3, 4]
    assert {(r.k, r.v) for r in SK.read_table(spark, table).collect()} == {("a", 5), (None, 8)}


def test_quarantine(spark, tmp_path):
    publish_chains(parse_chain(spark.createDataFrame([('{"symbol":"Q"}',), ("{}",)], "text string"), "text"), str(tmp_path / "in"))
    spark.createDataFrame([(b"x", b"broken"), (b"y", None)], "key binary, value binary").write.mode("append").parquet(str(tmp_path / "in"))
    stream = read_chain_stream(spark, "parquet", str(tmp_path / "in"), 10)
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    run_contract_job(stream, out, str(tmp_path / "cp"), lambda b: b.select("key"), quarantine=bad).awaitTermination()
    assert sorted(r.state for r in SK.read_epochs(spark, bad).collect()) == ["no_symbol", "unreadable", "unreadable"]


def test_contract_job_end_to_end(spark, tmp_path):
    contract = dict(symbol="QQQ   240119C00095000", putCall="CALL", strikePrice=95.0, mark=8.0, intrinsicValue=5.0,
                    expirationDate="2024-01-19T20:00:00.000+00:00", exerciseType="A")
    doc = {"symbol": "QQQ", "status": "SUCCESS", "underlyingPrice": 100.0, "fetchTime": "2024-01-02 19:30:00", "isIndex": False,
           "callExpDateMap": {"e": {"k": [contract]}}, "putExpDateMap": {"e": {"k": [{**contract, "putCall": "PUT", "mark": 1.0}]}}}
    chains = parse_chain(spark.createDataFrame([(json.dumps(doc),)], "text string"), "text")
    for _ in range(2):
        publish_chains(chains, str(tmp_path / "in"))
    spark.createDataFrame([(b"x", b"broken")], "key binary, value binary").write.mode("append").parquet(str(tmp_path / "in"))
    schedule = spark.createDataFrame([("2024-01-19", 0.05, 0.06)], "iso_date string, T_eqo double, T_ind double")
    funds = spark.createDataFrame([("QQQ", 2.0)], "symbol string, divAmount double")
    params = {"beta0": 0.04, "beta1": 0.0, "beta2": 0.0, "beta3": 0.0, "tau1": 1.0, "tau2": 2.0}
    close = F.lit("2024-01-02 21:00:00"), F.lit("2024-01-02 21:15:00")
    stream = read_chain_stream(spark, "parquet", str(tmp_path / "in"), 1)
    job = run_contract_job(stream, str(tmp_path / "out"), str(tmp_path / "cp"),
                           lambda batch: process_messages(batch, schedule, params, *close, fundamentals=funds))
    job.awaitTermination()
    rows = SK.read_epochs(spark, str(tmp_path / "out")).collect()
    assert len(rows) == 4 and {r.ticker for r in rows} == {"QQQ"}
    call = next(r for r in rows if r.putCall == "CALL")
    assert call.iv_mark > 0 and json.loads(call.extra)["dividendAmount"] == 2.0 and str(call.underlyingPrice) == "100.00"
    assert next(r for r in rows if r.putCall == "PUT").iv_mark is None
    joined = attach_dividends(read_chain_stream(spark, "parquet", str(tmp_path / "in"), 1).select(F.lit("Q").alias("symbol")), funds)
    assert joined.isStreaming


def test_fallback(spark, landed, tmp_path):
    kept = []

    def primary(df):
        if df.filter("v >= 100").count():
            raise OSError("down")
        kept.append(df.count())

    run_stream(landed, fallback_sink(primary, str(tmp_path / "fb"), "20240102"), str(tmp_path / "c"), trigger=None).awaitTermination()
    errors = spark.read.parquet(str(tmp_path / "fb/errors/20240102"))
    assert sum(kept) == 8 and errors.count() == 16 and {r.write_error for r in errors.collect()} == {"OSError"}


def test_fallback_does_not_hide_other_errors(spark, tmp_path):
    with pytest.raises(KeyError):
        SK.write_with_fallback(spark.range(1), lambda df: {}["x"], str(tmp_path), "d", 1)


def test_listeners(spark, landed, tmp_path):
    records, alerts = [], []
    listeners = [ProgressListener(records.append), QualityListener(alerts.append)]
    for listener in listeners:
        spark.streams.addListener(listener)
    try:
        observed = observe_quality(landed.withColumn("error", F.when(F.col("v") >= 100, "bad")), "error")
        query = run_stream(observed, epoch_sink(str(tmp_path / "o")), str(tmp_path / "c"), name="watched", trigger=None)
        query.awaitTermination()
        for _ in range(100):
            if len(records) >= 3 and len(alerts) >= 2:
                break
            spark.range(1).count()
            __import__("time").sleep(0.1)
    finally:
        for listener in listeners:
            spark.streams.removeListener(listener)
    assert sum(r["numInputRows"] for r in records) == 24 and json.dumps(records[0])
    assert records[0]["name"] == "watched" and "addBatch" in records[0]["durationMs"]
    assert len(alerts) == 2 and all(a["malformed"] == 8 for a in alerts)


def test_malformed_ratio(spark):
    df = spark.createDataFrame([("x",), (None,), ("y",)], "error string")
    row = malformed_ratio(df, "error").first()
    assert (row.cnt, row.malformed, row.alert) == (3, 2, True)
    empty = malformed_ratio(df.filter("false"), "error").first()
    assert empty.ratio is None and empty.alert is False


def test_json_documents_are_bounded_and_whole(spark):
    df = spark.range(0, 1000, 1, 3).select(F.lit("k").alias("key"), "id", F.lit("2024-01-01").cast("date").alias("d"))
    for parts in (1, 7):
        docs = SK.rows_to_json_documents(df.repartition(parts), ["key"], {"origin": F.lit("t")}, order=["id"], rows_per_document=300,
                                         bucket=F.floor(F.col("id") / 64)).collect()
        assert sorted((d["part"], d["rows"]) for d in docs) == [(0, 300), (1, 300), (2, 300), (3, 100)]
        for d in docs:
            assert [item["id"] for item in json.loads(d["json"])] == list(range(300 * d["part"], 300 * d["part"] + d["rows"]))
    assert json.loads(docs[0]["json"])[0]["d"] == "2024-01-01" and docs[0]["origin"] == "t"
    (whole,) = SK.rows_to_json_documents(df, ["key"], order=["id"], rows_per_document=None).collect()
    assert whole["rows"] == 1000 and [item["id"] for item in json.loads(whole["json"])] == list(range(1000))


def test_documents_are_bounded_by_default_and_listed_by_key(spark):
    df = spark.range(0, 5000, 1, 3).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 500 == 1, "few").alias("key"), "id")
    documents = SK.rows_to_json_documents(df, ["key"], order=["id"])
    found = documents.collect()
    assert max(d["rows"] for d in found) == SK.DOCUMENT_ROWS and sum(d["rows"] for d in found) == 5000
    for key, part in (("hot", 1), (None, 2)):
        own = next(d for d in found if d["key"] == key and d["part"] == part)
        ids = [r["id"] for r in df.filter(F.col("key").eqNullSafe(F.lit(key))).orderBy("id").collect()]
        assert [item["id"] for item in json.loads(own["json"])] == ids[1000 * part : 1000 * part + own["rows"]]
    items = F.from_json("json", "array<struct<id: bigint>>")
    index = {r["key"]: (r["parts"], r["rows"], r["first"], r["last"]) for r in SK.document_index(documents, ["key"], items[0]["id"], F.element_at(items, -1)["id"]).collect()}
    assert index["hot"] == (2, 1667, 0, 4998) and index["few"][0] == 1 and index[None][0] == 4
    everything = SK.rows_to_json_documents(df, rows_per_document=2000).collect()  # no key, no order
    assert sorted((d["part"], d["rows"]) for d in everything) == [(0, 2000), (1, 2000), (2, 1000)]


def test_messages_are_unzipped_once(spark, tmp_path):
    publish_chains(parse_chain(spark.createDataFrame([('{"symbol":"Q"}',)], "text string"), "text"), str(tmp_path / "in"))
    messages = with_text(spark.read.parquet(str(tmp_path / "in")))
    plan = decode_chain_payload(messages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_gunzip(") == 1 and decode_chain_payload(messages).first()["symbol"] == "Q"


def test_progress_table_keeps_a_record_for_each_batch(spark, landed, tmp_path):
    table = ProgressTable(spark, str(tmp_path / "progress"))
    observed = observe_quality(landed.withColumn("error", F.when(F.col("v") >= 100, "bad")), "error", "messages")
    for _ in range(2):  # the second start has nothing to do; its records are those of the query's id
        query = run_stream(observed, epoch_sink(str(tmp_path / "o")), str(tmp_path / "c"), trigger=None)
        query.awaitTermination()
        table.flush(query)
        table.flush(query)
    rows = sorted((r.batchId, r.numInputRows, r.observed["messages"].malformed, r.malformed_ratio, r.alert) for r in table.read().filter("numInputRows > 0").collect())
    assert rows == [(0, 8, 0, 0.0, False), (1, 8, 8, 1.0, True), (2, 8, 8, 1.0, True)]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "snap")
    assert SK.is_stale(spark, path, "2024-01-02")
    SK.save_snapshot(spark.range(5), path, "2024-01-02")
    SK.save_snapshot(spark.range(3), path, "2024-01-02")
    assert spark.read.parquet(path).count() == 3
    assert not SK.is_stale(spark, path, "2024-01-02") and SK.is_stale(spark, path, "2024-01-03")


def test_jdbc_options(monkeypatch, spark):
    seen = {}

    def jdbc(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, properties=properties)

    monkeypatch.setattr(type(spark.range(1).write), "jdbc", jdbc)
    SK.write_jdbc_append(spark.range(1), "jdbc:x", "t", {"user": "u", "batchsize": "10"})
    assert seen["mode"] == "append" and seen["properties"]["batchsize"] == "10" and seen["properties"]["user"] == "u"


class _Session:
    def __init__(self, value, master="local[2]"):
        self.conf = {"spark.checkpoint.dir": value, "spark.master": master} if value else {"spark.master": master}


def test_shared_dir_prefers_the_session_setting():
    assert shared_dir(_Session("/shared/place/")) == "/shared/place"
    assert shared_dir(_Session(None)) == shared_dir(_Session(None)) != ""
    with pytest.raises(ValueError):
        shared_dir(_Session(None, "spark://host:7077"))


def test_spread_for_write(spark):
    df = spark.range(1000).withColumn("symbol", F.col("id").cast("string"))
    sizes = SK.spread_for_write(df, files=4).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 400
