"""Source, sink, account, feed and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from optiontide.functions.feed_fields import SERVICE_FIELDS
from optiontide.operators import accounts as A
from optiontide.operators import chain as CH
from optiontide.operators import feeds as FD
from optiontide.operators import quality as QL
from optiontide.operators import tables as TB
from optiontide.plans import derived as D
from optiontide.plans import oracle_sql as O
from optiontide.plans.process import process_messages, run_contract_job
from optiontide.plans.queries_chain import CURVE, schedule
from optiontide.plans.queries_reference import hours_documents
from optiontide.plans.registry import query, rounded
from optiontide.session import run_dir, split_bytes
from optiontide.sources import chains as SC
from optiontide.sources import delimited as SD
from optiontide.sources import documents as DOC
from optiontide.sources import sinks as SK
from optiontide.streaming.listener import ProgressListener, ProgressTable
from optiontide.streaming import job as J

PAIRS = D.oracle_text(D.CONTRACT_PAIRS)
MASTER = D.oracle_text(D.OPTION_MASTER)
ORDERS = D.oracle_text(D.ORDERS)
INSTRUMENTS = D.oracle_text(D.INSTRUMENTS)

# --------------------------------------------------------------------------- chain messages

_DECODED = (
    "SELECT symbol, putCall, CAST(round(strikePrice, 2) AS double) AS strikePrice, expirationDate, exerciseType,"
    f" CAST(round(mark, 2) AS double) AS mark, underlyingPrice, {O.ts_text('fetchTime')} AS fetchTime, dividendAmount, isIndex"
    f" FROM ({PAIRS}) c"
)
_COLUMNS = ["symbol", "putCall", "strikePrice", "expirationDate", "exerciseType", "mark", "underlyingPrice", "fetchTime",
            "dividendAmount", "isIndex"]


def chain_documents(spark, sf):
    return D.chains(spark, sf).drop("l_orderkey", "l_linenumber")


@query("src2_decode_chain_payload", _DECODED)
def _(spark, sf):
    decoded = SC.decode_chain_payload(SC.encode_chains(chain_documents(spark, sf)), fields=_COLUMNS)
    return CH.flatten_chain(decoded).select(*_COLUMNS)


@query("src2_parse_chain_text", _DECODED)
def _(spark, sf):
    c = chain_documents(spark, sf)
    return CH.flatten_chain(SC.parse_chain(c.select(F.to_json(F.struct("*")).alias("text")), "text")).select(*_COLUMNS)


# every ninth message is cut short, every tenth is no JSON
@query(
    "src2_decode_corrupt",
    "SELECT CASE WHEN l_orderkey % 9 = 0 THEN 'unreadable' WHEN l_orderkey % 10 = 0 THEN 'not_json' ELSE 'ok' END AS state,"
    " count(*) AS n, count(CASE WHEN l_orderkey % 9 <> 0 AND l_orderkey % 10 <> 0 THEN 1 END) AS with_symbol FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    c = D.chains(spark, sf).withColumn("key", F.col("l_orderkey"))
    text = F.when(F.col("key") % 10 == 0, F.lit("no document")).otherwise(F.to_json(F.struct("symbol", "status")))
    packed = c.select("key", SC._gzip(text).alias("value"))
    cut = packed.withColumn("value", F.when(F.col("key") % 9 == 0, F.substring("value", 1, 12)).otherwise(F.col("value")))
    decoded = SC.decode_chain_payload(cut, record_status="state")
    return decoded.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.count("symbol").alias("with_symbol"))


_BY_TICKER = f"SELECT ticker AS symbol, count(*) // 2 AS chains, count(*) AS contracts FROM ({PAIRS}) c GROUP BY 1"


def _count_by_symbol(messages):
    rows = SC.decode_chain_payload(messages, fields=["symbol"], columns=["symbol", "callExpDateMap", "putExpDateMap"])
    sizes = rows.select("symbol", (F.size("callExpDateMap") + F.size("putExpDateMap")).alias("k"))
    return sizes.groupBy("symbol").agg(F.count(F.lit(1)).alias("chains"), F.sum("k").alias("contracts"))


@query("snk1_publish_chains", _BY_TICKER)
def _(spark, sf):
    target = run_dir(spark, "messages")
    SC.publish_chains(chain_documents(spark, sf), target)
    return _count_by_symbol(spark.read.parquet(target))


@query("src1_read_chain_stream", _BY_TICKER)
def _(spark, sf):
    landed, out = run_dir(spark, "landed"), run_dir(spark, "epochs")
    SC.publish_chains(chain_documents(spark, sf), landed)
    stream = SC.read_chain_stream(spark, "parquet", landed, SC.max_per_trigger(accounts=5))
    J.run_stream(stream, J.epoch_sink(out, codec=SC.MESSAGE_CODEC), run_dir(spark, "checkpoint"), trigger=None).awaitTermination()
    return _count_by_symbol(SK.read_epochs(spark, out).drop("run", "epoch"))


# --------------------------------------------------------------------------- streaming jobs

_LATEST = (
    "SELECT l_orderkey AS order_id, l_extendedprice AS price, l_linenumber AS line FROM (SELECT *, row_number() OVER (PARTITION BY"
    " l_orderkey ORDER BY l_linenumber DESC, l_extendedprice DESC) AS rn FROM lineitem) x WHERE rn = 1"
)


def _line_stream(spark, sf):
    rows = D.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("price"), F.col("l_linenumber").alias("line")
    )
    landed = run_dir(spark, "lines")
    rows.write.option("maxRecordsPerFile", 500_000).parquet(landed)
    # a batch takes a file for each core
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism).parquet(landed)


@query("str1_stream_merge", _LATEST)
def _(spark, sf):
    out = run_dir(spark, "merged")
    J.run_stream(_line_stream(spark, sf), J.epoch_sink(out), run_dir(spark, "checkpoint"), trigger=None).awaitTermination()
    return SK.read_merged(spark, out, ["order_id"], ["line", "price"])


@query(
    "str1_contract_job",
    "SELECT ticker, putCall, count(*) AS contracts, count(CASE WHEN mark > intrinsicValue THEN 1 END) AS eligible,"
    " round(sum(CAST(round(mark, 2) AS double)), 2) AS marks FROM (SELECT * REPLACE (CAST(round(mark, 2) AS decimal(10, 2)) AS mark,"
    f" CAST(round(intrinsicValue, 2) AS decimal(10, 2)) AS intrinsicValue) FROM ({PAIRS}) c) d GROUP BY 1, 2",
)
def _(spark, sf):
    landed, out = run_dir(spark, "landed"), run_dir(spark, "contracts")
    SC.publish_chains(chain_documents(spark, sf), landed)
    stream = SC.read_chain_stream(spark, "parquet", landed, SC.max_per_trigger(accounts=5))
    sessions = schedule(spark, sf).persist()  # a row per session, found once for all batches

    def transform(batch):
        close = F.lit(D.CLOSE_EQUITY), F.lit(D.CLOSE_INDEX)
        return process_messages(batch, sessions, CURVE, *close, solve=False)

    try:
        with split_bytes(spark, SC.MESSAGE_SPLIT):
            run_contract_job(stream, out, run_dir(spark, "checkpoint"), transform).awaitTermination()
    finally:
        sessions.unpersist()
    rows = SK.read_epochs(spark, out)
    return rounded(
        rows.groupBy("ticker", "putCall").agg(
            F.count(F.lit(1)).alias("contracts"),
            F.count_if(CH.is_iv_eligible()).alias("eligible"),
            F.sum(F.col("mark").cast("double")).alias("marks"),
        ), 2, "marks",
    )


@query(
    "str2_max_per_trigger",
    "SELECT s_nationkey, count(*) AS accounts, CAST(ceil(count(*) * 120 * 15 / 60.0 / 15) AS bigint) AS per_trigger FROM supplier GROUP BY 1",
)
def _(spark, sf):
    # one stream per nation, with an account per supplier
    streams = D.table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("accounts")).collect()
    rows = [(r["s_nationkey"], r["accounts"], SC.max_per_trigger(r["accounts"])) for r in streams]
    return spark.createDataFrame(rows, "s_nationkey int, accounts long, per_trigger long")


@query("str3_replayed_epochs", _LATEST)
def _(spark, sf):
    # every epoch is written a second time, as a restarted query does: nothing is doubled
    out = run_dir(spark, "replayed")
    sink = J.epoch_sink(out)

    def twice(batch, epoch):
        sink(batch, epoch)
        sink(batch, epoch)

    J.run_stream(_line_stream(spark, sf), twice, run_dir(spark, "checkpoint"), trigger=None).awaitTermination()
    total = SK.read_epochs(spark, out).agg(F.count(F.lit(1))).scalar()
    given = D.table(spark, sf, "lineitem").agg(F.count(F.lit(1))).scalar()
    return SK.read_merged(spark, out, ["order_id"], ["line", "price"]).filter(total == given)


@query("str3_two_topics", "SELECT l_returnflag AS topic, l_orderkey AS order_id, l_linenumber AS line FROM lineitem UNION ALL SELECT 'again', l_orderkey, l_linenumber FROM lineitem")
def _(spark, sf):
    # two topics with checkpoints of their own share a table; both number their epochs from 0
    out = run_dir(spark, "topics")
    rows = D.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), "l_returnflag")
    landed = run_dir(spark, "lines")
    rows.write.parquet(landed)
    for topic in (F.col("l_returnflag"), F.lit("again")):
        stream = spark.readStream.schema(rows.schema).parquet(landed).select(topic.alias("topic"), "order_id", "line")
        J.run_stream(stream, J.epoch_sink(out), run_dir(spark, "checkpoint"), trigger=None).awaitTermination()
    return SK.read_epochs(spark, out).drop("run", "epoch")


@query("str1_merged_table", _LATEST)
def _(spark, sf):
    # epochs are merged into a stored table in two goes; a third finds nothing new
    epochs, target = run_dir(spark, "epochs"), run_dir(spark, "stored")
    for run in ("a", "b"):
        J.run_stream(_line_stream(spark, sf), J.epoch_sink(epochs, run=run), run_dir(spark, "checkpoint"), trigger=None).awaitTermination()
        SK.merge_epochs(spark, epochs, target, ["order_id"], ["line", "price"])
    assert SK.merge_epochs(spark, epochs, target, ["order_id"], ["line", "price"]) == 0
    return SK.read_table(spark, target)


@query(
    "str3_merge_changing_days",
    "SELECT l_orderkey AS order_id, strftime(arg_max(l_shipdate, l_linenumber), '%Y-%m-%d') AS day, max(l_linenumber) AS line FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    # lines of an order come on days of their own, in runs "1" and "01"; each merge leaves one row of an order, with the last line's day
    epochs, target = run_dir(spark, "epochs"), run_dir(spark, "stored")
    lines = D.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), F.col("l_linenumber").cast("int").alias("line"))
    for epoch, parts in enumerate((("1", "line % 3 = 0"), ("01", "line % 3 = 1"), ("1", "line % 3 = 2"))):
        SK.write_epoch(lines.filter(parts[1]), epochs, epoch, parts[0])
        assert SK.merge_epochs(spark, epochs, target, ["order_id"], ["line"], buckets=8) == 1
    first = SK.read_table(spark, target, version=1)  # readers of an earlier version still see it whole
    given = lines.filter("line % 3 = 0").select("order_id").distinct().count()
    return SK.read_table(spark, target).filter(F.lit(first.count() == given))


def _sent_messages(spark, sf):
    """Chain messages of which some are cut off, no documents, or without a symbol."""
    c = D.chains(spark, sf).withColumn("key", F.col("l_orderkey"))
    named = F.struct(F.when(F.col("key") % 11 != 0, F.col("symbol")).alias("symbol"), "status")
    text = F.when(F.col("key") % 10 == 0, F.lit("no document")).otherwise(F.to_json(named))
    packed = c.select("key", SC._gzip(text).alias("value"))
    sent = packed.withColumn("value", F.when(F.col("key") % 9 == 0, F.substring("value", 1, 12)).otherwise(F.col("value")))
    return sent.select(F.col("key").cast("string").cast("binary").alias("key"), "value")


@query(
    "str1_quarantined_messages",
    "SELECT CASE WHEN l_orderkey % 9 = 0 THEN 'unreadable' WHEN l_orderkey % 10 = 0 THEN 'not_json' WHEN l_orderkey % 11 = 0 THEN 'no_symbol'"
    " ELSE 'ok' END AS state, count(*) AS n FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    landed, out, bad = (run_dir(spark, n) for n in ("landed", "read", "quarantine"))
    _sent_messages(spark, sf).write.parquet(landed)
    stream = SC.read_chain_stream(spark, "parquet", landed, SC.max_per_trigger(accounts=5))
    run_contract_job(stream, out, run_dir(spark, "checkpoint"), lambda b: SC.decode_chain_payload(b).select("symbol"), quarantine=bad).awaitTermination()
    read = SK.read_epochs(spark, out).filter("symbol is not null").select(F.lit("ok").alias("state"))
    kept = SK.read_epochs(spark, bad).select("state")
    return read.union(kept).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(
    "str4_batches_as_table",
    "SELECT count(*) AS messages, count(CASE WHEN l_orderkey % 9 = 0 OR l_orderkey % 10 = 0 OR l_orderkey % 11 = 0 THEN 1 END) AS malformed,"
    " true AS each_once, true AS shares_agree FROM lineitem",
)
def _(spark, sf):
    # the contract job's batches as rows of a table: their counts and the share of messages that gave no rows
    landed, out, bad, table = (run_dir(spark, n) for n in ("landed", "read", "quarantine", "progress"))
    _sent_messages(spark, sf).write.parquet(landed)
    stream = SC.read_chain_stream(spark, "parquet", landed, SC.max_per_trigger(accounts=5))
    records = ProgressTable(spark, table)
    listener = ProgressListener(records)
    spark.streams.addListener(listener)
    try:
        job = run_contract_job(stream, out, run_dir(spark, "checkpoint"), lambda b: SC.decode_chain_payload(b).select("symbol"), quarantine=bad)
        job.awaitTermination()
        records.flush(job)  # the listener has kept these records, or will: each batch has one document
    finally:
        spark.streams.removeListener(listener)
    batches = records.read().filter("numInputRows > 0")
    seen = F.col("observed")["messages"]
    return batches.agg(
        F.sum("numInputRows").alias("messages"), F.sum(seen["malformed"]).alias("malformed"),
        (F.count(F.lit(1)) == F.count_distinct("id", "batchId")).alias("each_once"),
        F.bool_and((F.col("malformed_ratio") == seen["malformed"] / F.col("numInputRows")) & (F.col("alert") == (F.col("malformed_ratio") > 0.5))).alias("shares_agree"))


@query("snk4_write_with_fallback", "SELECT l_returnflag, count(*) AS n, 'OSError' AS write_error FROM lineitem GROUP BY 1")
def _(spark, sf):
    def refused(df):
        raise OSError("no connection")

    base = run_dir(spark, "fallback")
    SK.write_with_fallback(D.table(spark, sf, "lineitem"), refused, base, "20240102", 7)
    kept = spark.read.parquet(f"{base}/errors/20240102")
    return kept.groupBy("l_returnflag", "write_error").agg(F.count(F.lit(1)).alias("n"))


@query("snk5_append_order_log", f"SELECT order_id, status, price FROM ({ORDERS}) o")
def _(spark, sf):
    path = run_dir(spark, "orderlog")
    orders = D.derived(spark, sf, D.ORDERS)
    SK.append_order_log(orders.filter("status = 'FILLED'"), path)
    SK.append_order_log(orders.filter("status <> 'FILLED'"), path)
    return spark.read.schema(orders.schema).json(path).select("order_id", "status", "price")


@query(
    "snk4_pending_rows",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber > 2",
)
def _(spark, sf):
    # the primary write breaks off after some rows: only the others are pending
    base, stored = run_dir(spark, "fallback"), run_dir(spark, "primary")

    def half(df):
        df.filter("l_linenumber <= 2").write.parquet(stored)
        raise OSError("connection lost")

    SK.write_with_fallback(D.table(spark, sf, "lineitem"), half, base, "20240102", 7)
    return SK.pending_rows(spark, base, "20240102", spark.read.parquet(stored), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


@query(
    "snk6_rows_to_json_documents",
    f"SELECT status, order_id, round(price, 2) AS price, {O.ts_text('entered_time')} AS entered_time, 'orders' AS source,"
    f" (row_number() OVER (PARTITION BY status ORDER BY order_id) - 1) // 700 AS part FROM ({ORDERS}) o",
)
def _(spark, sf):
    orders = D.derived(spark, sf, D.ORDERS).select("status", "order_id", "price", "entered_time")
    documents = SK.rows_to_json_documents(
        orders, ["status"], {"source": F.lit("orders")}, order=["order_id"], rows_per_document=700, bucket=F.floor(F.col("order_id") / 1000))
    items = "array<struct<order_id: bigint, price: double, entered_time: timestamp>>"
    return rounded(documents.select("status", "source", "part", F.inline(F.from_json("json", items))), 2, "price")


@query("snk6_one_document_per_key", "SELECT o_custkey AS account, count(*) AS rows, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id FROM orders GROUP BY 1")
def _(spark, sf):
    orders = D.derived(spark, sf, D.ORDERS).select("account", "order_id", "price")
    documents = SK.rows_to_json_documents(orders, ["account"], order=["order_id"], rows_per_document=4)
    items = F.from_json("json", "array<struct<order_id: bigint, price: double>>")
    index = SK.document_index(documents, ["account"], items[0]["order_id"], F.element_at(items, -1)["order_id"])
    return index.select("account", "rows", F.col("first").alias("first_id"), F.col("last").alias("last_id"))


@query(
    "snk8_snapshot_staleness",
    "SELECT cast(max(ts::date) AS varchar) AS last_updated, max(ts::date) < date '2024-02-15' AS is_stale FROM events",
)
def _(spark, sf):
    path = run_dir(spark, "snapshot")
    e = D.table(spark, sf, "events").withColumn("as_of", F.to_date("ts"))
    e.select("event_id", "value", "as_of").write.partitionBy("as_of").parquet(path)
    return SK.staleness(spark.read.parquet(path), "2024-02-15")


# --------------------------------------------------------------------------- files and documents


@query("src3_read_symbol_master", f"SELECT optionID, underlying, test_issue_flag, settlementType FROM ({MASTER}) m")
def _(spark, sf):
    path = run_dir(spark, "master")
    D.derived(spark, sf, D.OPTION_MASTER).write.csv(path, sep="|", header=True)
    return SD.read_symbol_master(spark, path, "options").select("optionID", "underlying", "test_issue_flag", "settlementType")


@query(
    "src4_read_delimited",
    "SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem WHERE l_orderkey % 50 <> 0",
)
def _(spark, sf):
    # a header line in each file, and a row in fifty that does not fit
    path = run_dir(spark, "delimited")
    li = D.table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 50 == 0, F.lit("bad")).otherwise(F.col("l_orderkey").cast("string")).alias("l_orderkey"),
        "l_linenumber", "l_extendedprice", "l_returnflag",
    )
    li.write.csv(path, sep=";", header=True)
    schema = "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string"
    return SD.read_delimited(spark, path, schema, first_row=2, sep=";")


_TABLE = (
    "concat(html, '<table class=\"yields\"><tr><th>Date</th><th> 1 Mo </th></tr><tr><td>2024-01-', cast(10 + page_id % 20 AS"
    " string), '</td><td> ', cast(page_id AS string), ' </td></tr><tr><td>2024-02-01</td><td>N/A</td></tr></table>')"
)


@query(
    "src5_extract_html_tables",
    "SELECT page_id, 0 AS table_no, row_no, header, cell FROM (SELECT page_id, 1 AS row_no, 'Date' AS header, '2024-01-' || (10 +"
    " page_id % 20) AS cell FROM pages UNION ALL SELECT page_id, 1, '1 Mo', cast(page_id AS varchar) FROM pages UNION ALL SELECT"
    " page_id, 2, 'Date', '2024-02-01' FROM pages UNION ALL SELECT page_id, 2, '1 Mo', 'N/A' FROM pages) x",
)
def _(spark, sf):
    pages = D.table(spark, sf, "pages").withColumn("html", F.expr(_TABLE))
    return DOC.extract_html_tables(pages, "yields")


@query(
    "src6_read_fundamentals",
    "SELECT concat('P', p_partkey) AS symbol, 'EQUITY' AS assetMainType, CAST(p_partkey AS bigint) AS ssid, CASE WHEN p_size % 3 = 0"
    " THEN 0.0 ELSE p_size / 4.0::double END AS divAmount, p_retailprice AS avg10DaysVolume FROM part",
)
def _(spark, sf):
    p = D.table(spark, sf, "part")
    record = F.struct(
        F.lit("EQUITY").alias("assetMainType"), F.col("p_partkey").alias("ssid"),
        F.struct(
            F.when(F.col("p_size") % 3 != 0, F.col("p_size") / F.lit(4.0)).alias("divAmount"),
            F.col("p_retailprice").alias("avg10DaysVolume"),
        ).alias("fundamental"),
    )
    documents = p.select(F.to_json(F.create_map(F.concat(F.lit("P"), F.col("p_partkey").cast("string")), record)).alias("value"))
    path = run_dir(spark, "fundamentals")
    documents.write.text(path)
    return DOC.read_fundamentals(spark, path).select("symbol", "assetMainType", "ssid", "divAmount", "avg10DaysVolume")


def _session_sql(product: str, minutes: int) -> str:
    return (
        f"SELECT event_id, ts::date::varchar AS date, 'option' AS market, '{product}' AS product, 'regularMarket' AS phase,"
        f" {O.ts_text('ts::date::timestamp + INTERVAL 870 MINUTE')} AS \"start\", {O.ts_text(f'ts::date::timestamp + INTERVAL {minutes} MINUTE')}"
        " AS \"end\", true AS is_open FROM events WHERE event_id % 4 <> 0"
    )


@query(
    "src7_read_market_hours",
    "SELECT * EXCLUDE (event_id) FROM (" + _session_sql("EQO", 1260) + " UNION ALL " + _session_sql("IND", 1275)
    + " UNION ALL SELECT event_id, ts::date::varchar, 'equity', 'equity', NULL, NULL, NULL, false FROM events WHERE event_id % 4 = 0) x",
)
def _(spark, sf):
    path = run_dir(spark, "hours")
    hours_documents(spark, sf).select("value").write.text(path)
    return DOC.read_market_hours(spark, path)


# --------------------------------------------------------------------------- accounts, orders, instruments

# accounts of a customer: some documents are objects, some lists; some fields are missing
_BALANCE_FIELDS = ("cashAvailableForTrading", "availableFunds", "buyingPower", "shortBalance")


def account_documents(spark, sf):
    c = D.table(spark, sf, "customer")
    balances = F.struct(
        F.col("c_acctbal").alias("cashBalance"), (F.col("c_acctbal") * 2).alias("longMarketValue"),
        *[F.when(F.col("c_custkey") % 4 == i, F.col("c_acctbal") + i).alias(n) for i, n in enumerate(_BALANCE_FIELDS)],
    )
    number = F.col("c_custkey").cast("string")
    holding = F.struct(
        (F.col("c_acctbal") / 2).alias("averagePrice"), F.col("c_acctbal").alias("marketValue"),
        F.lit(1.5).alias("currentDayProfitLossPercentage"), F.lit(2.5).alias("currentDayProfitLoss"),
        F.col("c_nationkey").cast("double").alias("longQuantity"), F.lit(0.0).alias("shortQuantity"),
        F.col("c_nationkey").cast("double").alias("settledLongQuantity"), F.lit(0.0).alias("settledShortQuantity"),
        F.struct(
            F.concat(F.lit("C"), number).alias("symbol"), F.lit("000").alias("cusip"), F.lit("EQUITY").alias("assetType"),
            F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("description"),
        ).alias("instrument"),
    )

    def account(kind: str):
        return F.struct(number.alias("accountId"), F.lit(kind).alias("type"), balances.alias("currentBalances"),
                        F.array(holding, holding).alias("positions"))

    cash, margin = F.create_map(F.lit("cashAccount"), account("CASH")), F.create_map(F.lit("marginAccount"), account("MARGIN"))
    single, listed = F.to_json(cash), F.to_json(F.array(cash, margin))
    return c.select(F.when(F.col("c_custkey") % 2 == 0, single).otherwise(listed).alias("value"))


_KINDS = "(SELECT c.*, k.kind FROM customer c JOIN (VALUES ('CASH', 0), ('MARGIN', 1)) k(kind, odd) ON k.odd <= c_custkey % 2)"


def _zero_unless(i: int) -> str:
    return f"CASE WHEN c_custkey % 4 = {i} THEN c_acctbal + {i} ELSE 0 END"


@query(
    "prj7_flatten_account_balances",
    "SELECT cast(c_custkey AS varchar) AS account_number, kind AS account_type, c_acctbal AS cash_balance, c_acctbal * 2 AS"
    f" long_market_value, {_zero_unless(0)} AS cash_available_for_trading, 0.0::double AS cash_available_for_withdrawl,"
    f" {_zero_unless(1)} AS available_funds, {_zero_unless(2)} AS buying_power, 0.0::double AS day_trading_buying_power,"
    " 0.0::double AS maintenance_call, 0.0::double AS maintenance_requirement,"
    f" {_zero_unless(3)} AS short_balance, 0.0::double AS short_market_value, 0.0::double AS short_margin_value FROM {_KINDS} c",
)
def _(spark, sf):
    return A.flatten_account_balances(account_documents(spark, sf))


@query(
    "prj8_flatten_account_positions",
    "SELECT cast(c_custkey AS varchar) AS account_number, c_acctbal / 2 AS average_price, c_acctbal AS market_value, 1.5::double AS"
    " current_day_profit_loss_percentage, 2.5::double AS current_day_profit_loss, c_nationkey::double AS long_quantity, 0.0::double"
    " AS short_quantity, c_nationkey::double AS settled_long_quantity, 0.0::double AS settled_short_quantity, 'C' || c_custkey AS"
    " symbol, '000' AS cusip, 'EQUITY' AS asset_type, '' AS sub_asset_type, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE ''"
    f" END AS description, '' AS type FROM {_KINDS} c, (VALUES (0), (1)) twice(n)",
)
def _(spark, sf):
    return A.flatten_account_positions(account_documents(spark, sf))


@query(
    "flt6_orders_by",
    f"SELECT order_id, account, price FROM ({ORDERS}) o WHERE status = 'FILLED' AND entered_time >= TIMESTAMP '2000-05-01 00:00:00'"
    " - INTERVAL 60 DAY AND entered_time <= TIMESTAMP '2000-05-01 00:00:00'",
)
def _(spark, sf):
    out = A.orders_by(D.derived(spark, sf, D.ORDERS), status="FILLED", now=F.lit("2000-05-01 00:00:00"))
    return out.select("order_id", "account", "price")


@query(
    "flt6_orders_by_capped",
    f"SELECT order_id, price FROM ({ORDERS}) o WHERE entered_time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31' ORDER BY"
    " entered_time DESC, order_id LIMIT 25",
)
def _(spark, sf):
    out = A.orders_by(D.derived(spark, sf, D.ORDERS), from_ts="1996-01-01", to_ts="1999-12-31", max_results=25)
    return out.select("order_id", "price")


@query(
    "flt7_order_status_is",
    "SELECT order_id, status = 'QUEUED' AS is_queued, status = 'WORKING' AS is_working, false AS is_cancelled FROM"
    f" ({ORDERS}) o",
)
def _(spark, sf):
    return A.order_flags(D.derived(spark, sf, D.ORDERS)).select("order_id", "is_queued", "is_working", "is_cancelled")


_TX = (
    "SELECT o_orderkey AS transaction_id, CASE o_orderkey % 4 WHEN 0 THEN 'TRADE' WHEN 1 THEN 'JOURNAL' WHEN 2 THEN 'WIRE_IN' ELSE"
    " 'MARGIN_CALL' END AS type, concat('P', cast(o_custkey % 50 AS string)) AS symbol, o_orderdate AS ts, o_totalprice AS amount FROM"
    " {orders}"
)


@query(
    "flt8_transactions_by",
    f"SELECT transaction_id, type, amount FROM ({D.oracle_text(_TX)}) t WHERE type IN ('TRADE', 'WIRE_IN') AND symbol = 'P8' AND ts"
    " BETWEEN TIMESTAMP '1996-06-01' AND TIMESTAMP '1999-06-30'",
)
def _(spark, sf):
    out = A.transactions_by(
        D.derived(spark, sf, _TX), ["TRADE", "WIRE_IN"], symbol="P8", start="1996-06-01", end="1999-06-30"
    )
    return out.select("transaction_id", "type", "amount")


def _instruments_query(name: str, pattern: str, projection: str, where: str) -> None:
    @query(f"flt9_search_instruments_{name}", f"SELECT symbol, description, cusip FROM ({INSTRUMENTS}) i WHERE {where}")
    def _(spark, sf):
        return A.search_instruments(D.derived(spark, sf, D.INSTRUMENTS), pattern, projection)


_instruments_query("symbol", "P17", "symbol-search", "symbol = 'P17' OR cusip = 'P17'")
_instruments_query("symbol_regex", "P1[0-4].*", "symbol-regex", "regexp_full_match(symbol, 'P1[0-4].*')")
_instruments_query("word", "Ring", "desc-search", "list_contains(regexp_split_to_array(lower(description), '\\W+'), 'ring')")
_instruments_query("desc_regex", "wid[a-z]+t", "desc-regex", "regexp_matches(description, '\\b(?:wid[a-z]+t)')")


@query(
    "prj12_quote_sections",
    "SELECT concat('P', p_partkey) AS symbol, p_retailprice AS lastPrice, p_name AS description FROM part",
)
def _(spark, sf):
    documents = D.table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"),
        F.struct(F.col("p_retailprice").alias("lastPrice"), F.col("p_size").alias("bidSize")).alias("quote"),
        F.struct(F.col("p_name").alias("description")).alias("reference"),
        F.struct(F.lit(0.0).alias("divAmount")).alias("fundamental"),
    )
    out = TB.sections(documents, ["quote", "reference"])
    return out.select("symbol", "quote.lastPrice", "reference.description")


# --------------------------------------------------------------------------- feeds


def feed_messages(spark, sf):
    """A message per event: one equity item and one option item, every seventh with an unknown field."""
    e = D.table(spark, sf, "events", wide=True)
    price, number = F.col("value").cast("string"), F.col("event_id").cast("string")
    equity = F.create_map(
        F.lit("0"), F.concat(F.lit("U"), (F.col("user_id") % 20).cast("string")), F.lit("1"), price,
        F.lit("8"), number, F.lit("15"), F.col("event_type"),
        F.lit("34"), F.unix_millis("ts").cast("string"),
        F.when(F.col("event_id") % 7 == 0, F.lit("99")).otherwise(F.lit("2")), F.lit("7.5"),
    )
    option = F.create_map(F.lit("0"), F.concat(F.lit("O"), number), F.lit("2"), F.lit("oops"), F.lit("9"), number)
    data = F.array(
        F.struct(F.lit("LEVELONE_EQUITIES").alias("service"), F.unix_millis("ts").alias("timestamp"),
                 F.lit("SUBS").alias("command"), F.array(equity).alias("content")),
        F.struct(F.lit("LEVELONE_OPTIONS").alias("service"), F.unix_millis("ts").alias("timestamp"),
                 F.lit("SUBS").alias("command"), F.array(option, option).alias("content")),
    )
    return e.select(F.to_json(F.struct(data.alias("data"))).alias("value"))


@query(
    "str7_decode_feed_equities",
    "SELECT concat('U', user_id % 20) AS SYMBOL, value AS BID_PRICE, CASE WHEN event_id % 7 <> 0 THEN 7.5::double END AS ASK_PRICE,"
    " event_id AS TOTAL_VOLUME, event_type AS DESCRIPTION, epoch_us(ts) // 1000 AS QUOTE_TIME_MILLIS, CASE WHEN event_id % 7 = 0"
    " THEN '7.5' END AS unknown_99 FROM events",
)
def _(spark, sf):
    rows = FD.decode_feed(feed_messages(spark, sf), "LEVELONE_EQUITIES")
    return rows.select(
        "SYMBOL", "BID_PRICE", "ASK_PRICE", "TOTAL_VOLUME", "DESCRIPTION", "QUOTE_TIME_MILLIS",
        F.try_element_at("other_fields", F.lit("99")).alias("unknown_99"),
    )


@query(
    "str7_decode_feed_options",
    "SELECT 'O' || event_id AS SYMBOL, NULL::double AS BID_PRICE, event_id AS OPEN_INTEREST FROM events, (VALUES (0), (1)) v(k)",
)
def _(spark, sf):
    return FD.decode_feed(feed_messages(spark, sf), "LEVELONE_OPTIONS").select("SYMBOL", "BID_PRICE", "OPEN_INTEREST")


@query(
    "str7_services_parsed_once",
    "SELECT 'LEVELONE_EQUITIES' AS service, count(*) AS items, count(DISTINCT user_id % 20) AS symbols FROM events"
    " UNION ALL SELECT 'LEVELONE_OPTIONS', 2 * count(*), count(*) FROM events",
)
def _(spark, sf):
    path = run_dir(spark, "feed")
    FD.write_by_service(FD.parse_feed(feed_messages(spark, sf)), path)
    items = spark.read.parquet(path)
    counts = [
        FD.feed_fields(items, s).groupBy("service").agg(F.count(F.lit(1)).alias("items"), F.countDistinct("SYMBOL").alias("symbols"))
        for s in ("LEVELONE_EQUITIES", "LEVELONE_OPTIONS")
    ]
    return counts[0].union(counts[1])


@query(
    "prj5_relabel_fields",
    "SELECT event_id, concat('U', user_id % 20) AS SYMBOL, CASE WHEN event_id % 7 = 0 THEN 'kept' ELSE 'named' END AS extra_key FROM events",
)
def _(spark, sf):
    e = D.table(spark, sf, "events")
    raw = F.create_map(
        F.lit("0"), F.concat(F.lit("U"), (F.col("user_id") % 20).cast("string")),
        F.when(F.col("event_id") % 7 == 0, F.lit("99")).otherwise(F.lit("2")), F.lit("7.5"),
    )
    mapping = {str(i): n for i, n in enumerate(SERVICE_FIELDS["LEVELONE_EQUITIES"])}
    named = e.select("event_id", FD.relabel_fields(raw, mapping).alias("m"))
    kept = F.when(F.map_contains_key("m", "99"), "kept").when(F.map_contains_key("m", "ASK_PRICE"), "named")
    return named.select("event_id", F.element_at("m", "SYMBOL").alias("SYMBOL"), kept.alias("extra_key"))


# one book per lineitem: two bid levels, the first on two exchanges, and one ask level
@query(
    "str8_decode_book",
    "SELECT 'P' || l_partkey AS symbol, l_orderkey AS book_time, side, price, level_volume, level_count, exchange, volume, sequence"
    " FROM (SELECT l_partkey, l_orderkey, 'BID' AS side, l_extendedprice AS price, 30 AS level_volume, 2 AS level_count, 'NYSE' AS"
    " exchange, 10 AS volume, l_linenumber AS sequence FROM lineitem UNION ALL SELECT l_partkey, l_orderkey, 'BID', l_extendedprice,"
    " 30, 2, 'ARCX', 20, l_linenumber + 1 FROM lineitem UNION ALL SELECT l_partkey, l_orderkey, 'BID', l_extendedprice - 1, 5, 1,"
    " 'NYSE', 5, l_linenumber FROM lineitem UNION ALL SELECT l_partkey, l_orderkey, 'ASK', l_extendedprice + 1, 7, 1, 'BATS', 7,"
    " l_linenumber FROM lineitem) x",
)
def _(spark, sf):
    def exchange(name, volume, step):
        return F.struct(F.lit(name).alias("0"), F.lit(volume).alias("1"), (F.col("l_linenumber") + step).alias("2"))

    def level(shift, volume, *exchanges):
        return F.struct((F.col("l_extendedprice") + shift).alias("0"), F.lit(volume).alias("1"),
                        F.lit(len(exchanges)).alias("2"), F.array(*exchanges).alias("3"))

    book = F.struct(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("0"), F.col("l_orderkey").alias("1"),
        F.array(level(0, 30, exchange("NYSE", 10, 0), exchange("ARCX", 20, 1)), level(-1, 5, exchange("NYSE", 5, 0))).alias("2"),
        F.array(level(1, 7, exchange("BATS", 7, 0))).alias("3"),
    )
    message = F.struct(F.array(F.struct(F.lit("NYSE_BOOK").alias("service"), F.array(book).alias("content"))).alias("data"))
    messages = D.table(spark, sf, "lineitem", wide=True).select(F.to_json(message).alias("value"))
    return FD.decode_book(messages, "NYSE_BOOK").drop("service")


@query(
    "str9_split_notifications",
    "SELECT kind, service, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN 'response' WHEN event_type = 'click' THEN"
    " 'notify' ELSE 'data' END AS kind, CASE WHEN event_type = 'error' THEN 'ADMIN' ELSE 'CHART_EQUITY' END AS service FROM events"
    " WHERE event_type <> 'view') x GROUP BY ALL",
)
def _(spark, sf):
    e = D.table(spark, sf, "events")
    item = F.when(F.col("event_type") == "view", '{"notify":[{"heartbeat":"1700000000000"}]}').when(
        F.col("event_type") == "error", '{"response":[{"service":"ADMIN","content":{"code":3,"msg":"bad"}}]}'
    ).when(F.col("event_type") == "click", '{"notify":[{"service":"CHART_EQUITY"}]}').otherwise(
        '{"data":[{"service":"CHART_EQUITY","content":[]}]}'
    )
    parts = FD.split_notifications(e.select(item.alias("value")))
    return parts.groupBy("kind", "service").agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg13_malformed_ratio",
    "SELECT count(*) AS cnt, count(CASE WHEN event_type = 'error' THEN 1 END) AS malformed, round(count(CASE WHEN event_type ="
    " 'error' THEN 1 END) / count(*), 9) AS ratio, false AS alert FROM events",
)
def _(spark, sf):
    e = D.table(spark, sf, "events").withColumn("error", F.when(F.col("event_type") == "error", F.col("props")))
    return rounded(QL.malformed_ratio(e, "error"), 9, "ratio")
