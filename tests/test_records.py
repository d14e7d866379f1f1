import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from optiontide.functions import orders as FO
from optiontide.functions import symbols as Y
from optiontide.functions.feed_fields import SERVICE_FIELDS
from optiontide.operators import accounts as A
from optiontide.operators import capacity as Q
from optiontide.operators import feeds as FD
from optiontide.operators import ranking as RK
from optiontide.operators import universe as U


def account(number, kind, **balances):
    return {"accountId": number, "type": kind, "currentBalances": {"cashBalance": 1.0, "longMarketValue": 2.0, **balances},
            "positions": [{"averagePrice": 3.0, "marketValue": 4.0, "instrument": {"symbol": "X", "cusip": "1", "assetType": "EQUITY"}}]}


def test_accounts(spark):
    docs = [{"a": account("1", "CASH", buyingPower=9.0), "b": account("2", "MARGIN")}, [{"a": account("3", "CASH")}, {"a": account("4", "CASH")}]]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs] + [(None,)], "value string")
    balances = {r.account_number: r for r in A.flatten_account_balances(df).collect()}
    assert set(balances) == {"1", "2", "3", "4"} and balances["1"].buying_power == 9.0 and balances["2"].buying_power == 0.0
    assert len(balances["1"]) == 14
    rows = A.flatten_account_positions(df).collect()
    assert len(rows) == 4 and len(rows[0]) == 15 and rows[0].description == "" and rows[0].sub_asset_type == ""


def test_orders_and_transactions(spark):
    with pytest.raises(ValueError):
        FO.order_status_is("status", "filled")
    assert len(FO.ORDER_STATES) == 12
    df = spark.createDataFrame([(1, "TRADE"), (2, "JOURNAL")], "transaction_id int, type string")
    assert [r.transaction_id for r in A.transactions_by(df, transaction_id=2).collect()] == [2]
    with pytest.raises(ValueError):
        A.transactions_by(df, ["BARTER"])
    flags = spark.createDataFrame([("CANCELED",), (None,)], "status string").select(FO.order_status_is("status", "cancelled").alias("c"))
    assert [r.c for r in flags.collect()] == [True, False]


def test_bracket_prices(spark):
    df = spark.createDataFrame([(10.126,), (0.5,), (1.02,)], "price double")
    prices = FO.bracket_prices("price", 0.1, 0.05, 0.02, profit_percent=True)
    rows = [tuple(r) for r in df.select(*prices.values()).collect()]
    assert rows[0] == (Decimal("11.1400"), Decimal("10.0800"), Decimal("10.1100"))
    assert rows[1] == (Decimal("0.5500"), Decimal("0.4500"), Decimal("0.4800"))
    assert rows[2] == (Decimal("1.1200"), Decimal("0.9700"), Decimal("1.0000"))


def test_occ_symbols(spark):
    df = spark.createDataFrame(
        [("QQQ   240420P00500000",), ("SPXW  240420C05040000",), ("SPXW  240420C05040500",), ("bad",), ("QQQ   249920P00500000",), (None,)],
        "s string")
    out = df.select("s", Y.parse_occ_symbol("s").alias("p")).select("s", "p.*").withColumn(
        "again", Y.build_occ_symbol("root", "expiry", "put_call", "strike")).collect()
    assert [(r.root, str(r.expiry), r.put_call, r.strike and float(r.strike)) for r in out[:3]] == [
        ("QQQ", "2024-04-20", "P", 500.0), ("SPXW", "2024-04-20", "C", 5040.0), ("SPXW", "2024-04-20", "C", 5040.5)]
    assert all(r.again == r.s for r in out[:3]) and all(r.root is None for r in out[3:])
    exact = spark.sql("SELECT 'A' r, date'2024-01-19' d, 'CALL' c, cast(1.005 AS decimal(8,3)) k")
    assert exact.select(Y.build_occ_symbol("r", "d", "c", "k")).first()[0] == "A     240119C00001005"


def test_option_master_symbols(spark):
    rows = [("AAPL  240119C00123500", "AAPL"), ("BRKB240119P00100000", "BRKB"), ("X     249919C00100000", "X"),
            ("Y     240119C", "Y"), ("Z     240119C00000500", "Z"), ("N     240119C00001000", None)]
    df = spark.createDataFrame(rows, "optionID string, underlying string")
    assert [r.symbol for r in U.normalise_option_master(df).collect()] == [
        "AAPL_011924C123.5", "BRKB_011924P100", "", "", "Z_011924C0.5", ""]


def test_universe(spark):
    def names(*values):
        return spark.createDataFrame([(v,) for v in values], "symbol string")

    options, equities = names("SPX", "AAPL", "BRK B", "CHUY"), names("AAPL", "BRK B", "CHUY", "IBM")
    assert sorted(r.symbol for r in U.option_universe(options, equities).collect()) == ["$SPX", "AAPL", "BRK.B", "CHUY"]
    assert sorted(r.symbol for r in U.option_universe(options, equities, ["BRK.B", "CHUY"]).collect()) == ["$SPX", "AAPL"]
    assert sorted(r.symbol for r in U.index_options(options, equities).collect()) == ["$SPX"]
    assert sorted(r.symbol for r in U.equity_options(options, equities).collect()) == ["AAPL", "BRK.B", "CHUY"]
    master = spark.createDataFrame([("nan", "N"), (None, "N"), ("A", "N"), ("A", "N"), ("T", "Y")], "underlying string, test_issue_flag string")
    assert [r.symbol for r in U.option_underlyings(master).collect()] == ["A"]
    chunks = U.chunk_symbols(names(*[f"S{i:03d}" for i in range(23)]), 4).orderBy("symbol").collect()
    assert [r.chunk for r in chunks] == [1] * 6 + [2] * 6 + [3] * 6 + [4] * 5
    assert [r.symbol for r in U.head_symbols(names("B", "A", "C"), 1, 2).collect()] == ["A", "B"]


def test_feed(spark):
    assert [len(SERVICE_FIELDS[s]) for s in ("LEVELONE_EQUITIES", "LEVELONE_OPTIONS", "LEVELONE_FUTURES", "LEVELONE_FOREX")] == [52, 56, 41, 30]
    msg = {"data": [{"service": "CHART_EQUITY", "timestamp": 5, "content": [{"0": "A", "2": 1.5, "6": 10, "key": "A", "7": "x"}]},
                    {"service": "OTHER", "content": [{"0": "B"}]}]}
    df = spark.createDataFrame([(json.dumps(msg),), ("garbage",), ('{"notify":[{"heartbeat":"1"}]}',)], "value string")
    (row,) = FD.decode_feed(df, "CHART_EQUITY").collect()
    assert (row.SYMBOL, row.OPEN_PRICE, row.VOLUME, row.CHART_TIME_MILLIS, row.other_fields) == ("A", 1.5, 10, None, {"key": "A"})
    assert FD.split_notifications(df).count() == 2
    with pytest.raises(ValueError):
        FD.decode_feed(df, "NOPE")
    with pytest.raises(ValueError):
        FD.decode_book(df, "CHART_EQUITY")


def test_capacity_with_queued(spark):
    requests = spark.sql("SELECT 1 AS client, timestamp'2024-01-01 00:00:00' + make_dt_interval(0,0,0,s) AS ts FROM (SELECT explode(sequence(0, 50, 10)) s)")
    limits = spark.createDataFrame([(1, 6, 3), (2, 4, 0)], "client int, limit int, queued int")
    now = "2024-01-01 00:00:55"
    plain = {r.client: r for r in Q.next_available(requests, limits, now).collect()}
    assert plain[1].capacity == 0 and str(plain[1].next_ts) == "2024-01-01 00:01:00" and str(plain[2].next_ts) == now
    queued = {r.client: r for r in Q.next_available(requests, limits, now, include_queued=True).collect()}
    assert str(queued[1].next_ts) == "2024-01-01 00:01:20"  # the third oldest request frees the slot
    projected = {r.client: r for r in Q.project_schedule(requests, limits, now).collect()}
    assert projected[1].projected_capacity == 0 and projected[2].projected_capacity == 4
    assert projected[2].position == 1 and projected[1].position == 2
    edge = Q.requests_last_60s(requests, "2024-01-01 00:01:00").first()
    assert edge.used == 6  # the instant a minute ago counts


def test_movers(spark):
    df = spark.createDataFrame([(f"S{i:02d}", "X", i % 3, 1, (i - 10) / 100) for i in range(20)], "symbol string, universe string, volume int, trades int, pct_change double")
    top = RK.movers(df, "VOLUME").orderBy("rank").collect()
    assert len(top) == 10 and [r.symbol for r in top[:3]] == ["S02", "S05", "S08"]
    assert RK.movers(df, "PERCENT_CHANGE_UP").orderBy("rank").first().symbol == "S19"
    recent = df.withColumn("pct_change_5m", -F.col("pct_change"))
    assert RK.movers(recent, "PERCENT_CHANGE_UP", frequency=5).orderBy("rank").first().symbol == "S00"
    for bad in ({"sort": "SIZE"}, {"frequency": 7}):
        with pytest.raises(ValueError):
            RK.movers(df, **bad)


def test_search(spark):
    df = spark.createDataFrame([("XYZA", "Fake Company", "1"), ("AB", "XYZC holdings", "XYZA")], "symbol string, description string, cusip string")
    found = lambda *a: [r.symbol for r in A.search_instruments(df, *a).collect()]
    assert found("XYZA") == ["XYZA", "AB"] and found("XYZ.*", "symbol-regex") == ["XYZA"]
    assert found("company", "desc-search") == ["XYZA"] and found("XYZ[A-C]", "desc-regex") == ["AB"]
    with pytest.raises(ValueError):
        found("x", "other")


def test_adapt(spark):
    df = spark.createDataFrame([("BRK B", True), ("BRK B", False)], "s string, i boolean")
    assert [r.a for r in df.select(Y.adapt_symbol("s", "i").alias("a")).collect()] == ["$BRK.B", "BRK.B"]
    assert df.select(Y.adapt_symbol("s", True).alias("a")).first().a == "$BRK.B"
    assert df.filter(F.col("i")).count() == 1
