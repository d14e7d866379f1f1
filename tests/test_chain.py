import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from optiontide import schemas as SCH
from optiontide.operators import chain as CH
from optiontide.operators import tables as TB
from optiontide.plans import derived as D
from optiontide.operators import schedule as S
from optiontide.operators import sessions as SS
from optiontide.plans.enrich import PARAMS, enrich_contracts, enrich_fetch_day
from optiontide.plans.process import process_messages
from optiontide.sources import chains as SC


def contract(symbol, side, strike, **more):
    return {"symbol": symbol, "putCall": side, "strikePrice": strike, "mark": 5.0, "intrinsicValue": 1.0,
            "expirationDate": "2024-01-19T20:00:00.000+00:00", "exerciseType": "E", "delta": 0.12567, **more}


def document(symbol, calls, puts, **more):
    return {"symbol": symbol, "status": "SUCCESS", "underlyingPrice": 100.0, "fetchTime": "2024-01-02 19:30:00",
            "dividendAmount": 0.5, "isIndex": False, "callExpDateMap": calls, "putExpDateMap": puts, **more}


DOCUMENTS = [
    document("A", {"2024-01-19:17": {"95.0": [contract("A1", "CALL", 95.0), contract("A2", "CALL", 95.0)],
                                     "100.0": [contract("A3", "CALL", 100.0)]},
                   "2024-02-16:45": {"95.0": [contract("A4", "CALL", 95.0)]}},
             {"2024-01-19:17": {"95.0": [contract("A5", "PUT", 95.0)]}}),
    document("B", None, {"2024-01-19:17": {"50.0": [contract("B1", "PUT", 50.0)]}}),
    document("C", {}, {}),
    document("D", {"2024-01-19:17": {}}, {"2024-01-19:17": {"1.0": []}}, status="FAILED"),
]


@pytest.fixture(scope="module")
def messages(spark):
    rows = [(d["symbol"], gzip.compress(json.dumps(d).encode())) for d in DOCUMENTS]
    rows += [("bad", b"no gzip"), ("cut", gzip.compress(b"{}" * 400)[:20]), ("text", gzip.compress(b"not json")), ("null", None)]
    return spark.createDataFrame(rows, "key string, value binary")


def test_decode_and_flatten(messages):
    chains = SC.decode_chain_payload(messages, record_status="state")
    states = [r.state for r in chains.collect()]
    assert states == ["ok"] * 4 + ["unreadable", "unreadable", "not_json", "unreadable"]
    rows = CH.flatten_chain(chains, keep_keys=True).collect()
    assert sorted((r.symbol, r.strikeKey, r.expiryKey) for r in rows) == [
        ("A1", "95.0", "2024-01-19:17"), ("A2", "95.0", "2024-01-19:17"), ("A3", "100.0", "2024-01-19:17"),
        ("A4", "95.0", "2024-02-16:45"), ("A5", "95.0", "2024-01-19:17"), ("B1", "50.0", "2024-01-19:17"),
    ]
    assert {r.delta for r in rows} == {0.12567} and {str(r.mark) for r in rows} == {"5.00"}


def test_decimal_greeks(messages):
    chains = SC.decode_chain_payload(messages, greeks="decimal(10,2)")
    assert {str(r.delta) for r in CH.flatten_chain(chains).collect()} == {"0.13"}


def test_flatten_decodes_a_chain_once(messages):
    plan = CH.flatten_chain(SC.decode_chain_payload(messages))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_stored_rows_parse_a_chain_once(spark, messages):
    schedule = spark.createDataFrame([("2024-01-19", 0.05, 0.06)], "iso_date string, T_eqo double, T_ind double")
    params = {"beta0": 0.04, "beta1": 0.0, "beta2": 0.0, "beta3": 0.0, "tau1": 1.0, "tau2": 2.0}
    close = F.lit("2024-01-02 21:00:00"), F.lit("2024-01-02 21:15:00")
    rows = process_messages(messages, schedule, params, *close)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(") == 1 and text.count("ArrowEvalPython") == 2  # one unzip, one solver
    nameless = spark.createDataFrame(
        [(b"k", gzip.compress(json.dumps({**DOCUMENTS[0], "symbol": None}).encode()))], "key binary, value binary")
    assert rows.count() == 6 and process_messages(nameless, schedule, params, *close).count() == 0


def test_round_trip(messages):
    chains = SC.decode_chain_payload(messages).filter("symbol is not null")
    again = SC.decode_chain_payload(SC.encode_chains(chains.withColumn("response", F.lit("raw"))))
    assert sorted(map(str, CH.flatten_chain(again).collect())) == sorted(map(str, CH.flatten_chain(chains).collect()))


def test_valid_chains(messages):
    good, bad = CH.valid_chains(SC.decode_chain_payload(messages))
    assert [r.symbol for r in good.collect()] == ["A"]
    assert bad.count() == 7


def test_null_routing(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, 1.0, 1.0), (3, None, 1.0), (4, 1.0, None)], "id int, mark double, intrinsicValue double")
    good, rest = CH.split_iv_eligible(df)
    assert [r.id for r in good.collect()] == [1] and [r.id for r in rest.collect()] == [2, 3, 4]
    _, rest = CH.split_iv_eligible(df, drop_nulls=True)
    assert [r.id for r in rest.collect()] == [2]


def test_filter_arguments():
    for bad in ({"contract_type": "STRADDLE"}, {"opt_range": "XYZ"}, {"exp_month": "FOO"}, {"option_type": "Q"}):
        with pytest.raises(ValueError):
            CH.filter_chain(None, **bad)
    assert CH.chain_request() == {"strategy": "SINGLE"}
    assert CH.chain_request("single", volatility=0.3) == {"strategy": "SINGLE"}
    assert CH.chain_request("analytical", volatility=0.3, interest_rate=None) == {"strategy": "ANALYTICAL", "volatility": 0.3}


def test_filter_chain_ranges(spark):
    rows = [("T", k, 100.0, "CALL", k < 100, False, "2024-11-15T") for k in (80.0, 95.0, 99.0, 100.0, 101.0, 104.0, 130.0)]
    df = spark.createDataFrame(
        rows, "ticker string, strikePrice double, underlyingPrice double, putCall string, inTheMoney boolean,"
        " nonStandard boolean, expirationDate string").withColumn("fetchTime", F.lit(1))

    def strikes(**kw):
        return sorted(r.strikePrice for r in CH.filter_chain(df, **kw).collect())

    assert strikes(opt_range="ITM") == [80.0, 95.0, 99.0]
    assert strikes(opt_range="SAK") == [101.0, 104.0, 130.0]
    assert strikes(opt_range="SBK") == [80.0, 95.0, 99.0]
    assert strikes(opt_range="SNK", near_pct=0.02) == [99.0, 100.0, 101.0]
    assert strikes(strike_count=2) == [95.0, 99.0, 100.0, 101.0]
    assert strikes(strike=104.001) == [104.0]
    assert strikes(exp_month="NOV", contract_type="put") == []
    assert strikes(option_type="NS") == []


def test_conform(spark):
    df = spark.createDataFrame([("S", 1.005, None)], "symbol string, price double, t string")
    schema = SCH.T.StructType([SCH.T.StructField("symbol", SCH.T.StringType(), False), SCH.T.StructField("p", SCH.PRICE),
                               SCH.T.StructField("missing", SCH.T.IntegerType())])
    row = TB.conform(df, schema, {"price": "p"}).first()
    assert (row.symbol, str(row.p), row.missing) == ("S", "1.01", None)
    with pytest.raises(Exception, match="null in required column"):
        TB.conform(df.withColumn("symbol", F.lit(None).cast("string")), schema, {"price": "p"}).collect()
    with pytest.raises(ValueError):
        TB.conform(df.drop("symbol"), schema)


def test_compute_on_distinct_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (None, 3.0)], "a int, b double")
    doubled = {"c": F.coalesce("a", F.lit(0)) + F.col("b")}
    assert sorted(r.c for r in TB.compute_on_distinct(df, ["a", "b"], doubled).collect()) == [3.0, 3.0, 3.0]
    assert [r.c for r in TB.compute_on_distinct(df, ["a", "b"], doubled, match_nulls=False).collect()].count(None) == 1


def test_enrich_rows(spark):
    docs = [
        document("A", {"e": {"k": [contract("A1", "CALL", 95.0, intrinsicValue=5.0, mark=8.0),
                                   contract("A2", "CALL", 95.0, intrinsicValue=5.0, mark=5.0)]}},
                 {"e": {"k": [contract("A3", "PUT", 95.0, mark=None)]}}),
    ]
    chains = SC.parse_chain(spark.createDataFrame([(json.dumps(d),) for d in docs], "text string"), "text")
    schedule = spark.createDataFrame([("2024-01-19", 0.05, 0.06)], "iso_date string, T_eqo double, T_ind double")
    params = {"beta0": 0.04, "beta1": 0.0, "beta2": 0.0, "beta3": 0.0, "tau1": 1.0, "tau2": 2.0}
    out = enrich_fetch_day(chains, schedule, params, F.lit("2024-01-02 21:00:00"), F.lit("2024-01-02 21:15:00"))
    rows = {r.symbol: r for r in out.collect()}
    assert rows["A1"].iv_mark > 0 and abs(rows["A1"].t - (0.05 + 5400 / 5896800)) < 1e-12
    assert json.loads(rows["A1"].extra).keys() == {"q", "r", "t", "dividendAmount", "isIndex"}
    for s in ("A2", "A3"):
        assert rows[s].t is None and rows[s].r is None and rows[s].iv_mark is None
        assert json.loads(rows[s].extra).keys() == {"q", "dividendAmount", "isIndex"}


def test_enrichment_over_fetch_days_is_that_of_each_day(spark):
    def chains(fetched):
        docs = [document(name, {"e": {"k": [contract(f"{name}{k}", "CALL", 90.0 + k, intrinsicValue=10.0 - k, mark=11.0 - k / 2, expirationDate=day)]}}, {})
                for name in "AB" for k, day in enumerate(("2024-01-19T21:00:00.000+00:00", "2024-03-15T20:00:00.000+00:00", "2024-01-20T21:00:00.000+00:00"))]
        parsed = SC.parse_chain(spark.createDataFrame([(json.dumps(d),) for d in docs], "text string"), "text")
        return parsed.withColumn("fetchTime", F.lit(fetched).cast("timestamp"))

    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-03-31')) AS day")
    sessions = SS.session_table(days)
    curves = [("2024-01-02", 0.04), ("2024-01-09", 0.05)]
    rest = {"beta1": 0.01, "beta2": 0.0, "beta3": 0.002, "tau1": 1.0, "tau2": 2.0}
    table = spark.createDataFrame([(d, b, *rest.values()) for d, b in curves], f"day string, {', '.join(f'{p} double' for p in PARAMS)}")
    fetched = {"2024-01-03 15:00:00": (0.04, "2024-01-03"), "2024-01-10 20:59:00": (0.05, "2024-01-10"), "2024-01-17 22:00:00": (0.05, "2024-01-17")}
    parts = [chains(f) for f in fetched]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    keys = ("symbol", "fetchTime", "t", "r", "iv_mark", "extra", "q")
    plain = lambda rows: sorted([tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in rows], key=str)
    got = plain(enrich_contracts(together, sessions, table).select(*keys).collect())
    want = []
    for f, (beta0, day) in fetched.items():
        one = enrich_fetch_day(chains(f), S.expiry_schedule(sessions, day), {"beta0": beta0, **rest}, F.lit(f"{day} 21:00:00"), F.lit(f"{day} 21:15:00"))
        want += one.select(*keys).collect()
    no_json = lambda rows: [r[:5] + r[6:] for r in rows]
    assert no_json(got) == no_json(plain(want)) and len(got) == 18
    assert sum(r[4] is not None for r in got) >= 8 and sum(r[2] is None for r in got) >= 6
    before = enrich_contracts(chains("2024-01-03 15:00:00"), sessions, table.filter("day > '2024-01-05'")).collect()
    assert all(r.r is None and r.iv_mark is None for r in before) and any(r.t is not None for r in before)


def test_topic_and_limits():
    assert SC.topic_name(dt.date(2024, 1, 2)) == "option_chain_topic_20240102"
    assert SC.max_per_trigger(3) == 6 and SC.max_per_trigger(1, per_minute=90) == 2
    assert SC.kafka_options("h:1", "t", 4)["maxOffsetsPerTrigger"] == "4"


def test_filters_reach_the_scan(spark, sf_dir):
    plan = D.table(spark, sf_dir, "lineitem").filter("l_quantity >= 50").select("l_partkey")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,50.0)" in text and "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
