import json

import pytest

from optiontide.functions import calendar as C
from optiontide.operators import tables as TB
from optiontide.plans.curve_job import curves_from_pages, points_from_pages
from optiontide.sources import delimited as SD
from optiontide.sources import documents as DOC

PAGE = """<html><table class="other"><tr><td>x</td></tr></table>
<table class="yields"><thead><tr><th>Date</th><th> 1 Mo </th><th>2 Mo</th></tr></thead><tbody>
<tr><td> 01/02/2024 </td><td>5.55</td><td>N/A</td></tr>
<tr><td>01/03/2024</td><td>5.5<b>4</b></td><td>N/A</td></tr><tr></tr></tbody></table></html>"""


def test_html_table_to_numbers(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, None), (4, "<table class='yields'><tr><th>Date")], "page_id long, html string")
    cells = DOC.extract_html_tables(pages, "yields")
    assert {(r.row_no, r.header, r.cell) for r in cells.collect()} == {
        (1, "Date", "01/02/2024"), (1, "1 Mo", "5.55"), (1, "2 Mo", "N/A"),
        (2, "Date", "01/03/2024"), (2, "1 Mo", "5.54"), (2, "2 Mo", "N/A")}
    wide = DOC.pivot_table_rows(cells, ["Date", "1 Mo", "2 Mo"]).select("Date", "1 Mo", "2 Mo")
    kept = TB.to_numeric(TB.drop_null_columns(wide), ["1 Mo"])
    assert kept.columns == ["Date", "1 Mo"] and sorted(r["1 Mo"] for r in kept.collect()) == [5.54, 5.55]
    assert DOC.extract_html_tables(pages).filter("page_id = 1").count() == 6  # header-only first table gives no rows


def test_pages_to_curves(spark):
    labels = ["1 Mo", "6 Mo", "1 Yr", "2 Yr", "5 Yr", "10 Yr", "30 Yr"]
    head = "".join(f"<th>{x}</th>" for x in ["Date", *labels])
    body = "".join(
        f"<tr><td>01/0{d}/2024</td>" + "".join(f"<td>{v}</td>" for v in ["N/A", 5.3, 5.1, 4.6 + d / 10, 4.2, 4.1, 4.3]) + "</tr>"
        for d in (2, 3)
    )
    page = f"<table class='y'><tr>{head}</tr>{body}</table>"
    pages = spark.createDataFrame([(1, page)], "page_id long, html string")
    points = points_from_pages(pages, labels, "y")
    rows = {(str(r.ref_date), r.label): r for r in points.collect()}
    assert len(rows) == 12 and ("2024-01-02", "1 Mo") not in rows
    assert abs(rows["2024-01-03", "2 Yr"].y - 0.049) < 1e-12 and str(rows["2024-01-02", "6 Mo"].maturity_date) == "2024-06-30"
    fitted = curves_from_pages(pages, "nelson_siegel", labels=labels, table_class="y").collect()
    assert len(fitted) == 2 and all(r.points == 6 and r.sse < 1e-4 for r in fitted)


def test_symbol_master(spark, tmp_path):
    (tmp_path / "e.txt").write_text('symbol|name|mkt|test\nA|Acme "Inc|N|N\nB|Beta|U|Y\n')
    rows = SD.read_symbol_master(spark, str(tmp_path / "e.txt"), "equities").collect()
    assert [tuple(r) for r in rows] == [("A", 'Acme "Inc', "N", "N"), ("B", "Beta", "U", "Y")]


def test_delimited_rows(spark, tmp_path):
    lines = ["id,v"] + [f"{i},{i / 2}" for i in range(1, 5001)] + ["oops,x"]
    (tmp_path / "big.csv").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")  # several splits of one file
    try:
        def ids(**kw):
            return sorted(r.id for r in SD.read_delimited(spark, str(tmp_path / "big.csv"), "id int, v double", **kw).collect())

        assert ids() == list(range(1, 5001))
        assert ids(first_row=4000, last_row=4003) == [3999, 4000, 4001, 4002]
        assert ids(max_errors=1) == list(range(1, 5001))
        with pytest.raises(ValueError):
            ids(max_errors=0)
        assert ids(max_errors=0, last_row=5000)[-1] == 4999
        bad = SD.parse_delimited(spark, str(tmp_path / "big.csv"), "id int, v double").filter("bad_line is not null")
        assert bad.count() == 1
        assert SD.load_delimited(spark, str(tmp_path / "big.csv"), "id int, v double", str(tmp_path / "a"), max_errors=1) == (5000, 1)
        with pytest.raises(ValueError):
            SD.load_delimited(spark, str(tmp_path / "big.csv"), "id int, v double", str(tmp_path / "b"), max_errors=0)
        assert spark.read.parquet(str(tmp_path / "b")).filter("bad = 'true'").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fundamentals_file(spark, tmp_path):
    doc = {"A": {"symbol": "A", "ssid": 7, "fundamental": {"divAmount": 5.2, "divFreq": 4}}, "B": {"symbol": "B"}}
    (tmp_path / "f.json").write_text(json.dumps(doc, indent=1))
    rows = {r.symbol: r for r in DOC.read_fundamentals(spark, str(tmp_path / "f.json"), whole_files=True).collect()}
    assert (rows["A"].divAmount, rows["A"].divFreq, rows["A"].ssid, rows["B"].divAmount) == (5.2, 4, 7, 0.0)
    (tmp_path / "empty.json").write_text("")
    assert DOC.read_fundamentals(spark, str(tmp_path / "empty.json"), whole_files=True).count() == 0
    (tmp_path / "lines.json").write_text(json.dumps({"A": {"ssid": 1}}) + "\n\n" + json.dumps({"B": {"ssid": 2}}) + "\n")
    assert sorted(r.symbol for r in DOC.read_fundamentals(spark, str(tmp_path / "lines.json")).collect()) == ["A", "B"]
    with pytest.raises(Exception, match="several documents"):
        DOC.read_fundamentals(spark, str(tmp_path / "lines.json"), whole_files=True).collect()


def test_market_hours_file(spark, tmp_path):
    doc = {
        "forex": {"forex": {"date": "2024-08-10", "isOpen": True}},
        "option": {"EQO": {"date": "2024-08-10", "product": "EQO", "isOpen": False, "sessionHours": None}},
        "equity": {"EQ": {"date": "2024-08-10", "product": "EQ", "isOpen": True, "sessionHours": {
            "preMarket": [{"start": "2024-08-10T07:00:00-04:00", "end": "2024-08-10T09:30:00-04:00"}],
            "regularMarket": [{"start": "2024-08-10T09:30:00-04:00", "end": "2024-08-10T16:00:00-04:00"}]}}},
        "date": "2024-08-10",
    }
    (tmp_path / "h.json").write_text(json.dumps(doc, indent=1))
    rows = DOC.read_market_hours(spark, str(tmp_path / "h.json"), whole_files=True).collect()
    (tmp_path / "h2.json").write_text("\n".join([json.dumps(doc), "", json.dumps(doc)]))
    assert DOC.read_market_hours(spark, str(tmp_path / "h2.json")).count() == 2 * len(rows)
    assert sorted((r.market, r.phase or "") for r in rows) == [("equity", "preMarket"), ("equity", "regularMarket"), ("forex", ""), ("option", "")]
    assert str(next(r for r in rows if r.phase == "regularMarket").end) == "2024-08-10 20:00:00"
    df = spark.createDataFrame([(json.dumps(doc),), (json.dumps({**doc, "isOpen": True}),)], "doc string")
    out = df.select(C.is_open("doc").alias("any"), C.is_open("doc", "EQUITY").alias("eq"), C.get_document_date("doc").alias("d"),
                    C.get_markets("doc").alias("m"), C.get_hour("doc", "$.equity.EQ.sessionHours.preMarket[0].start").alias("h")).collect()
    assert [r.any for r in out] == [False, True] and out[0].eq is True and str(out[0].d) == "2024-08-10"
    assert out[0].m[:2] == ["FOREX", "OPTION"] and str(out[0].h) == "2024-08-10 11:00:00"


def test_lines_of_many_splits_are_numbered_without_a_sort_of_lines(spark, tmp_path):
    for name, rows in (("a", 3000), ("b", 700)):
        (tmp_path / f"{name}.csv").write_text("id;v\n" + "".join(f"{i};{'x' * (i % 40)}\n" for i in range(rows)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        read = SD.read_delimited(spark, str(tmp_path), "id int, v string", sep=";", first_row=11, last_row=2000)
        plan = read._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(r.id for r in read.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted([*range(9, 1999), *range(9, 700)])
    assert "row_number" not in plan
