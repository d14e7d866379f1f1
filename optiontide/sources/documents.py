"""HTML tables, fundamentals and market-hours documents."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from optiontide.schemas import FUNDAMENTALS_DOCUMENT, MARKET_HOURS_DOCUMENT

CELL_COLUMNS = ["page_id", "table_no", "row_no", "header", "cell"]
CELLS_PER_SLICE = 20_000
TABLE_CELLS = "page_id bigint, table_no int, row_no int, header string, cell string"


class _TableReader(HTMLParser):
    """Cells of the tables of one class in one page."""

    def __init__(self, table_class: str | None) -> None:
        super().__init__()
        self.wanted, self.cells = table_class, []
        self.depth, self.table = 0, -1
        self.headers: list[str] = []
        self.row: list[str] = []
        self.row_no, self.text = 0, None
        self.first_row = True  # the first row of a table is its header row

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            if self.depth or self.wanted is None or dict(attrs).get("class") == self.wanted:
                self.depth += 1
                if self.depth == 1:
                    self.table, self.headers, self.row_no = self.table + 1, [], 0
                    self.first_row = True
        elif self.depth and tag == "tr":
            self._end_row()
        elif self.depth and tag in ("th", "td"):
            self._end_cell()
            self.text = (tag, [])

    def handle_data(self, data):
        if self.text:
            self.text[1].append(data)

    def handle_endtag(self, tag):
        if not self.depth:
            return
        if tag in ("th", "td"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
            self.first_row = False
        elif tag == "table":
            self._end_row()
            self.depth -= 1

    def _end_cell(self):
        if self.text:
            tag, parts = self.text
            (self.headers if tag == "th" else self.row).append("".join(parts).strip())
            self.text = None

    def _end_row(self):
        self._end_cell()
        if self.row and not self.first_row:
            self.row_no += 1
            for i, cell in enumerate(self.row):
                header = self.headers[i] if i < len(self.headers) else None
                self.cells.append((self.table, self.row_no, header, cell))
        self.row = []


def extract_html_tables(pages: DataFrame, table_class: str | None = None, html: str = "html") -> DataFrame:
    """Cells (page_id, table_no, row_no, header, cell) of the tables of ``table_class``, or of all.

    Pages are independent, so the work is spread by page; only pages that hold
    a table tag at all are handed to Python. Rows of a table inside a table
    count as rows of the outer one.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page_id, text in zip(batch["page_id"], batch[html]):
                reader = _TableReader(table_class)
                reader.feed(text)
                reader.close()
                rows += [(page_id, *cell) for cell in reader.cells]
                if len(rows) >= CELLS_PER_SLICE:
                    yield pd.DataFrame(rows, columns=CELL_COLUMNS)
                    rows = []
            yield pd.DataFrame(rows, columns=CELL_COLUMNS)

    candidates = pages.select("page_id", html).filter(F.col(html).rlike("(?i)<table"))
    return candidates.mapInPandas(read, TABLE_CELLS)


def pivot_table_rows(cells: DataFrame, headers: list[str], keys: tuple[str, ...] = ("page_id", "table_no", "row_no")) -> DataFrame:
    """One row per table row with a text column per known header."""
    return cells.groupBy(*keys).agg(*[F.max(F.when(F.col("header") == h, F.col("cell"))).alias(h) for h in headers])


def parse_fundamentals(df: DataFrame, value: str = "value") -> DataFrame:
    """One row per symbol of documents {symbol: record}; divAmount defaults to 0."""
    entries = df.select(F.explode(F.from_json(F.col(value), FUNDAMENTALS_DOCUMENT)).alias("symbol", "r"))
    names = [f.name for f in FUNDAMENTALS_DOCUMENT.valueType["fundamental"].dataType.fields if f.name != "divAmount"]
    return entries.select(
        "symbol",
        "r.assetMainType", "r.assetSubType", "r.ssid",
        F.coalesce("r.fundamental.divAmount", F.lit(0.0)).alias("divAmount"),
        *[f"r.fundamental.{n}" for n in names],
    )


def read_documents(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """JSON documents as ``value``: one per line, or with ``whole_files`` one per file that may span lines.

    Blank lines and empty files are skipped. A whole file whose first line is a
    document of its own with more below it would lose the others, so it fails the job.
    """
    text = spark.read.text(path, wholetext=whole_files).filter("trim(value) <> ''")
    if not whole_files:
        return text
    first = F.regexp_extract("value", r"^\s*([^\r\n]*)", 1)
    more = F.col("value").rlike(r"^\s*[^\r\n]*[\r\n]+\s*\S") & F.json_object_keys(first).isNotNull()
    refused = F.raise_error(F.lit(f"several documents in one file below {path}: read it line by line"))
    return text.select(F.when(more, refused.cast("string")).otherwise(F.col("value")).alias("value"))


def read_fundamentals(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Fundamentals of all documents under ``path``; see ``read_documents``."""
    return parse_fundamentals(read_documents(spark, path, whole_files))


def parse_market_hours(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows (date, market, product, phase, start, end, is_open).

    A product without session hours keeps one row with null phase and times.
    Top-level fields beside the markets are skipped.
    """
    markets = df.select(F.explode(F.from_json(F.col(value), T.MapType(T.StringType(), T.StringType()))).alias("market", "doc"))
    items = markets.filter(F.col("doc").startswith("{")).select(
        "market", F.explode(F.from_json("doc", MARKET_HOURS_DOCUMENT)).alias("product", "p")
    )
    phases = items.select("market", "product", "p", F.explode_outer("p.sessionHours").alias("phase", "spans"))
    spans = phases.select("market", "product", "p", "phase", F.explode_outer("spans").alias("s"))
    return spans.select(
        F.col("p.date").cast("date").alias("date"), "market", "product", "phase",
        _instant(F.col("s.start")).alias("start"), _instant(F.col("s.end")).alias("end"),
        F.col("p.isOpen").alias("is_open"),
    )


def _instant(text: Column) -> Column:
    return text.try_cast("timestamp")


def read_market_hours(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Market hours of all documents under ``path``; see ``read_documents``."""
    return parse_market_hours(read_documents(spark, path, whole_files))
