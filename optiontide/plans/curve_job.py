"""From landed yield pages to curve points and parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from optiontide.operators.curves import calibrate_curves, curve_points
from optiontide.operators.tables import to_numeric
from optiontide.sources.documents import extract_html_tables, pivot_table_rows

# Class of the yield table and its maturity labels.
YIELD_TABLE_CLASS = "usa-table views-table views-view-table cols-23"
YIELD_LABELS = (
    "1 Mo", "2 Mo", "3 Mo", "4 Mo", "6 Mo", "1 Yr", "2 Yr", "3 Yr", "5 Yr", "7 Yr", "10 Yr", "20 Yr", "30 Yr",
)


def points_from_pages(pages: DataFrame, labels: Sequence[str] = YIELD_LABELS,
                      table_class: str = YIELD_TABLE_CLASS) -> DataFrame:
    """Curve points of the yield tables in ``pages``; cells that are no number are left out."""
    rows = pivot_table_rows(extract_html_tables(pages, table_class), ["Date", *labels]).select("Date", *labels)
    return curve_points(to_numeric(rows, labels), "Date", labels)


def curves_from_pages(pages: DataFrame, model: str = "svensson", **options) -> DataFrame:
    """Fitted parameters per date of the yield tables in ``pages``."""
    return calibrate_curves(points_from_pages(pages, **options), model)
