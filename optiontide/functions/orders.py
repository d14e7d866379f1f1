"""Order prices and order states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Predicate name -> order state.
ORDER_STATES = {
    "cancelled": "CANCELED",
    "rejected": "REJECTED",
    "expired": "EXPIRED",
    "replaced": "REPLACED",
    "working": "WORKING",
    "pending_activation": "PENDING_ACTIVATION",
    "pending_cancel": "PENDING_CANCEL",
    "pending_replace": "PENDING_REPLACE",
    "queued": "QUEUED",
    "accepted": "ACCEPTED",
    "awaiting_parent_order": "AWAITING_PARENT_ORDER",
    "awaiting_condition": "AWAITING_CONDITION",
}


def _dec(value: Column | str | float, kind: str) -> Column:
    if isinstance(value, Column):
        return value.cast(kind)
    if isinstance(value, str):
        return F.col(value).cast(kind)
    return F.lit(str(value)).cast(kind)


def tick_round(price: Column) -> Column:
    """Half-up to four places below one dollar, to two places from there on."""
    return F.when(price < 1, F.round(price, 4)).otherwise(F.round(price, 2)).cast("decimal(18,4)")


def offset_price(price: Column | str, size: Column | str | float, percent: bool, up: bool) -> Column:
    """Price moved by ``size``, a share of the price or an amount, then tick-rounded.

    The starting price is first rounded to cents; all arithmetic is decimal.
    """
    base = F.round(_dec(price, "decimal(18,4)"), 2).cast("decimal(14,2)")
    size = _dec(size, "decimal(10,4)")
    move = size if up else -size
    moved = base * (1 + move) if percent else base + move
    return tick_round(moved.cast("decimal(22,6)"))


def bracket_prices(
    price: Column | str,
    profit: float | Column,
    stop: float | Column,
    limit: float | Column | None = None,
    profit_percent: bool = False,
    stop_percent: bool = False,
    limit_percent: bool = False,
) -> dict[str, Column]:
    """Take-profit, stop and (with ``limit``) stop-limit prices around ``price``."""
    out = {
        "take_profit_price": offset_price(price, profit, profit_percent, up=True),
        "stop_price": offset_price(price, stop, stop_percent, up=False),
    }
    if limit is not None:
        out["limit_price"] = offset_price(price, limit, limit_percent, up=False)
    return out


def is_profitable(current_price: Column | str, purchase_price: Column | str) -> Column:
    """Flat counts as profitable."""
    current = current_price if isinstance(current_price, Column) else F.col(current_price)
    paid = purchase_price if isinstance(purchase_price, Column) else F.col(purchase_price)
    return paid <= current


def order_status_is(status: Column | str, state: str) -> Column:
    if state not in ORDER_STATES:
        raise ValueError(f"unknown order state {state!r}; one of {', '.join(ORDER_STATES)}")
    column = status if isinstance(status, Column) else F.col(status)
    return F.coalesce(column == ORDER_STATES[state], F.lit(False))
