"""Interest-rate and dividend expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.0

# Models whose discount factor is exponential; the others discount simply.
CONTINUOUS_MODELS = ("svensson", "nelson_siegel")
SIMPLE_MODELS = ("flat", "flat_forward", "linear", "cubic")


def _col(value: Column | str | float) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))


def cc_rate(rate: Column | str, digits: int | None = None) -> Column:
    """Continuously compounded equivalent of a simple annual rate."""
    out = F.log1p(_col(rate))
    return out if digits is None else F.round(out, digits)


def dividend_yield(dividend: Column | str, price: Column | str, guarded: bool = True) -> Column:
    """ln(1 + dividend / price).

    Guarded, a non-positive dividend or price yields 0. Unguarded, only a zero
    price is special: it yields null, since the quotient does not exist.
    A null input always yields null.
    """
    dividend, price = _col(dividend), _col(price)
    value = F.log1p(F.try_divide(dividend, price))
    if not guarded:
        return value
    return F.when((dividend > 0) & (price > 0), value).when(dividend.isNotNull() & price.isNotNull(), F.lit(0.0))


def _loading(t: Column, tau: Column) -> Column:
    """(1 - exp(-t/tau)) / (t/tau), with its limit 1 at t = 0."""
    x = F.try_divide(t, tau)
    return F.when(t == 0, F.lit(1.0)).otherwise(F.try_divide(1 - F.exp(-x), x))


def _hump(t: Column, tau: Column) -> Column:
    return _loading(t, tau) - F.exp(-F.try_divide(t, tau))


def nelson_siegel(t: Column | str, params: Mapping[str, Column | str | float]) -> Column:
    """Three-factor curve with keys beta0, beta1, beta2, tau; null for t < 0."""
    t = _col(t)
    p = {name: _col(value) for name, value in params.items()}
    rate = p["beta0"] + p["beta1"] * _loading(t, p["tau"]) + p["beta2"] * _hump(t, p["tau"])
    return F.when(t >= 0, rate)


def svensson(t: Column | str, params: Mapping[str, Column | str | float]) -> Column:
    """Four-factor curve with keys beta0..beta3, tau1, tau2; null for t < 0."""
    t = _col(t)
    p = {name: _col(value) for name, value in params.items()}
    rate = (
        p["beta0"]
        + p["beta1"] * _loading(t, p["tau1"])
        + p["beta2"] * _hump(t, p["tau1"])
        + p["beta3"] * _hump(t, p["tau2"])
    )
    return F.when(t >= 0, rate)


def flat_rate(rate: float) -> Column:
    return F.lit(float(rate))


def discount_factor(rate: Column | str, t: Column | str, model: str) -> Column:
    rate, t = _col(rate), _col(t)
    if model in CONTINUOUS_MODELS:
        return F.exp(-rate * t)
    if model in SIMPLE_MODELS:
        return F.try_divide(F.lit(1.0), 1 + rate * t)
    raise ValueError(f"unknown curve model {model!r}")


def year_fraction_act365(day: Column | str, reference: Column | str) -> Column:
    return F.datediff(_col(day), _col(reference)) / F.lit(DAYS_PER_YEAR)


def maturity_days(label: Column | str) -> Column:
    """Days behind a maturity label: 30 per "Mo", 365 per "Yr", any letter case.

    Another unit is an error when the row is evaluated.
    """
    text = F.trim(_col(label))
    count = F.regexp_extract(text, r"^(\d+)\s+\S+$", 1).try_cast("int")
    unit = F.lower(F.regexp_extract(text, r"^\d+\s+(\S+)$", 1))
    return (
        F.when(text.isNull(), F.lit(None).cast("int"))
        .when(unit == "yr", count * 365)
        .when(unit == "mo", count * 30)
        .otherwise(F.raise_error(F.concat(F.lit("unrecognised maturity label: "), text)).cast("int"))
    )
