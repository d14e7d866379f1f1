"""Option and equity symbol text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def parse_occ_symbol(symbol: Column | str) -> Column:
    """Struct (root, expiry, put_call, strike) of a 21-character option symbol.

    The strike stays an exact decimal. Text of another shape gives a null struct.
    """
    s = _col(symbol)
    shape = s.rlike(r"^.{6}\d{6}[CP]\d{8}$")
    expiry = F.try_to_date(F.substring(s, 7, 6), "yyMMdd")
    return F.when(
        shape & expiry.isNotNull(),
        F.struct(
            F.rtrim(F.substring(s, 1, 6)).alias("root"),
            expiry.alias("expiry"),
            F.substring(s, 13, 1).alias("put_call"),
            (F.substring(s, 14, 8).try_cast("decimal(11,3)") / 1000).cast("decimal(11,3)").alias("strike"),
        ),
    )


def build_occ_symbol(root: Column | str, expiry: Column | str, put_call: Column | str, strike: Column | str) -> Column:
    """Root padded to six, yymmdd, C or P, strike times 1000 in eight digits."""
    root = _col(root)
    padded = F.when(F.length(root) < 6, F.rpad(root, 6, " ")).otherwise(root)
    thousandths = (_col(strike).cast("decimal(15,3)") * 1000).cast("bigint").cast("string")
    digits = F.when(F.length(thousandths) < 8, F.lpad(thousandths, 8, "0")).otherwise(thousandths)
    return F.concat(
        padded, F.date_format(_col(expiry).cast("date"), "yyMMdd"), F.substring(_col(put_call), 1, 1), digits
    )


def option_suffix(option_id: Column | str) -> Column:
    """Last blank-separated token, or the last 15 characters of a single token."""
    tokens = F.split(F.trim(_col(option_id)), r"\s+")
    last = F.try_element_at(tokens, F.lit(-1))
    return F.when(F.size(tokens) == 1, F.right(last, F.lit(15))).otherwise(last)


def us_date_text(suffix: Column | str) -> Column:
    """YYMMDD at the start of the suffix as MMDDYY; empty when it is no date."""
    day = F.try_to_date(F.substring(_col(suffix), 1, 6), "yyMMdd")
    return F.coalesce(F.date_format(day, "MMddyy"), F.lit(""))


def strike_text(suffix: Column | str) -> Column:
    """Strike digits after the type letter as a plain number; empty when missing."""
    thousandths = F.substring(_col(suffix), 8, 100)
    value = (thousandths.try_cast("decimal(18,3)") / 1000).cast("decimal(18,3)").cast("string")
    plain = F.rtrim(F.rtrim(value, F.lit("0")), F.lit("."))
    return F.when(F.length(thousandths) == 0, "").otherwise(F.coalesce(plain, F.lit("")))


def normalised_option_symbol(option_id: Column | str, underlying: Column | str) -> Column:
    """``UNDER_MMDDYYC123.5``; empty when date, type or strike is missing."""
    suffix = option_suffix(option_id)
    day, kind, strike = us_date_text(suffix), F.substring(suffix, 7, 1), strike_text(suffix)
    whole = (day != "") & (kind != "") & (strike != "") & _col(underlying).isNotNull()
    return F.when(whole, F.concat(_col(underlying), F.lit("_"), day, kind, strike)).otherwise("")


def adapt_symbol(symbol: Column | str, is_index: Column | str | bool = False) -> Column:
    """Blank to dot, with a leading ``$`` for index symbols."""
    flag = F.lit(is_index) if isinstance(is_index, bool) else _col(is_index)
    dotted = F.replace(_col(symbol), F.lit(" "), F.lit("."))
    return F.when(flag, F.concat(F.lit("$"), dotted)).otherwise(dotted)
