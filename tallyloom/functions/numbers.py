"""Numeric helpers (F25-F30).  ANSI mode stays on; junk and zero divisors are handled here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import _col

MONEY = "decimal(18,2)"
AMOUNT = "decimal(20,6)"
RATE = "decimal(9,2)"


def money(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def truncate(c: Column | str, places: int) -> Column:
    """Cut toward zero."""
    x = _col(c)
    return F.when(x < 0, F.ceil(x, F.lit(places))).otherwise(F.floor(x, F.lit(places)))


def to_ten_thousands(c: Column | str) -> Column:
    return (_col(c).cast(AMOUNT) / F.lit(10000)).cast(AMOUNT)


def to_int_or_zero(c: Column | str) -> Column:
    """Leading integer of a text; junk and null give zero."""
    digits = F.regexp_extract(_col(c).cast("string"), r"^\s*([+-]?\d+)", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def safe_div(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(_col(a), _col(b))


def percent(part: Column | str, whole: Column | str) -> Column:
    """`part / whole * 100` at two places, half up; null over a zero or missing whole."""
    ratio = F.try_divide(_col(part).cast("decimal(18,0)") * 100, _col(whole).cast("decimal(18,0)"))
    return F.round(ratio, 2).cast(RATE)


def percent_text(rate: Column | str) -> Column:
    return F.concat(_col(rate).cast("string"), F.lit("%"))
