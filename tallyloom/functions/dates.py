"""Date helpers.

Nothing here reads the clock: the day a report is made for is an argument.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import _col

# Month part of a term code and the term number it stands for.
TERM_OF_MONTH = {"02": "2", "06": "3", "09": "1"}


def day(value: str | dt.date) -> Column:
    """The reference day of a run as a date literal."""
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)


def days_inclusive(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start)) + 1


def epoch_to_text(c: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.timestamp_seconds(_col(c)), pattern)


def parse_time(c: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Null where the text does not parse."""
    return F.try_to_timestamp(_col(c), F.lit(pattern))


def shift(c: Column | str, unit: str, n: int, pattern: str = "yyyy-MM-dd HH:mm:ss",
          out: str | None = None) -> Column:
    """Move textual time by whole units (MINUTE, HOUR, DAY, QUARTER) and print it again."""
    moved = F.timestamp_add(unit, F.lit(n), parse_time(c, pattern))
    return F.date_format(moved, out or pattern)


def full_years(start: Column | str, as_of: Column) -> Column:
    """Completed years from `yyyy.MM` text to a day, by months."""
    text = _col(start)
    years = F.year(as_of) - F.substring(text, 1, 4).try_cast("int")
    months = F.month(as_of) - F.substring(text, 6, 2).try_cast("int")
    return F.floor((years * 12 + months) / F.lit(12)).cast("int")


def age_by_year(birth: Column | str, year: int | Column) -> Column:
    """Year minus birth year; null where the birth text has no year."""
    year = F.lit(year) if isinstance(year, int) else year
    return year - F.substring(_col(birth), 1, 4).try_cast("int")


def academic_year(term_code: Column | str) -> Column:
    """`yyyy-yyyy` of a `yyyyMM` term code; unknown terms keep the code."""
    code = _col(term_code)
    year = F.substring(code, 1, 4).try_cast("int")
    month = F.substring(code, 5, 2)
    later = F.concat_ws("-", (year - 1).cast("string"), year.cast("string"))
    first = F.concat_ws("-", year.cast("string"), (year + 1).cast("string"))
    return F.when(month == "09", first).when(month.isin("02", "06"), later).otherwise(code)


def term_number(term_code: Column | str) -> Column:
    month = F.substring(_col(term_code), 5, 2)
    out = F.when(month == "02", TERM_OF_MONTH["02"])
    out = out.when(month == "06", TERM_OF_MONTH["06"]).when(month == "09", TERM_OF_MONTH["09"])
    return out.otherwise(_col(term_code))


def previous_term(year: Column | str, term: Column | str) -> tuple[Column, Column]:
    """The term before (academic year, term): term 1 follows term 2 of the year before."""
    y, t = _col(year), _col(term).cast("int")
    start = F.split_part(y, F.lit("-"), F.lit(1)).try_cast("int")
    before = F.concat_ws("-", (start - 1).cast("string"), start.cast("string"))
    return F.when(t == 1, before).otherwise(y), F.when(t == 1, F.lit(2)).otherwise(t - 1)


def calendar_year(year: Column | str, term: Column | str) -> Column:
    """Calendar year of a term: term 1 falls in the first year, the others in the second."""
    first = F.split_part(_col(year), F.lit("-"), F.lit(1)).try_cast("int")
    return F.when(_col(term).cast("int") == 1, first).otherwise(first + 1)


def year_month(year: Column | str, month: str) -> Column:
    """`yyyy.MM` kept as text so that month 10 does not lose its zero."""
    return F.concat(_col(year).cast("string"), F.lit("." + month))


def repair_date(c: Column | str) -> Column:
    """Bring partial dates of length 6, 8 and 11 to a usable form; lengths 4, 7 and 10 stay."""
    text = _col(c)
    six = F.when(F.substring(text, 5, 1) == "-", F.replace(text, F.lit("-"), F.lit("-0"))).otherwise(
        F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2)))
    size = F.octet_length(text)
    return (F.when(size == 6, six)
            .when(size == 11, F.substring(text, 1, 4))
            .when(size == 8, F.replace(text, F.lit("-0"), F.lit("-")))
            .otherwise(text))


def first_year(*cols: Column | str) -> Column:
    """Year of the first column that is long enough to hold one, else `'0'`."""
    usable = [F.when(F.octet_length(_col(c)) >= 4, F.substring(_col(c), 1, 4)) for c in cols]
    return F.coalesce(*usable, F.lit("0"))


def in_period(start: Column | str, end: Column | str, lo: str, hi: str) -> Column:
    """Starts inside [lo, hi], or ends on or after lo; separators `-` and `.` compare equal."""
    def fold(c: Column | str) -> Column:
        return F.replace(_col(c), F.lit("-"), F.lit("."))
    low, high = fold(F.lit(lo)), fold(F.lit(hi))
    begins_inside = (fold(start) >= low) & (fold(start) <= high)
    return F.coalesce(begins_inside, F.lit(False)) | F.coalesce(fold(end) >= low, F.lit(False))


def in_assessment_year(year: Column | str, term: Column | str, assessment_year: Column | int) -> Column:
    """Term 1 of the year that starts then, or terms 2 and 3 of the year that ends then."""
    target = F.lit(assessment_year) if isinstance(assessment_year, int) else assessment_year
    return calendar_year(year, term) == target
