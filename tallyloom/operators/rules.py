"""Corrections, backfills and fee rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import _col, is_blank
from tallyloom.operators.joins import unique_by
from tallyloom.operators.windows import prior_total
from tallyloom.scale import join_side


def apply_corrections(df: DataFrame, fixes: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Apply rows of (key, column_name, value, seq, is_delete): set single cells, or drop rows.

    Later `seq` wins where a cell has several fixes; fixes for unknown keys do nothing.
    """
    last = [F.max_by("value", F.when((F.col("column_name") == c) & ~F.col("is_delete"), F.col("seq")))
            .alias(f"fix_{c}") for c in cols]
    has = [F.coalesce(F.bool_or((F.col("column_name") == c) & ~F.col("is_delete")), F.lit(False))
           .alias(f"has_{c}") for c in cols]
    per_key = join_side(fixes.groupBy(F.col(key).alias("__key")).agg(
        *last, *has, F.bool_or("is_delete").alias("_gone")))
    joined = df.join(per_key, F.col(key) == F.col("__key"), "left")
    joined = joined.filter(~F.coalesce("_gone", F.lit(False)))
    fixed = {c: F.when(F.col(f"has_{c}"), F.col(f"fix_{c}").cast(df.schema[c].dataType))
             .otherwise(F.col(c)) for c in cols}
    return joined.withColumns(fixed).select(*df.columns)


def backfill(df: DataFrame, src: DataFrame, key_cascade: Sequence[str | tuple[str, str]],
             cols: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Fill null columns only, trying keys in order; the source is made unique per key first."""
    for number, pair in enumerate(key_cascade):
        mine, theirs = (pair, pair) if isinstance(pair, str) else pair
        side = join_side(unique_by(src.filter(F.col(theirs).isNotNull()), [theirs], cols, order))
        side = side.select(F.col(theirs).alias("__k"), *[F.col(c).alias(f"_f{number}_{c}") for c in cols])
        df = df.join(side, F.col(mine) == F.col("__k"), "left").drop("__k")
        df = df.withColumns({c: F.coalesce(F.col(c), F.col(f"_f{number}_{c}")) for c in cols})
        df = df.drop(*[f"_f{number}_{c}" for c in cols])
    return df


@dataclass(frozen=True)
class Bracket:
    """`rate` applies to the part of the running total in [lo, hi); `hi` None is open."""

    lo: float
    hi: float | None
    rate: float


# Rates on the running total, in units of ten thousand, and the flat rate.
FEE_BRACKETS = (Bracket(0, 50, 0.04), Bracket(50, 100, 0.03), Bracket(100, 500, 0.02),
                Bracket(500, None, 0.01))
FLAT_RATE = 0.02


def bracket_part(before: Column, after: Column, bracket: Bracket) -> Column:
    """The share of (before, after] that lies in the bracket."""
    top = after if bracket.hi is None else F.least(after, F.lit(bracket.hi).cast("decimal(20,6)"))
    bottom = F.greatest(before, F.lit(bracket.lo).cast("decimal(20,6)"))
    return F.greatest(top - bottom, F.lit(0).cast("decimal(20,6)"))


def bracket_fee(df: DataFrame, part: Sequence[str], order: str, amount: str,
                brackets: Sequence[Bracket] = FEE_BRACKETS, unit: int = 10000,
                preset: str | None = None, flat: tuple[Column, Column] | None = None,
                out: str = "fee", split: bool | None = None) -> DataFrame:
    """Progressive fee on the group's running total, with `prior_total` beside it.

    `preset` names a column that replaces the fee where it is not null.  `flat` is (condition,
    amount): rows that meet it pay the flat rate on that amount instead.
    """
    base = prior_total(df.withColumn(amount, F.col(amount).cast("decimal(20,6)")), part, order, amount,
                       "prior_total", split)
    own = F.coalesce(F.col(amount), F.lit(0).cast("decimal(20,6)"))
    before, after = F.col("prior_total"), F.col("prior_total") + own
    fee = None
    for b in brackets:
        share = F.round(bracket_part(before, after, b).cast("decimal(20,6)")
                        * F.lit(unit) * F.lit(str(b.rate)).cast("decimal(6,4)"), 2)
        fee = share if fee is None else fee + share
    fee = fee.cast("decimal(20,2)")
    if flat is not None:
        condition, flat_amount = flat
        flat_fee = F.round(flat_amount.cast("decimal(20,6)") * F.lit(unit)
                           * F.lit(str(FLAT_RATE)).cast("decimal(6,4)"), 2).cast("decimal(20,2)")
        fee = F.when(condition, flat_fee).otherwise(fee)
    if preset:
        fee = F.coalesce(F.col(preset).cast("decimal(20,2)"), fee)
    return base.withColumn(out, fee)


def fee_status(total: Column | str, mode: Column | str, rate: Column | str, paid: Column | str,
               edited: Column | str | None = None, current: Column | str | None = None) -> tuple[Column, Column]:
    """Due fee (fixed sum, or percent of the total) and its payment status.

    A fee edited by hand stays as it is.
    """
    total, mode, rate, paid = _col(total), _col(mode), _col(rate), _col(paid)
    due = (F.when(mode == "STATIC", F.round(rate, 2))
           .when(mode == "PERCENT", F.round(total * 100 * rate)).otherwise(F.lit(0)))
    if edited is not None:
        due = F.when(_col(edited), _col(current)).otherwise(due)
    paid = F.coalesce(paid, F.lit(0))
    status = (F.when(due == 0, "FREE").when(paid == 0, "UNPAID")
              .when(paid >= due, "PAID").otherwise("PAID_HALF"))
    return due, status


# School shares of both fees that count as 4:6, and the contract's remuneration.
SHARE_LOW, SHARE_HIGH = 0.38, 0.42
REMUNERATION = 0.3


def split_fees(df: DataFrame, kind: str, fee_school: str, fee_college: str, performance_in: str,
               received: str, low: float = SHARE_LOW, high: float = SHARE_HIGH,
               unit: int = 10000) -> DataFrame:
    """Performance pay, college fee and remuneration of each income row.

    Granted projects (`kind` = grant): performance is the reported one; where none is reported and
    the school share of both fees is about 4:6 it is two thirds of the college fee, else zero;
    the rest of the college fee stays.  Contracts (`kind` = contract): 30 % of the receipt is
    remuneration, no performance, the college fee in full.
    """
    scale_to = F.lit(unit)
    school, college = F.col(fee_school), F.col(fee_college)
    reported = F.coalesce(F.col(performance_in), F.lit(0)) != 0
    share = F.try_divide(school, school + college)
    ratio_fits = F.coalesce(share.between(low, high) & (college != 0), F.lit(False))
    grant, contract = F.col(kind) == "grant", F.col(kind) == "contract"
    college_in_unit = F.coalesce(college, F.lit(0)) / scale_to
    performance = (F.when(grant & reported, F.col(performance_in) / scale_to)
                   .when(grant & ratio_fits, college / scale_to * 2 / 3)
                   .when(grant | contract, F.lit(0.0)))
    remaining = (F.when(grant & ~reported & ratio_fits, college / scale_to / 3)
                 .when(grant & reported, college_in_unit - F.col(performance_in) / scale_to)
                 .when(grant | contract, college_in_unit))
    return df.withColumns({
        "performance": performance, "college_fee": remaining,
        "remuneration": F.when(contract, F.col(received) / scale_to * F.lit(REMUNERATION))})


def status_by_date(df: DataFrame, status: str, end: str, as_of: Column, extended: str, ended: str,
                   when: Column | None = None) -> DataFrame:
    """Set a status from the contract end: still running on the day, or over."""
    applies = F.coalesce(when, F.lit(False)) if when is not None else F.lit(True)
    known = F.col(end).isNotNull()
    value = F.when(F.col(end) >= as_of, F.lit(extended)).otherwise(F.lit(ended))
    return df.withColumn(status, F.when(applies & known, value).otherwise(F.col(status)))


# Grades a title code can carry, as text.
SENIOR = ("senior", "associate")
MIDDLE = "middle"
NO_TITLE = "none"


def title_date(appointments: DataFrame, degrees: DataFrame, person: str, grades: Mapping[str, str]) -> DataFrame:
    """The date that counts for each person's title, from the best appointment and the doctorate.

    `appointments`: person, title_code, granted, appointed.  `degrees`: person, degree_code,
    degree_date; codes starting with 2 are doctorates.  `grades` maps the third character of a title
    code to senior, associate, middle, another grade, or none.  The appointment with the smallest
    grade character, then the earliest grant, counts.
    """
    code = F.when(is_blank("title_code"), F.lit("000")).otherwise(F.col("title_code"))
    sort_grade = F.when(is_blank("title_code"), F.lit("~")).otherwise(F.substring("title_code", 3, 1))
    best = (appointments.withColumns({"_code": code, "_grade": sort_grade})
            .groupBy(person)
            .agg(F.min_by(F.struct("_code", "granted", "appointed"),
                          F.struct("_grade", F.coalesce("granted", F.lit("~")), "_code",
                                   F.coalesce("appointed", F.lit("~")))).alias("a"))
            .select(person, "a._code", "a.granted", "a.appointed"))
    doctor = (degrees.filter(F.substring("degree_code", 1, 1) == "2")
              .groupBy(person).agg(F.min("degree_date").alias("degree_date")))
    joined = best.join(doctor, person, "left")
    grade = F.lit(None).cast("string")
    for char, name in grades.items():
        grade = F.when(F.substring("_code", 3, 1) == char, F.lit(name)).otherwise(grade)
    joined = joined.withColumn("grade", grade)
    has_doctor = F.col("degree_date").isNotNull()
    middle = F.col("grade") == MIDDLE
    value = (F.when(F.col("grade").isin(*SENIOR), F.col("granted"))
             .when(middle & has_doctor, F.least("granted", "degree_date"))
             .when(middle, F.col("granted"))
             .when(has_doctor, F.col("degree_date"))
             .when(F.coalesce(F.col("grade"), F.lit("")) != NO_TITLE, F.col("granted"))
             .otherwise(F.col("appointed")))
    return joined.withColumn("title_date", value).select(person, "grade", "title_date")
