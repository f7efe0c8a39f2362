"""Indicator tables (D11, D12), parameterised reports (X2) and report chains."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.numbers import percent
from tallyloom.operators.groups import rate
from tallyloom.operators.quality import Gate, run_chain
from tallyloom.sources.tables import Published


def kpi_table(units: DataFrame, indicators: Mapping[str, DataFrame], unit: str = "unit") -> DataFrame:
    """One row per unit and indicator with its value as text; units without a value get null.

    Each indicator frame has `unit` and `value` and is unique per unit.
    """
    stacked = None
    for code, frame in indicators.items():
        one = frame.select(unit, F.lit(code).alias("indicator"), F.col("value").cast("string").alias("value"))
        stacked = one if stacked is None else stacked.unionByName(one)
    codes = F.explode(F.array(*[F.lit(c) for c in indicators]))
    grid = units.select(unit).distinct().withColumn("indicator", codes)
    return grid.join(stacked, [unit, "indicator"], "left")


@dataclass(frozen=True)
class Indicator:
    """An indicator over rows of one base: `measures` (kind and column or condition), and its value from them.

    Kinds: "rows" counts rows that meet a condition, "ids" distinct ids of such rows, "sum" adds up a column's values.
    """

    measures: tuple[tuple[str, Column], ...]
    value: Callable[..., Column]


def counted(condition: Column) -> Indicator:
    """Rows that meet the condition; no value where there are none."""
    return Indicator((("rows", condition),), lambda n: F.nullif(n, F.lit(0)))


def counted_ids(condition: Column) -> Indicator:
    return Indicator((("ids", condition),), lambda n: F.nullif(n, F.lit(0)))


def id_rate(condition: Column, among: Column | None = None) -> Indicator:
    """Distinct ids that meet the condition over all distinct ids, or those of rows in `among`, in percent."""
    whole = F.lit(True) if among is None else among
    return Indicator((("ids", condition & whole), ("ids", whole)), percent)


def row_rate(condition: Column, among: Column | None = None) -> Indicator:
    whole = F.lit(True) if among is None else among
    return Indicator((("rows", condition & whole), ("rows", whole)), percent)


def summed(value: Column) -> Indicator:
    return Indicator((("sum", value),), lambda s: s)


def per_id(value: Column, places: int = 2) -> Indicator:
    """The sum over the number of distinct ids."""
    return Indicator((("sum", value), ("ids", F.lit(True))), lambda s, n: F.round(F.try_divide(s, n), places))


def counts_text(*conditions: Column) -> Indicator:
    """`a / b / c` of the rows that meet each condition."""
    return Indicator(tuple(("rows", c) for c in conditions), lambda *n: slashed(*n))


def kpi_from_base(units: DataFrame, base: DataFrame, indicators: Mapping[str, Indicator], unit: str = "unit", id_col: str | None = None) -> DataFrame:
    """`kpi_table` for any number of indicators of one base, in one pass over it.

    First one row per unit and id: flags of the distinct counts, counts and sums of the others, combined before the shuffle.  Then
    one row per unit, which is laid out as a row per indicator.  Units without rows in the base, and values that are
    undefined, get null.
    """
    columns, kinds = {}, {}
    for code, indicator in indicators.items():
        for k, (kind, column) in enumerate(indicator.measures):
            columns[f"{code}__{k}"], kinds[f"{code}__{k}"] = column, kind
    if id_col is None and "ids" in kinds.values():
        raise ValueError("indicators that count ids need `id_col`")
    first = {"rows": lambda c: F.count_if(c), "ids": lambda c: F.bool_or(F.coalesce(c, F.lit(False))), "sum": F.sum}
    ident = F.lit(None) if id_col is None else F.col(id_col)
    per_unit_id = base.groupBy(unit, ident.alias("_id")).agg(*[first[kinds[n]](c).alias(n) for n, c in columns.items()])
    second = {"rows": F.sum, "ids": lambda n: F.count_if(F.col(n) & F.col("_id").isNotNull()), "sum": F.sum}
    per_unit = per_unit_id.groupBy(unit).agg(*[second[kinds[n]](n).alias(n) for n in columns])
    values = {code: i.value(*[F.col(f"{code}__{k}") for k in range(len(i.measures))]).cast("string") for code, i in indicators.items()}
    wide = units.select(unit).distinct().join(per_unit.select(unit, *[v.alias(c) for c, v in values.items()]), unit, "left")
    rows = F.array(*[F.struct(F.lit(c).alias("indicator"), F.col(c).alias("value")) for c in indicators])
    return wide.select(unit, F.inline(rows))


def kpi_wide(table: DataFrame, codes: Sequence[str], unit: str = "unit") -> DataFrame:
    """The same with one column per indicator."""
    return table.groupBy(unit).pivot("indicator", list(codes)).agg(F.first("value"))


def slashed(*parts: Column) -> Column:
    """`a / b / c` text of several counts."""
    return F.concat_ws(" / ", *[F.coalesce(p.cast("string"), F.lit("0")) for p in parts])


def upsert_kpi_rows(spark: SparkSession, root: str, rows: DataFrame, at: dt.datetime,
                    name: str = "kpi_detail",
                    keys: Sequence[str] = ("unit", "indicator", "period")) -> Gate:
    """Keep detail rows under their natural key."""
    return Published(spark, root).upsert(rows, name, list(keys), at)


def report_chain(spark: SparkSession, reports: Mapping[str, Callable[[], DataFrame]], root: str,
                 at: dt.datetime, min_rows: int = 1) -> dict[str, str]:
    """Build and publish reports in order; each leaves a run-log row under `<root>/_run_log`."""
    tables = Published(spark, root)

    def step(name: str, build: Callable[[], DataFrame]) -> Callable[[], Gate]:
        return lambda: tables.publish(build(), name, at, min_rows)

    steps = {name: step(name, build) for name, build in reports.items()}
    return run_chain(spark, steps, f"{root}/_run_log", at)


def parameterised_report(rows: DataFrame, params: Sequence[tuple[Column, object]], keys: Sequence[str],
                         measures: Mapping[str, Column]) -> DataFrame:
    """One report for many callers: each parameter is a column and the value asked for, None for all values.

    The parameters become plain filters under the joins that made `rows`, so a report of one year reads that year.
    """
    for column, wanted in params:
        if wanted is not None:
            rows = rows.filter(column == F.lit(wanted))
    return rows.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])


def kpi_rate(numerator: DataFrame, denominator: DataFrame, unit: str, id_col: str) -> DataFrame:
    """A rate indicator: distinct ids of the numerator over those of the denominator, in percent."""
    num = numerator.groupBy(unit).agg(F.count_distinct(id_col).alias("n"))
    den = denominator.groupBy(unit).agg(F.count_distinct(id_col).alias("d"))
    return rate(num, den, [unit], "n", "d", "value").select(unit, "value")


def terms_to_run(calendar: DataFrame, today: str) -> DataFrame:
    """Terms a nightly run covers: the one that holds today, or in a holiday the last one and the next.

    calendar: year, term, begin_date, end_date.
    """
    day = F.lit(today).cast("date")
    running = calendar.filter((F.col("begin_date") <= day) & (F.col("end_date") >= day))
    past = calendar.filter(F.col("end_date") < day).orderBy(F.desc("end_date")).limit(1)
    ahead = calendar.filter(F.col("begin_date") > day).orderBy("begin_date").limit(1)
    holiday = past.unionByName(ahead)
    no_term = ~running.select(F.lit(1)).exists()
    return running.unionByName(holiday.filter(no_term)).select("year", "term")
