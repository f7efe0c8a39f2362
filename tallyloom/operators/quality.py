"""Gates, freshness and run logs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.windows import top_n


@dataclass(frozen=True)
class Gate:
    passed: bool
    rows: int
    reason: str


def gate(df: DataFrame, min_rows: int = 1, max_rows: int | None = None) -> Gate:
    """Whether a frame may be published: not empty, not too small, not too large."""
    rows = df.count()
    if rows == 0:
        return Gate(False, 0, "nothing to do")
    if rows < min_rows:
        return Gate(False, rows, f"fewer than {min_rows} rows")
    if max_rows is not None and rows > max_rows:
        return Gate(False, rows, f"more than {max_rows} rows")
    return Gate(True, rows, "ok")


def gate_frame(df: DataFrame, min_rows: int = 1, max_rows: int | None = None) -> DataFrame:
    """The gate's decision as one row, for logs."""
    n = F.count("*")
    reason = F.when(n == 0, "nothing to do").when(n < min_rows, f"fewer than {min_rows} rows")
    if max_rows is not None:
        reason = reason.when(n > max_rows, f"more than {max_rows} rows")
    return df.agg(n.alias("n_rows"), reason.otherwise("ok").alias("reason"))


def is_fresh(results: DataFrame, today: str | Column, keys: tuple[str, ...] = ("flow_name", "table_name"),
             status: str = "status", ok: str = "OK", created: str = "create_time") -> DataFrame:
    """Per key: are the newest two distinct successful days today and yesterday?

    The gaps of those two days to today then sum to one.
    """
    days = (results.filter(F.col(status) == ok)
            .select(*keys, F.to_date(created).alias("_day")).distinct())
    newest = top_n(days, list(keys), [F.desc("_day")], 2)
    gap = F.datediff((F.lit(today) if isinstance(today, str) else today).cast("date"), F.col("_day"))
    return newest.groupBy(*keys).agg(
        F.max("_day").alias("newest"),
        ((F.count("*") == 2) & (F.sum(gap) == 1)).alias("is_fresh"))


def load_since(src: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """Source rows newer than the target's newest row; an empty target loads everything."""
    mark = target.select(F.max(ts).alias("mark")).scalar()
    return src.filter(mark.isNull() | (F.col(ts) > mark))


def incremental(df: DataFrame, ts: str, until: str | dt.datetime, minutes: int = 15,
                init: bool = False, retired: str | None = None) -> DataFrame:
    """Rows changed in `[until - minutes, until)`, or all rows before `until` on a first run.

    Rows whose `retired` time has come by `until` are dropped.
    """
    hi = F.lit(until).cast("timestamp")
    out = df.filter(F.col(ts) < hi)
    if not init:
        out = out.filter(F.col(ts) >= hi - F.expr(f"interval {int(minutes)} minutes"))
    if retired:
        out = out.filter(F.col(retired).isNull() | (F.col(retired) > hi))
    return out


def resend_if_changed(base: DataFrame, scope: DataFrame, ts: str, until: str | dt.datetime,
                      minutes: int = 15) -> DataFrame:
    """The whole scope if the base table changed in the window, else none of it."""
    if incremental(base, ts, until, minutes).isEmpty():
        return scope.limit(0)
    return scope


RUN_LOG_SCHEMA = "module string, status string, run_at timestamp, remark string"


def run_logged(spark: SparkSession, name: str, fn: Callable[[], Gate | None], log_path: str,
               run_at: dt.datetime) -> str:
    """Run a step and append its outcome: `ok`, `skipped` (gate refused) or `failed`."""
    try:
        outcome = fn()
        status, remark = "ok", ""
        if isinstance(outcome, Gate) and not outcome.passed:
            status, remark = "skipped", outcome.reason
    except Exception as error:  # the log row is the report; the caller decides about the chain
        status, remark = "failed", f"{type(error).__name__}: {error}"
    row = spark.createDataFrame([(name, status, run_at, remark)], RUN_LOG_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(log_path)
    return status


def run_chain(spark: SparkSession, steps: dict[str, Callable[[], Gate | None]], log_path: str,
              run_at: dt.datetime, stop_on_failure: bool = True) -> dict[str, str]:
    """Run steps in order, one log row each."""
    outcome = {}
    for name, fn in steps.items():
        outcome[name] = run_logged(spark, name, fn, log_path, run_at)
        if outcome[name] == "failed" and stop_on_failure:
            break
    return outcome


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: the check that stands in for a primary key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def status_counts(df: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """Rows that meet a condition per key."""
    return df.groupBy(*keys).agg(F.count_if(condition).alias("n_rows"))
