"""Corrections, backfills, fee rules, gates and windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import scale
from tallyloom.functions.numbers import AMOUNT, money
from tallyloom.operators import quality as q
from tallyloom.operators import rules as r
from tallyloom.workload.registry import Tables, query

RUN_AT = dt.datetime(2024, 2, 1)


@query("""SELECT c_custkey, CASE WHEN c_acctbal < -500 THEN 'FROZEN' WHEN c_acctbal < 0 THEN 'CLOSED' ELSE c_mktsegment END
            AS c_mktsegment, CASE WHEN c_acctbal < 0 AND c_acctbal >= -500 THEN 0.0 ELSE c_acctbal END AS c_acctbal
          FROM customer WHERE c_acctbal >= -900""")
def corrected_customers(tb: Tables) -> DataFrame:
    def fix(rows, column, value, seq, delete=False):
        return rows.select("c_custkey", F.lit(column).alias("column_name"), F.lit(value).alias("value"),
                           F.lit(seq).alias("seq"), F.lit(delete).alias("is_delete"))

    low = tb.customer.filter("c_acctbal < 0")
    unknown = tb.customer.select((-F.col("c_custkey") - 1).alias("c_custkey"))
    fixes = (fix(low, "c_mktsegment", "CLOSED", 1)
             .unionByName(fix(low.filter("c_acctbal < -500"), "c_mktsegment", "FROZEN", 2))
             .unionByName(fix(low.filter("c_acctbal >= -500"), "c_acctbal", "0", 3))
             .unionByName(fix(low.filter("c_acctbal < -900"), None, None, 4, True))
             .unionByName(fix(unknown, "c_mktsegment", "NOBODY", 5)))
    out = r.apply_corrections(tb.customer, fixes, "c_custkey", ["c_mktsegment", "c_acctbal"])
    return out.select("c_custkey", "c_mktsegment", "c_acctbal")


@query("""WITH by_cust AS (SELECT o_custkey, min_by(o_orderpriority, (o_orderkey, o_orderpriority)) AS p FROM orders
                           WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
               by_nation AS (SELECT c_nationkey AS nk, min_by(o_orderpriority, (o_orderkey, o_orderpriority)) AS p FROM orders
                             JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
          SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 5000 THEN c_mktsegment END, by_cust.p, by_nation.p) AS class
          FROM customer LEFT JOIN by_cust ON o_custkey = c_custkey LEFT JOIN by_nation ON nk = c_nationkey""")
def backfill_cascade(tb: Tables) -> DataFrame:
    target = tb.customer.select("c_custkey", "c_nationkey",
                                F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).alias("class"))
    src = tb.orders.filter("o_orderpriority = '1-URGENT'").join(
        tb.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_custkey", "c_nationkey", F.col("o_orderpriority").alias("class"), "o_orderkey")
    out = r.backfill(target, src, [("c_custkey", "o_custkey"), "c_nationkey"], ["class"], order=["o_orderkey"])
    return out.select("c_custkey", "class")


_SHARE = """round(CAST(greatest(least(aft, CAST({hi} AS DECIMAL(20,6))) - greatest(bef, CAST({lo} AS DECIMAL(20,6))), 0)
    AS DECIMAL(20,6)) * 10000 * CAST({rate} AS DECIMAL(6,4)), 2)"""


@query("""WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, epoch(o_orderdate) AS d,
                       CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.0001 AS DECIMAL(6,4)) AS DECIMAL(20,6)) AS amt FROM orders),
               p AS (SELECT *, CAST(coalesce(sum(amt) OVER (PARTITION BY o_custkey ORDER BY d
                        RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DECIMAL(20,6)) AS bef FROM o),
               x AS (SELECT *, bef + amt AS aft FROM p)
          SELECT o_orderkey, CAST(bef AS DOUBLE) AS prior_total, CAST(CASE WHEN o_orderstatus = 'P'
            THEN round(amt * 10000 * CAST(0.02 AS DECIMAL(6,4)), 2) ELSE """
       + " + ".join(_SHARE.format(lo=b.lo, hi=b.hi if b.hi is not None else 99999999, rate=b.rate) for b in r.FEE_BRACKETS)
       + " END AS DOUBLE) AS fee FROM x")
def bracket_fee_orders(tb: Tables) -> DataFrame:
    orders = tb.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                              (money("o_totalprice") / 10000).cast(AMOUNT).alias("amount"))
    out = r.bracket_fee(orders, ["o_custkey"], "o_orderdate", "amount",
                        flat=(F.col("o_orderstatus") == "P", F.col("amount")))
    return out.select("o_orderkey", F.col("prior_total").cast("double"), F.col("fee").cast("double"))


@query("""WITH f AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderpriority, o_orderstatus,
                 CASE o_orderpriority WHEN '1-URGENT' THEN 'STATIC' WHEN '2-HIGH' THEN 'PERCENT' WHEN '3-MEDIUM' THEN 'PERCENT' END AS mode
               FROM orders),
               d AS (SELECT *, CASE mode WHEN 'STATIC' THEN 150.25 WHEN 'PERCENT' THEN CAST(round(total * 100 * 0.05) AS DECIMAL(20,2))
                     ELSE 0 END AS due,
                     CASE o_orderstatus WHEN 'F' THEN 150.25 WHEN 'O' THEN 0 END AS paid FROM f)
          SELECT o_orderkey, CAST(due AS DOUBLE) AS due, CASE WHEN due = 0 THEN 'FREE' WHEN coalesce(paid, 0) = 0 THEN 'UNPAID'
            WHEN paid >= due THEN 'PAID' ELSE 'PAID_HALF' END AS status FROM d""")
def fee_status(tb: Tables) -> DataFrame:
    mode = F.when(F.col("o_orderpriority") == "1-URGENT", "STATIC").when(
        F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), "PERCENT")
    rate = F.when(mode == "STATIC", F.lit("150.25").cast("decimal(8,2)")).otherwise(F.lit("0.05").cast("decimal(8,2)"))
    paid = F.when(F.col("o_orderstatus") == "F", F.lit("150.25").cast("decimal(8,2)")).when(
        F.col("o_orderstatus") == "O", F.lit(0).cast("decimal(8,2)"))
    rows = tb.orders.select("o_orderkey", money("o_totalprice").alias("total"), mode.alias("mode"), rate.alias("rate"),
                            paid.alias("paid"))
    due, status = r.fee_status("total", "mode", "rate", "paid")
    return rows.select("o_orderkey", due.cast("double").alias("due"), status.alias("status"))


@query("""WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS received, l_tax AS school, l_discount AS college,
                 CASE WHEN l_returnflag = 'R' THEN 'contract' ELSE 'grant' END AS kind,
                 CASE WHEN l_linestatus = 'O' AND l_quantity > 25 THEN l_quantity END AS perf FROM lineitem),
               c AS (SELECT *, CASE WHEN school + college = 0 THEN NULL ELSE school / (school + college) END AS ratio FROM f)
          SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
            CASE WHEN kind = 'contract' THEN 'none' WHEN perf IS NOT NULL THEN 'reported'
                 WHEN ratio BETWEEN 0.38 AND 0.42 AND college <> 0 THEN 'two_thirds' ELSE 'none' END AS rule,
            CASE WHEN kind = 'contract' THEN round(received * 0.3, 4) END AS remuneration,
            round(CASE WHEN kind = 'contract' THEN 0 WHEN perf IS NOT NULL THEN perf
                 WHEN ratio BETWEEN 0.38 AND 0.42 AND college <> 0 THEN college * 2 / 3 ELSE 0 END, 4) AS performance,
            round(CASE WHEN kind = 'contract' THEN college WHEN perf IS NOT NULL THEN college - perf
                 WHEN ratio BETWEEN 0.38 AND 0.42 AND college <> 0 THEN college / 3 ELSE college END, 4) AS college_fee FROM c""")
def fee_split(tb: Tables) -> DataFrame:
    lines = tb.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("received"),
        F.col("l_tax").alias("school"), F.col("l_discount").alias("college"),
        F.when(F.col("l_returnflag") == "R", "contract").otherwise("grant").alias("kind"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 25), F.col("l_quantity")).alias("perf"))
    out = r.split_fees(lines, "kind", "school", "college", "perf", "received", unit=1)
    rule = (F.when(F.col("performance") == 0, "none").when(F.col("perf").isNotNull(), "reported").otherwise("two_thirds"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rule.alias("rule"),
                      *[F.round(c, 4).alias(c) for c in ("remuneration", "performance", "college_fee")])


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'PENDING' WHEN month(o_orderdate) = 12 THEN o_orderstatus
            WHEN o_orderdate + INTERVAL 365 DAY >= TIMESTAMP '2000-01-01' THEN 'EXTENDED' ELSE 'ENDED' END AS status FROM orders""")
def status_by_end_date(tb: Tables) -> DataFrame:
    rows = tb.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", "PENDING").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.month("o_orderdate") != 12, F.date_add("o_orderdate", 365)).alias("ends"))
    out = r.status_by_date(rows, "status", "ends", F.lit("2000-01-01").cast("date"), "EXTENDED", "ENDED",
                           when=F.col("status") != "PENDING")
    return out.select("o_orderkey", "status")


GRADES = {"1": "senior", "2": "associate", "3": "middle", "4": "junior", "0": "none"}


@query("""WITH a AS (SELECT o_custkey AS p, nullif('01' || left(o_orderpriority, 1), '015') AS code, strftime(o_orderdate, '%Y.%m') AS granted,
                       strftime(o_orderdate + INTERVAL 40 DAY, '%Y.%m') AS appointed FROM orders),
               b AS (SELECT p, min_by((coalesce(code, '000'), granted, appointed),
                       (CASE WHEN code IS NULL THEN '~' ELSE substr(code, 3, 1) END, granted, coalesce(code, '000'), appointed)) AS x
                     FROM a GROUP BY 1),
               d AS (SELECT user_id, min(strftime(ts, '%Y.%m')) AS dd FROM events WHERE event_type = 'purchase' GROUP BY 1),
               j AS (SELECT p, x[1] AS code, x[2] AS granted, x[3] AS appointed, dd,
                       CASE substr(x[1], 3, 1) WHEN '1' THEN 'senior' WHEN '2' THEN 'associate' WHEN '3' THEN 'middle'
                         WHEN '4' THEN 'junior' WHEN '0' THEN 'none' END AS grade FROM b LEFT JOIN d ON user_id = p)
          SELECT p AS person, grade, CASE WHEN grade IN ('senior', 'associate') THEN granted
            WHEN grade = 'middle' THEN least(granted, dd) WHEN dd IS NOT NULL THEN dd
            WHEN grade <> 'none' THEN granted ELSE appointed END AS title_date FROM j""")
def title_dates(tb: Tables) -> DataFrame:
    appointments = tb.orders.select(
        F.col("o_custkey").alias("person"),
        F.nullif(F.concat(F.lit("01"), F.left("o_orderpriority", F.lit(1))), F.lit("015")).alias("title_code"),
        F.date_format("o_orderdate", "yyyy.MM").alias("granted"),
        F.date_format(F.date_add("o_orderdate", 40), "yyyy.MM").alias("appointed"))
    degrees = tb.events.select(F.col("user_id").alias("person"),
                               F.when(F.col("event_type") == "purchase", "200").otherwise("300").alias("degree_code"),
                               F.date_format("ts", "yyyy.MM").alias("degree_date"))
    return r.title_date(appointments, degrees, "person", GRADES)


# --- windows over time ------------------------------------------------------------------------

@query("""SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'purchase')""")
def loaded_since_mark(tb: Tables) -> DataFrame:
    return q.load_since(tb.events, tb.events.filter("event_type = 'purchase'"), "ts").select("event_id")


@query("""SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15 11:45:00' AND ts < TIMESTAMP '2024-01-15 12:00:00'""")
def window_15_minutes(tb: Tables) -> DataFrame:
    return q.incremental(tb.events, "ts", "2024-01-15 12:00:00", 15).select("event_id")


@query("""SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-15 12:00:00'
            AND (CASE WHEN event_type = 'error' THEN ts + INTERVAL 1 DAY END IS NULL
                 OR ts + INTERVAL 1 DAY > TIMESTAMP '2024-01-15 12:00:00')""")
def first_window(tb: Tables) -> DataFrame:
    rows = tb.events.withColumn("retired", F.when(F.col("event_type") == "error", F.col("ts") + F.expr("interval 1 day")))
    return q.incremental(rows, "ts", "2024-01-15 12:00:00", init=True, retired="retired").select("event_id")


@query("""SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM events
            WHERE ts >= TIMESTAMP '2024-01-15 11:45:00' AND ts < TIMESTAMP '2024-01-15 12:00:00')""")
def resent_scope(tb: Tables) -> DataFrame:
    return q.resend_if_changed(tb.events, tb.customer, "ts", "2024-01-15 12:00:00").select("c_custkey")


@query("""SELECT 'orders' AS module, 'ok' AS status, '' AS remark UNION ALL SELECT 'pending', 'skipped', 'more than 10 rows'
          UNION ALL SELECT 'broken', 'failed', 'ValueError: no such report'""")
def run_log_rows(tb: Tables) -> DataFrame:
    log = scale.fresh_path(tb.spark, "run-log")

    def broken():
        raise ValueError("no such report")

    q.run_chain(tb.spark, {
        "orders": lambda: q.gate(tb.orders, 10),
        "pending": lambda: q.gate(tb.orders.filter("o_orderstatus = 'P'"), 1, 10),
        "broken": broken}, log, RUN_AT, stop_on_failure=False)
    return tb.spark.read.parquet(log).select("module", "status", "remark")


@query("SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def key_violations(tb: Tables) -> DataFrame:
    return q.unique_violations(tb.orders, ["o_custkey"])
