"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import money
from tallyloom.operators import groups as g
from tallyloom.operators import quality
from tallyloom.workload.registry import Tables, query

MONEY = "CAST({} AS DECIMAL(18,2))"
PRICE = MONEY.format("l_extendedprice")
TOTAL = MONEY.format("o_totalprice")


def located_lines(tb: Tables) -> DataFrame:
    """Line items with the nation and region of the customer."""
    return (tb.lineitem.select("l_orderkey", money("l_extendedprice").alias("price"), "l_returnflag", "l_discount")
            .join(tb.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(tb.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(tb.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(tb.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("l_orderkey", "price", "l_returnflag", "l_discount", "n_name", "r_name"))


@query(f"""SELECT r_name, n_name, CAST(sum({PRICE}) AS DOUBLE) AS revenue,
             CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_orders,
             CAST(count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS BIGINT) AS n_returned,
             CASE WHEN grouping(n_name) = 0 THEN 'n_name' WHEN grouping(r_name) = 0 THEN 'r_name' ELSE 'total' END AS level
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
           JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
           GROUP BY GROUPING SETS ((r_name, n_name), (r_name), ())""")
def rollup_levels_revenue(tb: Tables) -> DataFrame:
    out = g.rollup_levels(located_lines(tb), ["r_name", "n_name"], {"revenue": F.col("price")},
                          {"n_orders": F.lit(True), "n_returned": F.col("l_returnflag") == "R"}, "l_orderkey")
    return out.withColumn("revenue", F.col("revenue").cast("double"))


@query(f"""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum({PRICE}) AS DOUBLE) AS total,
             min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def grouped_measures(tb: Tables) -> DataFrame:
    return tb.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum(money("l_extendedprice")).cast("double").alias("total"),
        F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY l_suppkey")
def exact_distinct(tb: Tables) -> DataFrame:
    return tb.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("n_parts"))


_CONDITIONS = {
    "n_all": "true", "n_returned": "l_returnflag = 'R'", "n_accepted": "l_returnflag = 'A'",
    "n_open": "l_linestatus = 'O'", "n_free": "l_discount = 0", "n_cheap": "l_discount >= 0.05",
    "n_small": "l_quantity < 10", "n_medium": "l_quantity >= 10 AND l_quantity < 30",
    "n_large": "l_quantity >= 30", "n_untaxed": "l_tax = 0",
    "n_old": "l_shipdate < TIMESTAMP '1998-01-01'", "n_new": "l_shipdate >= TIMESTAMP '1998-01-01'",
}


@query("SELECT l_suppkey, " + ", ".join(
    f"count(DISTINCT CASE WHEN {c} THEN l_orderkey END) AS {n}" for n, c in _CONDITIONS.items())
    + " FROM lineitem GROUP BY l_suppkey")
def count_matrix_suppliers(tb: Tables) -> DataFrame:
    return g.count_if_matrix(tb.lineitem, ["l_suppkey"], {n: F.expr(c) for n, c in _CONDITIONS.items()}, "l_orderkey")


@query(f"""SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN {TOTAL} ELSE 0 END) AS DOUBLE) AS open_total,
             count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS n_urgent FROM orders GROUP BY o_custkey""")
def conditional_sums(tb: Tables) -> DataFrame:
    return tb.orders.groupBy("o_custkey").agg(
        g.sum_if(money("o_totalprice"), F.col("o_orderstatus") == "O").cast("double").alias("open_total"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"))


@query("""SELECT l_returnflag, count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_partkey ELSE l_suppkey END) AS n_keys,
             count(DISTINCT coalesce(CASE WHEN l_tax > 0 THEN l_suppkey END, l_partkey)) AS n_fallback
           FROM lineitem GROUP BY l_returnflag""")
def distinct_of_chosen_key(tb: Tables) -> DataFrame:
    chosen = F.when(F.col("l_linestatus") == "O", F.col("l_partkey")).otherwise(F.col("l_suppkey"))
    fallback = F.coalesce(F.when(F.col("l_tax") > 0, F.col("l_suppkey")), "l_partkey")
    return tb.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct(chosen).alias("n_keys"), F.count_distinct(fallback).alias("n_fallback"))


@query(f"""SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey
           HAVING count(*) >= 8 AND sum({TOTAL}) > 1000000""")
def having_filter(tb: Tables) -> DataFrame:
    return (tb.orders.groupBy("o_custkey")
            .agg(F.count("*").alias("n_orders"), F.sum(money("o_totalprice")).alias("t"))
            .filter("n_orders >= 8 and t > 1000000").drop("t"))


@query(f"""SELECT CASE WHEN o_totalprice IS NULL THEN 'none' WHEN o_totalprice < 50000 THEN '0-50k'
               WHEN o_totalprice < 100000 THEN '50-100k' WHEN o_totalprice < 300000 THEN '100-300k' ELSE '300k+' END AS band,
             count(*) AS n, CAST(sum({TOTAL}) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def banded_totals(tb: Tables) -> DataFrame:
    band = g.bucket("o_totalprice", [50000, 100000, 300000], ["0-50k", "50-100k", "100-300k", "300k+"], "none")
    return tb.orders.groupBy(band.alias("band")).agg(
        F.count("*").alias("n"), F.sum(money("o_totalprice")).cast("double").alias("total"))


@query("""SELECT r_name, string_agg(DISTINCT n_name, ';' ORDER BY n_name) AS names
          FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY r_name""")
def names_per_region(tb: Tables) -> DataFrame:
    rows = tb.nation.join(tb.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return g.concat_group(rows, ["r_name"], "n_name", sep=";", distinct=True, out="names")


@query("""SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY o_orderdate, o_orderpriority) AS priorities FROM orders GROUP BY 1""")
def order_history_text(tb: Tables) -> DataFrame:
    return g.concat_group(tb.orders, ["o_custkey"], "o_orderpriority", "o_orderdate", out="priorities", part_rows=2,
                          tie="o_orderkey")


@query("""SELECT o_custkey, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS first_o_orderkey,
                 min_by(o_orderpriority, (o_orderdate, o_orderkey)) AS first_o_orderpriority,
                 max_by(o_orderkey, (o_orderdate, o_orderkey)) AS last_o_orderkey,
                 max_by(o_orderpriority, (o_orderdate, o_orderkey)) AS last_o_orderpriority
          FROM orders GROUP BY o_custkey""")
def first_last_per_customer(tb: Tables) -> DataFrame:
    return g.first_and_last(tb.orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey", "o_orderpriority"])


@query("""SELECT l_suppkey, max(l_extendedprice) AS l_extendedprice,
                 max_by(l_orderkey, (l_extendedprice, l_orderkey, l_linenumber)) AS l_orderkey,
                 max_by(CAST(l_linenumber AS BIGINT), (l_extendedprice, l_orderkey, l_linenumber)) AS l_linenumber
          FROM lineitem GROUP BY l_suppkey""")
def dearest_line_per_supplier(tb: Tables) -> DataFrame:
    out = g.argmax(tb.lineitem, ["l_suppkey"], "l_extendedprice", ["l_orderkey", "l_linenumber"])
    return out.withColumn("l_linenumber", F.col("l_linenumber").cast("long"))


@query("""SELECT p_brand, p_partkey, p_name FROM part
          QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) = 1""")
def one_part_per_brand(tb: Tables) -> DataFrame:
    return g.one_per(tb.part, ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")]).select(
        "p_brand", "p_partkey", "p_name")


@query("""WITH r AS (SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '5-LOW') AS pri FROM orders)
          SELECT * FROM r WHERE pri IS NULL
          UNION ALL SELECT max(o_orderkey), o_custkey, pri FROM r WHERE pri IS NOT NULL GROUP BY o_custkey, pri""")
def dedupe_keep_largest(tb: Tables) -> DataFrame:
    rows = tb.orders.select("o_orderkey", "o_custkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("pri"))
    return g.dedupe_keep(rows, ["o_custkey", "pri"], [F.desc("o_orderkey")])


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(tb: Tables) -> DataFrame:
    return tb.lineitem.select("l_suppkey", "l_returnflag").dropDuplicates()


_BLOCKS = {"priority": "o_orderpriority", "status": "o_orderstatus", "segment": "c_mktsegment",
           "band": "CASE WHEN o_totalprice < 100000 THEN 'low' ELSE 'high' END"}


@query(" UNION ALL ".join(
    f"""SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, '{tag}' AS block, {dim} AS value,
          CAST(sum({TOTAL}) AS DOUBLE) AS total, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
        FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3""" for tag, dim in _BLOCKS.items()))
def long_summary_orders(tb: Tables) -> DataFrame:
    rows = (tb.orders.join(tb.customer, F.col("o_custkey") == F.col("c_custkey"))
            .withColumn("order_year", F.year("o_orderdate").cast("long")))
    out = g.long_summary(rows, ["order_year"], {t: F.expr(e) for t, e in _BLOCKS.items()},
                         {"total": money("o_totalprice"), "n_orders": F.lit(1).cast("long")}, "o_custkey", "n_customers")
    return out.withColumn("total", F.col("total").cast("double"))


@query("""WITH a AS (SELECT s_nationkey, count(DISTINCT l_orderkey) AS whole,
                       count(DISTINCT CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN l_orderkey END) AS part
                     FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1)
          SELECT s_nationkey, part, whole, CAST((part * 20000 + whole) // (2 * whole) AS DOUBLE) / 100 AS rate FROM a""")
def return_rate_by_nation(tb: Tables) -> DataFrame:
    lines = tb.lineitem.join(tb.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    returned = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)
    counts = g.count_if_matrix(lines, ["s_nationkey"], {"part": returned, "whole": F.lit(True)}, "l_orderkey")
    return g.rate_of(counts, "part", "whole").withColumn("rate", F.col("rate").cast("double"))


@query("""WITH m AS (SELECT o_custkey, avg(o_orderkey) AS a, count(*) AS n, year(o_orderdate) < 1998 AS old
                     FROM orders GROUP BY 1, 4)
          SELECT o_custkey, CAST(round(avg(o_orderkey), 1) AS DOUBLE) AS merged FROM orders GROUP BY 1""")
def merged_averages(tb: Tables) -> DataFrame:
    halves = tb.orders.groupBy("o_custkey").agg(
        F.avg(F.when(F.year("o_orderdate") < 1998, F.col("o_orderkey"))).alias("a1"),
        F.count_if(F.year("o_orderdate") < 1998).alias("n1"),
        F.avg(F.when(F.year("o_orderdate") >= 1998, F.col("o_orderkey"))).alias("a2"),
        F.count_if(F.year("o_orderdate") >= 1998).alias("n2"))
    merged = g.merge_avg(F.col("a1"), F.col("n1"), F.col("a2"), F.col("n2"))
    return halves.select("o_custkey", merged.alias("merged"))


@query(f"""SELECT c_nationkey, CAST(sum(best) AS DOUBLE) AS sum_of_best, count(*) AS n_customers,
             CAST(max(n) AS BIGINT) AS most_orders
           FROM (SELECT o_custkey, max({TOTAL}) AS best, count(*) AS n FROM orders GROUP BY 1)
           JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def two_stage_totals(tb: Tables) -> DataFrame:
    per_customer = tb.orders.groupBy("o_custkey").agg(F.max(money("o_totalprice")).alias("best"),
                                                      F.count("*").alias("n"))
    joined = per_customer.join(tb.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_nationkey").agg(
        F.sum("best").cast("double").alias("sum_of_best"), F.count("*").alias("n_customers"),
        F.max("n").alias("most_orders"))


@query("""SELECT o_orderpriority, CAST((sum(a) * 20 + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS mean_age
          FROM (SELECT o_orderpriority, 2010 - year(o_orderdate) AS a FROM orders) GROUP BY 1""")
def mean_age(tb: Tables) -> DataFrame:
    age = F.lit(2010) - F.year("o_orderdate")
    mean = F.round(F.sum(age).cast("decimal(18,0)") / F.count("*").cast("decimal(18,0)"), 1)
    return tb.orders.groupBy("o_orderpriority").agg(mean.cast("double").alias("mean_age"))


@query(f"""WITH n AS (SELECT l_orderkey AS k, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1)
           SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n AS n_members,
             CAST((CAST({MONEY.format('o_totalprice')} * 100 AS BIGINT) * 2 + n) // (2 * n) AS DOUBLE) / 100 AS share
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN n ON k = l_orderkey""")
def split_order_value(tb: Tables) -> DataFrame:
    lines = tb.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(
        tb.orders.select(F.col("o_orderkey").alias("l_orderkey"), money("o_totalprice").alias("share")), "l_orderkey")
    return g.split_evenly(lines, ["l_orderkey"], "l_suppkey", {"share": 2}).withColumn(
        "share", F.col("share").cast("double"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hr,
                 strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS max_ts FROM events GROUP BY 1, 2""")
def max_ts_by_hour(tb: Tables) -> DataFrame:
    return g.max_ts_by_hour(tb.events).withColumn("max_ts", F.date_format("max_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hr, count(*) AS n_files
          FROM events GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC LIMIT 2""")
def recent_hours(tb: Tables) -> DataFrame:
    ledger = tb.events.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "HH").alias("hr"))
    return g.recent_hours(ledger)


@query("""WITH days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d FROM events
                        WHERE value > 30),
               last AS (SELECT event_type, d, row_number() OVER (PARTITION BY event_type ORDER BY d DESC) AS rn FROM days),
               ref AS (SELECT max(CAST(ts AS DATE)) AS today FROM events)
          SELECT event_type, strftime(max(d), '%Y-%m-%d') AS newest,
                 count(*) = 2 AND sum(date_diff('day', d, today)) = 1 AS is_fresh
          FROM last, ref WHERE rn <= 2 GROUP BY event_type""")
def freshness_days(tb: Tables) -> DataFrame:
    today = tb.events.select(F.to_date(F.max("ts"))).scalar()
    results = tb.events.select("event_type", F.col("ts").alias("create_time"),
                               F.when(F.col("value") > 30, "OK").otherwise("FAILED").alias("status"))
    out = quality.is_fresh(results, today, keys=("event_type",))
    return out.withColumn("newest", F.date_format("newest", "yyyy-MM-dd"))


@query("""SELECT 'orders' AS module, count(*) AS n_pending FROM (
            SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_or(l_linestatus = 'O'))
          UNION ALL SELECT 'suppliers', count(*) FROM (
            SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING bool_or(l_linestatus = 'O'))
          UNION ALL SELECT 'customers', count(*) FROM (
            SELECT o_custkey FROM orders GROUP BY 1 HAVING bool_or(o_orderstatus = 'O'))""")
def pending_counts(tb: Tables) -> DataFrame:
    return g.pending_counts({
        "orders": (tb.lineitem, "l_orderkey", "l_linestatus"),
        "suppliers": (tb.lineitem, "l_suppkey", "l_linestatus"),
        "customers": (tb.orders, "o_custkey", "o_orderstatus")}, "O")


@query("""SELECT o_custkey AS custkey,
            '[' || string_agg('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":' ||
              CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END || '}', ',' ORDER BY o_orderkey)
            || ']' AS members
          FROM orders GROUP BY 1""")
def orders_as_json(tb: Tables) -> DataFrame:
    rows = tb.orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey",
                            F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    return g.collect_members(rows, ["custkey"], ["o_orderkey", "o_orderstatus"], ["o_orderkey"], part_rows=2)


@query("""SELECT count(*) AS n_rows, CASE WHEN count(*) = 0 THEN 'nothing to do' WHEN count(*) < 100 THEN
            'fewer than 100 rows' WHEN count(*) > 100000000 THEN 'more than 100000000 rows' ELSE 'ok' END AS reason
          FROM lineitem""")
def row_count_gate(tb: Tables) -> DataFrame:
    return quality.gate_frame(tb.lineitem, 100, 100_000_000)


@query(f"""SELECT strftime(o_orderdate, '%Y') AS y, substr(strftime(o_orderdate, '%Y.%m'), 6, 2) AS m, o_orderstatus,
             CAST(sum({TOTAL}) AS DOUBLE) AS total FROM orders GROUP BY 1, 2, 3""")
def period_totals(tb: Tables) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy.MM")
    return tb.orders.groupBy(F.substring(text, 1, 4).alias("y"), F.substring(text, 6, 2).alias("m"),
                             "o_orderstatus").agg(F.sum(money("o_totalprice")).cast("double").alias("total"))


@query(f"""SELECT k, CAST(sum(ordered) AS DOUBLE) AS ordered, CAST(sum(shipped) AS DOUBLE) AS shipped,
             CAST(sum(n_lines) AS BIGINT) AS n_lines FROM (
             SELECT strftime(o_orderdate, '%Y-%m') AS k, sum({TOTAL}) AS ordered, 0 AS shipped, 0 AS n_lines
             FROM orders GROUP BY 1
             UNION ALL SELECT strftime(l_shipdate, '%Y-%m'), 0, sum({PRICE}), count(*) FROM lineitem GROUP BY 1)
           GROUP BY k""")
def combined_measures(tb: Tables) -> DataFrame:
    ordered = tb.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("k")).agg(
        F.sum(money("o_totalprice")).alias("ordered"))
    shipped = tb.lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("k")).agg(
        F.sum(money("l_extendedprice")).alias("shipped"), F.count("*").alias("n_lines"))
    out = g.combine_measures([ordered, shipped], ["k"])
    return out.withColumns({c: F.col(c).cast("double") for c in ("ordered", "shipped")})


@query("""SELECT o_custkey, max_by(o_orderstatus, CASE o_orderstatus WHEN 'P' THEN 3 WHEN 'O' THEN 2 ELSE 1 END)
            AS top_status FROM orders GROUP BY o_custkey""")
def worst_status_per_customer(tb: Tables) -> DataFrame:
    return g.top_status(tb.orders, ["o_custkey"], "o_orderstatus", {"P": 3, "O": 2}, other=1)
