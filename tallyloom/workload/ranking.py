"""Windows, sort keys and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import money
from tallyloom.functions.text import map_code
from tallyloom.operators import windows as w
from tallyloom.operators.groups import concat_group
from tallyloom.workload.registry import Tables, query


@query("""SELECT c_custkey, c_nationkey, row_number() OVER (
            PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer""")
def rank_in_nation(tb: Tables) -> DataFrame:
    return w.rank_in(tb.customer.select("c_custkey", "c_nationkey", "c_acctbal"), ["c_nationkey"],
                     [F.desc("c_acctbal"), F.asc("c_custkey")]).drop("c_acctbal")


@query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_order_per_customer(tb: Tables) -> DataFrame:
    return w.latest_per(tb.orders, "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")]).select(
        "o_custkey", "o_orderkey", "o_orderstatus")


@query("""SELECT p_brand, l_partkey, CAST(revenue AS DOUBLE) AS revenue, rn AS place FROM (
            SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY revenue DESC, l_partkey) AS rn FROM (
              SELECT p_brand, l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue
              FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2))
          WHERE rn <= 3""")
def top3_parts_per_brand(tb: Tables) -> DataFrame:
    revenue = tb.lineitem.groupBy("l_partkey").agg(F.sum(money("l_extendedprice")).alias("revenue"))
    parts = revenue.join(tb.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    top = w.top_n(parts, ["p_brand"], [F.desc("revenue"), F.asc("l_partkey")], 3, "place")
    return top.select("p_brand", "l_partkey", F.col("revenue").cast("double"), F.col("place").cast("long"))


@query("""WITH stored AS (SELECT o_custkey, count(*) AS seq FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
                          GROUP BY 1)
          SELECT o_orderkey, n.o_custkey, coalesce(seq, 0) + row_number() OVER (
                   PARTITION BY n.o_custkey ORDER BY o_orderdate, o_orderkey) AS seq
          FROM orders n LEFT JOIN stored s ON s.o_custkey = n.o_custkey WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def continued_sequence(tb: Tables) -> DataFrame:
    cut = F.lit("1999-01-01").cast("timestamp")
    order = [F.asc("o_orderdate"), F.asc("o_orderkey")]
    stored = w.rank_in(tb.orders.filter(F.col("o_orderdate") < cut), ["o_custkey"], order, "seq")
    new = tb.orders.filter(F.col("o_orderdate") >= cut).select("o_orderkey", "o_custkey", "o_orderdate")
    return w.next_seq(new, stored, ["o_custkey"], order, "seq").drop("o_orderdate")


@query("""SELECT l_suppkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey FROM lineitem
          QUALIFY row_number() OVER (PARTITION BY l_suppkey
            ORDER BY l_returnflag, l_quantity DESC, l_orderkey, l_linenumber DESC, l_partkey) = 1""")
def mixed_direction_pick(tb: Tables) -> DataFrame:
    order = [F.asc("l_returnflag"), F.desc("l_quantity"), F.asc("l_orderkey"), F.desc("l_linenumber"),
             F.asc("l_partkey")]
    return w.latest_per(tb.lineitem, "l_suppkey", order).select(
        "l_suppkey", "l_orderkey", F.col("l_linenumber").cast("long"), "l_partkey")


@query("""SELECT user_id, day, CAST(sum(t) OVER (PARTITION BY user_id ORDER BY day) AS DOUBLE) AS running_total FROM (
            SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, sum(CAST(value AS DECIMAL(18,2))) AS t FROM events
            GROUP BY 1, 2)""")
def running_value_per_user(tb: Tables) -> DataFrame:
    daily = tb.events.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.sum(money("value")).alias("t"))
    return w.running_total(daily, ["user_id"], "day", "t").select(
        "user_id", "day", F.col("running_total").cast("double"))


_SORT = "o_orderstatus, o_orderpriority DESC, o_totalprice DESC, o_orderkey"


@query(f"SELECT o_orderkey, row_number() OVER (ORDER BY {_SORT}) AS position FROM orders")
def multi_key_order(tb: Tables) -> DataFrame:
    rows = tb.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    order = [F.asc("o_orderstatus"), F.desc("o_orderpriority"), F.desc("o_totalprice"), F.asc("o_orderkey")]
    return w.rank_in(rows, [], order, "position").select("o_orderkey", "position")


@query("""SELECT c_custkey, row_number() OVER (ORDER BY last_order ASC NULLS LAST, c_custkey) AS position FROM customer
          LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders WHERE o_orderpriority = '1-URGENT'
                     GROUP BY 1) ON o_custkey = c_custkey""")
def order_nulls_last(tb: Tables) -> DataFrame:
    last = (tb.orders.filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.max("o_orderdate").alias("last_order")))
    rows = tb.customer.select("c_custkey").join(last, "c_custkey", "left")
    return w.rank_in(rows, [], [w.nulls_last("last_order"), F.asc("c_custkey")], "position").drop("last_order")


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY
            CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '5-LOW' THEN 3 ELSE 0 END, o_orderkey)
            AS position FROM orders""")
def explicit_value_order(tb: Tables) -> DataFrame:
    key = w.explicit_order("o_orderpriority", ["3-MEDIUM", "1-URGENT", "5-LOW"])
    rows = tb.orders.select("o_orderkey", "o_custkey", key.alias("place"))
    return w.rank_in(rows, ["o_custkey"], [F.asc("place"), F.asc("o_orderkey")], "position").select(
        "o_orderkey", "position")


# Chinese names and their pinyin order, syllable by syllable:
# ji-xie, jia-ju, jian-zhu, qi-che, ri-yong.
SEGMENT_NAMES = {"FURNITURE": "家具", "BUILDING": "建筑", "MACHINERY": "机械", "AUTOMOBILE": "汽车", "HOUSEHOLD": "日用"}


@query("""SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE c_mktsegment
            WHEN 'MACHINERY' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'BUILDING' THEN 3 WHEN 'AUTOMOBILE' THEN 4 ELSE 5 END,
            c_custkey) AS position FROM customer""")
def pinyin_value_order(tb: Tables) -> DataFrame:
    rows = tb.customer.select("c_custkey", "c_nationkey", map_code("c_mktsegment", SEGMENT_NAMES).alias("name"))
    return w.rank_in(rows, ["c_nationkey"], [w.pinyin_order("name").asc(), F.asc("c_custkey")], "position").select(
        "c_custkey", "position")


@query("""SELECT o_orderkey, 'first' AS pick FROM (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
          UNION ALL SELECT o_orderkey, 'eleventh' FROM (
            SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1 OFFSET 10)""")
def limit_and_offset(tb: Tables) -> DataFrame:
    ordered = tb.orders.orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")).select("o_orderkey")
    return ordered.limit(10).withColumn("pick", F.lit("first")).union(
        ordered.offset(10).limit(1).withColumn("pick", F.lit("eleventh")))


@query("""SELECT c_nationkey,
            string_agg(c_name, '>' ORDER BY c_acctbal, c_name) AS names FROM customer GROUP BY 1""")
def sorted_inside_group(tb: Tables) -> DataFrame:
    return concat_group(tb.customer, ["c_nationkey"], "c_name", "c_acctbal", sep=">", out="names", tie="c_custkey")
