"""Joins (J1-J24)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates as d
from tallyloom.functions.numbers import money
from tallyloom.operators import joins as j
from tallyloom.operators import matching
from tallyloom.operators import windows as w
from tallyloom.operators.joins import Lookup
from tallyloom.workload.registry import Tables, query

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("""SELECT o_orderkey, c_custkey, c_name, n_name FROM orders
          JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def order_customers(tb: Tables) -> DataFrame:
    return (tb.orders.join(tb.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(tb.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", "c_custkey", "c_name", "n_name"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderpriority, c_mktsegment,
                 cn.n_name AS customer_nation, cr.r_name AS customer_region, p_brand, s_name,
                 sn.n_name AS supplier_nation
          FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
          LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey LEFT JOIN region cr ON cr.r_regionkey = cn.n_regionkey
          LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
          LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey""")
def line_lookups(tb: Tables) -> DataFrame:
    names = {"n_name": "customer_nation", "n_regionkey": "_region"}
    out = j.lookup(tb.lineitem.select(*LINE), [  # each key is the primary key of its table
        Lookup(tb.orders, [("l_orderkey", "o_orderkey")], {"o_orderpriority": "o_orderpriority", "o_custkey": "_cust"}, unique=True),
        Lookup(tb.customer, [("_cust", "c_custkey")], {"c_mktsegment": "c_mktsegment", "c_nationkey": "_cn"}, unique=True),
        Lookup(tb.nation, [("_cn", "n_nationkey")], names, unique=True),
        Lookup(tb.region, [("_region", "r_regionkey")], {"r_name": "customer_region"}, unique=True),
        Lookup(tb.part, [("l_partkey", "p_partkey")], {"p_brand": "p_brand"}, unique=True),
        Lookup(tb.supplier, [("l_suppkey", "s_suppkey")], {"s_name": "s_name", "s_nationkey": "_sn"}, unique=True),
        Lookup(tb.nation, [("_sn", "n_nationkey")], {"n_name": "supplier_nation"}, unique=True),
    ])
    return out.drop("_cust", "_cn", "_region", "_sn")


@query("""SELECT c_custkey, n_name AS asian_nation FROM customer
          LEFT JOIN (SELECT * FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA')
            ON n_nationkey = c_nationkey""")
def lookup_with_condition(tb: Tables) -> DataFrame:
    dim = tb.nation.join(tb.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.lookup(tb.customer.select("c_custkey", "c_nationkey"), [
        Lookup(dim, [("c_nationkey", "n_nationkey")], {"n_name": "asian_nation"}, where=F.col("r_name") == "ASIA"),
    ]).drop("c_nationkey")


@query("""SELECT o_orderkey, c_name FROM orders
          LEFT JOIN customer ON c_name = 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')""")
def lookup_on_expression(tb: Tables) -> DataFrame:
    key = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    return j.lookup(tb.orders.select("o_orderkey", "o_custkey"), [
        Lookup(tb.customer.withColumn("cust_code", F.col("c_name")), [(key, "cust_code")], {"c_name": "c_name"}),
    ]).drop("o_custkey")


@query("""SELECT c_custkey, count(*) AS n_suppliers FROM customer JOIN supplier ON s_nationkey = c_nationkey
          GROUP BY c_custkey""")
def trimmed_key_lookup(tb: Tables) -> DataFrame:
    padded = (tb.supplier.groupBy("s_nationkey").agg(F.count("*").alias("n_suppliers"))
              .withColumn("code", F.concat(F.lit(" "), F.col("s_nationkey").cast("string"), F.lit("  "))))
    key = F.concat(F.col("c_nationkey").cast("string"), F.lit(" "))
    out = j.lookup(tb.customer, [Lookup(padded, [(key, "code")], {"n_suppliers": "n_suppliers"}, trim=True)])
    return out.filter("n_suppliers is not null").select("c_custkey", "n_suppliers")


@query("SELECT doc_id, item_id FROM documents JOIN benchmark ON contains(documents.text, benchmark.text)")
def passage_in_text(tb: Tables) -> DataFrame:
    return matching.contains_join(tb.documents, tb.benchmark, "doc_id", "text", "item_id", "text")


@query("""WITH names AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS noun FROM part
                         UNION SELECT p_type FROM part
                         UNION SELECT lower(r_name) FROM region
                         UNION SELECT 'th of' UNION SELECT 'une')
          SELECT doc_id, noun FROM documents JOIN names ON contains(text, noun)""")
def short_name_in_text(tb: Tables) -> DataFrame:
    nouns = tb.part.select(F.explode(F.split("p_name", " ")).alias("noun")).union(tb.part.select("p_type")).union(
        tb.region.select(F.lower("r_name"))).distinct()
    words = tb.region.select(F.explode(F.array(F.lit("th of"), F.lit("une"))).alias("noun")).distinct()
    names = nouns.union(words)
    return matching.contains_join(tb.documents, names.withColumn("name", F.col("noun")), "doc_id", "text", "noun", "name")


@query("""SELECT e.event_id, min(c.c_custkey) AS c_custkey FROM events e
          LEFT JOIN customer c ON c.c_custkey = e.user_id OR c.c_custkey = e.event_id
            OR c.c_name = 'Customer#' || lpad(CAST(json_extract(e.props, '$.k') AS VARCHAR), 9, '0')
          GROUP BY e.event_id""")
def any_key_match(tb: Tables) -> DataFrame:
    events = tb.events.select("event_id", "user_id", F.concat(
        F.lit("Customer#"), F.lpad(F.get_json_object("props", "$.k"), 9, "0")).alias("code"))
    out = j.any_key_join(events, tb.customer, [("user_id", "c_custkey"), ("event_id", "c_custkey"), ("code", "c_name")],
                         "c_custkey", "c_custkey")
    return out.select("event_id", "c_custkey")


@query("""SELECT a.o_orderkey, max_by(b.o_orderpriority, (b.o_orderdate, b.o_orderkey)) AS priority_before,
                 max_by(CAST(b.o_totalprice AS DOUBLE), (b.o_orderdate, b.o_orderkey)) AS price_before
          FROM orders a LEFT JOIN orders b ON b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate
          GROUP BY a.o_orderkey""")
def asof_previous_order(tb: Tables) -> DataFrame:
    states = tb.orders.select("o_custkey", F.col("o_orderdate").alias("since"), F.col("o_orderkey").alias("state_key"),
                              F.col("o_orderpriority").alias("priority_before"),
                              F.col("o_totalprice").alias("price_before"))
    facts = tb.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    out = w.asof_join(facts, states, "o_custkey", "o_orderdate", "since", ["priority_before", "price_before"],
                      tie=["state_key"], strict=True)
    return out.select("o_orderkey", "priority_before", "price_before")


@query("""SELECT e.event_id, max_by(p.event_id, (p.ts, p.event_id)) AS purchase_id FROM events e
          LEFT JOIN events p ON p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts <= e.ts
          GROUP BY e.event_id""")
def asof_last_purchase(tb: Tables) -> DataFrame:
    purchases = tb.events.filter("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("since"), F.col("event_id").alias("purchase_id"))
    out = w.asof_join(tb.events.select("event_id", "user_id", "ts"), purchases, "user_id", "ts", "since",
                      ["purchase_id"])
    return out.select("event_id", "purchase_id")


@query("""SELECT o_orderkey, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
              PARTITION BY o_custkey ORDER BY epoch(o_orderdate)
              RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS prior_total FROM orders""")
def prior_order_total(tb: Tables) -> DataFrame:
    orders = tb.orders.select("o_orderkey", "o_custkey", "o_orderdate", money("o_totalprice").alias("price"))
    out = w.prior_total(orders, ["o_custkey"], "o_orderdate", "price")
    return out.select("o_orderkey", F.col("prior_total").cast("double"))


@query("""SELECT n_name, r_name, s_suppkey FROM nation, region, supplier
          WHERE n_regionkey = r_regionkey AND s_nationkey = n_nationkey AND s_acctbal > 0""")
def comma_join(tb: Tables) -> DataFrame:
    rich = tb.supplier.filter("s_acctbal > 0")
    return (rich.join(tb.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(tb.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name", "s_suppkey"))


@query("""WITH tree AS (
            SELECT 'N' || n_nationkey AS id, n_name AS name, 'R' || n_regionkey AS parent FROM nation
            UNION ALL SELECT 'R' || r_regionkey, r_name, 'ROOT' FROM region
            UNION ALL SELECT 'ROOT', 'WORLD', NULL)
          SELECT t.id, a.name AS parent1_name, b.name AS parent2_name FROM tree t
          LEFT JOIN tree a ON a.id = t.parent LEFT JOIN tree b ON b.id = a.parent""")
def parent_names(tb: Tables) -> DataFrame:
    nations = tb.nation.select(F.concat(F.lit("N"), "n_nationkey").alias("id"), F.col("n_name").alias("name"),
                               F.concat(F.lit("R"), "n_regionkey").alias("parent"))
    regions = tb.region.select(F.concat(F.lit("R"), "r_regionkey"), "r_name", F.lit("ROOT"))
    root = tb.region.groupBy().agg(F.lit("ROOT"), F.lit("WORLD"), F.lit(None).cast("string"))
    tree = nations.union(regions).union(root)
    return j.parent_lookup(tree, "id", "parent", ["name"], levels=2).select("id", "parent1_name", "parent2_name")


@query("""SELECT c_custkey FROM customer WHERE EXISTS (
            SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def customers_with_urgent_orders(tb: Tables) -> DataFrame:
    urgent = tb.orders.filter("o_orderpriority = '1-URGENT'")
    return j.keep_existing(tb.customer, urgent, {"c_custkey": "o_custkey"}).select("c_custkey")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (
            SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def customers_without_urgent_orders(tb: Tables) -> DataFrame:
    urgent = tb.orders.filter("o_orderpriority = '1-URGENT'")
    return j.keep_missing(tb.customer, urgent, {"c_custkey": "o_custkey"}).select("c_custkey")


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'A')""")
def not_in_with_nulls(tb: Tables) -> DataFrame:
    # the list side carries nulls, which must not empty the result
    kept = tb.lineitem.select(F.when(F.col("l_returnflag") != "A", F.col("l_orderkey")).alias("o_orderkey"))
    return j.keep_missing(tb.orders, kept, ["o_orderkey"]).select("o_orderkey")


@query("""SELECT c_custkey, (SELECT s_name FROM supplier WHERE s_nationkey = c_nationkey
                             ORDER BY s_acctbal, s_name LIMIT 1) AS poorest_supplier FROM customer""")
def scalar_lookup(tb: Tables) -> DataFrame:
    return j.lookup(tb.customer.select("c_custkey", "c_nationkey"), [
        Lookup(tb.supplier, [("c_nationkey", "s_nationkey")], {"s_name": "poorest_supplier"}, order=["s_acctbal"]),
    ]).drop("c_nationkey")


@query("""SELECT c_custkey, n_orders, next_line, first_day FROM customer LEFT JOIN (
            SELECT o_custkey, count(*) AS n_orders, max(o_orderkey) + 1 AS next_line,
                   strftime(min(o_orderdate), '%Y-%m-%d') AS first_day FROM orders GROUP BY o_custkey)
          ON o_custkey = c_custkey""")
def correlated_aggregates(tb: Tables) -> DataFrame:
    orders = tb.orders.withColumnRenamed("o_custkey", "c_custkey")
    return j.lookup_grouped(tb.customer.select("c_custkey"), orders, ["c_custkey"], {
        "n_orders": F.count("*"), "next_line": F.max("o_orderkey") + 1,
        "first_day": F.date_format(F.min("o_orderdate"), "yyyy-MM-dd")})


@query("""SELECT o_orderkey FROM orders
          WHERE CAST(o_totalprice AS DECIMAL(18,2)) * 2 > (SELECT max(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders)
            AND o_orderdate >= (SELECT min(l_shipdate) FROM lineitem)""")
def scalar_threshold(tb: Tables) -> DataFrame:
    top = tb.orders.select(F.max(money("o_totalprice"))).scalar()
    first = tb.lineitem.select(F.min("l_shipdate")).scalar()
    kept = tb.orders.filter((money("o_totalprice") * 2 > top) & (F.col("o_orderdate") >= first))
    return kept.select("o_orderkey")


_DIFF = """WITH shipped AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), placed AS (SELECT o_orderkey AS k FROM orders)
          SELECT coalesce(a.k, b.k) AS o_orderkey, CASE WHEN b.k IS NULL THEN 'left' ELSE 'right' END AS only_in
          FROM shipped a FULL JOIN placed b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL"""


@query(_DIFF)
def key_difference(tb: Tables) -> DataFrame:
    return j.key_diff(tb.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), tb.orders, ["o_orderkey"])


@query("""SELECT c_custkey, CASE WHEN n > 0 AND c_acctbal < 5000 THEN last_status ELSE c_mktsegment END AS c_mktsegment
          FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, min_by(o_orderstatus, (o_orderdate, o_orderstatus))
                                   AS last_status FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def update_from_orders(tb: Tables) -> DataFrame:
    src = tb.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("c_mktsegment"), "o_orderdate")
    return j.update_from(tb.customer, src, ["c_custkey"], ["c_mktsegment"], order=["o_orderdate"],
                         when=F.col("c_acctbal") < 5000).select("c_custkey", "c_mktsegment")


@query("""WITH t AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders)
          SELECT o_orderkey, CASE WHEN m >= 9 THEN y WHEN m = 1 THEN y - 1 ELSE y END AS assessment_year,
                 CASE WHEN m >= 9 THEN y = 1997 WHEN m = 1 THEN y - 1 = 1997 ELSE y = 1997 END AS in_1997 FROM t""")
def academic_calendar(tb: Tables) -> DataFrame:
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    start = F.when(m >= 9, y).otherwise(y - 1)
    term = F.when((m >= 9) | (m == 1), 1).when(m < 6, 2).otherwise(3)
    year = F.concat_ws("-", start, start + 1)
    return tb.orders.select("o_orderkey", d.calendar_year(year, term).cast("long").alias("assessment_year"),
                            d.in_assessment_year(year, term, 1997).alias("in_1997"))


@query("""SELECT word, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_uses FROM (
            SELECT doc_id, trim(unnest(string_split(text, ','))) AS word, 1 AS n FROM documents)
          WHERE word <> '' GROUP BY word""")
def exploded_clauses(tb: Tables) -> DataFrame:
    rows = j.explode_list(tb.documents.select("doc_id", "text"), "text", "word")
    return rows.groupBy("word").agg(F.count("*").alias("n_docs"), F.sum(F.lit(1)).alias("n_uses"))


@query("""SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""")
def exploded_names(tb: Tables) -> DataFrame:
    return j.explode_list(tb.part, "p_name", "word", sep=" ").select("p_partkey", "word")


@query("""SELECT r_name, o_orderpriority, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
          FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
          JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""")
def per_region_report(tb: Tables) -> DataFrame:
    orders = tb.orders.join(tb.customer, F.col("o_custkey") == F.col("c_custkey"))
    with_nation = j.per_dimension(orders, tb.nation, {"c_nationkey": "n_nationkey"}, ["n_regionkey"])
    with_region = j.per_dimension(with_nation, tb.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    return with_region.groupBy("r_name", "o_orderpriority").agg(
        F.count("*").alias("n_orders"), F.sum(money("o_totalprice")).cast("double").alias("total"))


@query("""SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
            OR c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)""")
def scope_by_person_or_unit(tb: Tables) -> DataFrame:
    persons = tb.orders.filter("o_totalprice > 400000").select("o_custkey")
    units = tb.nation.filter("n_regionkey = 2").select("n_nationkey")
    return j.in_scope(tb.customer, persons, units, "c_custkey", "c_nationkey").select("c_custkey")


@query("""SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
            AS has_urgent FROM customer""")
def has_urgent_order(tb: Tables) -> DataFrame:
    urgent = tb.orders.filter(F.startswith("o_orderpriority", F.lit("1-")))
    return j.exists_flag(tb.customer.select("c_custkey"), urgent, {"c_custkey": "o_custkey"}, "has_urgent")
