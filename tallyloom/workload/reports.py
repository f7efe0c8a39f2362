"""Reports (D11-D20, D24-D32, D35, X1-X4) on the driver tables, renamed to the reports' inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import scale
from tallyloom.functions import text as t
from tallyloom.functions.numbers import money
from tallyloom.operators.groups import bucket, concat_group
from tallyloom.operators.joins import attach_totals, explode_list, keep_missing, per_dimension
from tallyloom.operators.windows import explicit_order, rank_in
from tallyloom.plans import kpi, papers, people, projects, teaching
from tallyloom.sources.tables import Published
from tallyloom.workload.registry import Tables, query

NOW = dt.datetime(2024, 2, 1)
MONEY = "CAST({} AS DECIMAL(18,2))"


def as_double(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


# --- indicators -------------------------------------------------------------------------------

def _nation_orders(tb: Tables) -> DataFrame:
    return tb.orders.join(tb.customer, F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("c_nationkey", "unit")


def _indicators() -> dict[str, kpi.Indicator]:
    status = F.col("o_orderstatus")
    return {
        "urgent_rate": kpi.id_rate((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000)),
        "status_counts": kpi.counts_text(*[status == s for s in "OFP"]),
        "big_orders": kpi.counted(F.col("o_totalprice") > 499000),
    }


_KPI = """WITH o AS (SELECT c_nationkey AS unit, * FROM orders JOIN customer ON c_custkey = o_custkey),
    rates AS (SELECT unit, count(DISTINCT o_custkey) AS d, count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' AND
                o_totalprice > 400000 THEN o_custkey END) AS n FROM o GROUP BY 1),
    vals AS (SELECT unit, 'urgent_rate' AS indicator,
               CAST(CAST((n * 20000 + d) // (2 * d) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(9,2))::VARCHAR AS value FROM rates
      UNION ALL SELECT unit, 'status_counts', count(*) FILTER (o_orderstatus = 'O') || ' / ' ||
        count(*) FILTER (o_orderstatus = 'F') || ' / ' || count(*) FILTER (o_orderstatus = 'P') FROM o GROUP BY 1
      UNION ALL SELECT unit, 'big_orders', count(*)::VARCHAR FROM o WHERE o_totalprice > 499000 GROUP BY 1),
    grid AS (SELECT n_nationkey AS unit, unnest(['urgent_rate', 'status_counts', 'big_orders']) AS indicator FROM nation),
    kpi AS (SELECT unit, indicator, value FROM grid LEFT JOIN vals USING (unit, indicator)) """


@query(_KPI + "SELECT unit, indicator, value FROM kpi")
def kpi_table_by_nation(tb: Tables) -> DataFrame:
    units = tb.nation.select(F.col("n_nationkey").alias("unit"))
    return kpi.kpi_from_base(units, _nation_orders(tb), _indicators(), id_col="o_custkey")


@query(_KPI + """SELECT unit, max(value) FILTER (indicator = 'urgent_rate') AS urgent_rate,
          max(value) FILTER (indicator = 'status_counts') AS status_counts,
          max(value) FILTER (indicator = 'big_orders') AS big_orders FROM kpi GROUP BY unit""")
def kpi_wide_by_nation(tb: Tables) -> DataFrame:
    units = tb.nation.select(F.col("n_nationkey").alias("unit"))
    table = kpi.kpi_from_base(units, _nation_orders(tb), _indicators(), id_col="o_custkey")
    return kpi.kpi_wide(table, list(_indicators()))


@query("""WITH o AS (SELECT c_nationkey AS unit, *, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders JOIN customer ON c_custkey = o_custkey),
    w AS (SELECT unit, count(DISTINCT o_custkey) AS ids, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS done_ids,
            count(*) AS n, count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS pressing, count(*) FILTER (year(o_orderdate) = 1997) AS n97,
            count(*) FILTER (year(o_orderdate) = 1997 AND o_orderstatus = 'F') AS f97, sum(price) AS total,
            sum(price) FILTER (year(o_orderdate) = 1997) AS total97, count(*) FILTER (o_orderpriority = '5-LOW') AS low FROM o GROUP BY 1),
    pct AS (SELECT unit, unnest([{'i': 'pressing_rate', 'a': pressing, 'b': n}, {'i': 'done_rate_1997', 'a': f97, 'b': n97}, {'i': 'done_people_rate', 'a': done_ids, 'b': ids}], recursive := true) FROM w),
    v AS (SELECT unit, i AS indicator, CASE WHEN b > 0 THEN CAST(CAST((a * 20000 + b) // (2 * b) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(9,2))::VARCHAR END AS value FROM pct
      UNION ALL SELECT unit, 'people', nullif(ids, 0)::VARCHAR FROM w UNION ALL SELECT unit, 'orders', nullif(n, 0)::VARCHAR FROM w
      UNION ALL SELECT unit, 'value', total::VARCHAR FROM w UNION ALL SELECT unit, 'value_1997', total97::VARCHAR FROM w
      UNION ALL SELECT unit, 'pressing_low', pressing || ' / ' || low FROM w)
  SELECT unit, indicator, value FROM (SELECT n_nationkey AS unit, unnest(['people', 'orders', 'value', 'value_1997', 'pressing_rate', 'done_rate_1997',
      'done_people_rate', 'pressing_low']) AS indicator FROM nation) LEFT JOIN v USING (unit, indicator)""")
def kpi_one_pass(tb: Tables) -> DataFrame:
    """Eight indicators of a unit, distinct people, rates, sums and texts, from one scan of the orders."""
    pressing, year = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.year("o_orderdate")
    done, price, anything = F.col("o_orderstatus") == "F", money("o_totalprice"), F.lit(True)
    return kpi.kpi_from_base(tb.nation.select(F.col("n_nationkey").alias("unit")), _nation_orders(tb), {
        "people": kpi.counted_ids(anything), "orders": kpi.counted(anything), "value": kpi.summed(price),
        "value_1997": kpi.summed(F.when(year == 1997, price)), "pressing_rate": kpi.row_rate(pressing),
        "done_rate_1997": kpi.row_rate(done, among=year == 1997), "done_people_rate": kpi.id_rate(done),
        "pressing_low": kpi.counts_text(pressing, F.col("o_orderpriority") == "5-LOW")}, id_col="o_custkey")


@query("""SELECT c_nationkey AS unit, 'orders' AS indicator, strftime(o_orderdate, '%Y') AS period, count(*) AS value
          FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 3""")
def kpi_detail_rows(tb: Tables) -> DataFrame:
    root = scale.fresh_path(tb.spark, "kpi")
    rows = _nation_orders(tb).groupBy("unit", F.lit("orders").alias("indicator"),
                                      F.date_format("o_orderdate", "yyyy").alias("period")).agg(F.count("*").alias("value"))
    kpi.upsert_kpi_rows(tb.spark, root, rows.withColumn("value", F.lit(0).cast("long")).filter("period < '1998'"), NOW)
    kpi.upsert_kpi_rows(tb.spark, root, rows, NOW)
    return Published(tb.spark, root).read("kpi_detail")


@query("""SELECT 'orders_by_status' AS report, count(*) AS n_rows FROM (SELECT DISTINCT o_orderstatus FROM orders)
          UNION ALL SELECT 'orders_by_priority', count(*) FROM (SELECT DISTINCT o_orderpriority FROM orders)""")
def report_chain(tb: Tables) -> DataFrame:
    root = scale.fresh_path(tb.spark, "chain")
    kpi.report_chain(tb.spark, {
        "orders_by_status": lambda: tb.orders.groupBy("o_orderstatus").count(),
        "orders_by_priority": lambda: tb.orders.groupBy("o_orderpriority").count()}, root, NOW)
    log = tb.spark.read.parquet(f"{root}/_run_log").filter("status = 'ok'").select(F.col("module").alias("report"))
    sizes = tb.spark.read.parquet(f"{root}/_versions").select(F.col("name").alias("report"), "n_rows")
    return log.join(sizes, "report")


@query("""SELECT c_custkey, count(*) AS n_orders, max(o_orderkey) AS last_order FROM orders JOIN customer ON c_custkey = o_custkey
          WHERE year(o_orderdate) = 1997 AND o_orderpriority = '2-HIGH' GROUP BY 1""")
def parameterised_report(tb: Tables) -> DataFrame:
    rows = tb.orders.join(tb.customer, F.col("o_custkey") == F.col("c_custkey"))
    params = [(F.year("o_orderdate"), 1997), (F.col("o_orderpriority"), "2-HIGH"), (F.col("c_nationkey"), None)]
    return kpi.parameterised_report(rows, params, ["c_custkey"], {"n_orders": F.count("*"), "last_order": F.max("o_orderkey")})


@query("""WITH cal AS (SELECT strftime(o_orderdate, '%Y') AS year, '1' AS term, min(CAST(o_orderdate AS DATE)) AS b,
                         CAST(strftime(o_orderdate, '%Y') || '-06-30' AS DATE) AS e FROM orders GROUP BY 1, 4)
          SELECT year, term FROM (SELECT * FROM cal WHERE e < DATE '1997-08-01' ORDER BY e DESC LIMIT 1)
          UNION ALL SELECT year, term FROM (SELECT * FROM cal WHERE b > DATE '1997-08-01' ORDER BY b LIMIT 1)""")
def terms_in_holiday(tb: Tables) -> DataFrame:
    year = F.date_format("o_orderdate", "yyyy")
    calendar = tb.orders.groupBy(year.alias("year")).agg(F.to_date(F.min("o_orderdate")).alias("begin_date")).select(
        "year", F.lit("1").alias("term"), "begin_date", F.to_date(F.concat("year", F.lit("-06-30"))).alias("end_date"))
    return kpi.terms_to_run(calendar, "1997-08-01")


# --- people -----------------------------------------------------------------------------------

def _people(tb: Tables) -> DataFrame:
    """Customers in service from their first to their last order; the newest quarter has not left."""
    last = F.date_format(F.max("o_orderdate"), "yyyy.MM")
    return tb.orders.groupBy(F.col("o_custkey").alias("person_id")).agg(
        F.date_format(F.min("o_orderdate"), "yyyy.MM").alias("entered"),
        F.when(last < "2000.07", last).alias("left_on"))


_PEOPLE = """p AS (SELECT o_custkey AS person_id, strftime(min(o_orderdate), '%Y.%m') AS entered,
    CASE WHEN strftime(max(o_orderdate), '%Y.%m') < '2000.07' THEN strftime(max(o_orderdate), '%Y.%m') END AS left_on
    FROM orders GROUP BY 1),
  pres AS (SELECT person_id, y AS year FROM p, generate_series(1996, 2000) g(y)
           WHERE entered <= y || '.12' AND (left_on IS NULL OR left_on >= y || '.12'))"""


@query(f"WITH {_PEOPLE} SELECT person_id, CAST(year AS BIGINT) AS year FROM pres")
def yearly_presence(tb: Tables) -> DataFrame:
    return people.yearly_presence(_people(tb), 1996, 2000).select("person_id", F.col("year").cast("long"))


@query(f"""WITH {_PEOPLE}, s AS (SELECT o_custkey, o_orderpriority, strftime(o_orderdate, '%Y.%m') AS g, o_orderkey AS seq
             FROM orders WHERE o_orderpriority <> '5-LOW')
           SELECT person_id, CAST(year AS BIGINT) AS year, max_by(o_orderpriority, (g, seq)) AS title_code, max(g) AS title_granted
           FROM pres LEFT JOIN s ON o_custkey = person_id AND g < year || '.12' GROUP BY 1, 2""")
def titles_at_year_end(tb: Tables) -> DataFrame:
    titles = tb.orders.select(
        F.col("o_custkey").alias("person_id"), F.date_format("o_orderdate", "yyyy.MM").alias("granted"),
        F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(F.col("o_orderpriority")).alias("title_code"),
        F.col("o_orderkey").alias("seq"))
    presence = people.yearly_presence(_people(tb), 1996, 2000)
    return people.titles_at_year_end(presence, titles).select(
        "person_id", F.col("year").cast("long"), "title_code", "title_granted")


@query("""WITH tree AS (SELECT n_nationkey::VARCHAR AS unit_id, n_name AS name, 'R' || n_regionkey AS parent_id FROM nation
                        UNION ALL SELECT 'R' || r_regionkey, r_name, NULL FROM region),
    acc AS (SELECT o_custkey AS k, max_by('A' || o_orderkey, (o_orderdate, 'A' || o_orderkey)) AS account FROM orders GROUP BY 1),
    par AS (SELECT user_id AS k, min_by((event_type, strftime(ts, '%Y.%m')), (event_id, event_type)) AS x FROM events GROUP BY 1),
    deg AS (SELECT o_custkey AS k, min_by((o_orderstatus, left(o_orderpriority, 1)), (left(o_orderpriority, 1), strftime(o_orderdate, '%Y.%m'), o_orderstatus)) AS x
            FROM orders GROUP BY 1)
  SELECT c_custkey::VARCHAR AS person_id, account, x1.x[1] AS party, x1.x[2] AS joined, d.x[1] AS school, d.x[2] AS degree_code,
         u.name AS unit_name, u.parent_id AS parent_unit, pu.name AS parent_unit_name, lower(c_mktsegment) AS segment_name
  FROM customer LEFT JOIN acc ON acc.k = c_custkey LEFT JOIN par x1 ON x1.k = c_custkey LEFT JOIN deg d ON d.k = c_custkey
  LEFT JOIN tree u ON u.unit_id = c_nationkey::VARCHAR LEFT JOIN tree pu ON pu.unit_id = u.parent_id
  WHERE c_custkey IN (SELECT user_id FROM events) OR c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def person_profiles(tb: Tables) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    padded = F.concat(text("c_custkey"), F.lit("  "))
    persons = tb.customer.select(padded.alias("person_id"), text("c_nationkey").alias("unit_code"), "c_mktsegment")
    accounts = tb.orders.select(F.concat(F.lit(" "), text("o_custkey")).alias("person_id"),
                                F.concat(F.lit("A"), text("o_orderkey")).alias("account"), F.col("o_orderdate").alias("updated"))
    units = tb.nation.select(text("n_nationkey").alias("unit_id"), F.col("n_name").alias("name"),
                             F.concat(F.lit("R"), "n_regionkey").alias("parent_id")).unionByName(
        tb.region.select(F.concat(F.lit("R"), "r_regionkey").alias("unit_id"), F.col("r_name").alias("name"),
                         F.lit(None).cast("string").alias("parent_id")))
    parties = tb.events.select(text("user_id").alias("person_id"), F.col("event_id").alias("seq"),
                               F.col("event_type").alias("party"), F.date_format("ts", "yyyy.MM").alias("joined"))
    degrees = tb.orders.select(text("o_custkey").alias("person_id"), F.col("o_orderstatus").alias("school"),
                               t.left("o_orderpriority", 1).alias("degree_code"),
                               F.date_format("o_orderdate", "yyyy.MM").alias("year_month"))
    segments = tb.customer.select(F.concat(F.lit(" "), "c_mktsegment").alias("code"),
                                  F.lower("c_mktsegment").alias("name")).distinct()
    scope_persons = tb.events.select(text("user_id").alias("person_id")).distinct()
    scope_units = tb.nation.filter("n_regionkey = 1").select(text("n_nationkey").alias("unit"))
    out = people.person_profile(persons, accounts, units, parties, degrees, {"c_mktsegment": (segments, "segment_name")},
                                scope_persons, scope_units)
    return out.drop("unit_code", "c_mktsegment")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'flag ' || l_returnflag AS flag_name, p_brand AS brand,
                 s_name AS supplier, l_returnflag || '/' || l_linestatus AS pair_name
          FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey""")
def student_profiles(tb: Tables) -> DataFrame:
    flags = tb.lineitem.select(F.col("l_returnflag").alias("code"), F.concat(F.lit("flag "), "l_returnflag").alias("name")).distinct()
    brands = tb.part.select(F.col("p_partkey").alias("code"), F.col("p_brand").alias("name"))
    suppliers = tb.supplier.select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name"))
    pairs = tb.lineitem.select(F.col("l_returnflag").alias("code"), F.col("l_linestatus").alias("source"),
                               F.concat_ws("/", "l_returnflag", "l_linestatus").alias("name")).distinct()
    rows = tb.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    out = people.student_profile(rows, [("l_returnflag", flags, "flag_name"), ("l_partkey", brands, "brand"),
                                        ("l_suppkey", suppliers, "supplier")], "l_linestatus",
                                 [("l_returnflag", pairs, "pair_name")])
    return out.drop("l_returnflag", "l_linestatus")


@query("""WITH m AS (
    SELECT 'moved' AS kind, c_custkey AS person_id, c_nationkey AS new_unit, NULL AS old_unit, NULL AS day FROM customer
    UNION SELECT 'ordered', o_custkey, NULL, NULL, strftime(o_orderdate, '%Y-%m-%d') FROM orders
    UNION SELECT 'supplied', l_suppkey, s_nationkey, c_nationkey, strftime(o_orderdate, '%Y-%m-%d') FROM lineitem
      JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey)
  SELECT m.*, a.n_name AS old_unit_name, b.n_name AS new_unit_name FROM m
  LEFT JOIN nation a ON a.n_nationkey = old_unit LEFT JOIN nation b ON b.n_nationkey = new_unit""")
def movements(tb: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    supplied = (tb.lineitem.join(tb.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
                .join(tb.orders, F.col("l_orderkey") == F.col("o_orderkey"))
                .join(tb.customer, F.col("o_custkey") == F.col("c_custkey")))
    names = tb.nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    return people.movements({
        "moved": tb.customer.select(F.col("c_custkey").alias("person_id"), F.col("c_nationkey").alias("new_unit")),
        "ordered": tb.orders.select(F.col("o_custkey").alias("person_id"), day),
        "supplied": supplied.select(F.col("l_suppkey").alias("person_id"), F.col("s_nationkey").alias("new_unit"),
                                    F.col("c_nationkey").alias("old_unit"), day)}, names)


@query("""WITH x AS (SELECT c_custkey, c_nationkey, c_acctbal AS age, 2001 - year(min(o_orderdate)) AS tenure,
                       CASE WHEN min(o_orderpriority) = '1-URGENT' THEN 1 ELSE 0 END AS u
                     FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1, 2, 3)
          SELECT c_nationkey, CASE WHEN age < 0 THEN 'debt' WHEN age < 5000 THEN 'low' ELSE 'high' END AS age_band,
            count(*) AS n_all, count(*) FILTER (tenure < 2) AS n_under_2, count(*) FILTER (tenure BETWEEN 2 AND 4) AS n_2_to_4,
            count(*) FILTER (tenure BETWEEN 5 AND 9) AS n_5_to_9, count(*) FILTER (tenure >= 10) AS n_10_up FROM x GROUP BY 1, 2""")
def headcount_bands(tb: Tables) -> DataFrame:
    recent = tb.orders.filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp"))
    first = recent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.year(F.min("o_orderdate")).alias("y"))
    rows = tb.customer.join(first, "c_custkey", "left").withColumn("person_id", F.col("c_custkey"))
    band = bucket("_age", [0, 5000], ["debt", "low", "high"])
    return people.headcount_bands(rows, "c_nationkey", F.col("c_acctbal"), F.lit(2001) - F.col("y"), band)


@query("""WITH s AS (SELECT l_orderkey || '/' || l_linenumber AS id, l_suppkey AS s1, CASE WHEN l_quantity > 10 THEN l_partkey END AS s2,
                       l_returnflag AS lv FROM lineitem WHERE l_linestatus = 'O'),
               r AS (SELECT id, s1 AS supervisor, lv, 1 AS place FROM s UNION SELECT id, s2, lv, 2 FROM s WHERE s2 IS NOT NULL AND s1 <> s2)
          SELECT supervisor, count(DISTINCT CASE WHEN lv = 'A' THEN id END) AS n_master,
                 count(DISTINCT CASE WHEN lv = 'R' THEN id END) AS n_doctor,
                 count(DISTINCT CASE WHEN place = 2 THEN id END) AS n_second FROM r GROUP BY 1""")
def supervision_counts(tb: Tables) -> DataFrame:
    students = tb.lineitem.select(
        F.concat_ws("/", "l_orderkey", "l_linenumber").alias("student_id"), F.col("l_suppkey").alias("supervisor1"),
        F.when(F.col("l_quantity") > 10, F.col("l_partkey")).alias("supervisor2"), F.col("l_returnflag").alias("level_code"),
        F.when(F.col("l_linestatus") == "F", "1").alias("left_flag"))
    return people.supervision(students, {"n_master": "A", "n_doctor": "R"})


@query("""SELECT c_custkey AS person_id, t.d AS first_granted, t.k AS first_title_code, p.d AS first_started, p.k AS first_project_no,
                 a.d AS first_awarded, a.k AS first_award, CAST(h.total AS DOUBLE) AS total_hours
  FROM customer
  LEFT JOIN (SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS d, min_by(o_orderpriority, (o_orderdate, o_orderpriority)) AS k
             FROM orders WHERE o_orderpriority < '3' GROUP BY 1) t ON t.o_custkey = c_custkey
  LEFT JOIN (SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS d, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS k
             FROM orders GROUP BY 1) p ON p.o_custkey = c_custkey
  LEFT JOIN (SELECT user_id, strftime(min(ts), '%Y-%m-%d') AS d, min_by(event_id, (strftime(ts, '%Y-%m-%d'), event_id)) AS k
             FROM events WHERE event_type = 'purchase' GROUP BY 1) a ON a.user_id = c_custkey
  LEFT JOIN (SELECT o_custkey, sum(l_quantity) AS total FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) h
    ON h.o_custkey = c_custkey""")
def career_milestones(tb: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    titles = tb.orders.select(F.col("o_custkey").alias("person_id"), F.col("o_orderpriority").alias("title_code"),
                              F.when(F.col("o_orderpriority") < "3", day).alias("granted"))
    started = tb.orders.select(F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("project_no"), day.alias("started"))
    awards = tb.events.filter("event_type = 'purchase'").select(
        F.col("user_id").alias("person_id"), F.col("event_id").alias("award"), F.date_format("ts", "yyyy-MM-dd").alias("awarded"))
    hours = tb.lineitem.join(tb.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("person_id"), F.col("l_quantity").alias("hours"))
    return people.milestones(tb.customer.select(F.col("c_custkey").alias("person_id")), titles, started, awards, hours)


# --- projects ---------------------------------------------------------------------------------

@query(f"""WITH s AS (
    SELECT o_custkey AS person_id, o_orderpriority AS card_no, year(o_orderdate)::VARCHAR AS project_no, 'o' || o_orderstatus AS name,
           {MONEY.format('o_totalprice')} AS amount, 'current' AS system FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_custkey, o_orderpriority, year(o_orderdate)::VARCHAR, NULL, {MONEY.format('o_totalprice')}, 'classified'
      FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_custkey, NULL, year(o_orderdate)::VARCHAR, 'legacy', NULL, 'legacy' FROM orders WHERE o_orderstatus = 'F')
  SELECT person_id, card_no, project_no, CAST(sum(coalesce(amount, 0)) AS DOUBLE) AS amount, count(*) AS n_rows,
         min(system) AS first_system, max(name) AS project_name, any_value(c_name) AS person_name, any_value(c_nationkey) AS unit
  FROM s LEFT JOIN customer ON c_custkey = person_id GROUP BY 1, 2, 3""")
def project_ledger(tb: Tables) -> DataFrame:
    base = tb.orders.select(F.col("o_custkey").alias("person_id"), F.col("o_orderpriority").alias("card_no"),
                            F.year("o_orderdate").cast("string").alias("project_no"),
                            F.concat(F.lit("o"), "o_orderstatus").alias("name"), money("o_totalprice").alias("amount"),
                            "o_orderstatus")
    part = {s: base.filter(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in "OPF"}
    sources = {"current": part["O"], "classified": part["P"].drop("name"),
               "legacy": part["F"].drop("card_no", "amount").withColumn("name", F.lit("legacy"))}
    staff = tb.customer.select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("unit"))
    return as_double(projects.project_ledger(sources, staff), "amount")


@query(f"""SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, o_orderstatus AS class,
             CAST(sum({MONEY.format('o_totalprice')}) AS DOUBLE) AS amount, count(*) AS n_rows FROM orders GROUP BY 1, 2, 3""")
def income_by_month(tb: Tables) -> DataFrame:
    income = tb.orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("booked"), F.col("o_orderstatus").alias("class"),
                              money("o_totalprice").alias("amount"))
    return as_double(projects.income_summary(income), "amount")


@query(f"""SELECT l_returnflag AS class, CAST(sum(c) AS DOUBLE) AS contract, count(*) AS n_projects FROM (
             SELECT l_returnflag, l_orderkey, max({MONEY.format('l_extendedprice')}) AS c FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def contract_totals(tb: Tables) -> DataFrame:
    rows = tb.lineitem.select(F.col("l_returnflag").alias("class"), F.col("l_orderkey").alias("project_no"),
                              money("l_extendedprice").alias("contract"))
    return as_double(projects.contract_totals(rows), "contract")


@query(f"""SELECT c_mktsegment AS discipline, CAST(sum({MONEY.format('o_totalprice')}) AS DOUBLE) AS amount,
             count(DISTINCT c_custkey) AS n_persons,
             CAST((CAST(sum({MONEY.format('o_totalprice')}) * 100 AS HUGEINT) * 2 + count(DISTINCT c_custkey))
               // (2 * count(DISTINCT c_custkey)) AS DOUBLE) / 100 AS average
           FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def discipline_average(tb: Tables) -> DataFrame:
    rows = tb.orders.join(tb.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("discipline"), F.col("c_custkey").alias("person_id"), money("o_totalprice").alias("amount"))
    return as_double(projects.discipline_average(rows), "amount", "average")


_TEXT = "regexp_replace(CAST({} AS VARCHAR), '\\.00$', '')"


@query(f"""WITH p AS (SELECT o_custkey AS person_id, o_orderkey AS project_no, o_orderpriority AS card_no,
                 strftime(o_orderdate, '%Y-%m') AS s, strftime(o_orderdate + INTERVAL 300 DAY, '%Y.%m') AS e,
                 CASE WHEN o_orderstatus = 'P' THEN 100 ELSE {MONEY.format('o_totalprice')} END AS income,
                 CASE WHEN o_orderstatus = 'F' THEN 'lead' ELSE o_orderstatus END AS role FROM orders),
               a AS (SELECT o_custkey, o_orderpriority, sum({MONEY.format('l_extendedprice')}) AS share FROM lineitem
                     JOIN orders ON o_orderkey = l_orderkey WHERE strftime(l_shipdate, '%Y.%m') BETWEEN '1996.06' AND '1997.06' GROUP BY 1, 2)
          SELECT p.person_id, project_no, card_no, s AS start, e AS "end", {_TEXT.format('CAST(income AS DECIMAL(18,2))')} AS income,
                 {_TEXT.format('CAST(share AS DECIMAL(18,2))')} AS share, role
          FROM p LEFT JOIN a ON a.o_custkey = person_id AND a.o_orderpriority = card_no
          WHERE (replace(s, '-', '.') BETWEEN '1996.06' AND '1997.06') OR e >= '1996.06'""")
def income_in_period(tb: Tables) -> DataFrame:
    own = tb.orders.select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("project_no"), F.col("o_orderpriority").alias("card_no"),
        F.date_format("o_orderdate", "yyyy-MM").alias("start"),
        F.date_format(F.date_add("o_orderdate", 300), "yyyy.MM").alias("end"), money("o_totalprice").alias("total"),
        F.when(F.col("o_orderstatus") == "P", F.lit(100).cast("decimal(18,2)")).alias("override"),
        F.when(F.col("o_orderstatus") == "F", "lead").when(F.col("o_orderstatus") == "P", "").alias("role"),
        F.col("o_orderstatus").alias("kind"))
    given = tb.lineitem.join(tb.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderpriority").alias("card_no"), money("l_extendedprice").alias("amount"),
        F.date_format("l_shipdate", "yyyy-MM").alias("allocated"))
    return projects.assess_income(own, given, "1996-06", "1997-06")


@query("""WITH l AS (SELECT DISTINCT o_custkey AS p, o_orderkey AS k FROM orders WHERE o_totalprice > 200000
                       AND strftime(o_orderdate, '%Y-%m') BETWEEN '1997-01' AND '1997-12'),
               m AS (SELECT DISTINCT o_custkey AS p, l_orderkey AS k FROM lineitem JOIN orders ON o_orderkey = l_orderkey
                     WHERE strftime(l_shipdate, '%Y-%m') BETWEEN '1997-01' AND '1997-12')
          SELECT coalesce(l.p, m.p) AS person_id, coalesce(l.k, m.k) AS project_no,
                 CASE WHEN l.p IS NOT NULL THEN 'lead' ELSE 'collaborator' END AS role, m.p IS NOT NULL AS has_share
          FROM l FULL JOIN m ON l.p = m.p AND l.k = m.k""")
def roles_in_period(tb: Tables) -> DataFrame:
    leads = tb.orders.filter("o_totalprice > 200000").select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("project_no"),
        F.date_format("o_orderdate", "yyyy-MM").alias("seen_on"))
    shares = tb.lineitem.join(tb.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("person_id"), F.col("l_orderkey").alias("project_no"),
        F.date_format("l_shipdate", "yyyy-MM").alias("seen_on"))
    return projects.roles_in_period(leads, shares, "1997-01", "1997-12")


@query(f"""WITH f AS (SELECT o_custkey AS c, min(o_orderkey) AS root FROM orders GROUP BY 1),
    a AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey = root THEN '' ELSE root::VARCHAR END AS parent, o_orderpriority AS unit,
            o_orderstatus AS team, {MONEY.format('o_totalprice')} AS amount, {MONEY.format('o_totalprice')} * 2 AS received
          FROM orders JOIN f ON c = o_custkey)
  SELECT a.o_orderkey::VARCHAR AS alloc_id, a.o_custkey AS person_id, a.o_custkey AS project_no, c_name AS project_name, c_mktsegment AS project_start,
         CAST(CASE WHEN a.parent = '' THEN a.received END AS DOUBLE) AS shown_receipt,
         CAST(CASE WHEN a.parent <> '' THEN a.amount ELSE a.received - a.amount END AS DOUBLE) AS shown_share,
         CASE WHEN a.parent <> '' THEN '1' ELSE '0' END AS is_child, coalesce(p.unit, a.unit) AS lead_unit, coalesce(p.team, a.team) AS lead_team
  FROM a LEFT JOIN a p ON p.o_orderkey::VARCHAR = a.parent LEFT JOIN customer ON c_custkey = a.o_custkey""")
def allocation_rows(tb: Tables) -> DataFrame:
    first = tb.orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("root"))
    rows = attach_totals(tb.orders, first, ["o_custkey"]).select(
        F.col("o_orderkey").cast("string").alias("alloc_id"),
        F.when(F.col("o_orderkey") == F.col("root"), "").otherwise(F.col("root").cast("string")).alias("parent_id"),
        F.col("o_custkey").alias("person_id"), F.col("o_custkey").alias("project_no"), F.col("o_orderpriority").alias("unit"),
        F.col("o_orderstatus").alias("team"), money("o_totalprice").alias("amount"), (money("o_totalprice") * 2).alias("received"))
    names = tb.customer.select(F.col("c_custkey").alias("project_no"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("start"))
    return as_double(projects.allocation_view(rows, names), "shown_receipt", "shown_share")


# --- teaching ---------------------------------------------------------------------------------

def _detail(tb: Tables) -> DataFrame:
    """Open lines taught by academic year, filled ones by term code."""
    year = F.year("l_shipdate")
    common = [F.col("l_suppkey").alias("person_id"), F.col("l_partkey").cast("string").alias("course_code"),
              F.col("l_quantity").cast("decimal(10,2)").alias("hours"), F.col("l_linenumber").alias("students")]
    by_year = tb.lineitem.filter("l_linestatus = 'O'").select(
        F.when(F.col("l_tax") > 0, F.col("l_orderkey").cast("string")).alias("section_id"), *common,
        F.concat_ws("-", year, year + 1).alias("year"), (F.month("l_shipdate") % 3 + 1).alias("term"),
        (F.round(F.col("l_discount") * 100) * 4 + 60).alias("score"))
    by_code = tb.lineitem.filter("l_linestatus = 'F'").select(
        F.col("l_orderkey").cast("string").alias("class_id"), *common, F.date_format("l_shipdate", "yyyyMM").alias("term_code"))
    return teaching.teaching_detail(by_year, by_code)


_DETAIL = """raw AS (
    SELECT CASE WHEN l_tax > 0 THEN l_orderkey::VARCHAR END AS section_id, 'undergraduate' AS audience, l_suppkey AS person_id,
      l_partkey::VARCHAR AS course_code, CAST(l_quantity AS DECIMAL(10,2)) AS hours, l_linenumber AS students,
      year(l_shipdate) || '-' || (year(l_shipdate) + 1) AS year, (month(l_shipdate) % 3 + 1)::VARCHAR AS term,
      round(l_discount * 100) * 4 + 60 AS score FROM lineitem WHERE l_linestatus = 'O'
    UNION SELECT l_orderkey::VARCHAR, 'graduate', l_suppkey, l_partkey::VARCHAR, CAST(l_quantity AS DECIMAL(10,2)), l_linenumber,
      CASE WHEN month(l_shipdate) = 9 THEN year(l_shipdate) || '-' || (year(l_shipdate) + 1)
           WHEN month(l_shipdate) IN (2, 6) THEN (year(l_shipdate) - 1) || '-' || year(l_shipdate) ELSE strftime(l_shipdate, '%Y%m') END,
      CASE month(l_shipdate) WHEN 9 THEN '1' WHEN 2 THEN '2' WHEN 6 THEN '3' ELSE strftime(l_shipdate, '%Y%m') END, NULL
    FROM lineitem WHERE l_linestatus = 'F'),
  one AS (SELECT * FROM raw WHERE section_id IS NULL UNION ALL SELECT * FROM (SELECT * FROM raw WHERE section_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY section_id, audience, person_id
      ORDER BY hours DESC, students DESC, year, term, course_code, score NULLS LAST) = 1)),
  cnt AS (SELECT section_id AS s, audience AS au, count(DISTINCT person_id) AS n FROM one GROUP BY 1, 2),
  detail AS (SELECT one.*, n FROM one LEFT JOIN cnt ON s = section_id AND au = audience)"""


@query(f"""WITH {_DETAIL} SELECT section_id, audience, person_id, course_code, CAST(hours AS DOUBLE) AS hours,
             CAST(students AS BIGINT) AS students, year, term, score, n AS n_teachers FROM detail""")
def teaching_detail_rows(tb: Tables) -> DataFrame:
    return as_double(_detail(tb), "hours").withColumn("students", F.col("students").cast("long"))


def _load(tb: Tables, report=teaching.teaching_load) -> DataFrame:
    staff = tb.supplier.join(tb.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("person_id"), F.col("n_name").alias("dept"), F.col("n_regionkey").alias("college"),
        F.when(F.col("s_acctbal") > 5000, "f").otherwise("m").alias("gender"),
        (F.col("s_acctbal") / 100).cast("int").alias("age"))
    titles = tb.lineitem.select(F.col("l_suppkey").alias("person_id"), F.col("l_orderkey").alias("seq"),
                                F.col("l_returnflag").alias("title"))
    return report(_detail(tb), staff, titles)


_LOAD = _DETAIL + """, staff AS (SELECT s_suppkey, n_name AS dept, n_regionkey AS college, CASE WHEN s_acctbal > 5000 THEN 'f' ELSE 'm' END AS gender,
      trunc(s_acctbal / 100) AS age FROM supplier JOIN nation ON n_nationkey = s_nationkey),
  tit AS (SELECT l_suppkey AS p, max_by(l_returnflag, (l_orderkey, l_returnflag)) AS title FROM lineitem GROUP BY 1),
  load AS (SELECT detail.*, dept, college, gender, age, title, CAST((CAST(hours * 100 AS BIGINT) * 2 + 100 * coalesce(n, 1)) // (200 * coalesce(n, 1)) AS BIGINT) AS hours_share,
      row_number() OVER (PARTITION BY college, year, term ORDER BY score DESC NULLS LAST, hours DESC, section_id NULLS FIRST, audience, person_id,
        course_code, students) AS place
    FROM detail LEFT JOIN staff ON s_suppkey = person_id LEFT JOIN tit ON p = person_id)"""


@query(f"""WITH {_LOAD} SELECT section_id, audience, person_id, dept, college, title, CAST(hours_share AS DOUBLE) AS hours_share, year, term, place
           FROM load""")
def teaching_load_rows(tb: Tables) -> DataFrame:
    rows = _load(tb).select(
        "section_id", "audience", "person_id", "dept", "college", "title", "hours_share", "year", "term", "place")
    return as_double(rows, "hours_share")


def _block(tag: str, value: str) -> str:
    return f"""SELECT college, audience, year, '{tag}' AS block, {value} AS value, CAST(sum(hours_share) AS DOUBLE) AS hours,
        CAST(0 AS BIGINT) AS n_courses FROM load GROUP BY ALL"""


@query(f"WITH {_LOAD} " + " UNION ALL ".join([
    _block("all", "'0'"), _block("title", "title"), _block("gender", "gender"),
    _block("age", "CASE WHEN age < 30 THEN 'under 30' WHEN age < 40 THEN '30-39' WHEN age < 50 THEN '40-49' "
                  "WHEN age < 60 THEN '50-59' ELSE '60 up' END"),
    _block("talent", "dept"), _block("track", "CASE WHEN title = 'R' THEN 'tenure' ELSE 'regular' END")]) + """
  UNION ALL SELECT college, audience, year, 'score', CASE WHEN score IS NULL THEN 'unscored' WHEN score < 70 THEN 'under 70'
    WHEN score < 80 THEN '70-79' WHEN score < 90 THEN '80-89' ELSE '90 up' END AS value, 0.0, count(DISTINCT section_id)
  FROM load GROUP BY ALL""")
def teaching_summary_blocks(tb: Tables) -> DataFrame:
    track = F.when(F.col("title") == "R", "tenure").otherwise("regular")
    return as_double(teaching.teaching_summary(_load(tb, teaching.teaching_rows), {"talent": F.col("dept"), "track": track}), "hours")


@query("""WITH s AS (SELECT DISTINCT n_regionkey AS college, p_type AS course_code, year(l_shipdate) || '-' || (year(l_shipdate) + 1) AS year,
                       (month(l_shipdate) % 3 + 1)::VARCHAR AS term, s_name AS name
                     FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
                     WHERE s_acctbal > 7000)
          SELECT college, course_code, year, term, string_agg(name, ',' ORDER BY name) AS teachers,
                 CASE WHEN term = '1' THEN CAST(left(year, 4) AS BIGINT) ELSE CAST(left(year, 4) AS BIGINT) + 1 END AS calendar_year
          FROM s GROUP BY 1, 2, 3, 4""")
def course_teachers(tb: Tables) -> DataFrame:
    year = F.year("l_shipdate")
    rows = tb.lineitem.join(tb.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("person_id"), F.col("p_type").alias("course_code"), F.concat_ws("-", year, year + 1).alias("year"),
        (F.month("l_shipdate") % 3 + 1).cast("string").alias("term"))
    staff = tb.supplier.join(tb.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("person_id"), F.col("n_regionkey").alias("college"), F.col("s_name").alias("name"), "s_acctbal")
    out = teaching.course_detail(rows, staff, only=F.col("s_acctbal") > 7000, part_rows=2)
    return out.withColumn("calendar_year", F.col("calendar_year").cast("long"))


@query("""SELECT 'o' || o_orderkey AS row_key, o_custkey AS person_id, o_totalprice AS hours FROM orders WHERE o_orderstatus = 'O'
          UNION ALL SELECT 'f' || o_orderkey, o_custkey, NULL FROM orders WHERE o_orderstatus = 'F'""")
def teaching_feed_rows(tb: Tables) -> DataFrame:
    key = lambda p: F.concat(F.lit(p), F.col("o_orderkey").cast("string")).alias("row_key")
    person = F.col("o_custkey").alias("person_id")
    feed, gate = teaching.teaching_feed({
        "feed_open": tb.orders.filter("o_orderstatus = 'O'").select(key("o"), person, F.col("o_totalprice").alias("hours")),
        "feed_filled": tb.orders.filter("o_orderstatus = 'F'").select(key("f"), person)}, ["row_key"])
    assert gate.passed, gate.reason
    return feed


# --- papers and patents -----------------------------------------------------------------------

def _papers(tb: Tables) -> DataFrame:
    return (tb.lineitem.join(tb.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(tb.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("l_partkey").alias("title"), F.date_format("l_shipdate", "yyyy-MM").alias("published"),
        (F.col("l_quantity") * 3).alias("citations"), F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("impact"),
        F.concat_ws(",", "l_returnflag", "l_linestatus").alias("index_codes"), F.col("l_linenumber").cast("string").alias("journal"),
        F.col("n_name").alias("dept"), F.col("n_regionkey").alias("college")))


@query("""SELECT strftime(l_shipdate, '%Y') AS year, count(DISTINCT l_partkey) AS n_papers,
    count(DISTINCT CASE WHEN l_quantity * 3 < 10 THEN l_partkey END) AS cited_0_9,
    count(DISTINCT CASE WHEN l_quantity * 3 >= 10 AND l_quantity * 3 < 50 THEN l_partkey END) AS cited_10_49,
    count(DISTINCT CASE WHEN l_quantity * 3 >= 50 AND l_quantity * 3 < 100 THEN l_partkey END) AS cited_50_99,
    count(DISTINCT CASE WHEN l_quantity * 3 >= 100 THEN l_partkey END) AS cited_100_up,
    count(DISTINCT CASE WHEN round(l_tax * 100) < 2 THEN l_partkey END) AS impact_0_1,
    count(DISTINCT CASE WHEN round(l_tax * 100) = 2 THEN l_partkey END) AS impact_2,
    count(DISTINCT CASE WHEN round(l_tax * 100) IN (3, 4) THEN l_partkey END) AS impact_3_4,
    count(DISTINCT CASE WHEN round(l_tax * 100) >= 5 THEN l_partkey END) AS impact_5_up FROM lineitem GROUP BY 1""")
def paper_bands_by_year(tb: Tables) -> DataFrame:
    return papers.paper_stats_by_year(_papers(tb))


@query("""SELECT n_regionkey AS college, n_name AS dept, count(DISTINCT l_partkey) AS n_papers,
    count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS n_class_r,
    count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_partkey END) AS n_class_o,
    count(DISTINCT CASE WHEN l_linenumber IN (1, 2) THEN l_partkey END) AS n_top,
    CASE WHEN grouping(n_name) = 0 THEN 'dept' WHEN grouping(n_regionkey) = 0 THEN 'college' ELSE 'total' END AS level
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
  GROUP BY GROUPING SETS ((n_regionkey, n_name), (n_regionkey), ())""")
def paper_counts_by_unit(tb: Tables) -> DataFrame:
    return papers.paper_stats_by_unit(_papers(tb), ["college", "dept"], {"n_class_r": "R", "n_class_o": "O"}, ["1", "2"])


@query("""WITH p AS (SELECT o_orderkey, o_orderpriority AS kind, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y')
                       WHEN 'O' THEN strftime(o_orderdate + INTERVAL 400 DAY, '%Y') ELSE '0' END AS year FROM orders),
               a AS (SELECT year, count(DISTINCT CASE WHEN kind = '1-URGENT' THEN o_orderkey END) AS n_invention,
                       count(DISTINCT CASE WHEN kind = '2-HIGH' THEN o_orderkey END) AS n_utility,
                       count(DISTINCT CASE WHEN kind NOT IN ('1-URGENT', '2-HIGH') THEN o_orderkey END) AS n_other,
                       count(DISTINCT o_orderkey) AS n_domestic FROM p GROUP BY 1),
               b AS (SELECT strftime(l_shipdate, '%Y') AS year, count(DISTINCT l_partkey) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
          SELECT year, n_invention, n_utility, n_other, n_domestic, coalesce(n, 0) AS n_international, n_domestic + coalesce(n, 0) AS n_total
          FROM a LEFT JOIN b USING (year)""")
def patent_totals(tb: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    rows = tb.orders.select(
        F.col("o_orderkey").alias("title"), F.col("o_orderpriority").alias("kind"),
        F.when(status == "F", F.date_format("o_orderdate", "yyyy.MM")).when(status == "O", "n/a").alias("granted"),
        F.when(status != "P", F.date_format(F.date_add("o_orderdate", 400), "yyyy.MM")).alias("applied"))
    abroad = tb.lineitem.filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("title"),
                                                            F.date_format("l_shipdate", "yyyy.MM").alias("applied"))
    return papers.patent_stats(rows, abroad, {"n_invention": "1-URGENT", "n_utility": "2-HIGH"})


# --- awards and member lists ------------------------------------------------------------------

@query("""WITH a AS (SELECT c_mktsegment AS major, o_orderkey AS award, o_orderpriority AS kind, o_orderstatus AS level,
                       strftime(o_orderdate, '%Y') AS year FROM orders JOIN customer ON c_custkey = o_custkey),
               n AS (SELECT l_orderkey, string_agg(DISTINCT s_name, ',' ORDER BY s_name) AS names FROM lineitem
                     JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1)
          SELECT major, award, kind, level, year, names,
            row_number() OVER (PARTITION BY major ORDER BY
              CASE level WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END, kind, year DESC, award) AS place
          FROM a LEFT JOIN n ON l_orderkey = award""")
def award_lists(tb: Tables) -> DataFrame:
    awards = tb.orders.select(
        "o_custkey", F.col("o_orderkey").alias("award"), F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("level"),
        F.date_format("o_orderdate", "yyyy").alias("year"))
    majors = tb.customer.select("c_custkey", F.col("c_mktsegment").alias("major"))
    rows = per_dimension(awards, majors, {"o_custkey": "c_custkey"}, ["major"]).withColumn(
        "_level", explicit_order("level", ["F", "O"]))
    order = [F.asc("_level"), F.asc("kind"), F.desc("year"), F.asc("award")]
    placed = rank_in(rows, ["major"], order, "place").drop("_level", "o_custkey")
    winners = tb.lineitem.join(tb.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("award"), "s_name")
    return placed.join(concat_group(winners, ["award"], "s_name", distinct=True, out="names", part_rows=2), "award", "left")


@query("""WITH l AS (SELECT l_orderkey, string_agg(l_partkey || '/' || l_suppkey, ',' ORDER BY l_partkey, l_suppkey) AS members FROM lineitem GROUP BY 1),
               m AS (SELECT DISTINCT l_orderkey, unnest(string_split(members, ',')) AS member FROM l)
          SELECT l_orderkey AS project, split_part(member, '/', 2) AS student_no, string_agg(split_part(member, '/', 1), ',' ORDER BY split_part(member, '/', 1)) AS names FROM m
          WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') GROUP BY 1, 2""")
def member_lists(tb: Tables) -> DataFrame:
    pairs = tb.lineitem.withColumns({"project": F.col("l_orderkey"), "member": F.concat_ws("/", "l_partkey", "l_suppkey")})
    lists = concat_group(pairs, ["project"], "member", "l_partkey", out="members")
    rows = explode_list(lists, "members", "member").select(
        "project", F.substring_index("member", "/", -1).alias("student_no"), F.substring_index("member", "/", 1).alias("name"))
    known = tb.orders.filter("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("project"))
    return concat_group(keep_missing(rows, known, ["project"]), ["project", "student_no"], "name", distinct=True, out="names")
