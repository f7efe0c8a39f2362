"""Set operations, merges, logs and matching."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import money
from tallyloom.functions.records import row_id
from tallyloom.functions.text import canonical_number, fold_key, is_blank, replace_all
from tallyloom.operators import merge as m
from tallyloom.operators import sets as s
from tallyloom.operators.groups import collect_members
from tallyloom.operators.matching import Rule, match_cascade, resolve_identity
from tallyloom.operators.merge import Policy
from tallyloom.scale import fresh_path
from tallyloom.sources.tables import Published
from tallyloom.workload.registry import Tables, query

NOW = dt.datetime(2024, 2, 1)
# All orders before this day make the old state, all from it on the new one.
SPLIT = "1998-07-01"
OLD, NEW = f"o_orderdate < TIMESTAMP '{SPLIT}'", f"o_orderdate >= TIMESTAMP '{SPLIT}'"


def customer_snapshot(tb: Tables, side: str) -> DataFrame:
    """Customers that ordered on one side of the split, with what they ordered."""
    inside = tb.orders.filter(side)
    active = inside.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count("*").alias("n_orders"), F.sum(money("o_totalprice")).cast("decimal(18,2)").alias("total"),
        F.nullif(F.min("o_orderpriority"), F.lit("5-LOW")).alias("priority"))
    return active.join(tb.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"),
                                          F.col("c_nationkey").alias("nation")), "custkey")


def _snapshot_sql(side: str) -> str:
    return f"""SELECT o_custkey AS custkey, n_orders, total, priority, c_mktsegment AS segment, c_nationkey AS nation
        FROM (SELECT o_custkey, count(*) AS n_orders,
                CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total,
                nullif(min(o_orderpriority), '5-LOW') AS priority FROM orders
              WHERE {side} GROUP BY 1)
        JOIN customer ON c_custkey = o_custkey"""


WITH = f"WITH b AS ({_snapshot_sql(OLD)}), n AS ({_snapshot_sql(NEW)}) "
DIFFERS = """(b.n_orders <> n.n_orders OR b.total <> n.total OR coalesce(b.priority, '') <> coalesce(n.priority, ''))"""
WATCH = ["n_orders", "total", "priority"]


def snapshots(tb: Tables) -> tuple[DataFrame, DataFrame]:
    return customer_snapshot(tb, OLD), customer_snapshot(tb, NEW)


# --- unions -----------------------------------------------------------------------------------

@query("""SELECT c_custkey AS id, 'customer' AS kind, c_mktsegment AS class, c_acctbal AS balance FROM customer
          UNION SELECT s_suppkey, 'supplier', NULL, s_acctbal FROM supplier
          UNION SELECT CAST(n_nationkey AS BIGINT), 'nation', NULL, NULL FROM nation
          UNION SELECT l_suppkey, 'supplier', NULL, NULL FROM lineitem""")
def union_of_layouts(tb: Tables) -> DataFrame:
    return s.union_layouts([
        tb.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"),
                           F.col("c_mktsegment").alias("class"), F.col("c_acctbal").alias("balance")),
        tb.supplier.select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"),
                           F.col("s_acctbal").alias("balance")),
        tb.nation.select(F.col("n_nationkey").cast("long").alias("id"), F.lit("nation").alias("kind")),
        tb.lineitem.select(F.col("l_suppkey").alias("id"), F.lit("supplier").alias("kind"))])


@query("""SELECT k, count(*) AS n FROM (SELECT o_custkey AS k FROM orders UNION ALL SELECT user_id FROM events
            UNION ALL SELECT l_suppkey FROM lineitem) GROUP BY k""")
def union_all_counts(tb: Tables) -> DataFrame:
    frames = [tb.orders.select(F.col("o_custkey").alias("k")), tb.events.select(F.col("user_id").alias("k")),
              tb.lineitem.select(F.col("l_suppkey").alias("k"))]
    return s.union_layouts(frames, distinct=False).groupBy("k").agg(F.count("*").alias("n"))


@query("""SELECT y, status, count(*) AS n_rows, count(DISTINCT id) AS n_ids FROM (
            SELECT 'y' || year(o_orderdate) AS y, o_orderstatus AS status, 'o' || o_orderkey AS id FROM orders
            UNION ALL SELECT 'y' || year(l_shipdate), l_linestatus,
              'l' || row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate)
            FROM lineitem) GROUP BY 1, 2""")
def union_with_fresh_ids(tb: Tables) -> DataFrame:
    # rows carry their own id, so equal values must survive the union
    orders = tb.orders.select(F.concat(F.lit("y"), F.year("o_orderdate")).alias("y"),
                              F.col("o_orderstatus").alias("status"), row_id(F.lit("o"), "o_orderkey").alias("id"))
    lines = tb.lineitem.select(F.concat(F.lit("y"), F.year("l_shipdate")).alias("y"), F.col("l_linestatus").alias("status"),
                               F.uuid().alias("id"))
    stacked = s.union_layouts([orders, lines], distinct=False)
    return stacked.groupBy("y", "status").agg(F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids"))


# --- differences and merges -------------------------------------------------------------------

@query(WITH + f"""SELECT coalesce(n.custkey, b.custkey) AS custkey, CASE WHEN b.custkey IS NULL THEN 'new'
            WHEN n.custkey IS NULL THEN 'removed' WHEN {DIFFERS} THEN 'changed' ELSE 'same' END AS change,
            n.n_orders AS new_n, b.n_orders AS old_n
          FROM n FULL JOIN b ON b.custkey = n.custkey""")
def snapshot_diff(tb: Tables) -> DataFrame:
    before, now = snapshots(tb)
    return s.diff(now, before, ["custkey"], WATCH, keep_same=True).select(
        "custkey", "change", F.col("new_n_orders").alias("new_n"), F.col("old_n_orders").alias("old_n"))


@query(WITH + "SELECT n.custkey FROM n WHERE n.custkey NOT IN (SELECT custkey FROM b)")
def snapshot_new_rows(tb: Tables) -> DataFrame:
    before, now = snapshots(tb)
    return s.diff(now, before, ["custkey"], WATCH).filter("change = 'new'").select("custkey")


@query(WITH + f"SELECT n.custkey FROM n JOIN b ON b.custkey = n.custkey WHERE {DIFFERS}")
def snapshot_changed_rows(tb: Tables) -> DataFrame:
    before, now = snapshots(tb)
    return s.diff(now, before, ["custkey"], WATCH).filter("change = 'changed'").select("custkey")


@query(WITH + "SELECT b.custkey FROM b WHERE b.custkey NOT IN (SELECT custkey FROM n)")
def snapshot_removed_rows(tb: Tables) -> DataFrame:
    before, now = snapshots(tb)
    return s.diff(now, before, ["custkey"], WATCH).filter("change = 'removed'").select("custkey")


@query(WITH + """SELECT n.custkey, n.n_orders, CAST(coalesce(b.total, n.total) AS DOUBLE) AS total, n.priority
                 FROM n LEFT JOIN b ON b.custkey = n.custkey""")
def merge_snapshot_customers(tb: Tables) -> DataFrame:
    before, now = snapshots(tb)  # `total` is the users' own column: the merge leaves it alone
    out = m.merge_snapshot(before, now, ["custkey"], ["n_orders", "priority"])
    return out.select("custkey", "n_orders", F.col("total").cast("double"), "priority")


@query(WITH + """SELECT coalesce(n.custkey, b.custkey) AS custkey, coalesce(n.n_orders, b.n_orders) AS n_orders
                 FROM n FULL JOIN b ON b.custkey = n.custkey
                 WHERE NOT (n.custkey IS NULL AND b.segment IN ('BUILDING', 'MACHINERY'))""")
def merge_within_scope(tb: Tables) -> DataFrame:
    before, now = snapshots(tb)
    scope = F.col("segment").isin("BUILDING", "MACHINERY")
    return m.merge_snapshot(before, now, ["custkey"], scope=scope).select("custkey", "n_orders")


@query(WITH + """SELECT coalesce(n.custkey, b.custkey) AS custkey, coalesce(n.n_orders, b.n_orders) AS n_orders,
                   CASE WHEN n.custkey IS NULL THEN 'Y' ELSE 'N' END AS deleted
                 FROM n FULL JOIN b ON b.custkey = n.custkey""")
def merge_with_logical_delete(tb: Tables) -> DataFrame:
    before, now = snapshots(tb)
    target = before.withColumn("deleted", F.when(F.col("segment") == "BUILDING", "Y").otherwise("N"))
    return m.merge_snapshot(target, now, ["custkey"], delete="flag", flag="deleted").select(
        "custkey", "n_orders", "deleted")


@query(WITH + """SELECT coalesce(n.custkey, b.custkey) AS custkey, coalesce(n.n_orders, b.n_orders) AS n_orders,
                   CAST(coalesce(n.total, b.total) AS DOUBLE) AS total
                 FROM n FULL JOIN b ON b.custkey = n.custkey""")
def upsert_rows(tb: Tables) -> DataFrame:
    before, now = snapshots(tb)
    return m.upsert(before, now, ["custkey"]).select("custkey", "n_orders", F.col("total").cast("double"))


LABELS = {"n_orders": "orders", "total": "sum", "priority": "priority"}
CHANGE_TEXT = """CASE WHEN b.n_orders <> n.n_orders THEN 'orders:' || b.n_orders || '-->' || n.n_orders || ';' ELSE '' END
    || CASE WHEN b.total <> n.total THEN 'sum:' || b.total || '-->' || n.total || ';' ELSE '' END
    || CASE WHEN coalesce(b.priority, '') <> coalesce(n.priority, '')
         THEN 'priority:' || coalesce(b.priority, '') || '-->' || coalesce(n.priority, '') || ';' ELSE '' END"""


@query(WITH + f"""SELECT n.custkey, {CHANGE_TEXT} AS change_text FROM n JOIN b ON b.custkey = n.custkey
                  WHERE {CHANGE_TEXT} <> ''""")
def change_log_customers(tb: Tables) -> DataFrame:
    before, now = snapshots(tb)
    return m.change_log(before, now, ["custkey"], LABELS)


def _image(t: str) -> str:
    return f"""'{{"custkey":' || {t}.custkey || ',"n_orders":' || {t}.n_orders || ',"priority":' ||
        CASE WHEN {t}.priority IS NULL THEN 'null' ELSE '"' || {t}.priority || '"' END || ',"members":' || m.members || '}}'"""


@query(WITH + f""", m AS (SELECT o_custkey, '[' || string_agg('{{"o_orderkey":' || o_orderkey || '}}', ',' ORDER BY o_orderkey)
                          || ']' AS members FROM orders GROUP BY 1)
          SELECT n.custkey, {CHANGE_TEXT} AS change_text, {_image('b')} AS image_before, {_image('n')} AS image_after
          FROM n JOIN b ON b.custkey = n.custkey JOIN m ON m.o_custkey = n.custkey WHERE {CHANGE_TEXT} <> ''""")
def audit_images_customers(tb: Tables) -> DataFrame:
    before, now = snapshots(tb)
    members = collect_members(tb.orders.withColumnRenamed("o_custkey", "custkey"), ["custkey"], ["o_orderkey"],
                              ["o_orderkey"], part_rows=2)
    return m.audit_images(before, now, ["custkey"], LABELS, ["n_orders", "priority"], members)


@query(WITH + f"""SELECT n.custkey, n.n_orders, CASE WHEN b.custkey IS NULL THEN 'new' ELSE 'changed' END AS change
                  FROM n LEFT JOIN b ON b.custkey = n.custkey WHERE b.custkey IS NULL OR {DIFFERS}""")
def diff_feed_customers(tb: Tables) -> DataFrame:
    before, now = snapshots(tb)
    return m.diff_feed(now, before, ["custkey"], WATCH).rows.select("custkey", "n_orders", "change")


@query(WITH + f"""SELECT run, change, n FROM (
            SELECT 'first' AS run, 'new' AS change, count(*) AS n FROM b
            UNION ALL SELECT 'second', 'new', count(*) FROM n WHERE custkey NOT IN (SELECT custkey FROM b)
            UNION ALL SELECT 'second', 'changed', count(*) FROM n JOIN b ON b.custkey = n.custkey WHERE {DIFFERS}
            UNION ALL SELECT 'back', 'new', count(*) FROM b WHERE custkey NOT IN (SELECT custkey FROM n)
            UNION ALL SELECT 'back', 'changed', count(*) FROM n JOIN b ON b.custkey = n.custkey WHERE {DIFFERS}) WHERE n > 0""")
def rolled_forward_feed(tb: Tables) -> DataFrame:
    """A first snapshot, the next one twice, and the first again: the repeated run sends nothing."""
    before, now = snapshots(tb)
    tables = Published(tb.spark, fresh_path(tb.spark, "feed"))
    out = None
    for run, snapshot in (("first", before), ("second", now), ("again", now), ("back", before)):
        sent = tables.roll_forward("customers", snapshot, ["custkey"], WATCH, NOW)
        counted = sent.groupBy(F.lit(run).alias("run"), "change").agg(F.count("*").alias("n"))
        out = counted if out is None else out.unionByName(counted)
    return out


@query("""WITH src AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'),
               p AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'),
               mem AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_linestatus = 'O')
          SELECT l_orderkey, l_partkey, CASE WHEN l_orderkey NOT IN (SELECT o_orderkey FROM p) THEN 'add_both'
                   WHEN (l_orderkey, l_partkey) NOT IN (SELECT (l_orderkey, l_partkey) FROM mem) THEN 'add_member'
                   ELSE 'update' END AS action FROM src""")
def parent_child_actions(tb: Tables) -> DataFrame:
    src = tb.lineitem.filter("l_returnflag = 'R'").select("l_orderkey", "l_partkey").distinct()
    parents = tb.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    members = tb.lineitem.filter("l_linestatus = 'O'").select("l_orderkey", "l_partkey")
    return m.sync_parent_child(src, parents, members, "l_orderkey", ["l_orderkey", "l_partkey"])


# --- matching ---------------------------------------------------------------------------------

_STEP = """{name} AS (SELECT a.id AS left_id, c.id AS right_id, {n} AS rule FROM (
    SELECT id, {lkey} AS k, row_number() OVER (PARTITION BY {lkey} ORDER BY id) AS rn FROM l
    WHERE coalesce({lkey}, '') <> '' {lskip}) a JOIN (
    SELECT id, {rkey} AS k, row_number() OVER (PARTITION BY {rkey} ORDER BY id) AS rn FROM r
    WHERE coalesce({rkey}, '') <> '' {rskip}) c ON a.k = c.k AND a.rn = c.rn)"""
_L1 = "AND id NOT IN (SELECT left_id FROM m1)"
_R1 = "AND id NOT IN (SELECT right_id FROM m1)"
_L2, _R2 = _L1 + " AND id NOT IN (SELECT left_id FROM m2)", _R1 + " AND id NOT IN (SELECT right_id FROM m2)"
_DIGITS = "split_part(replace(replace(replace(number, ' ', ''), 'CN', ''), 'ZL', ''), '.', 1)"
_MATCH_SQL = """WITH base AS (SELECT p_partkey, p_size, p_brand, p_name, p_type, 'ZL20' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS no
                      FROM part),
  l AS (SELECT p_partkey AS id, CASE p_type WHEN 'ECONOMY' THEN no WHEN 'SMALL' THEN replace(no, 'ZL', 'CN ') || '.' || p_size
               WHEN 'MEDIUM' THEN '' END AS number, upper(p_name) || ' ' AS title, p_brand AS brand FROM base),
  r AS (SELECT p_partkey + 1000000 AS id, CASE WHEN p_size >= 10 THEN no END AS number, p_name AS title, p_brand AS brand
        FROM base WHERE p_brand <> 'Brand#3'),
""" + ", ".join([
    _STEP.format(name="m1", n=1, lkey="number", rkey="number", lskip="", rskip=""),
    _STEP.format(name="m2", n=2, lkey=_DIGITS, rkey=_DIGITS, lskip=_L1, rskip=_R1),
    _STEP.format(name="m3", n=3, lkey="lower(trim(title)) || '|' || brand", rkey="lower(trim(title)) || '|' || brand",
                 lskip=_L2, rskip=_R2)]) + """
  SELECT l.id AS left_id, x.right_id, CAST(coalesce(x.rule, 0) AS BIGINT) AS rule FROM l LEFT JOIN (
    SELECT * FROM m1 UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m3) x ON x.left_id = l.id"""


@query(_MATCH_SQL)
def match_cascade_parts(tb: Tables) -> DataFrame:
    number = F.concat(F.lit("ZL20"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"))
    damaged = (F.when(F.col("p_type") == "ECONOMY", number)
               .when(F.col("p_type") == "SMALL", F.concat(replace_all(number, {"ZL": "CN "}), F.lit("."), "p_size"))
               .when(F.col("p_type") == "MEDIUM", F.lit("")))
    left = tb.part.select(F.col("p_partkey").alias("left_id"), damaged.alias("number"),
                          F.concat(F.upper("p_name"), F.lit(" ")).alias("title"), F.col("p_brand").alias("brand"))
    right = tb.part.filter("p_brand <> 'Brand#3'").select(
        (F.col("p_partkey") + 1_000_000).alias("right_id"), F.when(F.col("p_size") >= 10, number).alias("number"),
        F.col("p_name").alias("title"), F.col("p_brand").alias("brand"))
    digits = canonical_number("number", (" ", "CN", "ZL"))
    titled = F.concat_ws("|", fold_key("title"), "brand")
    rules = [Rule("number", F.col("number"), F.col("number")), Rule("digits", digits, digits),
             Rule("title", titled, titled)]
    out = match_cascade(left, right, rules, "left_id", "right_id")
    return out.withColumn("rule", F.col("rule").cast("long"))


@query("""WITH e AS (SELECT event_id, CASE WHEN event_type = 'click' THEN user_id END AS ident,
                       CASE WHEN event_type = 'view' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS legacy,
                       'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS name,
                       CASE WHEN value > 5 THEN 'Customer#' || lpad(CAST(json_extract(props, '$.k') AS VARCHAR), 9, '0') END AS alt,
                       CASE WHEN value > 50 THEN c_acctbal END AS balance
                     FROM events LEFT JOIN customer ON c_custkey = user_id),
               u AS (SELECT c_acctbal, min(c_custkey) AS c_custkey FROM customer GROUP BY 1 HAVING count(*) = 1)
          SELECT event_id, coalesce(ident, a.c_custkey, b.c_custkey, u.c_custkey) AS ident,
                 CAST(CASE WHEN ident IS NOT NULL THEN 0 WHEN a.c_custkey IS NOT NULL THEN 1 WHEN b.c_custkey IS NOT NULL THEN 2
                      WHEN u.c_custkey IS NOT NULL THEN 3 END AS BIGINT) AS resolved_by
          FROM e LEFT JOIN customer a ON a.c_custkey = legacy AND a.c_name = name
          LEFT JOIN customer b ON b.c_name = alt LEFT JOIN u ON u.c_acctbal = balance""")
def resolved_identities(tb: Tables) -> DataFrame:
    code = F.get_json_object("props", "$.k")
    with_balance = tb.events.join(tb.customer.select(F.col("c_custkey").alias("user_id"), "c_acctbal"), "user_id", "left")
    rows = with_balance.select(
        "event_id", F.when(F.col("event_type") == "click", F.col("user_id")).alias("ident"),
        F.when(F.col("event_type") == "view", code.cast("long")).alias("legacy"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("name"),
        F.when(F.col("value") > 5, F.concat(F.lit("Customer#"), F.lpad(code, 9, "0"))).alias("alt"),
        F.when(F.col("value") > 50, F.col("c_acctbal")).alias("balance"))
    people = tb.customer.select("c_custkey", "c_name", "c_acctbal")
    out = resolve_identity(rows, people, [[("legacy", "c_custkey"), ("name", "c_name")], [("alt", "c_name")],
                                          [("balance", "c_acctbal")]], "ident", "c_custkey")
    return out.select("event_id", "ident", F.col("resolved_by").cast("long"))


# --- policies, overlays, logs -----------------------------------------------------------------

def _policy(tb: Tables) -> m.PolicyResult:
    state = (F.when(F.col("n_regionkey").isin(0, 1), "confirmed").when(F.col("n_regionkey").isin(2, 3), "open")
             .otherwise("deleted"))
    target = tb.customer.join(tb.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("custkey"), state.alias("state"),
        F.when(F.col("c_acctbal") < 0, "").when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("name"),
        F.col("c_mktsegment").alias("segment"))
    src = tb.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.min("o_orderpriority").alias("segment"), F.concat(F.lit("N"), F.max("o_orderkey").cast("string")).alias("name"),
        (F.count("*") < 8).alias("weak"))
    policies = {"confirmed": Policy({"segment": "always", "name": "fill"}),
                "open": Policy({"segment": "always", "name": "always"}, next_state="confirmed")}
    return m.policy_update(target, src, ["custkey"], "state", policies, {"name": "name", "segment": "class"}, weak="weak")


_POLICY_SQL = """WITH t AS (SELECT c_custkey AS custkey, CASE WHEN n_regionkey IN (0, 1) THEN 'confirmed'
                      WHEN n_regionkey IN (2, 3) THEN 'open' ELSE 'deleted' END AS state,
                      CASE WHEN c_acctbal < 0 THEN '' WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS name,
                      c_mktsegment AS segment FROM customer JOIN nation ON n_nationkey = c_nationkey),
    s AS (SELECT o_custkey, min(o_orderpriority) AS segment, 'N' || max(o_orderkey) AS name, count(*) < 8 AS weak
          FROM orders GROUP BY 1),
    u AS (SELECT t.custkey, t.state AS old_state, t.name AS old_name, t.segment AS old_segment,
            CASE WHEN o_custkey IS NOT NULL AND t.state = 'open' AND NOT weak THEN 'confirmed' ELSE t.state END AS state,
            CASE WHEN o_custkey IS NULL OR t.state = 'deleted' THEN t.name
                 WHEN t.state = 'open' OR coalesce(t.name, '') = '' THEN s.name ELSE t.name END AS name,
            CASE WHEN o_custkey IS NULL OR t.state = 'deleted' THEN t.segment ELSE s.segment END AS segment
          FROM t LEFT JOIN s ON o_custkey = custkey) """


@query(_POLICY_SQL + "SELECT custkey, state, name, segment FROM u")
def policy_update_rows(tb: Tables) -> DataFrame:
    return _policy(tb).rows


@query(_POLICY_SQL + """, x AS (SELECT custkey,
    CASE WHEN coalesce(old_name, '') <> coalesce(name, '') THEN 'name:' || coalesce(old_name, '') || '-->' || name || ';' ELSE '' END
    || CASE WHEN old_segment <> segment THEN 'class:' || old_segment || '-->' || segment || ';' ELSE '' END AS change_text FROM u)
  SELECT custkey, change_text FROM x WHERE change_text <> ''""")
def policy_update_log(tb: Tables) -> DataFrame:
    return _policy(tb).log


@query("""WITH base AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
               imp AS (SELECT * FROM orders WHERE o_totalprice > 250000)
          SELECT o_orderkey, o_orderstatus FROM base
          WHERE o_orderkey NOT IN (SELECT o_orderkey FROM imp WHERE o_orderpriority = '5-LOW')
          UNION ALL SELECT o_orderkey, o_orderstatus FROM imp
          WHERE o_orderpriority <> '5-LOW' AND o_orderkey NOT IN (SELECT o_orderkey FROM base)""")
def overlay_orders(tb: Tables) -> DataFrame:
    base, imports = tb.orders.filter("o_orderstatus <> 'P'"), tb.orders.filter("o_totalprice > 250000")
    return m.overlay(base, imports, ["o_orderkey"], F.col("o_orderpriority") == "5-LOW").select(
        "o_orderkey", "o_orderstatus")


@query("""SELECT event_id, user_id, event_type FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""")
def deduped_log(tb: Tables) -> DataFrame:
    return m.dedupe_log(tb.events, ["user_id", "event_type"], F.to_date("ts"), [F.asc("ts"), F.asc("event_id")]).select(
        "event_id", "user_id", "event_type")


@query("""SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0 OR c_name IS NULL""")
def blank_names(tb: Tables) -> DataFrame:
    rows = tb.customer.withColumn("shown", F.when(F.col("c_acctbal") >= 0, F.col("c_name")).otherwise(F.lit(" ")))
    return rows.filter(is_blank("shown")).select("c_custkey", "c_name")
