"""Change logs, table writes, ledgers and streams.

The change log is built from the events table: sharded database and table names, the payload as
JSON, and one broken copy of every `error` event's line.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom import scale
from tallyloom.functions.numbers import money
from tallyloom.operators.groups import max_ts_by_hour
from tallyloom.operators.predicates import allow
from tallyloom.operators.windows import latest_per
from tallyloom.sources import events as ev
from tallyloom.sources import tables as st
from tallyloom.sources.html import html_list_items
from tallyloom.sources.keyed import KeyedTable, apply_window
from tallyloom.streaming import ingest as si
from tallyloom.workload.registry import Tables, query

NOW = dt.datetime(2024, 2, 1)
PAYLOAD = "event_id bigint, k bigint, value double"


def change_lines(tb: Tables) -> DataFrame:
    """Envelope lines; the payload's second column is upper case."""
    seconds = F.unix_timestamp("ts")
    data = F.to_json(F.struct("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"),
                              F.col("value"), F.col("user_id").alias("USER_REF")))
    lines = ev.to_lines(
        tb.events, F.concat(F.lit("shop"), (F.col("user_id") % 4).cast("string")),
        F.concat(F.col("event_type"), F.lit("_0"), (F.col("event_id") % 3).cast("string")),
        F.when(F.col("value") > 20, "update").otherwise("insert"), seconds, F.col("event_id"), data)
    broken = lines.filter(F.contains("value", F.lit('"error_'))).select(
        F.expr("substring(value, 1, length(value) - 3)").alias("value"))
    return lines.unionByName(broken)


def good_events(tb: Tables) -> DataFrame:
    return ev.parse_events(change_lines(tb)).good


_SECONDS = "CAST(floor(epoch(ts)) AS BIGINT)"


@query(f"""SELECT 'shop' || (user_id % 4) AS database, event_type || '_0' || (event_id % 3) AS "table",
             CASE WHEN value > 20 THEN 'update' ELSE 'insert' END AS type, {_SECONDS} AS ts, event_id AS xid FROM events""")
def parsed_change_events(tb: Tables) -> DataFrame:
    return good_events(tb).select("database", "table", "type", "ts", "xid")


@query("SELECT count(*) AS n_bad FROM events WHERE event_type = 'error'")
def quarantined_lines(tb: Tables) -> DataFrame:
    return ev.parse_events(change_lines(tb)).bad.agg(F.count("*").alias("n_bad"))


@query("""SELECT 'shop' AS database, event_type AS "table", 'shop' || (user_id % 4) AS etl_db,
             event_type || '_0' || (event_id % 3) AS etl_table, count(*) AS n FROM events GROUP BY ALL""")
def folded_shards(tb: Tables) -> DataFrame:
    return ev.fold_shards(good_events(tb)).groupBy("database", "table", "etl_db", "etl_table").agg(
        F.count("*").alias("n"))


@query("""SELECT event_id AS xid, event_type AS "table" FROM events
          WHERE user_id % 4 IN (0, 2) AND event_type IN ('click', 'purchase')""")
def allowed_tables(tb: Tables) -> DataFrame:
    folded = ev.fold_shards(good_events(tb))
    return allow(folded, {"etl_db": ["shop0", "shop2"], "table": ["click", "purchase"]}).select("xid", "table")


@query(f"""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value,
             CASE WHEN value > 20 THEN 'update' ELSE 'insert' END AS etl_type,
             strftime(to_timestamp({_SECONDS}), '%Y-%m-%d %H:%M:%S') AS etl_time, event_id AS etl_xid,
             '20240201000000' AS flowid, strftime(ts, '%Y-%m-%d') AS dt FROM events""")
def flattened_events(tb: Tables) -> DataFrame:
    flat = ev.flatten_events(good_events(tb), PAYLOAD, "20240201000000").good
    return flat.withColumns({"etl_time": F.date_format("etl_time", "yyyy-MM-dd HH:mm:ss"),
                             "dt": F.date_format("dt", "yyyy-MM-dd")})


@query("""SELECT event_type || '_0' || (event_id % 3) AS "table", CASE event_type WHEN 'signup' THEN 'payload does not fit: event_id'
              WHEN 'purchase' THEN 'payload does not fit: k,value' WHEN 'error' THEN 'payload is not an object' ELSE 'fits' END AS reason,
            count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY ALL""")
def unfit_payloads(tb: Tables) -> DataFrame:
    """Ids as text, fractions for whole numbers and words for numbers, and payloads that are lists: none becomes a null, each says why."""
    number = F.get_json_object("props", "$.k").cast("long")
    kind = F.col("event_type")
    data = (F.when(kind == "signup", F.to_json(F.struct(F.concat(F.lit("e"), "event_id").alias("event_id"), number.alias("k"), "value")))
            .when(kind == "purchase", F.to_json(F.struct("event_id", (number + F.lit(0.5)).alias("k"), F.lit("much").alias("value"))))
            .when(kind == "error", F.to_json(F.array("event_id", "user_id")))
            .otherwise(F.to_json(F.struct("event_id", number.alias("k"), "value"))))
    lines = ev.to_lines(tb.events, F.lit("shop"), F.concat(kind, F.lit("_0"), (F.col("event_id") % 3).cast("string")), F.lit("insert"),
                        F.unix_timestamp("ts"), F.col("event_id"), data)
    # shard numbers of the tables stay; the payload's own table is the folded name
    flat = ev.flatten_events(ev.fold_shards(ev.parse_events(lines).good), PAYLOAD, "b")
    told = lambda df, reason, ident: df.select(F.col("etl_table").alias("table"), reason.alias("reason"), ident.alias("id"))
    both = told(flat.good, F.lit("fits"), F.col("event_id")).unionByName(told(flat.bad, F.col("reason"), F.col("xid")))
    return both.groupBy("table", "reason").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


TARGET = "dt date, EVENT_ID bigint, note string, value double, stars int"


@query("""SELECT strftime(ts, '%Y-%m-%d') AS dt, event_id, '' AS note, value, CAST(NULL AS BIGINT) AS stars FROM events""")
def aligned_columns(tb: Tables) -> DataFrame:
    aligned = ev.align_to(ev.flatten_events(good_events(tb), PAYLOAD, "b").good, StructType.fromDDL(TARGET))
    return aligned.df.select(F.date_format("dt", "yyyy-MM-dd").alias("dt"), F.col("EVENT_ID").alias("event_id"), "note",
                             "value", F.col("stars").cast("long"))


@query("""SELECT "table", "column", count(*) AS n_events FROM (SELECT event_type || '_0' || (event_id % 3) AS "table",
            unnest(['event_id', 'k', 'value', 'USER_REF']) AS "column" FROM events) GROUP BY ALL""")
def payload_columns(tb: Tables) -> DataFrame:
    return ev.payload_columns(good_events(tb))


def hour_files(tb: Tables) -> DataFrame:
    """One file per event under its hour directory."""
    path = F.concat(F.lit("/lake/binlog/"), F.date_format("ts", "yyyy/MM/dd/HH"), F.lit("/part-"), "event_id")
    return ev.with_path_hour(tb.events.select(path.alias("file"), F.col("ts").alias("modificationTime")))


_FILES = """files AS (SELECT '/lake/binlog/' || strftime(ts, '%Y/%m/%d/%H') || '/part-' || event_id AS file,
               strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hr, ts, event_type FROM events)"""


@query(f"WITH {_FILES} SELECT file, day, hr FROM files")
def files_by_hour(tb: Tables) -> DataFrame:
    return hour_files(tb).select("file", "day", "hr")


_LEDGER_END = "2024-01-15 12:00:00"


@query(f"""WITH {_FILES}, ledger AS (SELECT * FROM files WHERE ts < TIMESTAMP '{_LEDGER_END}' AND event_type <> 'view'),
             hours AS (SELECT DISTINCT day, hr FROM ledger ORDER BY day DESC, hr DESC LIMIT 2),
             newest AS (SELECT max(strptime(day || ' ' || hr, '%Y-%m-%d %H')) AS h FROM hours)
           SELECT file, day, hr FROM files, newest
           WHERE file NOT IN (SELECT file FROM ledger) AND date_trunc('hour', ts) <= h + INTERVAL 24 HOUR
           ORDER BY date_trunc('hour', ts) < h AND (day, hr) NOT IN (SELECT (day, hr) FROM hours), day, hr, file LIMIT 200""")
def next_files(tb: Tables) -> DataFrame:
    files = hour_files(tb)
    seen = (F.col("modificationTime") < F.lit(_LEDGER_END).cast("timestamp_ntz")) & (F.col("event_type") != "view")
    ledger = ev.with_path_hour(tb.events.withColumn("modificationTime", F.col("ts")).filter(seen).select(
        F.concat(F.lit("/lake/binlog/"), F.date_format("ts", "yyyy/MM/dd/HH"), F.lit("/part-"), "event_id").alias("file")))
    return ev.select_new_files(files, ledger, max_hours=24, max_files=200).select("file", "day", "hr")


@query(f"WITH {_FILES} SELECT file FROM files ORDER BY ts DESC, file LIMIT 100")
def first_files(tb: Tables) -> DataFrame:
    files = hour_files(tb)
    return ev.select_new_files(files, files.filter("file is null")).select("file")


@query(f"WITH {_FILES} SELECT file, CAST(1 AS BIGINT) AS times, CAST(1 AS BIGINT) AS intervals FROM files")
def whole_history(tb: Tables) -> DataFrame:
    """A first run takes the newest files, further runs what was there before, until every file has been taken once."""
    files, path = scale.written(hour_files(tb)), scale.fresh_path(tb.spark, "files")
    batch = -(-files.count() // 3)
    ledger = files.limit(0)
    while True:
        chosen = scale.written(ev.select_new_files(files, ledger, max_files=batch, first_files=batch // 2))
        if chosen.isEmpty():
            break
        st.write_ledger(st.file_ledger_rows(chosen, "flow", "f", NOW), path)
        ledger = tb.spark.read.parquet(path)
    coverage = ev.hour_coverage(files, ledger)
    assert not ev.history_open(coverage)
    return ledger.groupBy("file").agg(F.count("*").alias("times")).withColumn(
        "intervals", ev.covered_intervals(coverage).select(F.count("*")).scalar())


_PAUSE = ("2024-01-10 12:00:00", "2024-01-22 12:00:00")  # longer than the 240 hours walked at once


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hr, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1, 2""")
def listed_hours(tb: Tables) -> DataFrame:
    """Files in hour folders: taken up to a pause, across it, with a late file in a recorded hour, and those of the pause at last."""
    root = scale.fresh_path(tb.spark, "hours")
    stamped = tb.events.select(F.concat_ws(" ", "event_id", F.date_format("ts", "yyyy-MM-dd HH")).alias("value"), "ts", "event_type", *[
        F.date_format("ts", f).alias(n) for n, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))])
    begin, end = (F.lit(t).cast("timestamp_ntz") for t in _PAUSE)
    late = (F.col("event_type") == "click") & (F.col("ts") >= begin - F.expr("interval 1 hour"))
    parts = ["year", "month", "day", "hour"]
    names = [f"{p}=" for p in parts]
    ledger_path, taken = f"{root}/ledger", None

    def arrive(rows: DataFrame) -> None:
        rows.drop("ts", "event_type").repartition(*parts).write.mode("append").partitionBy(*parts).text(f"{root}/log")

    def take(history: bool) -> None:
        nonlocal taken
        while True:
            ledger = tb.spark.read.parquet(ledger_path) if taken is not None else tb.spark.createDataFrame([], st.FILE_LEDGER)
            hours = ev.hours_glob(ledger, max_hours=240, root=root, topic="log", history=history, names=names)
            listed = scale.written(ev.list_files(tb.spark, root, "log", hours))
            chosen = scale.written(ev.select_new_files(listed, ledger, max_hours=240, max_files=1000, first_files=300, history=history))
            paths = [r[0] for r in chosen.select("file").collect()]  # 1000 at most
            if not paths:
                return
            lines = scale.written(ev.read_lines(tb.spark, paths))
            taken = lines if taken is None else taken.unionByName(lines)
            st.write_ledger(st.file_ledger_rows(chosen, "flow", "f", NOW), ledger_path)

    before, after = F.col("ts") < begin, F.col("ts") >= end
    arrive(stamped.filter(before & ~late))
    take(True)
    arrive(stamped.filter((before & late) | after))  # late files beside what comes after the pause
    take(False)
    arrive(stamped.filter(~before & ~after))
    take(True)
    cut = F.split("value", " ")
    return taken.groupBy(cut[1].alias("day"), cut[2].alias("hr")).agg(F.count("*").alias("n"), F.sum(cut[0].cast("long")).alias("ids"))


# --- table writes -----------------------------------------------------------------------------

def _daily(tb: Tables, kind: Column) -> DataFrame:
    return tb.events.filter(kind).select(
        "event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("dt"), F.lit("flow-a").alias("flowid"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1
          UNION ALL SELECT 'extra', count(*) FROM events WHERE event_type = 'error'""")
def replayed_partitions(tb: Tables) -> DataFrame:
    path = scale.fresh_path(tb.spark, "ods")
    extra = _daily(tb, F.col("event_type") == "error").withColumn("dt", F.lit("extra"))
    st.write_partitions(extra, path, ["dt", "flowid"])
    for _ in range(2):  # a replay replaces its own partitions and no others
        st.write_partitions(_daily(tb, F.col("event_type") != "error"), path, ["dt", "flowid"], files=4)
    return tb.spark.read.schema("event_id bigint, value double, dt string, flowid string").parquet(path).groupBy(
        "dt").agg(F.count("*").alias("n"))


@query("""SELECT o_orderstatus, CAST(year(o_orderdate) AS BIGINT) AS order_year, count(*) AS n FROM orders GROUP BY 1, 2""")
def refreshed_slices(tb: Tables) -> DataFrame:
    path = scale.fresh_path(tb.spark, "slices")
    rows = tb.orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").cast("long").alias("order_year"))
    st.refresh(rows.limit(0), path + "-full")
    # every slice starts with stale rows, which its own refresh must drop
    st.refresh_slice(rows.withColumn("o_orderkey", -F.col("o_orderkey")).unionByName(rows), path, ["order_year"])
    st.refresh_slice(rows.filter("order_year < 1998"), path, ["order_year"])
    stale = rows.withColumn("order_year", F.col("order_year") + 1000)  # slices that the next refresh finds empty
    st.refresh_slice(stale, path, ["order_year"])
    years = [(r[0],) for r in stale.select("order_year").distinct().collect()]
    st.refresh_slice(rows.filter("order_year >= 1998"), path, ["order_year"], slices=years)
    return tb.spark.read.parquet(path).groupBy("o_orderstatus", F.col("order_year").cast("long")).agg(
        F.count("*").alias("n"))


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def refreshed_table(tb: Tables) -> DataFrame:
    path = scale.fresh_path(tb.spark, "refresh")
    st.refresh(tb.customer.unionByName(tb.customer), path)
    st.refresh(tb.customer, path)
    return tb.spark.read.parquet(path).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("SELECT year(o_orderdate) AS year, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1")
def appended_yearly_snapshots(tb: Tables) -> DataFrame:
    path = scale.fresh_path(tb.spark, "yearly")
    rows = tb.orders.select("o_custkey", F.year("o_orderdate").cast("long").alias("year")).distinct()
    st.append(rows, path, ["year"])  # one scan for all years
    return tb.spark.read.parquet(path).groupBy(F.col("year").cast("long").alias("year")).agg(F.count("*").alias("n"))


@query("SELECT n_regionkey, count(*) AS n_customers FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def table_from_query(tb: Tables) -> DataFrame:
    joined = tb.customer.join(tb.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    view = st.register_view(joined, "customer_nation")
    grouped = view.groupBy("n_regionkey").agg(F.count("*").alias("n_customers"))
    return st.ctas(grouped, "region_customers", scale.fresh_path(tb.spark, "ctas"))


@query("""SELECT c_custkey, 'column' AS place FROM customer WHERE c_acctbal > 9000""")
def catalog_table_columns(tb: Tables) -> DataFrame:
    rich = tb.customer.filter("c_acctbal > 9000").select("c_name", "c_custkey", F.lit("column").alias("place"))
    st.ctas(rich, "rich_customers", scale.fresh_path(tb.spark, "columns"))
    schema = ev.target_columns(tb.spark, "default", "rich_customers", partition_cols=("place",))
    assert schema.names == ["c_name", "c_custkey", "place"]
    return ev.align_to(tb.spark.table("rich_customers"), schema).df.select("c_custkey", "place")


@query("""SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1""")
def published_table(tb: Tables) -> DataFrame:
    tables = st.Published(tb.spark, scale.fresh_path(tb.spark, "published"))
    tables.publish_dated(tb.orders.select("o_orderkey", "o_orderpriority"), "orders", "2024-02-01", NOW)
    refused = tables.publish(tb.orders.filter("o_orderkey < 0").select("o_orderkey", "o_orderpriority"), "orders", NOW)
    assert not refused.passed  # an empty result is not announced
    assert not tables.exists("orders_20240201")  # the dated name is gone, its files are the stable name's
    return tables.read("orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("""SELECT 'newest' AS version, o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate >= DATE '1996-01-01' GROUP BY 2
          UNION ALL SELECT 'dated', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def swept_versions(tb: Tables) -> DataFrame:
    """What is left after retention: the newest version of one name, and files that a retired dated name handed on."""
    tables = st.Published(tb.spark, scale.fresh_path(tb.spark, "swept"))
    orders = tb.orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    for since in ("1992-01-01", "1994-01-01", "1996-01-01"):
        tables.publish(orders.filter(F.col("o_orderdate") >= F.lit(since).cast("date")), "recent", NOW)
    tables.publish_dated(orders, "orders", "2024-02-01", NOW)
    young = tables.sweep(dt.datetime(2000, 1, 1))
    old = tables.sweep(dt.datetime(9999, 1, 1))
    assert young == [] and len(old) == 2 and all(f.startswith("recent/") for f in old)
    counted = lambda name, label: tables.read(name).groupBy(F.lit(label).alias("version"), "o_orderpriority").agg(F.count("*").alias("n"))
    return counted("recent", "newest").unionByName(counted("orders", "dated"))


@query("""SELECT k, CAST(max_by(total, half) AS DOUBLE) AS total FROM (
            SELECT o_custkey AS k, year(o_orderdate) >= 1998 AS half, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
            FROM orders GROUP BY 1, 2) GROUP BY k""")
def published_upsert(tb: Tables) -> DataFrame:
    tables = st.Published(tb.spark, scale.fresh_path(tb.spark, "upsert"))
    for part in (F.year("o_orderdate") < 1998, F.year("o_orderdate") >= 1998):
        rows = tb.orders.filter(part).groupBy(F.col("o_custkey").alias("k")).agg(F.sum(money("o_totalprice")).alias("total"))
        tables.upsert(rows, "totals", ["k"], NOW)
    return tables.read("totals").withColumn("total", F.col("total").cast("double"))


@query(f"""WITH {_FILES} SELECT day, hr, count(*) AS n_files, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS log_time
           FROM files GROUP BY 1, 2""")
def progress_ledgers(tb: Tables) -> DataFrame:
    files, hours = (scale.fresh_path(tb.spark, "ledger") for _ in range(2))
    st.write_ledger(st.file_ledger_rows(hour_files(tb), "flow", "20240201000000", NOW), files)
    st.write_ledger(st.date_ledger_rows(max_ts_by_hour(tb.events), "flow", "20240201000000", NOW), hours)
    counted = tb.spark.read.parquet(files).groupBy("day", "hr").agg(F.count("*").alias("n_files"))
    newest = tb.spark.read.parquet(hours).select(
        "day", "hr", F.date_format("log_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("log_time"))
    return counted.join(newest, ["day", "hr"])


@query(r"""WITH i AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li>', 1)) AS raw,
                       generate_subscripts(regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li>', 1), 1) AS ix FROM pages),
                t AS (SELECT page_id, ix, trim(replace(replace(replace(replace(replace(replace(
                        regexp_replace(raw, '<[^>]*>', '', 'gs'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
                        '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) AS item FROM i)
          SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY ix) AS BIGINT) AS pos, item FROM t WHERE item <> ''""")
def html_items(tb: Tables) -> DataFrame:
    items = html_list_items(tb.pages, "page_id", "html")
    return items.withColumn("pos", F.col("pos").cast("long"))


# --- streams ----------------------------------------------------------------------------------

@query("""SELECT event_type AS "table", strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
          FROM events WHERE event_type <> 'signup' GROUP BY 1, 2
          UNION ALL SELECT reason, '', count(*), 0 FROM (
            SELECT 'not an event' AS reason FROM events WHERE event_type = 'error'
            UNION ALL SELECT 'no target for this table' FROM events WHERE event_type = 'signup') GROUP BY 1""")
def streamed_ods_tables(tb: Tables) -> DataFrame:
    """Sign-ups have no target: they are quarantined with the broken lines, each with its reason."""
    root = scale.fresh_path(tb.spark, "stream")
    change_lines(tb).write.text(f"{root}/in")
    schema = StructType.fromDDL(PAYLOAD)
    kinds = ["click", "view", "purchase", "error"]
    targets = [si.Target("shop", kind, schema, f"{root}/ods/{kind}") for kind in kinds]
    si.ingest(tb.spark, f"{root}/in", targets, root, f"{root}/checkpoint", max_files=3).awaitTermination()
    out = None
    for target in targets:
        table = tb.spark.read.parquet(target.path).groupBy(
            F.lit(target.table).alias("table"), F.date_format("dt", "yyyy-MM-dd").alias("dt")).agg(
            F.count("*").alias("n"), F.sum("event_id").alias("ids"))
        out = table if out is None else out.unionByName(table)
    bad = tb.spark.read.parquet(f"{root}/_quarantine").groupBy("reason").agg(F.count("*").alias("n")).select(
        F.col("reason").alias("table"), F.lit("").alias("dt"), "n", F.lit(0).cast("long").alias("ids"))
    return out.unionByName(bad)


@query("""SELECT event_type AS "table", CASE event_type WHEN 'view' THEN 'FAILED' ELSE 'OK' END AS status,
            count(*) FILTER (event_type <> 'view') AS n FROM events WHERE event_type <> 'error' GROUP BY 1""")
def isolated_failure(tb: Tables) -> DataFrame:
    """Four tables of one batch, read once: the definition of one names a column twice, the others are written all the same."""
    root = scale.fresh_path(tb.spark, "isolated")
    change_lines(tb).write.text(f"{root}/in")
    sound, broken = StructType.fromDDL(PAYLOAD), StructType([*StructType.fromDDL(PAYLOAD), *StructType.fromDDL("value double")])
    kinds = ["click", "view", "purchase", "signup"]
    targets = [si.Target("shop", kind, broken if kind == "view" else sound, f"{root}/ods/{kind}") for kind in kinds]
    try:
        si.write_batch(ev.read_lines(tb.spark, f"{root}/in"), 0, targets, f"{root}/results", f"{root}/quarantine")
    except RuntimeError as failed:  # the batch fails as a whole, after the others are done
        assert "view" in str(failed)
    results = tb.spark.read.parquet(f"{root}/results").select(F.col("table_name").alias("table"), "status")
    held = None
    for target in targets:
        if target.schema == sound:
            rows = tb.spark.read.parquet(target.path).agg(F.count("*").alias("n")).withColumn("table", F.lit(target.table))
            held = rows if held is None else held.unionByName(rows)
    return results.join(held, "table", "left").select("table", "status", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query("""SELECT event_type AS "table", count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, count(*) FILTER (value > 50) AS late FROM events GROUP BY 1""")
def streamed_late_files(tb: Tables) -> DataFrame:
    """Two runs of one stream; between them a file arrives late in the older of two hour folders, and is taken with the second."""
    root = scale.fresh_path(tb.spark, "late")
    seconds = F.unix_timestamp("ts")

    def arrive(rows: DataFrame, folder: str) -> None:
        data = F.to_json(F.struct("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), "value"))
        lines = ev.to_lines(rows, F.lit("shop7"), F.col("event_type"), F.lit("insert"), seconds, F.col("event_id"), data)
        lines.coalesce(2).write.mode("append").text(f"{root}/in/{folder}")

    kinds = [r[0] for r in tb.events.select("event_type").distinct().collect()]
    targets = [si.Target("shop", kind, StructType.fromDDL(PAYLOAD), f"{root}/ods/{kind}") for kind in kinds]
    run = lambda: si.ingest(tb.spark, f"{root}/in", targets, root, f"{root}/checkpoint").awaitTermination()
    late, early = F.col("value") > 50, F.col("event_id") <= tb.events.select(F.avg("event_id")).scalar()
    arrive(tb.events.filter(~late & early), "2024/02/01/10")
    arrive(tb.events.filter(~late & ~early), "2024/02/01/11")
    run()
    arrive(tb.events.filter(late), "2024/02/01/10")
    run()
    out = None
    for target in targets:
        table = tb.spark.read.parquet(target.path).groupBy(F.lit(target.table).alias("table")).agg(
            F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.count_if(F.col("value") > 50).alias("late"))
        out = table if out is None else out.unionByName(table)
    return out


def event_stream(tb: Tables) -> DataFrame:
    """The events table as a file stream."""
    schema = tb.events.schema
    return (tb.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(tb.root)
            .withColumn("event_time", F.col("ts").cast("timestamp")))


@query("""WITH m AS (SELECT max(ts) - INTERVAL 2 HOUR AS mark FROM events)
          SELECT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hr,
                 strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS max_ts, count(*) AS n_events FROM events, m
          WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark GROUP BY 1, 2""")
def streamed_hourly_progress(tb: Tables) -> DataFrame:
    root = scale.fresh_path(tb.spark, "progress")
    si.stream_to_table(si.hourly_progress(event_stream(tb)), f"{root}/out", f"{root}/checkpoint")
    return tb.spark.read.parquet(f"{root}/out").withColumn("max_ts", F.date_format("max_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("""SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events
          WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""")
def completed_days(tb: Tables) -> DataFrame:
    return si.completed_days(max_ts_by_hour(tb.events))


@query("""SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1""")
def streamed_upsert(tb: Tables) -> DataFrame:
    """The events arrive in files by time, each a micro-batch; their number is bounded, since every batch may touch every user."""
    root = scale.fresh_path(tb.spark, "stream-upsert")
    tb.events.repartitionByRange("ts").coalesce(12).write.parquet(f"{root}/in")
    order = [F.desc("ts"), F.desc("event_id")]

    table = KeyedTable(tb.spark, f"{root}/latest", ["user_id"], bucket_rows=500)

    def merge(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per(batch.select("user_id", "event_id", "ts"), "user_id", order)
        for _ in range(2):  # a replayed batch is recognised
            table.upsert(newest, NOW, order=order, token=f"batch {batch_id}")

    stream = (tb.spark.readStream.schema(tb.events.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/in"))
    si.stream_upsert(stream, merge, f"{root}/checkpoint")
    assert table.ledger().groupBy("token").count().filter("count > 1").isEmpty()
    return table.read().select("user_id", "event_id")


_WINDOW_ENDS = ["2024-01-15 12:00:00", "2024-01-15 12:15:00"]


@query("""SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, CAST(3 AS BIGINT) AS versions,
            strftime(max(max(ts)) OVER () + INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S.%f') AS mark FROM events GROUP BY 1""")
def windowed_upsert(tb: Tables) -> DataFrame:
    """A first load, a window of 15 minutes taken twice, and one that makes up for all runs left out since: three versions."""
    table = KeyedTable(tb.spark, scale.fresh_path(tb.spark, "windows"), ["user_id"], bucket_rows=500)
    source = tb.events.select("user_id", "event_id", "ts")
    last = tb.events.agg(F.max("ts") + F.expr("interval 1 second")).first()[0]
    ends = [dt.datetime.fromisoformat(e) for e in _WINDOW_ENDS]
    taken = [apply_window(table, source, "ts", end, NOW, order=[F.desc("ts"), F.desc("event_id")]).taken for end in [*ends, ends[1], last]]
    assert taken == [True, True, False, True]
    of_ledger = lambda c: table.ledger().select(c).scalar()
    return table.read().select("user_id", "event_id", of_ledger(F.count("*")).alias("versions"),
                               of_ledger(F.date_format(F.max("mark"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("mark"))
