import datetime as dt
import json
import os
import shutil
import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallyloom.sources import events as ev
from tallyloom.sources import jdbc
from tallyloom.sources.html import html_list_items
from tallyloom.sources.tables import FILE_LEDGER, Published, file_ledger_rows, refresh_slice, write_ledger, write_partitions
from tallyloom.streaming import ingest as si
from tests.conftest import rows

NOW = dt.datetime(2024, 1, 2)
SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType())])


def event(table, ts, data, database="shop3", kind="insert", xid=1):
    return json.dumps({"database": database, "table": table, "type": kind, "ts": ts, "xid": xid, "data": data})


def put(root, path, lines):
    full = os.path.join(root, path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w") as f:
        f.write("\n".join(lines) + "\n")


MIDNIGHT = 1704067200  # 2024-01-01 00:00:00 UTC


def test_bad_lines_are_kept_apart(spark, tmp_path):
    good = [event("orders_01", MIDNIGHT - 1, {"id": 1}), event("orders_02", MIDNIGHT, {"id": 2, "NAME": "x"})]
    put(tmp_path, "t/2024/01/01/00/a.json", [*good, "{broken", '{"database": "d"}'])
    events = ev.read_events(spark, str(tmp_path))
    assert events.good.count() == 2 and events.bad.count() == 2
    flat = ev.flatten_events(ev.fold_shards(events.good), "id bigint", "b1").good
    assert [r["dt"].isoformat() for r in flat.orderBy("id").collect()] == ["2023-12-31", "2024-01-01"]
    assert rows(ev.fold_shards(events.good).select("database", "table", "etl_table")) == [
        ("shop", "orders", "orders_01"), ("shop", "orders", "orders_02")]
    with pytest.raises(Exception, match="bad event line"):
        ev.read_events(spark, str(tmp_path), bad="abort").good.count()


def test_alignment_reports_drift(spark):
    df = spark.createDataFrame([(1, "x", 2)], "ID bigint, note string, surplus int")
    out = ev.align_to(df, StructType.fromDDL("id bigint, label string, n int"))
    assert rows(out.df) == [(1, "", None)] and out.df.columns == ["id", "label", "n"]
    assert out.missing == ["label", "n"] and out.extra == ["note", "surplus"]
    assert ev.drift_rows(spark, "t", out).count() == 4


def test_file_choice(spark, tmp_path):
    root = str(tmp_path)
    for path in ["10/a", "11/a", "11/late", "12/a", "13/a"]:
        put(root, f"t/2024/01/01/{path}", ["x"])
    put(root, "t/2024/01/03/00/far", ["x"])
    found = ev.list_files(spark, "file:" + root, "t")
    assert found.count() == 6
    name = F.substring_index("file", "/", -2)
    taken = found.filter(name.isin("10/a", "11/a", "12/a"))
    ledger = file_ledger_rows(taken, "f", "1", NOW)
    assert ledger.schema.simpleString() == spark.createDataFrame([], FILE_LEDGER).schema.simpleString()
    write_ledger(ledger, root + "/ledger")
    ledger = spark.read.parquet(root + "/ledger")
    chosen = ev.select_new_files(found, ledger, max_hours=24, max_files=10)
    assert rows(chosen.select(name)) == [("11/late",), ("13/a",)]
    assert ev.select_new_files(found, ledger.limit(0), first_files=2).count() == 2
    assert ev.select_new_files(found, ledger, max_hours=24, max_files=1).count() == 1
    near = ev.list_files(spark, "file:" + root, "t", ev.hours_glob(ledger, max_hours=1))
    assert rows(near.select(name)) == [("11/a",), ("11/late",), ("12/a",), ("13/a",)]
    assert ev.list_files(spark, "file:" + root, "other").count() == 0


def test_a_long_pause_does_not_stall_the_flow(spark):
    files = spark.createDataFrame([("new", "2024-01-05", "07", NOW), ("later", "2024-01-09", "07", NOW)], "file string, day string, hr string, modificationTime timestamp")
    ledger = ev_ledger(spark)
    assert rows(ev.select_new_files(files, ledger, max_hours=24).select("file")) == [("new",)]


def test_files_after_a_long_pause_are_listed_and_taken(spark, tmp_path):
    root = str(tmp_path)
    for path in ["01/10/a", "01/11/a", "01/11/late", "05/07/new", "05/08/next", "09/07/later"]:
        put(root, f"t/2024/01/{path}", ["x"])
    name = F.substring_index("file", "/", -3)
    found = ev.list_files(spark, "file:" + root, "t")
    write_ledger(file_ledger_rows(found.filter(name.isin("01/10/a", "01/11/a")), "f", "1", NOW), root + "/ledger")
    taken = []
    for _ in range(3):
        ledger = spark.read.parquet(root + "/ledger")
        near = ev.list_files(spark, "file:" + root, "t", ev.hours_glob(ledger, max_hours=24, root="file:" + root, topic="t"))
        chosen = ev.select_new_files(near, ledger, max_hours=24)
        taken.append([n for n, in rows(chosen.select(name))])
        write_ledger(file_ledger_rows(chosen, "f", "1", NOW), root + "/ledger")
    assert taken == [["01/11/late"], ["05/07/new", "05/08/next"], ["09/07/later"]]


def ev_ledger(spark):
    return spark.createDataFrame([("old", NOW, "2024-01-01", "00", "f", "1", "INSERT")], FILE_LEDGER)


def test_day_rollover(spark):
    files = spark.createDataFrame([("/r/t/2024/01/01/23/a",), ("/r/t/2024/01/02/00/b",), ("/r/t/odd",)], "file string")
    hours = ev.with_path_hour(files)
    assert rows(hours.select("day", "hr")) == sorted([("2024-01-01", "23"), ("2024-01-02", "00"), (None, None)], key=repr)
    ledger = hours.filter("hr = '23'")
    assert rows(ev.select_new_files(hours, ledger, max_hours=1).select("file")) == [("/r/t/2024/01/02/00/b",)]


def targets(root):
    return [si.Target("shop", t, SCHEMA, f"{root}/ods/{t}") for t in ("orders", "users")]


def test_stream_late_file_and_replay(spark, tmp_path):
    root = str(tmp_path)
    put(root, "in/2024/01/01/10/a.json", [event("orders_01", MIDNIGHT, {"id": 1, "name": "a"}), "junk"])
    put(root, "in/2024/01/01/11/a.json", [event("users", MIDNIGHT + 86400, {"id": 2})])

    def run():
        si.ingest(spark, f"{root}/in", targets(root), root, f"{root}/cp", max_files=1).awaitTermination()

    run()
    put(root, "in/2024/01/01/10/late.json", [event("orders_07", MIDNIGHT, {"id": 3, "name": "c"})])
    run()
    run()  # nothing new
    orders = spark.read.parquet(f"{root}/ods/orders")
    assert rows(orders.select("id", "name")) == [(1, "a"), (3, "c")]
    assert spark.read.parquet(f"{root}/_quarantine").count() == 1
    assert spark.read.parquet(f"{root}/_results").filter("status = 'OK'").count() == 6

    lines = ev.read_lines(spark, f"{root}/in/2024/01/01/10/a.json")
    before = rows(orders)
    # files of one instant come in either order: the batch is the one whose row was stored
    batch = int(orders.filter("id = 1").first()["flowid"].split("-")[1])
    for _ in range(2):
        si.write_batch(lines, batch, targets(root), f"{root}/_results", f"{root}/_quarantine", run_id=si.run_token(spark, f"{root}/cp") + "-")
    assert rows(spark.read.parquet(f"{root}/ods/orders")) == before

    # a second checkpoint starts its batches at 0 again and leaves the first one's rows
    si.ingest(spark, f"{root}/in", targets(root), root, f"{root}/cp2").awaitTermination()
    assert rows(spark.read.parquet(f"{root}/ods/orders").select("id")) == [(1,), (1,), (3,), (3,)]


def test_every_line_ends_in_a_table_or_in_quarantine(spark, tmp_path):
    root = str(tmp_path)
    put(root, "in/a.json", [event("orders", MIDNIGHT, {"id": 1, "name": None}), event("orders", MIDNIGHT, {"id": "abc"}), event("orders", MIDNIGHT, "text"),
                            event("unlisted_3", MIDNIGHT, {"id": 5}), "junk", event("users", MIDNIGHT, {"other": 1})])
    si.ingest(spark, f"{root}/in", targets(root), root, f"{root}/cp").awaitTermination()
    assert rows(spark.read.parquet(f"{root}/ods/orders").select("id")) == [(1,)]
    assert rows(spark.read.parquet(f"{root}/ods/users").select("id")) == [(None,)]
    assert rows(spark.read.parquet(f"{root}/_quarantine").select("reason")) == [
        ("no target for this table",), ("not an event",), ("payload does not fit: id",), ("payload is not an object",)]


def test_a_checkpoint_made_anew_keeps_the_earlier_rows(spark, tmp_path):
    root = str(tmp_path)
    put(root, "in/a.json", [event("orders", MIDNIGHT, {"id": 1})])
    run = lambda: si.ingest(spark, f"{root}/in", targets(root)[:1], root, f"{root}/cp").awaitTermination()
    run()
    token = si.run_token(spark, f"{root}/cp")
    assert si.run_token(spark, f"{root}/cp") == token
    shutil.rmtree(f"{root}/cp")
    run()  # the same path, batch 0 again, another token
    assert si.run_token(spark, f"{root}/cp") != token
    ids = spark.read.parquet(f"{root}/ods/orders").select("id", "flowid")
    assert [i for i, _ in rows(ids)] == [1, 1] and ids.select("flowid").distinct().count() == 2


def test_lines_are_scanned_once_for_all_tables(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put(root, "in/a.json", [event(t, MIDNIGHT, {"id": k}) for t in ("orders", "users", "other") for k in range(3)])
    many = [si.Target("shop", t, SCHEMA, f"{root}/ods/{t}") for t in ("orders", "users", "none", "nobody")]
    lines = ev.read_lines(spark, f"{root}/in")
    staged = si.staged_by_table(lines, many)
    assert rows(staged.groupBy("_target", "reason").count()) == sorted([(-1, "no target for this table", 3), (0, None, 3), (1, None, 3)], key=repr)
    mine = staged.filter("_target = 1")
    assert "PartitionFilters: [isnotnull(_target" in mine._jdf.queryExecution().executedPlan().toString()
    si.write_batch(lines, 0, many, f"{root}/results", f"{root}/quarantine", now=lambda: NOW)
    assert spark.read.parquet(f"{root}/results").filter("status = 'OK'").count() == 4
    assert spark.read.parquet(f"{root}/quarantine").count() == 3


def test_an_empty_batch_writes_its_ledger_rows(spark, tmp_path):
    root = str(tmp_path)
    lines = spark.createDataFrame([], "value string, file string")
    si.write_batch(lines, 0, targets(root), f"{root}/results", f"{root}/quarantine", now=lambda: NOW)
    assert spark.read.parquet(f"{root}/results").count() == 2


def test_payloads_that_do_not_fit_are_told_apart(spark):
    good = {"id": 1, "name": "a"}
    lines = [event("t", MIDNIGHT, d) for d in (good, {"id": "x"}, {"id": 1.5}, {"name": 5}, {"id": None}, {}, [1], "text", None, {"id": 2**70})]
    flat = ev.flatten_events(ev.parse_events(spark.createDataFrame([(x,) for x in lines], "value string")).good, "id bigint, name string", "b")
    assert rows(flat.good.select("id", "name")) == sorted([(1, "a"), (None, "5"), (None, None), (None, None)], key=repr)
    assert [r for r, in rows(flat.bad.select("reason"))] == ["payload does not fit: id"] * 3 + ["payload is not an object"] * 2
    assert "data" in flat.bad.columns


def test_history_is_taken_after_the_first_run(spark, tmp_path):
    hours = [f"2024/01/{d:02d}/{h:02d}" for d in (1, 2, 3) for h in (0, 12)]
    files = ev.with_path_hour(spark.createDataFrame([(f"/r/t/{h}/{k}", NOW + dt.timedelta(minutes=i)) for i, h in enumerate(hours) for k in "ab"], "file string, modificationTime timestamp"))
    ledger, rounds = files.limit(0), []
    while True:
        chosen = ev.select_new_files(files, ledger, max_files=5, first_files=3)
        taken = [f for f, in rows(chosen.select("file"))]
        if not taken:
            break
        rounds.append(taken)
        ledger = files.join(spark.createDataFrame([(f,) for r in rounds for f in r], "file string"), "file")
        coverage = ev.hour_coverage(files, ledger)
        if len(rounds) == 1:
            assert ev.history_open(coverage)
            assert rows(ev.covered_intervals(coverage).select("n_hours", "n_files")) == [(1, 2)]
    assert sorted(f for r in rounds for f in r) == [f for f, in rows(files.select("file"))]
    assert rounds[0] == [f"/r/t/{hours[4]}/a", f"/r/t/{hours[5]}/a", f"/r/t/{hours[5]}/b"]
    assert rounds[1][0] == f"/r/t/{hours[0]}/a" and f"/r/t/{hours[4]}/b" in rounds[1]
    assert not ev.history_open(coverage)
    assert rows(ev.covered_intervals(coverage).select("n_hours", "n_files")) == [(6, 12)]


def test_an_emptied_slice_loses_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2020, "a"), (2, 2021, "a"), (3, 2021, "b")], "v int, year int, term string")
    refresh_slice(df, path, ["year", "term"])
    refresh_slice(df.filter("v = 3").withColumn("v", F.lit(9)), path, ["year", "term"], slices=[(2021, "a"), (2021, "b")])
    assert rows(spark.read.parquet(path).select("v", "year", "term")) == [(1, 2020, "a"), (9, 2021, "b")]


def test_a_dated_result_moves_to_the_stable_name(spark, tmp_path):
    tables = Published(spark, str(tmp_path))
    assert tables.publish_dated(spark.range(3).toDF("k"), "t", "2024-01-02", NOW).passed
    assert rows(tables.read("t")) == [(0,), (1,), (2,)]
    assert not tables.exists("t_20240102")
    with pytest.raises(LookupError):
        tables.read("t_20240102")
    # a refused result changes neither name, a later one of the same day takes its place
    assert not tables.publish_dated(spark.range(0).toDF("k"), "t", "2024-01-02", NOW).passed
    assert tables.read("t").count() == 3
    assert tables.publish_dated(spark.range(5).toDF("k"), "t", "2024-01-02", NOW).passed and tables.read("t").count() == 5


def test_a_feed_rolls_forward_with_its_backup(spark, tmp_path):
    tables = Published(spark, str(tmp_path))
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    second = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string")
    sent = []

    def run(snapshot, send=None):
        got = rows(tables.roll_forward("t", snapshot, ["k"], ["v"], NOW, send).select("k", "change"))
        sent.append(got)
        return got

    assert run(first) == [(1, "new"), (2, "new"), (3, "new")] and run(first) == []

    def refuse(rows_to_send):
        raise ConnectionError("away")

    with pytest.raises(ConnectionError):
        run(second, refuse)
    assert rows(tables.read("t_before")) == rows(first) and tables.read("t_feed").count() == 0
    assert run(second) == [(2, "changed"), (4, "new")] and run(second) == []
    # a row that was gone in between is new again
    assert run(first) == [(2, "changed"), (3, "new")]
    assert rows(tables.read("t_before")) == rows(first)
    ledger = spark.read.parquet(tables.ledger)
    versions = ledger.groupBy("name").agg(F.max("version")).orderBy("name")
    assert [tuple(r) for r in versions.collect()] == [("t_before", 5), ("t_feed", 5)]


def test_names_change_between_whole_and_keyed(spark, tmp_path):
    tables = Published(spark, str(tmp_path))
    kv = lambda *pairs: spark.createDataFrame(list(pairs), "k int, v string")
    tables.upsert(kv((1, "a"), (2, "a")), "t", ["k"], NOW)
    tables.upsert(kv((2, "b")), "t", ["k"], NOW)
    assert rows(tables.read("t")) == [(1, "a"), (2, "b")]
    tables.publish(kv((9, "z")), "t", NOW)
    assert rows(tables.read("t")) == [(9, "z")]
    tables.upsert(kv((1, "c")), "t", ["k"], NOW)
    assert rows(tables.read("t")) == [(1, "c"), (9, "z")]
    tables.retire("t", NOW)
    assert not tables.exists("t")
    tables.upsert(kv((5, "e")), "t", ["k"], NOW)
    assert rows(tables.read("t")) == [(5, "e")]


def test_one_failing_table_does_not_stop_the_others(spark, tmp_path):
    root = str(tmp_path)
    put(root, "in/a.json", [event("orders", MIDNIGHT, {"id": 1}), event("users", MIDNIGHT, {"id": 2})])
    with open(f"{root}/file", "w") as f:
        f.write("not a folder")
    bad = si.Target("shop", "users", SCHEMA, f"{root}/file/below")
    lines = ev.read_lines(spark, f"{root}/in")
    with pytest.raises(RuntimeError, match="users"):
        si.write_batch(lines, 3, [targets(root)[0], bad], f"{root}/results", f"{root}/quarantine", now=lambda: NOW)
    assert rows(spark.read.parquet(f"{root}/results").select("table_name", "status")) == [("orders", "OK"), ("users", "FAILED")]
    assert spark.read.parquet(f"{root}/ods/orders").count() == 1


def test_partition_overwrite_leaves_others(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, dt string")
    write_partitions(df, path, ["dt"])
    write_partitions(df.filter("dt = 'a'").withColumn("v", F.lit(9)), path, ["dt"], files=2)
    assert rows(spark.read.parquet(path)) == [(2, "b"), (9, "a")]


def test_published_versions(spark, tmp_path):
    tables = Published(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(LookupError):
        tables.read("t")
    assert tables.publish(df, "t", NOW).passed
    assert not tables.publish(df.limit(0), "t", NOW).passed
    assert not tables.publish(df, "t", NOW, min_rows=5).passed
    assert rows(tables.read("t")) == [(1, "a"), (2, "b")]
    tables.upsert(spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), "t", ["k"], NOW)
    assert rows(tables.read("t")) == [(1, "a"), (2, "B"), (3, "c")]


def test_jdbc_options():
    conf = jdbc.Database("jdbc:x", "d", "u", "p")
    plain = jdbc.jdbc_options(conf, "select 1", "set x")
    assert plain["query"] == "select 1" and plain["sessionInitStatement"] == "set x"
    cut = jdbc.jdbc_options(conf, "select 1", slices=jdbc.Slices("id", "0", "9", 3))
    assert cut["dbtable"] == "(select 1) q" and cut["numPartitions"] == "3" and "query" not in cut
    assert jdbc.upsert_statement("t", ["k", "v"], ["k"]) == (
        "INSERT INTO t (k, v) VALUES (%s, %s) ON DUPLICATE KEY UPDATE v = VALUES(v)")


def test_jdbc_upsert_writes_real_nulls_once(spark, tmp_path):
    path = str(tmp_path / "db.sqlite")
    with sqlite3.connect(path) as c:
        c.execute("create table t (k integer primary key, v text)")
        c.execute("insert into t values (1, 'old')")
    df = spark.createDataFrame([(1, "new"), (2, None), (3, "c")], "k int, v string")
    for _ in range(2):
        jdbc.upsert_jdbc(df, lambda: sqlite3.connect(path), "t", ["k"], "sqlite", "?", batch=2, writers=1)
    with sqlite3.connect(path) as c:
        assert c.execute("select * from t order by k").fetchall() == [(1, "new"), (2, None), (3, "c")]


def test_html_items(spark):
    html = "<ul class='x'><li> A &amp; B </li><li></li><LI><a href='#'>c</a></LI></ul><ol><li>d</li></ol>"
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "id int, html string")
    assert rows(html_list_items(df, "id", "html")) == [(1, 1, "A & B"), (1, 2, "c"), (1, 3, "d")]
    only = html_list_items(df, "id", "html", list_pattern=r"(?s)<ul class='x'>(.*?)</ul>")
    assert only.count() == 2


def test_hourly_progress_waits_for_the_watermark(spark, tmp_path):
    root = str(tmp_path)
    times = ["2024-01-01 10:05:00", "2024-01-01 10:50:00", "2024-01-01 12:59:00", "2024-01-01 13:00:00"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(x),) for x in times], "event_time timestamp")
    df.coalesce(1).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
    si.stream_to_table(si.hourly_progress(stream), f"{root}/out", f"{root}/cp")
    out = spark.read.parquet(f"{root}/out")
    assert rows(out.select("day", "hr", "n_events")) == [("2024-01-01", "10", 2)]
