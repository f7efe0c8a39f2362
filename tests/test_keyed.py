"""Keyed tables: buckets that grow, versions that share files, windows that count once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import retention
from tallyloom.sources.keyed import BUCKET_ROWS, SMALL_BUCKETS, Conflict, KeyedTable, apply_window, bucket_of, buckets_for
from tallyloom.sources.tables import Published
from tests.conftest import rows

NOW = dt.datetime(2024, 1, 2)


def files(table, number=None):
    return {r[0] for r in table.read(number).select("_metadata.file_path").distinct().collect()}


def keyed(spark, n, value, start=0):
    return spark.range(start, start + n).select("id", F.lit(value).alias("v"))


def test_buckets_split_in_turn(spark):
    """Every row of a new bucket comes from the one that its number names among the old buckets."""
    ids = spark.range(500).select("id", F.xxhash64("id").alias("h"))
    for old, new in ((1, 2), (3, 4), (3, 11), (8, 9), (5, 40)):
        got = ids.select(bucket_of(F.col("h"), old).alias("a"), bucket_of(F.col("h"), new).alias("b"))
        assert got.agg(F.min("b"), F.max("b"), F.max("a")).first()[0:3] == (0, new - 1, old - 1)
        assert got.filter((F.col("b") < old) & (F.col("a") != F.col("b"))).isEmpty()
        assert got.filter((F.col("b") >= old) & (F.col("a") != bucket_of(F.col("b"), old))).isEmpty()


def test_an_upsert_leaves_the_files_of_other_buckets(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["id"], bucket_rows=20)
    table.upsert(keyed(spark, 200, "old"), NOW)
    assert table.version().buckets == 10
    before = files(table)
    made = table.upsert(spark.createDataFrame([(7, "new"), (8, "new")], "id long, v string"), NOW)
    # two buckets at most hold the rows, one splits for the eleventh
    assert (made.buckets, made.n_rows) == (11, 200) and len(before & files(table)) >= 7
    got = dict(rows(table.read()))
    assert len(got) == 200 and {k for k, v in got.items() if v == "new"} == {7, 8}
    assert set(dict(rows(table.read(1))).values()) == {"old"} and files(table, 1) == before


def test_buckets_follow_the_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["id"], bucket_rows=50)
    for k in range(4):
        table.upsert(keyed(spark, 200, str(k), start=150 * k), NOW)
    at = table.version()
    assert (at.version, at.n_rows) == (4, 650) and at.buckets >= 13
    assert rows(table.read()) == sorted([(i, str(min(3, i // 150))) for i in range(650)], key=repr)
    manifest = table._manifest(at)
    assert manifest.count() == manifest.select("bucket").distinct().count()
    assert manifest.agg(F.max("n_rows")).first()[0] < 150


def test_small_buckets_stay_few(spark, tmp_path):
    """Each bucket is a folder to make, list and open, so a table of small rows does not get one for every few rows."""
    table = KeyedTable(spark, str(tmp_path), ["id"], bucket_rows=5)
    table.upsert(keyed(spark, 900, "old"), NOW)
    made = table.upsert(keyed(spark, 900, "new", start=300), NOW)
    assert (made.buckets, made.n_rows) == (SMALL_BUCKETS, 1200)
    assert rows(table.read()) == sorted([(i, "old" if i < 300 else "new") for i in range(1200)], key=repr)
    assert table.replace(keyed(spark, 900, "z"), NOW).buckets == SMALL_BUCKETS and table.read().count() == 900
    # more only where they are full
    assert [buckets_for(n, 500) for n in (1, 501, 10**6, 64 * BUCKET_ROWS, 10**10)] == [1, 2, SMALL_BUCKETS, 64, 5000]
    assert buckets_for(10 * BUCKET_ROWS, BUCKET_ROWS) == 10 and buckets_for(100 * BUCKET_ROWS, 10 * BUCKET_ROWS) == 10


def test_orders_nulls_and_repeated_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["id"], bucket_rows=2)
    schema = "id long, v string"
    table.upsert(spark.createDataFrame([(1, "b"), (2, "b"), (None, "n")], schema), NOW)
    table.upsert(spark.createDataFrame([(1, "a"), (2, "c"), (2, "a"), (None, "n")], schema), NOW, order=[F.desc("v")])
    assert rows(table.read()) == sorted([(1, "b"), (2, "c"), (None, "n"), (None, "n")], key=repr)
    with pytest.raises(Exception, match="twice"):
        table.upsert(spark.createDataFrame([(1, "x"), (1, "y")], schema), NOW)
    assert table.version().version == 2 and table.read().count() == 4


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["id"], bucket_rows=10)
    table.upsert(keyed(spark, 30, "old"), NOW)
    broken = keyed(spark, 5, "new").withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("disk"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="disk"):
        table.upsert(broken, NOW)
    assert set(dict(rows(table.read())).values()) == {"old"} and table.version().version == 1


def test_two_writers_do_not_lose_rows(spark, tmp_path):
    table, other = (KeyedTable(spark, str(tmp_path), ["id"]) for _ in range(2))
    table.upsert(keyed(spark, 3, "a"), NOW)
    old = other.version()
    table.upsert(keyed(spark, 3, "b"), NOW)
    with pytest.raises(Conflict):
        other._announce(old, old.manifest, old.buckets, old.n_rows, None, None, old.schema, NOW)
    assert set(dict(rows(table.read())).values()) == {"b"}


def test_tokens_and_empty_batches(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["id"])
    with pytest.raises(LookupError):
        table.read()
    assert table.upsert(keyed(spark, 0, "a"), NOW).n_rows == 0 and table.read().count() == 0
    table.upsert(keyed(spark, 2, "a"), NOW, token="t1")
    assert table.upsert(keyed(spark, 2, "b"), NOW, token="t1").version == 2  # seen: nothing happens
    assert set(dict(rows(table.read())).values()) == {"a"}
    assert table.upsert(keyed(spark, 0, "a"), NOW, token="t2").version == 3 and table.read().count() == 2
    assert table.replace(keyed(spark, 5, "z"), NOW).n_rows == 5 and table.read().count() == 5
    assert table.replace(keyed(spark, 0, "z"), NOW).n_rows == 0 and table.read().count() == 0


def test_windows_count_once(spark, tmp_path):
    minute = lambda n: dt.datetime(2024, 1, 1, 10, n)
    source = spark.createDataFrame(
        [(1, "a", minute(1), None), (1, "b", minute(16), None), (2, "a", minute(3), minute(5)), (3, "a", minute(31), None), (3, "b", minute(30), None),
         (4, "x", None, None), (None, "n", minute(2), None)], "id long, v string, ts timestamp, gone timestamp")
    table = KeyedTable(spark, str(tmp_path), ["id"])
    run = lambda until: apply_window(table, source, "ts", until, NOW, retired="gone")
    assert run(minute(15)).taken and rows(table.read().select("id", "v")) == sorted([(1, "a"), (None, "n")], key=repr)
    assert run(minute(30)).taken and not run(minute(30)).taken and not run(minute(15)).taken
    assert table.version().version == 2 and table.mark() == minute(30)
    # the half-open window: minute 30 belongs to the next one, which also makes up for the run left out
    assert run(dt.datetime(2024, 1, 1, 12, 0)).taken
    assert rows(table.read().select("id", "v")) == sorted([(1, "b"), (3, "a"), (None, "n")], key=repr)


LATE, EARLY = dt.datetime(9999, 1, 1), dt.datetime(2000, 1, 1)


def test_sweep_keeps_what_the_newest_version_shares(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["id"], bucket_rows=20)
    assert table.sweep(LATE) == []
    table.upsert(keyed(spark, 200, "first"), NOW)
    table.upsert(spark.createDataFrame([(7, "second")], "id long, v string"), NOW)
    table.upsert(keyed(spark, 200, "third"), NOW)  # touches every bucket, so nothing of the first two versions is left
    table.upsert(spark.createDataFrame([(8, "fourth")], "id long, v string"), NOW)
    before = rows(table.read())
    assert table.sweep(EARLY) == []
    gone = table.sweep(LATE, versions=[3])
    assert len(gone) == 4 and all(g.startswith(("v000001", "v000002")) for g in gone)  # rows and manifest of each
    assert rows(table.read()) == before and table.read(3).count() == 200
    assert len(table.sweep(LATE)) == 1  # the manifest of version 3; its folder holds buckets of version 4
    assert rows(table.read()) == before and table.sweep(LATE) == []


def test_sweep_of_published_names(spark, tmp_path):
    tables = Published(spark, f"{tmp_path}/tables")
    assert tables.sweep(LATE) == []
    for n in (5, 6, 7):
        tables.publish(spark.range(n), "whole", NOW)
    tables.publish(spark.range(0), "whole", NOW)  # refused, its folder stays behind
    tables.publish(spark.range(3), "gone", NOW)
    tables.retire("gone", NOW)
    for value in ("a", "b"):
        tables.upsert(keyed(spark, 10, value), "keyed", ["id"], NOW)
    assert tables.sweep(EARLY) == []
    first = tables.sweep(LATE, keep=2)
    assert sorted(f.split("/")[0] for f in first) == ["gone", "whole", "whole"]
    second = tables.sweep(LATE)
    assert sorted("/".join(f.split("/")[:-1]) for f in second) == ["keyed/keyed", "keyed/keyed", "whole"]
    assert tables.read("whole").count() == 7 and {r["v"] for r in tables.read("keyed").collect()} == {"b"}
    assert not tables.exists("gone") and tables.sweep(LATE) == []
    tables.publish(spark.range(4), "gone", NOW)
    assert tables.read("gone").count() == 4


def test_staged_tables_are_swept_by_name_and_age(spark, tmp_path):
    for name in ("side-" + "0" * 32, "side-" + "a" * 32, "kept", "9f0b-checkpoint"):
        spark.range(3).write.parquet(f"{tmp_path}/{name}")
    assert retention.sweep(f"file:{tmp_path}", (), EARLY, retention.STAGED) == []
    assert retention.sweep(f"file:{tmp_path}", {"side-" + "a" * 32}, LATE, retention.STAGED) == ["side-" + "0" * 32]
    assert [n for n, _ in retention.subfolders(str(tmp_path))] == ["9f0b-checkpoint", "kept", "side-" + "a" * 32]
