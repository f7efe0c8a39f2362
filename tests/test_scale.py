"""The paths taken for large inputs give the same results as the plain ones."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyloom import scale, session
from tallyloom.operators import joins as j, matching
from tallyloom.operators import merge as m
from tallyloom.operators import windows as w
from tallyloom.operators.groups import collect_members, concat_group, rollup_levels
from tests.conftest import rows
from tools.oracle_check import connect, rows_of

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds most rows; times and values repeat; some keys are null."""
    df = spark.range(2000).select(
        F.col("id"),
        F.when(F.col("id") % 3 < 2, F.lit("hot")).when(F.col("id") % 30 != 2, (F.col("id") % 7).cast("string")).alias("k"),
        (F.col("id") * 7919 % 97).alias("t"), (F.col("id") % 13).cast("decimal(20,6)").alias("v"))
    return df.cache()


def test_rank_in(hot):
    order = [F.desc("t"), F.asc("id")]
    assert rows(w.rank_in(hot, ["k"], order, split=True, slices=5)) == rows(w.rank_in(hot, ["k"], order, split=False))


def test_slices_cut_a_hot_group(hot):
    sliced = scale.range_slices(hot, ["k"], [F.asc("t"), F.asc("id")], slices=8)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2000 / 8 * 2
    assert sliced.filter("k = 'hot'").select("_slice").distinct().count() >= 4


def test_rank_over_the_whole_frame(hot):
    order = [F.asc_nulls_last("t"), F.asc("id")]
    assert rows(w.rank_in(hot, [], order, split=True, slices=5)) == rows(w.rank_in(hot, [], order, split=False))


def test_prior_total(hot):
    split = w.prior_total(hot, ["k"], "t", "v", split=True, slices=5)
    assert rows(split) == rows(w.prior_total(hot, ["k"], "t", "v", split=False))


def test_running_total(hot):
    daily = hot.groupBy("k", "t").agg(F.sum("v").alias("v"))
    split = w.running_total(daily, ["k"], "t", "v", split=True, slices=5)
    assert rows(split) == rows(w.running_total(daily, ["k"], "t", "v", split=False))


@pytest.mark.parametrize("strict", [True, False])
def test_asof_join(hot, strict):
    states = hot.filter("id % 11 = 0").select("k", F.col("t").alias("since"), F.col("id").alias("state"))
    facts = hot.select("id", "k", "t")
    args = (facts, states, "k", "t", "since", ["state"])
    split = rows(w.asof_join(*args, tie=["state"], strict=strict, split=True, slices=5))
    assert split == rows(w.asof_join(*args, tie=["state"], strict=strict, split=False))
    brute = {}
    known = [tuple(r) for r in states.collect()]
    for r in facts.collect():
        fits = [(s, i) for k, s, i in known if k is not None and k == r["k"] and (s < r["t"] if strict else s <= r["t"])]
        brute[r["id"]] = max(fits)[1] if fits else None
    assert {r[0]: r[-1] for r in split} == brute


def test_long_groups_are_one_value(hot):
    texts = hot.withColumn("s", F.col("id").cast("string"))
    want = {}
    for r in hot.orderBy("id").collect():
        want.setdefault(r["k"], []).append(str(r["id"]))
    for split in (True, False):
        joined = {r["k"]: r["joined"].split(",") for r in concat_group(texts, ["k"], "s", "id", part_rows=100, split=split).collect()}
        assert joined == want
        members = {r["k"]: json.loads(r["members"]) for r in collect_members(texts, ["k"], ["s"], ["id"], part_rows=100, split=split).collect()}
        assert members == {k: [{"s": s} for s in v] for k, v in want.items()}
    largest = max(len(",".join(v)) for v in want.values())
    assert concat_group(texts, ["k"], "s", "id", part_rows=100, value_bytes=largest + 1).count() == len(want)
    with pytest.raises(Exception, match="beyond"):
        concat_group(texts, ["k"], "s", "id", part_rows=100, value_bytes=largest).collect()


def test_slices_join_without_another_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("s"))
    plan = concat_group(df, ["k"], "s", part_rows=2, split=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_written_frame_keeps_rows_and_size_is_known(spark, hot):
    back = scale.written(hot)
    assert rows(back) == rows(hot)
    assert scale.estimated_bytes(back) < 10 * 1024 * 1024
    assert not scale._multiplies(back) and scale._multiplies(hot.select(F.explode(F.array("id", "id"))))


LARGE = ["bracket_fee_orders", "asof_previous_order", "prior_order_total", "rank_in_nation", "continued_sequence",
         "multi_key_order", "order_history_text", "orders_as_json", "match_cascade_parts", "line_lookups", "any_key_match",
         "update_from_orders", "not_in_with_nulls", "has_urgent_order", "scope_by_person_or_unit", "split_order_value",
         "corrected_customers", "backfill_cascade", "resolved_identities", "titles_at_year_end", "passage_in_text",
         "short_name_in_text", "award_lists", "person_profiles", "parent_names", "teaching_load_rows"]


@pytest.mark.parametrize("name", LARGE)
def test_queries_on_the_large_path(spark, monkeypatch, name):
    monkeypatch.setattr(scale, "ONE_TASK_BYTES", -1)
    monkeypatch.setattr(scale, "HOT_ROWS", 3)
    df = contract.queries()[name](spark, ROOT)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connect(ROOT).execute(contract.oracle_sql()[name])
    assert got == rows_of([d[0] for d in result.description], result.fetchall())


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_settings(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("join", ["lookup", "flag", "semi", "totals", "sync"])
def test_a_hot_fact_key_is_split(spark, monkeypatch, skew_settings, join):
    monkeypatch.setattr(scale, "ONE_TASK_BYTES", -1)
    n = F.col("id")
    facts = spark.range(0, 400_000, 1, 8).select(
        "id", F.when(n % 3 == 0, F.lit(1)).otherwise(n % 2000).alias("k"), F.md5(n.cast("string")).alias("x"))
    dim = spark.range(6000).select((n % 2000).alias("k"), n.alias("name"))
    df = {"lookup": lambda: j.lookup(facts, [j.Lookup(dim, [("k", "k")], {"name": "name"})]),
          "flag": lambda: j.exists_flag(facts, dim, ["k"], "name"),
          "sync": lambda: m.sync_parent_child(facts, dim, dim.select("k", F.col("name").cast("string").alias("x")), "k", ["k", "x"]),
          "semi": lambda: j.keep_existing(facts, dim, ["k"]),
          "totals": lambda: j.attach_totals(facts, dim.groupBy("k").agg(F.max("name").alias("name")), ["k"])}[join]()
    total = df.agg(F.count("*"), F.max("x"), F.max(df.columns[-1]))
    assert total.collect()[0][0] == 400_000
    assert "SortMergeJoin(skew=true)" in total._jdf.queryExecution().executedPlan().toString()


def test_words_are_combined_before_they_meet_names(spark, monkeypatch, skew_settings):
    monkeypatch.setattr(scale, "join_side", lambda side: side)  # not written, so that one plan shows all
    words = spark.range(1000).select("id", F.lit("the").alias("_word"))
    names = spark.createDataFrame([(1, "in the end", ["the"])], "n int, _name string, _inner array<string>")
    found = matching._rarest_inner_word(names, words, "n")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == [(1, "in the end", "the")]
    assert plan.index("LeftSemi") < plan.index("count(1)")  # the count stands below the join


def test_picks_are_trimmed_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = w.latest_per(df, "k", [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


ADVISORY, SPLIT = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
BOUNDED = {ADVISORY: None, SPLIT: None, "spark.sql.shuffle.partitions": "64", "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
           "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}


@pytest.fixture
def left_at_defaults(spark):
    before = {k: spark.conf.get(k, None) for k in BOUNDED}
    put = lambda conf: [spark.conf.unset(k) if v is None else spark.conf.set(k, v) for k, v in conf.items()]
    put(BOUNDED)
    yield
    put(before)


def test_sizes_of_partitions_are_lowered_only(spark, left_at_defaults):
    session.prepare(spark)
    assert (spark.conf.get(ADVISORY), spark.conf.get(SPLIT)) == (f"{16 << 20}b", f"{32 << 20}b")
    spark.conf.set(ADVISORY, "8m")
    spark.conf.set(SPLIT, "1000000")
    session.prepare(spark)
    assert (spark.conf.get(ADVISORY), spark.conf.get(SPLIT)) == ("8m", "1000000")


def partitions_read(node):
    """The number of partitions in every shuffle read of a finished plan."""
    name = node.nodeName()
    if name == "AQEShuffleRead":
        yield node.partitionSpecs().size()
    inner = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if name.endswith("QueryStage") else []
    for child in inner + [node.children().apply(n) for n in range(node.children().size())]:
        yield from partitions_read(child)


@pytest.mark.parametrize("name", ["teaching_summary_blocks", "split_order_value", "rollup_levels_revenue"])
def test_shuffled_partitions_stay_small(spark, monkeypatch, left_at_defaults, name):
    monkeypatch.setitem(session.AT_MOST, ADVISORY, 2000)
    df = contract.queries()[name](spark, ROOT)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert max(partitions_read(df._jdf.queryExecution().executedPlan())) >= 8
    result = connect(ROOT).execute(contract.oracle_sql()[name])
    assert got == rows_of([d[0] for d in result.description], result.fetchall())


@pytest.fixture
def few_partitions(spark, left_at_defaults):
    before = spark.conf.get(session.INITIAL, None)
    spark.conf.unset(session.INITIAL)
    spark.conf.set(session.SHUFFLED, "4")
    yield
    spark.conf.unset(session.INITIAL) if before is None else spark.conf.set(session.INITIAL, before)


def test_the_number_of_partitions_is_raised_only(spark, few_partitions):
    def after(read_bytes):
        session.follow_input(spark, read_bytes)
        return spark.conf.get(session.INITIAL, None)

    assert after(4 * session.READ_PER_PARTITION) is None
    assert after(4 * session.READ_PER_PARTITION + 1) == "5"
    assert after(1) == "5"
    spark.conf.set(session.SHUFFLED, "64")
    assert after(1) == "64"
    assert after(1 << 60) == str(session.MOST_PARTITIONS)


@pytest.mark.parametrize("name", ["split_order_value", "rollup_levels_revenue"])
def test_the_number_of_partitions_follows_the_input(spark, monkeypatch, few_partitions, name):
    monkeypatch.setitem(session.AT_MOST, ADVISORY, 2000)
    monkeypatch.setattr(session, "READ_PER_PARTITION", 500)
    df = contract.queries()[name](spark, ROOT)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert max(partitions_read(df._jdf.queryExecution().executedPlan())) >= 8
    result = connect(ROOT).execute(contract.oracle_sql()[name])
    assert got == rows_of([d[0] for d in result.description], result.fetchall())


def test_the_number_of_partitions_follows_the_input_where_joining_was_off(spark, monkeypatch, few_partitions):
    monkeypatch.setitem(session.AT_MOST, ADVISORY, 2000)
    monkeypatch.setattr(session, "READ_PER_PARTITION", 500)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = contract.queries()["rollup_levels_revenue"](spark, ROOT)
        assert len(df.collect()) == 31
        assert max(partitions_read(df._jdf.queryExecution().executedPlan()), default=0) >= 8
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows_shuffled(node):
    """The rows that each shuffle of a finished plan has sent."""
    name = node.nodeName()
    if name == "Exchange":
        yield node.metrics().apply("shuffleRecordsWritten").value()
    inner = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if name.endswith("QueryStage") else []
    for child in inner + [node.children().apply(n) for n in range(node.children().size())]:
        yield from rows_shuffled(child)


def test_ids_are_not_copied_per_level(spark):
    df = spark.range(3000).select("id", F.lit("c").alias("college"), (F.col("id") % 3).alias("dept"))
    out = rollup_levels(df, ["college", "dept"], {"v": F.col("id")}, {"n": F.lit(True), "n_even": F.col("id") % 2 == 0}, "id")
    got = {(r["level"], r["dept"]): (r["v"], r["n"], r["n_even"]) for r in out.collect()}
    assert got == {("total", None): (4498500, 3000, 1500), ("college", None): (4498500, 3000, 1500)} | {
        ("dept", d): (sum(range(d, 3000, 3)), 1000, 500) for d in range(3)}
    assert max(rows_shuffled(out._jdf.queryExecution().executedPlan())) <= 3000
