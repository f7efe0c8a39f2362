"""Behaviours decided one by one (T1-T31) and edge rows of the operators."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom import scale
from tallyloom.functions import dates as d
from tallyloom.functions import numbers as n
from tallyloom.functions import text as t
from tallyloom.operators import groups as g
from tallyloom.operators import joins as j
from tallyloom.operators import merge as m
from tallyloom.operators import quality as q
from tallyloom.operators import rules as r
from tallyloom.operators import sets as s
from tallyloom.operators import windows as w
from tallyloom.operators.predicates import allow, apply_steps, live
from tests.conftest import rows


def one(spark, expression, **values):
    """Value of a column expression over one row of text values."""
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(expression().alias("x")).first()[0]


def test_t1_allow_list_filters(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "db string, tbl string")
    assert rows(allow(df, {"db": ["a"], "tbl": None})) == [("a", "x")]


def test_t4_t7_first_values_come_from_one_row(spark):
    df = spark.createDataFrame([(1, "2", "B, C", "x"), (1, "1", None, "y"), (1, "3", "D", "z")],
                               "k int, code string, school string, other string")
    assert rows(g.first_by(df, ["k"], ["code"], ["school", "other"])) == [(1, None, "y")]
    assert rows(g.argmax(df, ["k"], "code", ["school"])) == [(1, "3", "D")]


def test_t6_union_of_rows_with_own_ids_keeps_equal_rows(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    assert s.union_layouts([df, df], distinct=False).count() == 4
    assert s.union_layouts([df, df]).count() == 1


def test_t8_null_in_the_list_excludes_nothing(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(j.keep_missing(left, right, ["k"])) == [(2,), (None,)]
    assert rows(j.keep_existing(left, right, ["k"])) == [(1,)]


def test_t9_keys_fold_case_and_blanks(spark):
    assert one(spark, lambda: t.fold_key("a"), a=" C ") == "c"


def test_t10_junk_and_zero(spark):
    assert one(spark, lambda: n.to_int_or_zero("a"), a="x1") == 0
    assert one(spark, lambda: n.to_int_or_zero("a"), a="12.7") == 12
    assert one(spark, lambda: n.safe_div(F.lit(1), F.lit(0)), a="") is None
    assert one(spark, lambda: n.percent(F.lit(1), F.lit(0)), a="") is None
    assert one(spark, lambda: n.percent(F.lit(1), F.lit(3)), a="") == Decimal("33.33")
    assert one(spark, lambda: n.percent_text(n.percent(F.lit(1), F.lit(8))), a="") == "12.50%"


def test_t11_month_ten_keeps_its_zero(spark):
    assert one(spark, lambda: d.year_month("a", "10"), a="2020") == "2020.10"


def test_t12_length_in_bytes(spark):
    assert one(spark, lambda: t.byte_length("a"), a="学a") == 4


def test_t18_degree_rule_sorts_by_degree_code(spark):
    df = spark.createDataFrame([("p", "1", "3"), ("p", "9", "2")], "person_id string, education string, degree_code string")
    assert rows(g.first_by(df, ["person_id"], ["degree_code"], ["education"])) == [("p", "9")]


def test_t20_empty_scope_is_fine(spark):
    df = spark.createDataFrame([("p", "u")], "person string, unit string")
    none = spark.createDataFrame([], "id string")
    assert rows(j.in_scope(df, none, none, "person", "unit")) == []
    assert rows(j.in_scope(df, none, spark.createDataFrame([("u",)], "id string"), "person", "unit")) == [("p", "u")]


def test_t21_several_partners_are_settled_by_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    src = spark.createDataFrame([(1, "x", 2), (1, "y", 1)], "k int, v string, o int")
    assert rows(j.update_from(df, src, ["k"], ["v"], order=["o"])) == [(1, "y"), (2, "b")]


def test_t26_bands_are_parameters(spark):
    df = spark.createDataFrame([(29,), (30,), (None,), (65,)], "age int")
    out = df.select("age", g.bucket("age", [30, 60], ["<30", "30-59", "60+"], "?"))
    assert dict(rows(out)) == {29: "<30", 30: "30-59", None: "?", 65: "60+"}


def test_t28_freshness_looks_at_the_newest_days(spark):
    def result(table, days, status="OK"):
        return [("f", table, status, dt.datetime.fromisoformat(x)) for x in days]
    data = (result("good", ["2024-01-01", "2024-01-09", "2024-01-10", "2024-01-10 05:00:00"])
            + result("missed", ["2024-01-08", "2024-01-10"]) + result("failed", ["2024-01-09"])
            + result("failed", ["2024-01-10"], "FAILED") + result("old", ["2024-01-01", "2024-01-02"]))
    df = spark.createDataFrame(data, "flow_name string, table_name string, status string, create_time timestamp")
    fresh = {r["table_name"]: r["is_fresh"] for r in q.is_fresh(df, "2024-01-10").collect()}
    assert fresh == {"good": True, "missed": False, "failed": False, "old": False}


def test_t30_t31_fill_takes_own_column_and_log_says_what_changed(spark):
    target = spark.createDataFrame([(1, "confirmed", "", "t1", None), (2, "open", "h", "t2", "x"), (3, "deleted", "", "t3", "")],
                                   "id int, state string, holder string, title string, kind string")
    src = spark.createDataFrame([(1, "H", "T", "K", False), (2, "H2", "T2", "K2", True), (3, "H3", "T3", "K3", False)],
                                "id int, holder string, title string, kind string, weak boolean")
    result = m.policy_update(target, src, ["id"], "state", {
        "confirmed": m.Policy({"title": "always", "holder": "fill", "kind": "fill"}),
        "open": m.Policy({"title": "always", "holder": "always", "kind": "always"}, next_state="confirmed")},
        {"title": "title", "holder": "holder", "kind": "kind"}, weak="weak")
    assert rows(result.rows) == [(1, "confirmed", "H", "T", "K"), (2, "open", "H2", "T2", "K2"), (3, "deleted", "", "t3", "")]
    assert rows(result.log) == [(1, "title:t1-->T;holder:-->H;kind:-->K;"), (2, "title:t2-->T2;holder:h-->H2;kind:x-->K2;")]


def test_a_repeated_key_is_an_error(spark):
    once = spark.createDataFrame([(1, "a"), (None, "n"), (None, "m")], "id int, v string")
    twice = spark.createDataFrame([(1, "b"), (1, "c"), (2, "d")], "id int, v string")
    for action in (lambda: m.merge_snapshot(once, twice, ["id"]), lambda: m.upsert(once, twice, ["id"]), lambda: m.change_log(once, twice, ["id"], {"v": "v"}),
                   lambda: s.diff(twice, once, ["id"], ["v"]), lambda: s.diff(once, twice, ["id"], ["v"]),
                   lambda: m.policy_update(once, twice, ["id"], "v", {"a": m.Policy({"v": "always"})}, {"v": "v"}).rows):
        with pytest.raises(Exception, match="holds a key twice"):
            action().collect()


@pytest.mark.parametrize("split", [False, True])
def test_rows_without_a_date_or_group_are_earlier_than_none(spark, split):
    df = spark.createDataFrame([("c", None, Decimal(60)), ("c", dt.date(2024, 1, 1), Decimal(10)), ("c", dt.date(2024, 1, 2), None), ("c", dt.date(2024, 1, 3), Decimal(5)),
                                (None, dt.date(2024, 1, 1), Decimal(7)), (None, dt.date(2024, 1, 2), Decimal(8))], "card string, day date, amount decimal(20,6)")
    got = w.prior_total(df, ["card"], "day", "amount", split=split, slices=2)
    assert got.schema["prior_total"].dataType == df.schema["amount"].dataType
    assert sorted((str(r["card"]), str(r["day"]), int(r["prior_total"])) for r in got.collect()) == [
        ("None", "2024-01-01", 0), ("None", "2024-01-02", 0), ("c", "2024-01-01", 0), ("c", "2024-01-02", 10), ("c", "2024-01-03", 10), ("c", "None", 0)]
    fees = {str(x["day"]): x["fee"] for x in r.bracket_fee(df, ["card"], "day", "amount", split=split).where("card = 'c'").collect()}
    alone = r.bracket_fee(df.where("card = 'c' and day is not null"), ["card"], "day", "amount", split=split).collect()
    assert {str(x["day"]): x["fee"] for x in alone} == {k: v for k, v in fees.items() if k != "None"}


def test_running_totals_agree_in_type_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, Decimal(3)), ("a", 3, None), ("a", 4, Decimal(4)), ("b", 1, None)], "k string, t int, v decimal(18,2)")
    plain, split = (w.running_total(df, ["k"], "t", "v", split=x, slices=3) for x in (False, True))
    assert plain.schema["running_total"].dataType == split.schema["running_total"].dataType
    assert rows(plain) == rows(split)


def test_the_gate_counts_rows_that_a_generator_makes(spark, monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 1000)
    few = spark.range(2).select(F.lit(1).alias("k"), F.explode(F.sequence(F.lit(1), F.lit(2000))).alias("n"))
    assert scale.has_hot_group(few, ["k"]) and not scale.has_hot_group(spark.range(900).withColumn("k", F.lit(1)), ["k"])


def test_null_and_blank_are_the_same_value(spark):
    schema = "id int, a string"
    before = spark.createDataFrame([(1, None), (2, "x"), (3, None), (4, "")], schema)
    now = spark.createDataFrame([(1, ""), (2, None), (3, "y"), (5, "z")], schema)
    assert {r["id"]: r["change"] for r in s.diff(now, before, ["id"], ["a"]).collect()} == {
        2: "changed", 3: "changed", 4: "removed", 5: "new"}
    assert rows(m.change_log(before, now, ["id"], {"a": "A"})) == [(2, "A:x-->;"), (3, "A:-->y;")]


def test_merge_then_diff_is_empty_and_feed_replay_is_idle(spark):
    schema = "id int, a string, own string"
    target = spark.createDataFrame([(1, "x", "mine"), (2, "y", "keep")], schema)
    snap = spark.createDataFrame([(2, "z", None), (3, "w", None)], schema)
    merged = m.merge_snapshot(target, snap, ["id"], ["a"])
    assert rows(merged) == [(2, "z", "keep"), (3, "w", None)]
    assert s.diff(merged, snap, ["id"], ["a"]).isEmpty()
    feed = m.diff_feed(snap, target, ["id"], ["a"])
    assert rows(feed.rows.select("id", "change")) == [(2, "changed"), (3, "new")]
    assert m.diff_feed(snap, feed.next_before, ["id"], ["a"]).rows.isEmpty()


def test_merge_keeps_rows_without_a_key_and_flags_returning_ones(spark):
    target = spark.createDataFrame([(1, "x", "N"), (None, "own", "N"), (2, "y", "Y"), (4, "q", "N")], "id int, a string, gone string")
    snap = spark.createDataFrame([(2, "z"), (None, "new")], "id int, a string")
    flagged = m.merge_snapshot(target, snap, ["id"], delete="flag", flag="gone")
    assert rows(flagged) == sorted([(1, "x", "Y"), (None, "own", "N"), (2, "z", "N"), (4, "q", "Y"), (None, "new", "N")], key=repr)
    assert rows(m.merge_snapshot(target, snap, ["id"]).select("id", "a")) == sorted(
        [(None, "own"), (2, "z"), (None, "new")], key=repr)


def test_overlay_adds_live_and_drops_tombstoned(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    imports = spark.createDataFrame([(2, "B", True), (3, "c", False), (1, "A", False), (4, "d", None)], "id int, v string, gone boolean")
    assert rows(m.overlay(base, imports, ["id"], F.col("gone"))) == [(1, "a"), (3, "c"), (4, "d")]


@pytest.mark.parametrize("raw, fixed", [("2020", "2020"), ("202003", "2020-03"), ("2020-3", "2020-03"), ("2020-03", "2020-03"),
                                        ("2020-3-1", "2020-3-1"), ("2020-0-01", "2020-0-01"), ("2020-03-1 x", "2020"),
                                        ("2020-03-01", "2020-03-01")])
def test_partial_dates(spark, raw, fixed):
    assert one(spark, lambda: d.repair_date("a"), a=raw) == fixed


def test_terms(spark):
    for code, want in {"202009": ("2020-2021", "1"), "202102": ("2020-2021", "2"), "202106": ("2020-2021", "3"), "202111": ("202111", "202111")}.items():
        assert (one(spark, lambda: d.academic_year("a"), a=code), one(spark, lambda: d.term_number("a"), a=code)) == want
    assert one(spark, lambda: d.calendar_year("a", F.lit(1)), a="2020-2021") == 2020
    assert one(spark, lambda: d.calendar_year("a", F.lit(3)), a="2020-2021") == 2021
    assert one(spark, lambda: d.first_year("a", "b"), a="199", b="2001.02") == "2001"
    assert one(spark, lambda: d.first_year("a"), a=None) == "0"
    assert one(spark, lambda: d.full_years("a", d.day("2020-05-01")), a="2000.06") == 19


def test_truncation_goes_toward_zero(spark):
    value = lambda x: n.truncate(F.lit(x).cast("decimal(10,4)"), 2)
    assert one(spark, lambda: value("1.239"), a="") == Decimal("1.23")
    assert one(spark, lambda: value("-1.239"), a="") == Decimal("-1.23")
    assert one(spark, lambda: t.drop_zero_cents("a"), a="5.00") == "5"
    assert one(spark, lambda: t.drop_zero_cents("a"), a="5.001") == "5.001"


def test_text_helpers(spark):
    assert one(spark, lambda: t.canonical_number("a"), a="CN 2010 1.5") == "20101"
    assert one(spark, lambda: t.between_markers("a", "第", "号"), a="证第12号x") == "12"
    assert one(spark, lambda: t.fold_punctuation("a"), a="（一）。") == "(一)."
    assert one(spark, lambda: t.strip_leading_zeros("a"), a="00120") == "120"
    assert one(spark, lambda: t.tuple_field("a", 2, 2), a="1|2|3,4|5|6") == "5"
    assert one(spark, lambda: F.concat_ws("+", t.split_list("a", ";")), a="x; y;;") == "x+y"


def test_unknown_step_is_an_error(spark):
    with pytest.raises(KeyError):
        apply_steps(spark.range(1), ["nope"], {})


def test_live_rows(spark):
    df = spark.createDataFrame([("N",), ("Y",), (None,)], "flag string")
    assert live(df, "flag").count() == 2 and live(df, "flag", null_is_live=False).count() == 1


def _fee_rows(spark, data):
    return spark.createDataFrame([(k, dt.date.fromisoformat(x), Decimal(str(a))) for k, x, a in data],
                                 "card string, booked date, amount decimal(20,6)")


def test_bracket_fee_of_a_card_is_the_fee_of_its_total(spark):
    data = [("a", f"2020-01-{i + 1:02d}", x) for i, x in enumerate([10, 45, 30, 200, 300, 0.5, 700])]
    fees = r.bracket_fee(_fee_rows(spark, data), ["card"], "booked", "amount")
    total = sum(x for _, _, x in data)
    whole = r.bracket_fee(_fee_rows(spark, [("a", "2020-01-01", total)]), ["card"], "booked", "amount")
    assert sum(x["fee"] for x in fees.collect()) == whole.first()["fee"]


def test_t13_bracket_edges(spark):
    data = [("a", "2020-01-01", 50), ("a", "2020-01-02", 50), ("a", "2020-01-03", 400), ("a", "2020-01-04", 1),
            ("b", "2020-01-01", 450), ("b", "2020-01-02", 100), ("c", "2020-01-01", 600),
            ("d", "2020-01-01", 30), ("d", "2020-01-01", 30)]
    got = rows(r.bracket_fee(_fee_rows(spark, data), ["card"], "booked", "amount").select("card", "booked", "fee"))
    fee = [float(x[2]) for x in got]
    # a: 4 %, 3 %, 2 %, 1 %; b: 2000 + 1500 + 7000, then 50 at 2 % and 50 at 1 %; c: all four; d: same day, same base
    assert fee == [20000, 15000, 80000, 100, 20000 + 15000 + 70000, 10000 + 5000,
                   20000 + 15000 + 80000 + 10000, 12000, 12000]


def test_preset_and_flat_fee(spark):
    df = _fee_rows(spark, [("a", "2020-01-01", 10), ("b", "2020-01-01", 10)]).withColumn(
        "preset", F.when(F.col("card") == "b", F.lit(7)))
    out = r.bracket_fee(df, ["card"], "booked", "amount", preset="preset", flat=(F.col("card") == "a", F.col("amount")))
    assert [float(x["fee"]) for x in out.orderBy("card").collect()] == [2000.0, 7.0]


def test_fee_status(spark):
    df = spark.createDataFrame([(1, 10.0, "STATIC", 5.0, 0.0), (2, 10.0, "PERCENT", 0.02, 20.0), (3, 10.0, "PERCENT", 0.02, 5.0),
                                (4, 10.0, None, 1.0, 0.0)], "id int, total double, mode string, rate double, paid double")
    due, status = r.fee_status("total", "mode", "rate", "paid")
    assert rows(df.select("id", due, status)) == [(1, 5.0, "UNPAID"), (2, 20.0, "PAID"), (3, 20.0, "PAID_HALF"), (4, 0.0, "FREE")]


def test_fee_split_at_the_ratio_edges(spark):
    df = spark.createDataFrame([(1, "grant", 0.4, 0.6, None, 0.0), (2, "grant", 0.3, 0.7, None, 0.0), (3, "grant", 0.0, 0.0, None, 0.0),
                                (4, "grant", 0.4, 0.6, 0.1, 0.0), (5, "contract", 0.4, 0.6, None, 10.0)],
                               "id int, kind string, school double, college double, perf double, got double")
    out = r.split_fees(df, "kind", "school", "college", "perf", "got", unit=1)
    got = {x["id"]: (round(x["performance"], 6), round(x["college_fee"], 6), x["remuneration"]) for x in out.collect()}
    assert got == {1: (0.4, 0.2, None), 2: (0.0, 0.7, None), 3: (0.0, 0.0, None), 4: (0.1, 0.5, None), 5: (0.0, 0.6, 3.0)}


def test_corrections(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "id int, v string, n int")
    fixes = spark.createDataFrame([(1, "v", "x", 1, False), (1, "v", "y", 2, False), (2, None, None, 1, True), (9, "v", "z", 1, False),
                                   (3, "n", None, 1, False)], "id int, column_name string, value string, seq int, is_delete boolean")
    assert rows(r.apply_corrections(df, fixes, "id", ["v", "n"])) == [(1, "y", 1), (3, "c", None)]


def test_backfill_tries_keys_in_order(spark):
    df = spark.createDataFrame([("k1", "p1", None), ("k9", "p1", None), ("k1", "p1", "own"), (None, None, None)], "a string, b string, v string")
    src = spark.createDataFrame([("k1", "p1", "first"), ("k1", "p2", "second"), ("k2", "p1", "other")], "a string, b string, v string")
    assert rows(r.backfill(df, src, ["a", "b"], ["v"])) == sorted(
        [("k1", "p1", "first"), ("k9", "p1", "first"), ("k1", "p1", "own"), (None, None, None)], key=repr)


def test_title_dates(spark):
    appointments = spark.createDataFrame([
        ("s", "011", "2010.01", "2010.02"), ("s", "013", "2000.01", "2000.02"), ("m", "013", "2012.01", "2012.02"),
        ("n", "010", "2015.01", "2015.03"), ("j", "014", "2016.01", "2016.02"), ("b", "", "2001.01", "2001.02")],
        "person string, title_code string, granted string, appointed string")
    degrees = spark.createDataFrame([("m", "210", "2011.06"), ("j", "310", "2009.06"), ("s", "210", "1990.01")],
                                    "person string, degree_code string, degree_date string")
    out = r.title_date(appointments, degrees, "person", {"1": "senior", "2": "associate", "3": "middle", "4": "junior", "0": "none"})
    assert {x["person"]: x["title_date"] for x in out.collect()} == {
        "s": "2010.01", "m": "2011.06", "n": "2015.03", "j": "2016.01", "b": "2001.02"}


def test_status_by_date(spark):
    df = spark.createDataFrame([(1, "x", "2020-01-01"), (2, "x", "2030-01-01"), (3, "x", None)], "id int, status string, ends string")
    out = r.status_by_date(df, "status", "ends", F.lit("2024-01-01"), "extended", "ended")
    assert rows(out.select("id", "status")) == [(1, "ended"), (2, "extended"), (3, "x")]


def test_rollup_counts_an_id_once_per_level(spark):
    df = spark.createDataFrame([("c", "d1", 1, 5), ("c", "d2", 1, 7), (None, "d3", 2, 1)], "college string, dept string, id int, v int")
    out = g.rollup_levels(df, ["college", "dept"], {"v": F.col("v")}, {"n": F.lit(True)}, "id")
    got = {(x["level"], x["college"], x["dept"]): (x["v"], x["n"]) for x in out.collect()}
    assert got == {("dept", "c", "d1"): (5, 1), ("dept", "c", "d2"): (7, 1), ("dept", None, "d3"): (1, 1),
                   ("college", "c", None): (12, 1), ("college", None, None): (1, 1), ("total", None, None): (13, 2)}


def test_rollup_counts_an_id_by_any_of_its_groups(spark):
    df = spark.createDataFrame([("c", "d1", 1, False), ("c", "d2", 1, True), ("c", None, 1, True), ("e", "d1", 1, True), ("c", "d1", None, True),
                                ("c", "d1", 2, None)], "college string, dept string, id int, f boolean")
    out = g.rollup_levels(df, ["college", "dept"], {}, {"n": F.lit(True), "n_f": F.col("f")}, "id")
    got = {(x["level"], x["college"], x["dept"]): (x["n"], x["n_f"]) for x in out.collect()}
    assert got == {("dept", "c", "d1"): (2, 0), ("dept", "c", "d2"): (1, 1), ("dept", "c", None): (1, 1), ("dept", "e", "d1"): (1, 1),
                   ("college", "c", None): (2, 1), ("college", "e", None): (1, 1), ("total", None, None): (2, 1)}
    no_total = g.rollup_levels(df, ["college", "dept"], {}, {"n": F.lit(True), "n_f": F.col("f")}, "id", total=False)
    assert {(x["level"], x["college"], x["dept"]): (x["n"], x["n_f"]) for x in no_total.collect()} == {
        k: v for k, v in got.items() if k[0] != "total"}


def test_windows_are_half_open(spark):
    times = ["2024-01-01 11:44:59", "2024-01-01 11:45:00", "2024-01-01 11:59:59", "2024-01-01 12:00:00"]
    df = spark.createDataFrame([(x, dt.datetime.fromisoformat(x)) for x in times], "id string, ts timestamp")
    assert [x[0] for x in rows(q.incremental(df, "ts", "2024-01-01 12:00:00").select("id"))] == times[1:3]
    assert q.incremental(df, "ts", "2024-01-01 12:00:00", init=True).count() == 3
    assert q.load_since(df, df.limit(0), "ts").count() == 4
    assert q.resend_if_changed(df, spark.range(5), "ts", "2023-01-01 12:00:00").count() == 0


def test_gates(spark):
    assert not q.gate(spark.range(0)).passed
    assert q.gate(spark.range(5), 10).reason == "fewer than 10 rows"
    assert q.gate(spark.range(50), 1, 10).reason == "more than 10 rows"
    assert q.gate(spark.range(5), 1, 10).passed
