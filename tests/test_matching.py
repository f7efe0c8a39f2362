import random

from pyspark.sql import functions as F

from tallyloom.operators.joins import any_key_join, key_diff
from tallyloom.operators.matching import Rule, contains_join, match_cascade, resolve_identity
from tallyloom.operators.merge import sync_parent_child
from tests.conftest import rows


def test_contains_join_equals_brute_force(spark):
    rng = random.Random(7)
    words = ["ab", "abc", "cab", "bab", "a", "xabx", "dog", "hotdog", "dogs", "the", "cat", "long-word-here", "é", ""]
    texts = [(i, "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", " "]) for _ in range(rng.randint(0, 14)))) for i in range(150)]
    names = [(i, rng.choice(["", " "]) + " ".join(rng.choice(words) for _ in range(rng.randint(1, 5)))) for i in range(120)]
    names += [(900, "ab abc"), (901, "b c"), (902, " "), (903, "ong-word-her"), (904, ""), (905, None), (906, "dog the cat")]
    got = contains_join(spark.createDataFrame(texts, "t int, text string"), spark.createDataFrame(names, "n int, name string"),
                        "t", "text", "n", "name")
    want = sorted((i, k) for i, text in texts for k, name in names if name and name in text)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_contains_join_with_no_names(spark):
    texts = spark.createDataFrame([(1, "a b c")], "t int, text string")
    assert contains_join(texts, spark.createDataFrame([], "n int, name string"), "t", "text", "n", "name").count() == 0


def test_cascade_is_one_to_one_and_earlier_rules_win(spark):
    left = spark.createDataFrame([(1, "N1", "t"), (2, None, "t"), (3, None, "t"), (4, "", "u"), (5, "N9", None)],
                                 "l int, no string, title string")
    right = spark.createDataFrame([(11, "N1", "t"), (12, "x", "t"), (13, "y", "v")], "r int, no string, title string")
    rules = [Rule("no", F.col("no"), F.col("no")), Rule("title", F.col("title"), F.col("title"))]
    out = match_cascade(left, right, rules, "l", "r")
    assert rows(out) == [(1, 11, 1), (2, 12, 2), (3, None, 0), (4, None, 0), (5, None, 0)]


def test_a_hot_key_costs_its_rows_not_its_pairs(spark):
    left = spark.range(3000).select(F.col("id").alias("l"), F.lit("same").alias("k"))
    right = spark.range(2000).select((F.col("id") + 10_000).alias("r"), F.lit("same").alias("k"))
    out = match_cascade(left, right, [Rule("k", F.col("k"), F.col("k"))], "l", "r", split=True)
    assert out.filter("rule = 1").count() == 2000 and out.count() == 3000
    assert out.filter("rule = 1 and r <> l + 10000").count() == 0


def test_identity_needs_a_unique_candidate(spark):
    people = spark.createDataFrame([(1, "a", "u"), (2, "b", "u"), (3, "b", "w"), (4, "b", "u")], "id int, name string, unit string")
    df = spark.createDataFrame([(10, 7, "a", "u"), (11, None, "a", "u"), (12, None, "b", "w"), (13, None, "b", "u")],
                               "row int, who int, name string, unit string")
    out = resolve_identity(df, people, [[("name", "name")], [("name", "name"), ("unit", "unit")]], "who", "id")
    assert rows(out.select("row", "who", "resolved_by")) == [(10, 7, 0), (11, 1, 1), (12, 3, 2), (13, None, None)]


def test_any_key_takes_the_smallest_partner(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), (None, "z")], "k1 string, k2 string")
    src = spark.createDataFrame([(5, "a", "q"), (3, "n", "x"), (1, None, None)], "id int, k1 string, k2 string")
    assert rows(any_key_join(df, src, [("k1", "k1"), ("k2", "k2")], "id", "hit").select("k1", "hit")) == sorted(
        [("a", 3), ("b", None), (None, None)], key=repr)


def test_two_sided_difference(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(key_diff(a, b, ["k"])) == [(1, "left"), (3, "right")]


def test_three_way_sync(spark):
    src = spark.createDataFrame([("p1", "m1"), ("p1", "m2"), ("p2", "m1")], "p string, m string")
    parents, members = spark.createDataFrame([("p1",)], "p string"), spark.createDataFrame([("p1", "m1")], "p string, m string")
    assert rows(sync_parent_child(src, parents, members, "p", ["p", "m"])) == [
        ("p1", "m1", "update"), ("p1", "m2", "add_member"), ("p2", "m1", "add_both")]
