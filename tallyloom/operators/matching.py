"""Record matching."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import scale
from tallyloom.operators.joins import keep_missing
from tallyloom.operators.windows import rank_in


@dataclass(frozen=True)
class Rule:
    """Canonical key of each side; rows where it is null or blank do not take part."""

    name: str
    left: Column
    right: Column


def match_cascade(left: DataFrame, right: DataFrame, rules: Sequence[Rule], left_id: str,
                  right_id: str, split: bool | None = None) -> DataFrame:
    """First-rule-wins, one-to-one matching; returns (left_id, right_id, rule) for every left row.

    Within one key the n-th left row goes with the n-th right row, by id, so a key shared by very
    many rows costs its rows, not their pairs.  Each rule sees what the earlier ones left; its
    matches are written, which keeps the plan of the last rule as small as the first.  Rule 0
    marks left rows without a partner.
    """
    rest_left, rest_right, found = left, right, []
    for number, rule in enumerate(rules, start=1):
        l = _keyed(rest_left, rule.left, left_id, split)
        r = _keyed(rest_right, rule.right, right_id, split)
        pairs = l.join(r, ["_key", "_nth"]).select(left_id, right_id, F.lit(number).alias("rule"))
        pairs = scale.written(pairs)
        found.append(pairs)
        if number < len(rules):
            rest_left = keep_missing(rest_left, pairs, [left_id])
            rest_right = keep_missing(rest_right, pairs, [right_id])
    matched = found[0]
    for pairs in found[1:]:
        matched = matched.unionByName(pairs)
    unmatched = keep_missing(left.select(left_id), matched, [left_id]).select(
        left_id, F.lit(None).cast(right.schema[right_id].dataType).alias(right_id),
        F.lit(0).alias("rule"))
    return matched.unionByName(unmatched)


def _keyed(df: DataFrame, key: Column, ident: str, split: bool | None) -> DataFrame:
    keyed = df.select(key.cast("string").alias("_key"), ident).filter(
        F.col("_key").isNotNull() & (F.col("_key") != ""))
    return rank_in(keyed, ["_key"], [F.col(ident).asc()], "_nth", split)


def resolve_identity(df: DataFrame, people: DataFrame,
                     rules: Sequence[Sequence[tuple[str, str]]], ident: str, person_id: str,
                     out_rule: str = "resolved_by") -> DataFrame:
    """Fill a missing person id from rules of (row column, people column) pairs, first hit wins.

    A combination that belongs to more than one person resolves nothing.
    """
    hits = []
    for number, rule in enumerate(rules, start=1):
        people_cols = [p for _, p in rule]
        candidates = scale.join_side(people.groupBy(*people_cols)
                      .agg(F.min(person_id).alias("_lo"), F.max(person_id).alias("_hi"))
                      .filter(F.col("_lo") == F.col("_hi"))
                      .select(*[F.col(p).alias(f"__{p}") for p in people_cols],
                              F.col("_lo").alias(f"_hit{number}")))
        on = None
        for mine, theirs in rule:
            same = F.col(mine) == F.col(f"__{theirs}")
            on = same if on is None else on & same
        df = df.join(candidates, on, "left").drop(*[f"__{p}" for p in people_cols])
        hits.append(f"_hit{number}")
    rule_no = F.when(F.col(ident).isNotNull(), F.lit(0))
    for number, hit in enumerate(hits, start=1):
        rule_no = rule_no.when(F.col(hit).isNotNull(), F.lit(number))
    return (df.withColumn(out_rule, rule_no)
            .withColumn(ident, F.coalesce(F.col(ident), *hits)).drop(*hits))


# Characters of a one- or two-word name that are looked up in the vocabulary.
GRAM = 8


def _grams(word: str, size: int) -> Column:
    """Hashes of the `size`-character pieces of a word; the size keeps kinds apart."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(word) - size + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.xxhash64(F.lit(size), F.substring(F.col(word), i, F.lit(size))))


def _rarest_inner_word(prepared: DataFrame, words: DataFrame, name_id: str) -> DataFrame:
    """Per name with inner words, the one found in the fewest texts."""
    inner = prepared.select(name_id, "_name", F.explode(F.array_distinct("_inner")).alias("_word"))
    # counted before they meet the names: a word that every text has is combined before its shuffle
    spread = words.groupBy("_word").agg(F.count("*").alias("_texts")).join(inner.select("_word").distinct(), "_word", "left_semi")
    rarity = F.struct(F.coalesce("_texts", F.lit(0)), F.col("_word"))
    return (inner.join(scale.join_side(spread), "_word", "left").groupBy(name_id, "_name")
            .agg(F.min_by("_word", rarity).alias("_word")))


def _words_holding(short: DataFrame, words: DataFrame, name_id: str) -> DataFrame:
    """Per name without inner words, every word of the texts that holds its longer part."""
    second = F.coalesce(F.get("_w", F.lit(1)), F.lit(""))
    piece = F.when(F.length(second) > F.length(F.get("_w", F.lit(0))), second).otherwise(
        F.get("_w", F.lit(0)))
    short = short.withColumn("_piece", piece).withColumn("_n", F.least(F.length("_piece"), F.lit(GRAM)))
    sizes = [r["_n"] for r in short.select("_n").distinct().collect()]  # at most GRAM + 1 rows
    hashes = F.array_distinct(F.flatten(F.array(*[_grams("_word", n) for n in sizes])))
    # few bytes but much work per word, so it is spread over all cores, and over more partitions where shuffles have more
    spark = words.sparkSession
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    vocabulary = (words.select("_word").distinct().repartition(width, "_word")
                  .select("_word", F.explode_outer(hashes).alias("_gram")))
    keyed = short.withColumn("_gram", F.xxhash64("_n", F.left("_piece", "_n")))
    return (vocabulary.join(keyed, "_gram").filter(F.contains("_word", "_piece"))
            .select(name_id, "_name", "_word"))


def contains_join(texts: DataFrame, names: DataFrame, text_id: str, text: str, name_id: str,
                  name: str) -> DataFrame:
    """(text_id, name_id) for every name that occurs as a substring of a text.

    Where a text holds a name, it holds the name's inner words as whole words: only the first and
    the last word may be cut off from longer ones.  So each name is anchored on its rarest inner
    word; a name of one or two words is anchored on every word of the texts that holds its longer
    part, found in the vocabulary rather than in the texts.  Texts meet names in an equi-join on
    the anchor word, and candidates are checked on the whole text: no match is lost to an anchor
    and none is added.
    """
    split = F.array_distinct(F.split(F.col(text), r"\s+"))
    words = texts.select(text_id, F.explode_outer(split).alias("_word"))
    prepared = (names.filter(F.coalesce(F.col(name), F.lit("")) != "")
                .select(name_id, F.col(name).alias("_name"), F.split(F.col(name), r"\s+").alias("_w"))
                .withColumn("_inner", F.slice("_w", 2, F.greatest(F.size("_w") - 2, F.lit(0)))))
    prepared = scale.written(prepared)  # read several times below
    anchors = _rarest_inner_word(prepared, words, name_id)
    short = prepared.filter(F.size("_inner") < 1)
    if not short.isEmpty():
        anchors = anchors.unionByName(_words_holding(short, words, name_id))
    candidates = words.join(scale.join_side(anchors), "_word").select(text_id, name_id, "_name").distinct()
    return (texts.select(text_id, F.col(text).alias("_text")).join(candidates, text_id)
            .filter(F.contains("_text", "_name")).select(text_id, name_id))
