"""Ranking, running totals and carry-forward.

`latest_per` and `top_n` filter on a bounded row number, which Spark trims inside each map task.
The others need every row of a group; a group too large for one task is cut into range slices.
`split` forces the choice (tests use it); by default the size of the input decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom import scale
from tallyloom.scale import join_null_safe


def latest_per(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column]) -> DataFrame:
    """First row of each key by `order`."""
    return top_n(df, key, order, 1)


def top_n(df: DataFrame, part: Sequence[str] | str, order: Sequence[Column], n: int,
          out: str | None = None) -> DataFrame:
    """First `n` rows of each group; `out` keeps the position."""
    part = [part] if isinstance(part, str) else list(part)
    position = out or "_position"
    kept = (df.withColumn(position, F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
            .filter(F.col(position) <= n))
    return kept if out else kept.drop(position)


def rank_in(df: DataFrame, part: Sequence[str], order: Sequence[Column], out: str = "rank",
            split: bool | None = None, slices: int | None = None) -> DataFrame:
    """Position of every row inside its group; an empty `part` ranks the whole frame.

    `order` must be total, otherwise the position of tied rows is not defined.
    """
    part = list(part)
    if split is None:
        split = scale.has_hot_group(df, part)
    if not split:
        within = Window.partitionBy(*(part or [F.lit(0)])).orderBy(*order)
        return df.withColumn(out, F.row_number().over(within).cast("long"))
    sliced = scale.range_slices(df, part, order, slices)
    earlier = (Window.partitionBy(*(part or [F.lit(0)])).orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (sliced.groupBy(*part, "_slice").agg(F.count("*").alias("_rows"))
               .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
               .drop("_rows"))
    within = Window.partitionBy(*part, "_slice").orderBy(*order)
    numbered = sliced.withColumn("_within", F.row_number().over(within))
    return (join_null_safe(numbered, offsets, [*part, "_slice"])
            .withColumn(out, (F.col("_before") + F.col("_within")).cast("long"))
            .drop("_before", "_within", "_slice"))


def next_seq(new: DataFrame, stored: DataFrame, part: Sequence[str], order: Sequence[Column],
             seq: str, split: bool | None = None) -> DataFrame:
    """Number new rows on from the highest stored number of their group."""
    highest = stored.groupBy(*part).agg(F.max(seq).alias("_highest"))
    ranked = rank_in(new, part, order, "_rank", split)
    return (join_null_safe(ranked, highest, list(part))
            .withColumn(seq, F.coalesce(F.col("_highest"), F.lit(0)) + F.col("_rank"))
            .drop("_highest", "_rank"))


def running_total(df: DataFrame, part: Sequence[str], order: str, value: str,
                  out: str = "running_total", split: bool | None = None,
                  slices: int | None = None) -> DataFrame:
    """Total of the group up to and including each row; (part, order) must be unique.

    The total is null until the first value that is not, and has the type that Spark gives a sum of
    `value`, whichever way it is computed.
    """
    part = list(part)
    kind = df.select(F.sum(value)).schema[0].dataType
    if split is None:
        split = scale.has_hot_group(df, part)
    upto = Window.unboundedPreceding, Window.currentRow
    if not split:
        within = Window.partitionBy(*part).orderBy(order).rowsBetween(*upto)
        return df.withColumn(out, F.sum(value).over(within))
    sliced = scale.range_slices(df, part, [F.col(order).asc()], slices)
    earlier = (Window.partitionBy(*part).orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = (sliced.groupBy(*part, "_slice").agg(F.sum(value).alias("_sum"))
               .withColumn("_before", F.sum("_sum").over(earlier)).drop("_sum"))
    within = Window.partitionBy(*part, "_slice").orderBy(order).rowsBetween(*upto)
    local = sliced.withColumn("_within", F.sum(value).over(within))
    return (join_null_safe(local, carried, [*part, "_slice"])
            .withColumn(out, F.coalesce(F.col("_before") + F.col("_within"), "_before", "_within").cast(kind))
            .drop("_before", "_within", "_slice"))


def prior_total(df: DataFrame, part: Sequence[str], order: str, value: str,
                out: str = "prior_total", split: bool | None = None,
                slices: int | None = None) -> DataFrame:
    """Per row, the total over rows of its group with a strictly smaller `order`; zero if none.

    One shuffle: the running total with ties, less the total of the ties.  A hot group is first
    summed per `order`, so that its ties collapse, and then cut into slices.  `value` should be a
    decimal or an integer, which subtract exactly.  A row without a date or without a group is earlier than none
    and in no group: it adds to no total, and its own is zero.
    """
    part = list(part)
    kind = df.schema[value].dataType
    placed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*part, order]])
    aside = df.filter(~placed).withColumn(out, F.lit(0).cast(kind))
    df = df.filter(placed)
    if split is None:
        split = scale.has_hot_group(df, part)
    if not split:
        through = F.sum(value).over(Window.partitionBy(*part).orderBy(order))
        ties = F.sum(value).over(Window.partitionBy(*part, order))
        return df.withColumn(out, (F.coalesce(through, F.lit(0)) - F.coalesce(ties, F.lit(0))).cast(kind)).unionByName(aside)
    per_step = df.groupBy(*part, order).agg(F.sum(value).alias("_step"))
    totals = running_total(per_step, part, order, "_step", "_through", True, slices)
    before = totals.select(
        *part, order, (F.coalesce("_through", F.lit(0)) - F.coalesce("_step", F.lit(0))).cast(kind).alias(out))
    return (join_null_safe(df, before, [*part, order])
            .withColumn(out, F.coalesce(F.col(out), F.lit(0).cast(kind)))).unionByName(aside)


def asof_join(facts: DataFrame, states: DataFrame, key: str, at: str, since: str,
              cols: Sequence[str], tie: Sequence[str] = (), strict: bool = False,
              split: bool | None = None, slices: int | None = None) -> DataFrame:
    """For each fact, the columns of the latest state of its key that began by then.

    `strict` asks for states that began before the fact, not at the same time.  States of equal
    time are settled by the greatest `tie` columns.  No pair of fact and state is ever formed:
    both are stacked, ordered by time, and the last state seen is carried forward.
    """
    fact_cols = facts.columns
    state = F.struct(*[F.col(c).alias(c) for c in cols])
    picked = (states.filter(F.col(since).isNotNull())
              .groupBy(F.col(key).alias("_key"), F.col(since).alias("_at"))
              .agg(F.max_by(state, F.struct(*[F.col(c) for c in (*tie, *cols)])).alias("_state")))
    # at equal times a state sorts before the fact, or after it when it has to be earlier
    picked = picked.select("_key", "_at", F.lit(2 if strict else 0).alias("_kind"), "_state",
                           F.lit(None).cast(facts.select(F.struct(*fact_cols)).schema[0].dataType)
                           .alias("_fact"))
    asked = facts.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
                         F.lit(None).cast(picked.schema["_state"].dataType).alias("_state"),
                         F.struct(*fact_cols).alias("_fact"))
    stacked = picked.unionByName(asked)
    order = [F.col("_at").asc_nulls_first(), F.col("_kind").asc()]
    if split is None:
        split = scale.has_hot_group(stacked, ["_key"])
    upto = Window.unboundedPreceding, Window.currentRow
    if not split:
        seen = Window.partitionBy("_key").orderBy(*order).rowsBetween(*upto)
        filled = stacked.withColumn("_seen", F.last("_state", ignorenulls=True).over(seen))
    else:
        # the hash separates facts of one instant so that even those can be cut apart
        salted = stacked.withColumn("_salt", F.xxhash64("_fact"))
        order = [*order, F.col("_salt").asc()]
        sliced = scale.range_slices(salted, ["_key"], order, slices)
        earlier = (Window.partitionBy("_key").orderBy("_slice")
                   .rowsBetween(Window.unboundedPreceding, -1))
        last_of_slice = (sliced.groupBy("_key", "_slice")
                         .agg(F.max_by("_state", F.when(F.col("_state").isNotNull(),
                                                        F.struct("_at", "_kind"))).alias("_last"))
                         .withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier))
                         .drop("_last"))
        seen = Window.partitionBy("_key", "_slice").orderBy(*order).rowsBetween(*upto)
        filled = join_null_safe(
            sliced.withColumn("_seen", F.last("_state", ignorenulls=True).over(seen)),
            last_of_slice, ["_key", "_slice"])
        filled = filled.withColumn("_seen", F.coalesce("_seen", "_carried"))
    found = F.when(F.col("_key").isNotNull() & F.col("_at").isNotNull(), F.col("_seen"))
    return (filled.filter(F.col("_kind") == 1)
            .withColumn("_found", found)
            .select("_fact.*", *[F.col(f"_found.{c}").alias(c) for c in cols]))


def explicit_order(c: Column | str, values: Sequence[str]) -> Column:
    """Sort key for a stated value order; values not listed sort first."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), F.col(c) if isinstance(c, str) else c)


def pinyin_order(c: Column | str) -> Column:
    """Sort key in Chinese pinyin order."""
    return F.collate(F.col(c) if isinstance(c, str) else c, "zh")


def nulls_last(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()
