"""Joins (J1-J7, J11-J21, J23, J24).

No broadcast hints: Spark broadcasts a side whose size it knows to be under
`spark.sql.autoBroadcastJoinThreshold`, from statistics or from the finished shuffle, and splits
skewed shuffle partitions otherwise.  Every lookup side is made unique per key first, so a lookup
never multiplies rows; `scale.join_side` keeps such a side from standing in the way of the split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import split_list
from tallyloom.scale import join_null_safe, join_side


def unique_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
              order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the values of the row smallest in `order`, then in `cols`."""
    chosen = F.min_by(F.struct(*cols), F.struct(*order, *cols)) if cols else F.lit(True)
    return df.groupBy(*keys).agg(chosen.alias("_one")).select(
        *keys, *[F.col(f"_one.{c}").alias(c) for c in cols])


@dataclass(frozen=True)
class Lookup:
    """One code table joined to a fact.

    `on` maps a fact column or expression to the key column of `dim`; `take` maps a column of
    `dim` to its output name.  `where` filters `dim` first, which is what a constant condition
    inside ON means for a left join.  `unique` says the keys are a primary key of `dim` already.
    """

    dim: DataFrame
    on: Sequence[tuple[Column | str, str]]
    take: Mapping[str, str]
    where: Column | None = None
    trim: bool = False
    order: Sequence[str] = field(default_factory=tuple)
    unique: bool = False


def lookup(df: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Left-join code tables one after the other; unmatched rows keep nulls."""
    for number, one in enumerate(lookups):
        keys = [k for _, k in one.on]
        dim = one.dim if one.where is None else one.dim.filter(one.where)
        if one.trim:
            dim = dim.withColumns({k: F.trim(k) for k in keys})
        if not one.unique:
            dim = join_side(unique_by(dim, keys, list(one.take), one.order))
        dim = dim.select(*[F.col(k).alias(f"_k{number}_{k}") for k in keys],
                         *[F.col(c).alias(name) for c, name in one.take.items()])
        condition = []
        for source, k in one.on:
            left = F.col(source) if isinstance(source, str) else source
            condition.append((F.trim(left) if one.trim else left) == F.col(f"_k{number}_{k}"))
        df = df.join(dim, reduce(lambda a, b: a & b, condition), "left")
        df = df.drop(*[f"_k{number}_{k}" for k in keys])
    return df


def parent_lookup(df: DataFrame, id_col: str, parent_col: str, cols: Sequence[str],
                  levels: int = 1) -> DataFrame:
    """Columns of the parent row (and its parents, `levels` deep) as `parent<n>_<col>`."""
    source = join_side(unique_by(df, [id_col], [parent_col, *cols]))
    link = parent_col
    for level in range(1, levels + 1):
        up = source.select(F.col(id_col).alias("_up"), F.col(parent_col).alias(f"_link{level}"),
                           *[F.col(c).alias(f"parent{level}_{c}") for c in cols])
        df = df.join(up, F.col(link) == F.col("_up"), "left").drop("_up")
        link = f"_link{level}"
    return df.drop(*[f"_link{n}" for n in range(1, levels + 1)])


def _pairs(keys: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}


def _side(src: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """The distinct keys of the right side: a hot key there shrinks to one row before the shuffle."""
    keys = src.select(*[F.col(r).alias(f"__{n}") for n, r in enumerate(pairs.values())])
    return join_side(keys.distinct())


def keep_existing(df: DataFrame, src: DataFrame, keys: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Rows with a partner in `src` (IN, EXISTS).  `keys` may map left names to right names."""
    pairs = _pairs(keys)
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{n}") for n, k in enumerate(pairs)])
    return df.join(_side(src, pairs), on, "left_semi")


def keep_missing(df: DataFrame, src: DataFrame, keys: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Rows without a partner in `src`.

    Null keys have no partner and are kept; a null in `src` excludes nothing, unlike NOT IN.
    """
    pairs = _pairs(keys)
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{n}") for n, k in enumerate(pairs)])
    return df.join(_side(src, pairs), on, "left_anti")


def exists_flag(df: DataFrame, src: DataFrame, keys: Sequence[str] | Mapping[str, str],
                out: str) -> DataFrame:
    """Whether a partner exists, as a column."""
    pairs = _pairs(keys)
    partners = _side(src, pairs).withColumn(out, F.lit(True))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{n}") for n, k in enumerate(pairs)])
    joined = df.join(partners, on, "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))
    return joined.drop(*[f"__{n}" for n in range(len(pairs))])


def any_key_join(df: DataFrame, src: DataFrame, keys: Sequence[tuple[str, str]], id_col: str,
                 out: str) -> DataFrame:
    """`out` is the smallest `id_col` of `src` that equals the row in any of the key pairs.

    One equi-join per key against a side that is unique per key: no OR in the join condition and
    no pair of rows beyond one per key.
    """
    found = []
    for number, (left_key, right_key) in enumerate(keys):
        side = (src.filter(F.col(right_key).isNotNull()).groupBy(F.col(right_key).alias("_k"))
                .agg(F.min(id_col).alias(f"_id{number}")))
        df = df.join(join_side(side), F.col(left_key) == F.col("_k"), "left").drop("_k")
        found.append(f"_id{number}")
    best = F.least(*found) if len(found) > 1 else F.col(found[0])
    return df.withColumn(out, best).drop(*found)


def update_from(df: DataFrame, src: DataFrame, keys: Sequence[str], cols: Sequence[str],
                order: Sequence[str] = (), when: Column | None = None,
                keep_on_null: bool = False) -> DataFrame:
    """UPDATE ... JOIN ... SET: matched rows take `cols` from `src`.

    Several partners are settled by `order`.  `when` is tested on the row before the update and
    may use the new values as `new_<col>`.
    """
    side = join_side(unique_by(src, keys, cols, order)).select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        *[F.col(c).alias(f"new_{c}") for c in cols], F.lit(True).alias("_hit"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in keys])
    joined = df.join(side, on, "left")
    hit = F.col("_hit").isNotNull()
    if when is not None:
        hit = hit & F.coalesce(when, F.lit(False))
    new = {c: F.coalesce(f"new_{c}", c) if keep_on_null else F.col(f"new_{c}") for c in cols}
    joined = joined.withColumn("_take", hit)
    joined = joined.withColumns({c: F.when(F.col("_take"), new[c]).otherwise(F.col(c)) for c in cols})
    return joined.select(*df.columns)


def key_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], out: str = "only_in") -> DataFrame:
    """Keys found on one side only, marked `left` or `right`."""
    left = a.select(*keys).distinct().withColumn("_l", F.lit(True))
    right = b.select(*keys).distinct().withColumn("_r", F.lit(True))
    both = left.join(right, list(keys), "full_outer")
    side = F.when(F.col("_r").isNull(), F.lit("left")).when(F.col("_l").isNull(), F.lit("right"))
    return both.withColumn(out, side).filter(F.col(out).isNotNull()).select(*keys, out)


def explode_list(df: DataFrame, col: str, out: str, sep: str = ",",
                 keep_empty: bool = False) -> DataFrame:
    """One row per entry of a delimited list."""
    explode = F.explode_outer if keep_empty else F.explode
    return df.withColumn(out, explode(split_list(col, sep)))


def in_scope(df: DataFrame, persons: DataFrame, units: DataFrame, person_col: str,
             unit_col: str) -> DataFrame:
    """Rows whose person is in one set or whose unit is in the other; empty sets are fine."""
    flagged = exists_flag(df, persons, {person_col: persons.columns[0]}, "_person")
    flagged = exists_flag(flagged, units, {unit_col: units.columns[0]}, "_unit")
    return flagged.filter(F.col("_person") | F.col("_unit")).drop("_person", "_unit")


def lookup_grouped(df: DataFrame, src: DataFrame, keys: Sequence[str],
                   measures: Mapping[str, Column]) -> DataFrame:
    """Correlated aggregates: group `src` once, then look the measures up."""
    grouped = src.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])
    return df.join(join_side(grouped), list(keys), "left")


def per_dimension(df: DataFrame, dimension: DataFrame, keys: Mapping[str, str],
                  take: Sequence[str]) -> DataFrame:
    """What a loop over dimension values computes, as one join on the dimension."""
    pairs = dict(keys)
    side = join_side(unique_by(dimension, list(pairs.values()), list(take)))
    side = side.select(*[F.col(r).alias(f"__{r}") for r in pairs.values()], *take)
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{r}") for k, r in pairs.items()])
    return df.join(side, on, "inner").drop(*[f"__{r}" for r in pairs.values()])


def attach_totals(df: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join per-group totals back to their rows; null groups find theirs too."""
    return join_null_safe(df, totals, list(keys))
