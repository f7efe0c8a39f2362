"""Aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numbers import percent
from tallyloom.operators.joins import attach_totals
from tallyloom.operators.windows import rank_in, top_n

# Members of one group that are joined in one step; larger groups are joined from several such slices.
PART_ROWS = 10_000
# What one value may hold: Spark's limit is 2^31 bytes, some of them taken by its own bookkeeping.
VALUE_BYTES = 2_000_000_000


def count_if_matrix(df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column],
                    id_col: str | Column) -> DataFrame:
    """Many distinct conditional counts of one id in two plain aggregates.

    First one row per (keys, id) with a flag per condition, then a count of flags: one shuffle of
    reduced rows where as many DISTINCT aggregates would copy every input row once per measure.
    """
    ident = F.col(id_col) if isinstance(id_col, str) else id_col
    per_id = df.groupBy(*keys, ident.alias("_id")).agg(
        *[F.bool_or(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()])
    counted = F.col("_id").isNotNull()
    return per_id.groupBy(*keys).agg(
        *[F.count_if(F.col(name) & counted).alias(name) for name in conditions])


def sum_if(value: Column | str, condition: Column) -> Column:
    """Conditional sum with zero where nothing qualifies."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(condition, value)), F.sum(F.lit(0)))


def bucket(col: Column | str, edges: Sequence[float], labels: Sequence[str],
           null_label: str | None = None) -> Column:
    """Label of the half-open band `[edge, next edge)`; one more label than edges."""
    if len(labels) != len(edges) + 1:
        raise ValueError("bucket needs one more label than edges")
    value = F.col(col) if isinstance(col, str) else col
    out = F.when(value.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        out = out.when(value < F.lit(edge), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def concat_group(df: DataFrame, keys: Sequence[str], col: str, order: str | None = None,
                 sep: str = ",", distinct: bool = False, out: str = "joined",
                 part_rows: int = PART_ROWS, tie: str | None = None,
                 split: bool | None = None, value_bytes: int = VALUE_BYTES) -> DataFrame:
    """Join the strings of each group in order: one row and one value per group, whatever its size.

    Slices of `part_rows` members are joined first, each by its own task, then the slices by rank; a value beyond
    `value_bytes` is an error that names its group.  Distinct values are reduced to one row before anything is joined,
    at their smallest `order`.  Otherwise `tie`, a column unique in the group, keeps equal strings apart, which lets a
    group of very many copies be cut.
    """
    keys, by = list(keys), order or col
    rows = df.filter(F.col(col).isNotNull()).select(
        *keys, F.col(col).alias("_text"), F.col(by).alias("_by"),
        (F.lit(0) if tie is None else F.col(tie)).alias("_tie"))
    if distinct:
        rows = rows.groupBy(*keys, "_text").agg(F.min("_by").alias("_by"), F.lit(0).alias("_tie"))
    ranked = rank_in(rows, keys, [F.col("_by").asc(), F.col("_text").asc(), F.col("_tie").asc()], "_rank", split)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "_text"))),
                                      lambda x: x["_text"]), sep)
    return _one_value(_sliced(ranked, keys, part_rows, joined), keys, sep, out, value_bytes)


def collect_members(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str],
                    out: str = "members", part_rows: int = PART_ROWS,
                    split: bool | None = None, value_bytes: int = VALUE_BYTES) -> DataFrame:
    """Member rows of each parent as one JSON array, in order, joined from slices like `concat_group`."""
    keys = list(keys)
    ranked = rank_in(df, keys, [F.col(c).asc() for c in order], "_rank", split)
    listed = F.array_sort(F.collect_list(F.struct("_rank", F.struct(*cols).alias("_row"))))
    array = F.to_json(F.transform(listed, lambda x: x["_row"]), {"ignoreNullFields": "false"})
    inside = array.substr(F.lit(2), F.length(array) - 2)
    merged = _one_value(_sliced(ranked, keys, part_rows, inside), keys, ",", out, value_bytes)
    return merged.withColumn(out, F.concat(F.lit("["), F.col(out), F.lit("]")))


def _sliced(ranked: DataFrame, keys: list[str], part_rows: int, value: Column) -> DataFrame:
    """One text per slice of a group: (keys, _part, _value)."""
    part = F.floor((F.col("_rank") - 1) / F.lit(part_rows)).cast("long")
    return ranked.withColumn("_part", part).groupBy(*keys, "_part").agg(value.alias("_value"))


def _one_value(slices: DataFrame, keys: list[str], sep: str, out: str, value_bytes: int) -> DataFrame:
    """The slices of each group joined in order; the rows of `rank_in` are placed by `keys`, so no shuffle is added."""
    size = F.sum(F.octet_length("_value") + F.lit(len(sep.encode())))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_part", "_value"))), lambda x: x["_value"]), sep)
    names = F.to_json(F.struct(*[F.first(k).alias(k) for k in keys]))
    message = F.concat(F.lit(f"a joined value beyond {value_bytes} bytes: "), names)
    return slices.groupBy(*keys).agg(F.when(size > value_bytes, F.raise_error(message).cast("string")).otherwise(joined).alias(out))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
             prefix: str = "") -> DataFrame:
    """Several columns of the row first in `order`, all taken from that one row."""
    return _pick(df, keys, order, cols, prefix, F.min_by)


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
            prefix: str = "") -> DataFrame:
    return _pick(df, keys, order, cols, prefix, F.max_by)


def first_and_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                   first: str = "first_", last: str = "last_") -> DataFrame:
    """`first_by` and `last_by` in one aggregate over one scan."""
    row = F.struct(*cols), F.struct(*order, *[c for c in cols if c not in order])
    return df.groupBy(*keys).agg(F.min_by(*row).alias("_first"), F.max_by(*row).alias("_last")).select(
        *keys, *[F.col(f"{side}.{c}").alias(prefix + c) for side, prefix in (("_first", first), ("_last", last)) for c in cols])


def _pick(df, keys, order, cols, prefix, picker) -> DataFrame:
    chosen = picker(F.struct(*cols), F.struct(*order, *[c for c in cols if c not in order]))
    return df.groupBy(*keys).agg(chosen.alias("_row")).select(
        *keys, *[F.col(f"_row.{c}").alias(prefix + c) for c in cols])


def argmax(df: DataFrame, keys: Sequence[str], by: str, cols: Sequence[str]) -> DataFrame:
    """The row holding the maximum of `by` (rows with a null there do not compete)."""
    return last_by(df.filter(F.col(by).isNotNull()), keys, [by], [by, *cols])


def one_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per group, chosen by a stated order."""
    return top_n(df, list(keys), order, 1)


def dedupe_keep(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Drop duplicates on `keys`; rows with a null key are all kept."""
    complete = None
    for k in keys:
        complete = F.col(k).isNotNull() if complete is None else complete & F.col(k).isNotNull()
    return top_n(df.filter(complete), list(keys), order, 1).unionByName(df.filter(~complete))


def rollup_levels(df: DataFrame, levels: Sequence[str], sums: Mapping[str, Column],
                  distinct: Mapping[str, Column] | None = None, id_col: str | None = None,
                  total: bool = True) -> DataFrame:
    """The same measures at every level of a hierarchy, in one GROUPING SETS pass.

    `levels` runs from the coarsest to the finest column.  `distinct` counts `id_col` under a
    condition.  Rows are reduced to one per (finest level, id), and those are not repeated per
    level: sums need no id, and an id present in several fine groups counts in a coarse one where
    it comes first.  An id has a row per finest group at most, so the window's groups stay small.
    `level` names the level of a row; deeper columns are null there.
    """
    distinct = dict(distinct or {})
    sets = [list(levels[: n + 1]) for n in range(len(levels))] + ([[]] if total else [])
    ids = [id_col] if distinct else []
    flags = [F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in distinct.items()]
    reduced = df.groupBy(*levels, *ids).agg(*[F.sum(v).alias(n) for n, v in sums.items()], *flags)
    depths = sorted({len(s) for s in sets}) if distinct else []
    # coarsest first: rows dealt and sorted for it serve the deeper windows too
    for depth in depths:
        once = {n: F.col(n) & F.col(id_col).isNotNull() for n in distinct}
        if depth < len(levels):
            earlier = Window.partitionBy(id_col, *levels[:depth]).orderBy(*levels[depth:]).rowsBetween(
                Window.unboundedPreceding, -1)
            once = {n: c & ~F.coalesce(F.bool_or(n).over(earlier), F.lit(False)) for n, c in once.items()}
        reduced = reduced.withColumns({f"_{depth}_{n}": c for n, c in once.items()})
    out = reduced.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in levels]).agg(
        *[F.sum(n).alias(n) for n in sums],
        *[F.count_if(f"_{depth}_{n}").alias(f"_{depth}_{n}") for depth in depths for n in distinct],
        *[F.grouping(c).alias(f"_no_{c}") for c in levels])
    depth = sum((1 - F.col(f"_no_{c}") for c in levels), F.lit(0))
    out = out.withColumns({n: F.coalesce(*[F.when(depth == d, F.col(f"_{d}_{n}")) for d in depths]) for n in distinct})
    out = out.drop(*[f"_{d}_{n}" for d in depths for n in distinct])
    label = F.lit("total")
    for c in levels:
        label = F.when(F.col(f"_no_{c}") == 0, F.lit(c)).otherwise(label)
    return out.withColumn("level", label).drop(*[f"_no_{c}" for c in levels])


def long_summary(df: DataFrame, keys: Sequence[str], blocks: Mapping[str, Column],
                 sums: Mapping[str, Column], id_col: str | None = None,
                 id_count: str = "n_ids") -> DataFrame:
    """One block of rows per dimension, tagged with `block` and its `value`.

    Rows are first reduced to one per combination of dimensions (and id); only those are
    repeated once per block.
    """
    keys = list(keys)
    named = {f"_d{n}": c for n, c in enumerate(blocks.values())}
    ids = [id_col] if id_col else []
    reduced = df.groupBy(*keys, *ids, *[c.cast("string").alias(n) for n, c in named.items()]).agg(
        *[F.sum(v).alias(n) for n, v in sums.items()])
    tagged = F.array(*[F.struct(F.lit(tag).alias("block"), F.col(n).alias("value"))
                       for tag, n in zip(blocks, named)])
    stacked = reduced.withColumn("_b", F.explode(tagged)).select(
        *keys, *ids, "_b.block", "_b.value", *sums)
    again = [F.sum(n).alias(n) for n in sums]
    by = [*keys, "block", "value"]
    if not id_col:
        return stacked.groupBy(*by).agg(*again)
    return (stacked.groupBy(*by, id_col).agg(*again)
            .groupBy(*by).agg(*again, F.count(id_col).alias(id_count)))


def rate(numerator: DataFrame, denominator: DataFrame, keys: Sequence[str], num: str, den: str,
         out: str = "rate") -> DataFrame:
    """Percentage per group of the denominator; a missing numerator counts as zero."""
    return rate_of(denominator.join(numerator, list(keys), "left"), num, den, out)


def rate_of(counts: DataFrame, num: str, den: str, out: str = "rate") -> DataFrame:
    """`rate` of two counts that one pass made side by side (`count_if_matrix`)."""
    return counts.withColumn(num, F.coalesce(F.col(num), F.lit(0))).withColumn(out, percent(num, den))


def merge_avg(avg_a: Column, n_a: Column, avg_b: Column, n_b: Column, places: int = 1) -> Column:
    """Average of two averages weighted by their counts."""
    total = F.coalesce(avg_a * n_a, F.lit(0)) + F.coalesce(avg_b * n_b, F.lit(0))
    return F.round(F.try_divide(total, F.coalesce(n_a, F.lit(0)) + F.coalesce(n_b, F.lit(0))), places)


def split_evenly(df: DataFrame, group: Sequence[str], member: str,
                 cols: Mapping[str, int]) -> DataFrame:
    """Share each column among the distinct members of its group, at the given places."""
    members = df.groupBy(*group).agg(F.count_distinct(member).alias("n_members"))
    joined = attach_totals(df, members, list(group))
    return joined.withColumns({c: F.round(F.try_divide(F.col(c), F.col("n_members")), places)
                               for c, places in cols.items()})


def max_ts_by_hour(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Latest event time of every (day, hour)."""
    return events.groupBy(F.date_format(ts, "yyyy-MM-dd").alias("day"),
                          F.date_format(ts, "HH").alias("hr")).agg(F.max(ts).alias("max_ts"))


def recent_hours(ledger: DataFrame, n: int = 2) -> DataFrame:
    """Row counts of the newest `n` recorded hours."""
    return (ledger.groupBy("day", "hr").agg(F.count("*").alias("n_files"))
            .orderBy(F.desc("day"), F.desc("hr")).limit(n))


def pending_counts(modules: Mapping[str, tuple[DataFrame, str, str]], status: object) -> DataFrame:
    """Per module, the groups with any member in `status`; values are (frame, group, status)."""
    frames = []
    for name, (frame, group, status_col) in modules.items():
        hit = frame.groupBy(group).agg(F.bool_or(F.col(status_col) == F.lit(status)).alias("_hit"))
        frames.append(hit.agg(F.count_if("_hit").alias("n_pending"))
                      .select(F.lit(name).alias("module"), "n_pending"))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def combine_measures(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Add up measures of several sources on shared keys; absent measures count as zero."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    measures = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(
        *[F.sum(F.coalesce(F.col(m), F.lit(0))).alias(m) for m in measures])


def top_status(df: DataFrame, keys: Sequence[str], status: str, ranks: Mapping[str, int],
               other: int = 0, out: str = "top_status") -> DataFrame:
    """The status of highest rank per group; unranked statuses share the rank `other`."""
    weight = F.lit(other)
    for value, n in ranks.items():
        weight = F.when(F.col(status) == F.lit(value), F.lit(n)).otherwise(weight)
    return df.groupBy(*keys).agg(F.max_by(status, F.struct(weight, F.col(status))).alias(out))


def distribution(df: DataFrame, keys: Sequence[str], band: Column, measures: Mapping[str, Column],
                 id_col: str, out: str = "band") -> DataFrame:
    """Distinct members per unit and band under several conditions."""
    return count_if_matrix(df.withColumn(out, band), [*keys, out], measures, id_col)
