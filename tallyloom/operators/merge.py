"""Snapshot merges, change logs and update policies.

A merge returns the next version of the target as a frame; `sources.tables` publishes it beside
the old one, so nothing is overwritten while it is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.records import json_image
from tallyloom.functions.text import changed, is_blank
from tallyloom.operators.joins import keep_missing
from tallyloom.operators.windows import top_n
from tallyloom.scale import join_side


def _on(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])


def unique_on(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """`df`, whose action fails if a key without nulls occurs twice: it would double rows on the other side.

    The rows are numbered per key in the partitions that the join on `keys` needs anyway.
    """
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    message = F.concat(F.lit(f"{what} holds a key twice: "), F.to_json(F.struct(*keys)))
    checked = df.withColumn("_place", F.when(keyed, place).otherwise(1))
    sound = F.when(F.col("_place") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return checked.filter(sound).drop("_place")


def merge_snapshot(target: DataFrame, snap: DataFrame, keys: Sequence[str],
                   update_cols: Sequence[str] | None = None, delete: str = "remove",
                   scope: Column | None = None, flag: str | None = None,
                   deleted_value: str = "Y", live_value: str = "N",
                   null_keys: bool = True) -> DataFrame:
    """The target after a snapshot: matched rows updated, new rows added, missing rows deleted.

    Columns outside `update_cols` keep the target's values.  `delete` is `remove`, `flag` (set
    `flag` to `deleted_value`; a key that returns becomes live again) or `keep`.  `scope` limits
    deletion to target rows that meet it.  A key twice in the snapshot is an error (`unique_on`).  Rows with a null
    key match nothing: the target's stay, the snapshot's are added.  They go round the join, where
    they would all meet in one task; `null_keys=False` says there are none and saves that pass.
    """
    if delete not in ("remove", "flag", "keep"):
        raise ValueError(f"unknown delete mode {delete!r}")
    cols = [c for c in target.columns if c not in keys and c != flag]
    updates = [c for c in (cols if update_cols is None else update_cols) if c in snap.columns]
    in_scope = F.lit(True) if scope is None else F.coalesce(scope, F.lit(False))
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    t = target.filter(keyed).withColumns({"_in_t": F.lit(True), "_scoped": in_scope}).alias("t")
    s = unique_on(snap.filter(keyed), keys, "the snapshot").withColumn("_in_s", F.lit(True)).alias("s")
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()
    missing = in_t & ~in_s & F.col("t._scoped")
    out = {k: F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")) for k in keys}
    for c in cols:
        if c in updates:
            out[c] = F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        elif c in snap.columns:
            out[c] = F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        else:
            out[c] = F.col(f"t.{c}")
    if flag:
        gone = F.lit(deleted_value) if delete == "flag" else F.col(f"t.{flag}")
        out[flag] = (F.when(missing, gone).when(in_s, F.lit(live_value))
                     .otherwise(F.col(f"t.{flag}")))
    both = t.join(s, _on(keys), "full_outer")
    if delete == "remove":
        both = both.filter(~F.coalesce(missing, F.lit(False)))
    merged = both.select(*[out[c].alias(c) for c in target.columns])
    if not null_keys:
        return merged
    added = snap.filter(~keyed)
    if flag:
        added = added.withColumn(flag, F.lit(live_value))
    blank = {c: F.lit(None).cast(target.schema[c].dataType) for c in target.columns if c not in added.columns}
    return (merged.unionByName(target.filter(~keyed))
            .unionByName(added.withColumns(blank).select(*target.columns)))


def upsert(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with matched rows replaced and new rows added; nothing is deleted."""
    return merge_snapshot(target, rows, keys, delete="keep")


def change_log(old: DataFrame, new: DataFrame, keys: Sequence[str], labels: Mapping[str, str],
               out: str = "change_text") -> DataFrame:
    """One text per changed key, `label:old-->new;` for every changed column."""
    pair = _side_by_side(old, new, keys, list(labels))
    return pair.filter(any_changed(labels)).select(*keys, change_text(labels).alias(out))


def any_changed(cols: Iterable[str]) -> Column:
    """Whether any of the columns `old_<c>` and `new_<c>` differ."""
    return reduce(lambda a, b: a | b, [changed(f"old_{c}", f"new_{c}") for c in cols])


def change_text(labels: Mapping[str, str]) -> Column:
    """The text for columns `old_<c>` and `new_<c>`."""
    fragments, blank = [], F.lit("")
    for c, label in labels.items():
        fragments.append(F.when(changed(f"old_{c}", f"new_{c}"), F.concat(
            F.lit(label + ":"), F.coalesce(F.col(f"old_{c}").cast("string"), blank), F.lit("-->"),
            F.coalesce(F.col(f"new_{c}").cast("string"), blank), F.lit(";"))))
    return F.concat_ws("", *fragments)


def _side_by_side(old, new, keys, cols) -> DataFrame:
    left = unique_on(old, keys, "the old state").select(*keys, *[F.col(c).alias(f"old_{c}") for c in cols])
    right = unique_on(new, keys, "the new state").select(*keys, *[F.col(c).alias(f"new_{c}") for c in cols])
    return left.join(right, list(keys), "inner")


def audit_images(old: DataFrame, new: DataFrame, keys: Sequence[str], labels: Mapping[str, str],
                 cols: Sequence[str], members: DataFrame | None = None) -> DataFrame:
    """Change text with JSON images of the row before and after.

    `members` (keys, `members`, see `collect_members`) adds the JSON array of member rows to both images.
    """
    left = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in labels],
                      json_image(*keys, *cols).alias("image_before"))
    right = new.select(*keys, *[F.col(c).alias(f"new_{c}") for c in labels],
                       json_image(*keys, *cols).alias("image_after"))
    logged = left.join(right, list(keys), "inner").filter(any_changed(labels)).select(
        *keys, change_text(labels).alias("change_text"), "image_before", "image_after")
    if members is None:
        return logged
    with_members = logged.join(members, list(keys), "left")
    tail = F.concat(F.lit(',"members":'), F.coalesce(F.col("members"), F.lit("[]")), F.lit("}"))
    for image in ("image_before", "image_after"):
        body = F.expr(f"substring({image}, 1, length({image}) - 1)")
        with_members = with_members.withColumn(image, F.concat(body, tail))
    return with_members.drop("members")


@dataclass
class Feed:
    """`rows` are the new and changed rows to send and back up, `next_before` the state to keep."""

    rows: DataFrame
    next_before: DataFrame


def diff_feed(now: DataFrame, before: DataFrame, keys: Sequence[str], watch: Sequence[str]) -> Feed:
    """Rows of the snapshot that are new or differ in a watched column, marked `change`."""
    prior = before.select(*[F.col(k).alias(f"__{k}") for k in keys],
                          *[F.col(c).alias(f"__old_{c}") for c in watch], F.lit(True).alias("_had"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in keys])
    joined = now.join(prior, on, "left")
    differs = reduce(lambda a, b: a | b, [changed(c, f"__old_{c}") for c in watch])
    change = F.when(F.col("_had").isNull(), "new").when(differs, "changed")
    rows = joined.withColumn("change", change).filter(F.col("change").isNotNull())
    return Feed(rows.select(*now.columns, "change"), now)


def sync_parent_child(src: DataFrame, parents: DataFrame, members: DataFrame, parent_key: str,
                      member_keys: Sequence[str]) -> DataFrame:
    """What each source member row needs: `update`, `add_member` or `add_both`."""
    known = join_side(parents.select(F.col(parent_key).alias("_known_p")).distinct()).withColumn("_has_p", F.lit(True))
    exact = join_side(members.select(*[F.col(k).alias(f"__{k}") for k in member_keys]).distinct())
    exact = exact.withColumn("_has_m", F.lit(True))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in member_keys])
    joined = src.join(known, F.col(parent_key) == F.col("_known_p"), "left").join(exact, on, "left")
    action = (F.when(F.col("_has_p").isNull(), "add_both")
              .when(F.col("_has_m").isNull(), "add_member").otherwise("update"))
    return joined.withColumn("action", action).select(*src.columns, "action")


@dataclass(frozen=True)
class Policy:
    """How one column of a target row in a given state takes a source value.

    `always` overwrites, `fill` overwrites blanks only, `keep` leaves the target alone.
    """

    modes: Mapping[str, str]
    next_state: str | None = None


@dataclass
class PolicyResult:
    rows: DataFrame
    log: DataFrame


def policy_update(target: DataFrame, src: DataFrame, keys: Sequence[str], state: str,
                  policies: Mapping[str, Policy], labels: Mapping[str, str],
                  weak: str | None = None) -> PolicyResult:
    """Update by record state and match quality; the log comes from the same expressions.

    Rows whose state has no policy are left alone (deleted rows, say).  `weak` names a boolean
    source column: such rows are updated but keep their state.  A key twice in `src` is an error.
    """
    cols = list(labels)
    side = unique_on(src, keys, "the source").select(*[F.col(k).alias(f"__{k}") for k in keys],
                      *[F.col(c).alias(f"src_{c}") for c in cols],
                      (F.col(weak) if weak else F.lit(False)).alias("_weak"),
                      F.lit(True).alias("_hit"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in keys])
    joined = target.join(side, on, "left")
    hit = F.col("_hit").isNotNull()
    new_values = {}
    for c in cols:
        value = F.col(c)
        for name, policy in policies.items():
            mode = policy.modes.get(c, "keep")
            in_state = hit & (F.col(state) == F.lit(name))
            if mode == "always":
                value = F.when(in_state, F.col(f"src_{c}")).otherwise(value)
            elif mode == "fill":
                value = F.when(in_state & is_blank(c), F.col(f"src_{c}")).otherwise(value)
        new_values[f"new_{c}"] = value
    next_state = F.col(state)
    for name, policy in policies.items():
        if policy.next_state is not None:
            moves = hit & (F.col(state) == F.lit(name)) & ~F.coalesce("_weak", F.lit(False))
            next_state = F.when(moves, F.lit(policy.next_state)).otherwise(next_state)
    applied = joined.withColumns(new_values).withColumn("_state", next_state)
    renamed = {c: F.col(f"new_{c}") for c in cols} | {state: F.col("_state")}
    rows = applied.select(*[renamed.get(c, F.col(c)).alias(c) for c in target.columns])
    log = (applied.withColumns({f"old_{c}": F.col(c) for c in cols})
           .filter(hit & any_changed(labels))
           .select(*keys, change_text(labels).alias("change_text")))
    return PolicyResult(rows, log)


def overlay(base: DataFrame, imports: DataFrame, keys: Sequence[str], deleted: Column) -> DataFrame:
    """Add live manual imports that the base lacks and drop the rows they tombstone."""
    gone = F.coalesce(deleted, F.lit(False))
    tombstones, alive = imports.filter(gone), imports.filter(~gone)
    kept = keep_missing(base, tombstones, list(keys))
    added = keep_missing(alive, base, list(keys)).select(*base.columns)
    return kept.unionByName(added)


def dedupe_log(log: DataFrame, keys: Sequence[str], day: Column, order: Sequence[Column]) -> DataFrame:
    """One log row per key and day."""
    return top_n(log.withColumn("_day", day), [*keys, "_day"], order, 1).drop("_day")
