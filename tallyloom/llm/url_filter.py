"""URL filters: fixed rules by host and path, and a path-template tree judged by labelled purity.

Paths are generalised into templates: digits become a wildcard, and so do the segments of a place in the tree that the
labels do not tell from each other, however many or few they are.  Branches whose labelled share of bad pages does not
differ from that of the rest of their parent are merged into it.  Templates whose smoothed purity is low are blocked.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import equal_keys
from tallyloom.scale import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# (verdict, host and path); a rule fits its host and all subdomains if the path starts with the rule's
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def url_parts(url: str | Column) -> tuple[Column, Column]:
    """(host, path): both empty for null and for text without ://."""
    col = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    rest = F.when(F.instr(col, "://") > 0, F.substring(col, F.instr(col, "://") + 3, F.length(col))).otherwise(F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def path_shape(path: Column) -> Column:
    """All segments of the path, with `*` for each run of digits."""
    segments = F.split(path, "/")  # the first is empty: paths begin with a slash
    named = F.transform(F.slice(segments, 2, F.size(segments)), lambda s: F.regexp_replace(s, "[0-9]+", "*"))
    return F.when(path == "", F.array().cast("array<string>")).otherwise(named)


def templates(shapes: DataFrame, z_limit: float = 1.96, strength: float = 10.0) -> DataFrame:
    """(host, shape, template, labelled, purity) from `shapes` (host, shape, pages, labelled, bad).

    `shapes` has a row per host and path shape.  Where a place in the tree has several segments, those become one
    wildcard that a two-proportion test does not tell from their siblings, neither themselves nor by a branch below; the
    others stay.  The wildcard is `*`, or `?` where the digits' `*` stays beside it; a segment without siblings keeps its
    name.  `purity` is the share of good pages in the branch a template belongs to after merging, smoothed with
    `strength` pages at its host's rate, which is itself smoothed with as many at the rate of all labelled pages: so few
    labels alone block nothing.

    The tree is walked to the full depth of the paths, a round per fork on the way: what all shapes of a node share
    is passed over at once, however long.
    """
    rows = written(shapes.select("host", "shape", "labelled", "bad"))
    all_rows = rows.agg(F.coalesce((F.sum("labelled") - F.sum("bad")) / F.nullif(F.sum("labelled"), F.lit(0)), F.lit(1.0)))
    # first without wildcards, for the depth down to which labels tell a shape's branches apart
    ended = _leaves(_leaves(rows.withColumn("told", F.lit(0)), False, z_limit), True, z_limit)
    ended = ended.withColumn("template", F.concat_ws("/", F.lit(""), F.col("named"), _rest(F.col("shape"), F.size("named"))))
    # the last level: paths that differ in a slash at their end only
    last = written(ended.groupBy("host", "node", "template").agg(F.sum("labelled").alias("leaf_n"), F.sum("bad").alias("leaf_b")))
    judged = _beside(ended, last, ["host", "node", "template"])
    apart = _differs(F.col("leaf_b"), F.col("leaf_n"), F.col("node_b") - F.col("leaf_b"), F.col("node_n") - F.col("leaf_n"), z_limit)
    n, b = F.when(apart, F.col("leaf_n")).otherwise(F.col("n")), F.when(apart, F.col("leaf_b")).otherwise(F.col("b"))
    host_rate = (F.col("host_n") - F.col("host_b") + strength * all_rows.scalar()) / (F.col("host_n") + strength)
    return judged.select("host", "shape", "template", "labelled", ((n - b + strength * host_rate) / (n + strength)).alias("purity"))


def _rest(shape: Column, start: int | Column) -> Column:
    """The segments of a shape from place `start` on."""
    return F.slice(shape, start + 1, F.greatest(F.size(shape), F.lit(1)))


def _beside(rows: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on `keys`, null equal to null, that keeps one copy of them."""
    renamed = side.withColumnsRenamed({k: f"{k}_at" for k in keys})
    return rows.join(renamed, equal_keys(keys, [f"{k}_at" for k in keys])).drop(*[f"{k}_at" for k in keys])


def _leaves(rows: DataFrame, merge: bool, z_limit: float) -> DataFrame:
    """`rows` (host, shape, labelled, bad, told) at the end of their walk down the tree of their host.

    Adds `node`, where the walk ended: below it all shapes are the same; `named`, the segments up to it, with wildcards if `merge`;
    the labels of the node, of the host and (`n`, `b`) of the deepest branch on the way that differs from the rest of its parent.
    `told` becomes the number of segments of the deepest branch that differs.

    Aggregates are written before they meet the rows they are made of, so that a host or a node with a third of all
    shapes is split like any skewed join.
    """
    rows = rows.select("host", "shape", "labelled", "bad", "told")
    hosts = written(rows.groupBy("host").agg(F.sum("labelled").alias("host_n"), F.sum("bad").alias("host_b"),
                                             F.min("shape").alias("low"), F.max("shape").alias("high")))
    at = _beside(rows, hosts.withColumn("depth", _shared("low", "high")).drop("low", "high"), ["host"]).withColumns({
        "named": F.slice("shape", F.lit(1), F.col("depth")), "node": F.lit(""),
        "node_n": F.col("host_n"), "node_b": F.col("host_b"), "n": F.col("host_n"), "b": F.col("host_b")})
    kept, ended = at.columns, []
    # hosts of one shape end where they begin
    at = written(at)
    while True:
        at = at.withColumns({"segment": F.get("shape", F.col("depth")), "below": _rest(F.col("shape"), F.col("depth") + 1)})
        children = written(at.groupBy("host", "node", "segment").agg(
            F.sum("labelled").alias("child_n"), F.sum("bad").alias("child_b"), F.min("below").alias("low"), F.max("below").alias("high"),
            F.max("told").alias("deepest"), F.first("depth").alias("from"), F.first("node_n").alias("all_n"), F.first("node_b").alias("all_b")))
        own = (F.col("deepest") > F.col("from") + 1) | _differs(
            F.col("child_b"), F.col("child_n"), F.col("all_b") - F.col("child_b"), F.col("all_n") - F.col("child_n"), z_limit)
        children = children.withColumn("own", own)
        fans = written(children.groupBy("host", "node").agg(F.count("segment").alias("children"), F.max(F.col("own") & F.col("segment").eqNullSafe("*")).alias("digits")))
        wild = F.lit(merge) & (F.col("children") > 1) & F.col("segment").isNotNull() & ~F.col("own")
        name = F.when(wild, F.when(F.col("digits"), F.lit("?")).otherwise(F.lit("*"))).otherwise(F.coalesce("segment", F.lit("")))
        children = _beside(children, fans, ["host", "node"]).withColumn("name", name)
        branches = written(children.groupBy("host", "node", "name").agg(
            F.sum("child_n").alias("branch_n"), F.sum("child_b").alias("branch_b"), F.min("low").alias("low"), F.max("high").alias("high")))
        placed = _beside(children.select("host", "node", "segment", "name"), branches, ["host", "node", "name"]) \
            .withColumns({"shared": _shared("low", "high"), "same": F.col("low") == F.col("high")}).drop("low", "high")
        apart = _differs(F.col("branch_b"), F.col("branch_n"), F.col("node_b") - F.col("branch_b"), F.col("node_n") - F.col("branch_n"), z_limit)
        passed = F.slice("below", F.lit(1), F.col("shared"))
        inside = F.when(F.col("segment").isNotNull(), F.concat("named", F.array("name"), passed)).otherwise(F.col("named"))
        stepped = _beside(at, written(placed), ["host", "node", "segment"]).withColumns({
            "n": F.when(apart, F.col("branch_n")).otherwise(F.col("n")), "b": F.when(apart, F.col("branch_b")).otherwise(F.col("b")),
            "told": F.when(apart, F.greatest("told", F.col("depth") + 1)).otherwise(F.col("told")),
            "node": F.concat_ws("/", "node", "name", F.when(F.col("shared") > 0, F.array_join(passed, "/"))),
            "node_n": F.col("branch_n"), "node_b": F.col("branch_b"), "named": inside,
            "depth": F.col("depth") + 1 + F.col("shared")})
        moved = written(stepped.select(*kept, "same"))
        ended.append(moved.where("same").drop("same"))
        at = moved.where("NOT same").drop("same")
        if at.isEmpty():
            return reduce(DataFrame.unionAll, ended)


def _shared(low: str, high: str) -> Column:
    """Segments that the least and the greatest of some paths share at their head: those that all share."""
    at = F.array_position(F.zip_with(low, high, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(at == 0, F.size(high)).otherwise(at - 1).cast("int")


def _differs(bad: Column, n: Column, bad_rest: Column, n_rest: Column, limit: float) -> Column:
    """Whether two shares differ: a pooled two-proportion test; no, where either side has no labels."""
    both = n * n_rest > 0
    pooled = (bad + bad_rest) / F.greatest(n + n_rest, F.lit(1))
    spread = pooled * (1 - pooled) * (1 / F.greatest(n, F.lit(1)) + 1 / F.greatest(n_rest, F.lit(1)))
    gap = bad / F.greatest(n, F.lit(1)) - bad_rest / F.greatest(n_rest, F.lit(1))
    return both & (gap * gap > limit * limit * spread) & (spread > 0)


def filter_urls(pages: DataFrame, page_labels: DataFrame, page_id: str = "page_id", url: str = "url",
                rules: Sequence[tuple[str, str]] = RULES, min_purity: float = 0.5) -> DataFrame:
    """One row per page: (page_id, host, path, rule, template, verdict).

    `page_labels` has (label, bad): `label` is what `page_label` makes of a path, `bad` 1 or 0, one row each.
    Pages that a rule fits get the rule's verdict; others are blocked if their template's purity is below
    `min_purity`.  Only the url column is read.  Null urls and text without :// have an empty host and
    path, an empty template, and are judged like any host.  Repeated rows each get their row; an empty
    table gives no rows; without labels everything that no rule blocks is allowed.
    """
    host, path = url_parts(url)
    parsed = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path")) \
        .withColumn("shape", path_shape(F.col("path"))).withColumn("label", page_label(F.col("path")))
    known = page_labels.select(F.col("label").alias("known_label"), "bad")
    labelled = parsed.select("host", "shape", "label").join(known, F.col("label") == F.col("known_label"), "left") \
        .groupBy("host", "shape").agg(F.count("*").alias("pages"), F.count("bad").alias("labelled"),
                                      F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    found = templates(labelled).select(F.col("host").alias("host_at"), F.col("shape").alias("shape_at"), "template", "purity")
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    by_tree = F.when(F.col("purity") < min_purity, F.lit("block")).otherwise(F.lit("allow"))
    return parsed.join(found, (F.col("host") == F.col("host_at")) & (F.col("shape") == F.col("shape_at")), "left") \
        .select("page_id", "host", "path", rule.alias("rule"), "template", F.coalesce(verdict, by_tree).alias("verdict"))


def page_label(path: Column) -> Column:
    """The number at the start of the last segment that is not empty: the document a page shows."""
    return F.regexp_extract(path, r"/([0-9]{1,18})[^/]*/?\z", 1).try_cast("long")


def document_labels(labels: DataFrame, ident: str = "doc_id") -> DataFrame:
    """(label, bad) from document labels: bad if of low quality or toxic; a document labelled twice is bad if either says so."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.where(F.col(ident).isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    return known.groupBy(F.col(ident).alias("label")).agg(F.max(bad.cast("int")).alias("bad"))
