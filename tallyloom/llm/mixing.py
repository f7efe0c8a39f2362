"""Mixing sources to target weights: each source gives exactly its share of the words, repeating if it must.

Documents get hash-random keys and are range-sorted within their source; distributed prefix sums of
the sizes then tell, for every document by itself, how many whole copies the mix takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import each_copy, equal_keys, free_prefix, prefix_sums, slices_for, uniform_key, word_count
from tallyloom.scale import written


def cycled_weights(sources: DataFrame, source: str, cycle: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """Weights for `sources` (a row per source) in code point order, null last, taken from `cycle` in turn."""
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return sources.withColumn("weight", F.get(weights, (place % len(cycle)).cast("int")))


def source_targets(weighted: DataFrame, source: str, max_epochs: float = 3.0) -> DataFrame:
    """Adds `target`: the share of all words by weight, capped at `max_epochs` times the source's words.

    What the caps leave over is shared again by weight until no source is above its cap.  The end of that
    process is known without repeating it: in order of cap over weight, sources are capped as long as the
    remaining words per remaining weight exceed that ratio.  One row per source passes the window.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    ratio = cap / F.col("weight")
    w = Window.orderBy("_ratio", F.col(source).asc_nulls_last())
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stepped = (
        weighted.withColumn("_cap", cap).withColumn("_ratio", ratio)
        .withColumn("_words", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_weights", F.sum("weight").over(everything))
        .withColumn("_caps_before", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_weights_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("_level", (F.col("_words") - F.col("_caps_before")) / (F.col("_weights") - F.col("_weights_before")))
        .withColumn("_open", F.col("_ratio") >= F.col("_level"))
    )
    # the first source whose cap is not reached fixes the level for all that follow it
    level = F.min(F.when(F.col("_open"), F.struct("_ratio", "_level"))).over(everything)["_level"]
    return stepped.withColumn("target", F.least(F.col("_cap"), F.col("weight") * F.coalesce(level, F.lit(float("inf"))))) \
        .select(source, "source_size", "weight", "target")


ALIKE = ["doc_id", "source", "size", "key"]


def _unit(ident: str, source: str, text: str, seed: int) -> dict[str, Column]:
    key = uniform_key(seed, ident, F.md5(F.coalesce(F.col(text), F.lit(""))))
    return {"doc_id": F.col(ident), "source": F.col(source), "size": word_count(text).cast("long"), "key": key}


def mix(docs: DataFrame, source: str = "source", text: str = "text", ident: str = "doc_id",
        cycle: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: float = 3.0, seed: int = 17) -> DataFrame:
    """A row per distinct (doc_id, source, size, key) and `copies`: how many rows are alike (`n_alike`), and `copies` of each.

    `copies` is how often the mix takes the whole document: the full epochs of its source, plus one if its
    middle lies before the cut in the last, partial epoch.  A source so comes within half a document of its
    target, and no document is taken more than `max_epochs` times (rounded up).

    Null texts count as empty (size 0); a null source is a source of its own, placed last.  Rows alike in
    id, source and text lie next to each other; where the cut falls among them, some get one copy more than the others.  A source without words
    has target 0 and its documents are not taken.  An empty table gives an empty result.  Other columns
    of `docs` are not read.
    """
    dealt = _dealt(docs, source, text, ident, cycle, max_epochs, seed)
    shares = F.array(F.struct(F.col("extra").alias("n_alike"), (F.col("epochs") + 1).alias("copies")),
                     F.struct((F.col("n_alike") - F.col("extra")).alias("n_alike"), F.col("epochs").alias("copies")))
    return dealt.withColumn("share", F.explode(F.filter(shares, lambda x: x["n_alike"] > 0))) \
        .select(*ALIKE, "share.n_alike", "source_size", "target", "share.copies")


def _dealt(docs: DataFrame, source: str, text: str, ident: str, cycle: tuple[float, ...], max_epochs: float, seed: int) -> DataFrame:
    """A row per unit of rows alike: each is taken `epochs` times, `extra` of the `n_alike` once more; see `mix`."""
    # the texts are read once; all that follows works on these few bytes a row
    narrow = written(docs.select(*[e.alias(c) for c, e in _unit(ident, source, text, seed).items()]).groupBy(*ALIKE).agg(F.count("*").alias("n_alike"))
                     .withColumn("words", F.col("size") * F.col("n_alike")))
    totals = narrow.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(cycled_weights(totals, "source", cycle), "source", max_epochs)
    placed = prefix_sums(narrow, ["source"], "key", ["doc_id", "size"], {"before": "words"}, slices_for(narrow.count()))
    sides = targets.select(F.col("source").alias("source_at"), "source_size", "target")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - epochs * F.col("source_size")
    # rows of the unit whose middle lies before the cut
    fitting = F.when(F.col("size") > 0, F.ceil((rest - F.col("before")) / F.col("size") - 0.5)).otherwise(F.when(F.col("before") < rest, F.col("n_alike")).otherwise(0))
    extra = F.coalesce(F.greatest(F.lit(0), F.least(F.col("n_alike"), fitting)), F.lit(0)).cast("long")
    return placed.join(sides, F.col("source").eqNullSafe(F.col("source_at")), "left") \
        .select(*ALIKE, "n_alike", "source_size", "target", epochs.cast("long").alias("epochs"), extra.alias("extra"))


def mix_rows(docs: DataFrame, **options) -> DataFrame:
    """One row per document: (doc_id, source, size, source_size, target, copies, taken); see `mix`."""
    return each_copy(mix(docs, **options), "n_alike", "nth") \
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, source: str = "source", text: str = "text", ident: str = "doc_id",
                    cycle: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: float = 3.0, seed: int = 17) -> DataFrame:
    """The documents of the mix, all their columns unchanged, each as often as the mix takes it.

    A document without words is kept once: it costs its source nothing.
    """
    o, m = free_prefix(docs, "own"), free_prefix(docs, "mix")
    own, mixed = [f"{o}{c}" for c in ALIKE], [f"{m}{c}" for c in ALIKE]
    split = (F.col("extra") > 0) & (F.col("extra") < F.col("n_alike"))
    plan = written(_dealt(docs, source, text, ident, cycle, max_epochs, seed).select(
        *[F.col(c).alias(f"{m}{c}") for c in ALIKE],
        (F.col("epochs") + (F.col("extra") == F.col("n_alike")).cast("long")).alias(f"{m}copies"), F.when(split, F.col("extra")).otherwise(0).alias(f"{m}extra")))
    keyed = docs.withColumns({f"{o}{c}": e for c, e in _unit(ident, source, text, seed).items()})
    placed = keyed.join(plan, equal_keys(own, mixed), "left")
    halved = plan.where(F.col(f"{m}extra") > 0)
    if not halved.isEmpty():  # at most one unit a source: the rows are numbered where they lie, and the first get the copy more
        rows = written(keyed.join(halved, equal_keys(own, mixed)).withColumn(f"{m}part", F.spark_partition_id()))
        counts = rows.groupBy(*mixed, f"{m}part").agg(F.count("*").alias(f"{m}rows"))
        earlier = Window.partitionBy(*mixed).orderBy(f"{m}part").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select(*[F.col(c).alias(f"{c}_at") for c in [*mixed, f"{m}part"]], F.coalesce(F.sum(f"{m}rows").over(earlier), F.lit(0)).alias(f"{m}before"))
        number = F.row_number().over(Window.partitionBy(*mixed, f"{m}part").orderBy(F.lit(0)))
        numbered = rows.withColumn(f"{m}number", number).join(starts, equal_keys([*mixed, f"{m}part"], [f"{c}_at" for c in [*mixed, f"{m}part"]]))
        more = (F.col(f"{m}before") + F.col(f"{m}number") <= F.col(f"{m}extra")).cast("long")
        placed = placed.where(F.col(f"{m}extra") == 0).unionByName(numbered.withColumn(f"{m}copies", F.col(f"{m}copies") + more).select(*placed.columns))
    times = F.when(F.col(f"{o}size") == 0, F.lit(1)).otherwise(F.col(f"{m}copies")).cast("int")
    return placed.withColumn(f"{m}times", times).where(F.col(f"{m}times") > 0) \
        .withColumn(f"{m}nth", F.explode(F.sequence(F.lit(1), F.col(f"{m}times")))).select(*docs.columns)
