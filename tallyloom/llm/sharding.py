"""Sharding: a uniform shuffle into shards whose sizes are exact.

Rows are dealt by hash into parts.  For each part the number of rows it sends to each shard is drawn
from the hypergeometric law of dealing without replacement, given what the shards have left; so the
shards fill up exactly, as they would if the whole table were permuted at once.  Rows are permuted in
their part, sent, and permuted again in their shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import KEY_BITS, each_copy, prefix_sums, slices_for, uniform_key
from tallyloom.scale import written


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes at most one apart."""
    return np.array([rows // shards + (s < rows % shards) for s in range(shards)], dtype=np.int64)


def communication_matrix(part_rows: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """Rows each part sends to each shard; line sums are `part_rows`, column sums `sizes`."""
    left = sizes.copy()
    out = np.zeros((len(part_rows), len(sizes)), dtype=np.int64)
    draw = np.random.default_rng(seed)
    for p, n in enumerate(part_rows):
        # shard by shard: of the rows the shards still want, how many of this part's go to shard s
        need, rest = int(n), int(left.sum())
        for s in range(len(sizes)):
            want = int(left[s])
            other = rest - want
            got = need if other == 0 else _hypergeometric(draw, want, other, need)
            out[p, s] = got
            need -= got
            rest = other
        left -= out[p]
    return out


ONE_BY_ONE = 64


def _hypergeometric(draw: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn from an urn, exactly, at any size.

    Beyond the generator's limit every ball is drawn with probability n over all, which is two binomial draws; that leaves
    about the square root of n too many or too few, and those are put back or drawn in the same way.
    """
    every = good + bad
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    if every < 1_000_000_000:  # the generator's own limit
        return int(draw.hypergeometric(good, bad, n))
    if n > every // 2:
        return good - _hypergeometric(draw, good, bad, every - n)
    if n <= ONE_BY_ONE:
        found = 0
        for k in range(n):
            found += int(draw.integers(every - k)) < good - found
        return found
    x, y = int(draw.binomial(good, n / every)), int(draw.binomial(bad, n / every))
    if x + y <= n:
        return x + _hypergeometric(draw, good - x, bad - y, n - x - y)
    return x - _hypergeometric(draw, x, y, x + y - n)


def shard_rows(docs: DataFrame, shards: int = 16, ident: str = "doc_id", text: str = "text", seed: int = 29) -> DataFrame:
    """One row per document: (doc_id, size, text_crc32, shard, slot).

    `size` is the text's UTF-8 bytes plus one, `slot` the place in the shard, gapless from 0.  Parts and keys
    come from hashes of id and text: a rerun deals alike.  Null texts count as empty, a null id is a
    value like any other, an empty table gives no rows.  Rows alike in id and text are counted before they move and
    numbered, so that each has keys of its own and however many there are, they are dealt over all parts.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    alike = docs.select(F.col(ident).cast("long").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                        F.crc32(body).cast("long").alias("text_crc32")).groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n_alike"))
    narrow = written(each_copy(alike, "n_alike", "nth").drop("n_alike"))
    rows = narrow.count()
    parts = slices_for(rows)
    keyed = narrow.withColumn("part_key", uniform_key(seed, "doc_id", "text_crc32", "nth")) \
        .withColumn("part", F.shiftright(F.shiftright("part_key", KEY_BITS - 30) * F.lit(parts), 30)) \
        .withColumn("order_key", uniform_key(seed + 1, "doc_id", "text_crc32", "size", "nth"))
    counts = np.zeros(parts, dtype=np.int64)  # the square root of the rows, not the rows
    for r in keyed.groupBy("part").count().collect():
        counts[r["part"]] = r["count"]
    ends = communication_matrix(counts, shard_sizes(rows, shards), seed).cumsum(axis=1)
    spark = docs.sparkSession
    cuts = spark.createDataFrame([(p, [int(e) for e in line]) for p, line in enumerate(ends)],
                                 "part_at long, ends array<long>")
    place = F.row_number().over(Window.partitionBy("part").orderBy("order_key", "doc_id", "text_crc32", "size", "nth")) - 1
    sent = keyed.withColumn("place", place).join(cuts, F.col("part") == F.col("part_at")) \
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("place")))) \
        .withColumn("slot_key", uniform_key(seed + 2, "doc_id", "text_crc32", "nth")) \
        .withColumn("one", F.lit(1).cast("long")) \
        .select("doc_id", "size", "text_crc32", "nth", "shard", "slot_key", "one")
    placed = prefix_sums(sent, ["shard"], "slot_key", ["doc_id", "text_crc32", "size", "nth"], {"slot": "one"},
                         slices_for(max(1, rows // shards)))
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot")
