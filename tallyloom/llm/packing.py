"""Packing into length buckets with the least padding, and batches of a token budget inside each bucket."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import each_copy, prefix_sums, slices_for, uniform_key, word_count
from tallyloom.scale import written


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets such that padding each row to its bound costs least.

    Dynamic programming over the distinct lengths in ascending order.  A bucket over lengths i..j costs
    length_j times its rows, less their tokens.  The best split point never moves left as j grows, so each
    layer is solved by halving: a range of ends takes its candidates from between its neighbours' answers.
    """
    lengths, counts = np.asarray(lengths, dtype=np.int64), np.asarray(counts, dtype=np.int64)
    d = len(lengths)
    if d == 0:
        return []
    buckets = min(buckets, d)
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)

    def cost(i, j):  # a bucket that holds lengths i..j, both included
        return lengths[j] * (rows[j + 1] - rows[i]) - (tokens[j + 1] - tokens[i])

    best = cost(np.zeros(d, dtype=np.int64), np.arange(d))
    starts = [np.zeros(d, dtype=np.int64)]
    for _ in range(buckets - 1):
        layer, start = np.full(d, np.inf), np.zeros(d, dtype=np.int64)
        spans = [(0, d - 1, 0, d - 1)]
        while spans:
            lo, hi, first, last = spans.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(first, min(last, j) + 1)
            total = np.where(i > 0, best[i - 1], 0.0) + cost(i, j)
            k = int(np.argmin(total))
            layer[j], start[j] = total[k], i[k]
            spans += [(lo, j - 1, first, int(i[k])), (j + 1, hi, int(i[k]), last)]
        best = layer
        starts.append(start)
    bounds, j = [], d - 1
    for start in reversed(starts):
        if j < 0:
            break
        bounds.append(int(lengths[j]))
        j = int(start[j]) - 1
    return bounds[::-1]


def pack(docs: DataFrame, buckets: int = 16, token_budget: int = 65_536, ident: str = "doc_id", text: str = "text",
         end_tokens: int = 1, seed: int = 41) -> DataFrame:
    """One row per document: (doc_id, n_tokens, bucket, bucket_len, batch, place, padding).

    A document's tokens are its words plus `end_tokens` (an end mark).  Every row of a bucket is
    padded to the bucket's length; a batch is as many rows as the token budget holds at that length, one at
    least.  Rows are batched in hash order, so batches are mixed and a rerun gives the same ones.
    The histogram has a row per distinct length: D of them need about D*D/2 tokens, so its size is at
    most the square root of twice the corpus.

    Null and empty texts have `end_tokens` tokens; repeated rows (the mix makes them) are counted before they move,
    numbered and packed each, however many there are; an empty table gives no rows; a text longer than the budget is
    a batch of its own, uncut; columns other than id and text are not read.
    """
    alike = docs.select(
        F.col(ident).cast("long").alias("doc_id"), (word_count(text) + end_tokens).cast("long").alias("n_tokens"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("crc")).groupBy("doc_id", "n_tokens", "crc").agg(F.count("*").alias("n_alike"))
    narrow = written(each_copy(alike, "n_alike", "nth").select("doc_id", "n_tokens", "nth", uniform_key(seed, "doc_id", "crc", "nth").alias("key")))
    histogram = narrow.groupBy("n_tokens").count().orderBy("n_tokens").collect()
    bounds = best_boundaries(np.array([r["n_tokens"] for r in histogram]), np.array([r["count"] for r in histogram]), buckets)
    rows = sum(r["count"] for r in histogram)
    ends = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    bucket = F.size(F.filter(ends, lambda e: e < F.col("n_tokens")))
    placed = prefix_sums(narrow.withColumn("bucket", bucket).withColumn("one", F.lit(1).cast("long")),
                         ["bucket"], "key", ["doc_id", "n_tokens", "nth"], {"rank": "one"}, slices_for(max(1, rows // max(1, len(bounds)))))
    length = F.get(ends, F.col("bucket"))  # the bucket's upper bound
    per_batch = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(token_budget) / F.col("bucket_len")))
    return placed.withColumn("bucket_len", length).withColumn("_per", per_batch) \
        .select("doc_id", "n_tokens", "bucket", "bucket_len", F.floor(F.col("rank") / F.col("_per")).alias("batch"),
                (F.col("rank") % F.col("_per")).alias("place"), (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
