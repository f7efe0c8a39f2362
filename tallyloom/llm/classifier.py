"""Quality classifier: naive Bayes support vectors over n-gram indicators.

A text's features are the n-grams that occur in it at all, of three token streams: its words (one and two
in a row), the words' shapes (one to three: runs of letters, digits and each other sign), and whether each
word repeats the one before (three in a row).  Indicators are scaled to unit length and by the log-count
ratio of the classes; a linear hinge-loss model is fitted on them by dual coordinate descent, and a
logistic curve through margins of rows kept aside turns its margin into a score.  Features are numbered by hash, modulo
DIM: those that share a number share a weight.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import free_name, bounded_batches, uniform_key
from tallyloom.llm.hashes import R1, R2, constant, mixed, run_hashes

DIM = 1 << 18
CHUNK_BYTES = 2 << 20  # texts are handled so many bytes at a time, or one by one if they are longer


def _class_table() -> np.ndarray:
    """Byte to class: 0 between words, 1 letters and all of UTF-8 beyond ASCII, 2 digits, else the sign itself."""
    table = np.arange(256, dtype=np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = 0
    table[0] = 3  # the zero byte is a sign like others; 0 is taken
    table[128:] = 1
    for lo, hi in (("a", "z"), ("A", "Z")):
        table[ord(lo):ord(hi) + 1] = 1
    table[ord("0"):ord("9") + 1] = 2
    return table


CLASSES = _class_table()


def chunk_features(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the distinct feature numbers that occur in it."""
    none = np.empty(0, dtype=np.int32)
    joined = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(joined, dtype=np.uint8)
    kind = CLASSES[raw]
    inside = np.flatnonzero(kind)
    if len(inside) == 0:
        return [none] * len(texts)
    first = np.empty(len(inside), dtype=bool)
    first[0] = True
    np.not_equal(np.diff(inside), 1, out=first[1:])
    starts = np.flatnonzero(first)  # into `inside`
    letters = raw[inside]
    lower = np.where((letters >= 65) & (letters <= 90), letters + 32, letters)
    word = run_hashes(lower, starts)
    kinds = kind[inside]
    turn = first.copy()
    turn[1:] |= kinds[1:] != kinds[:-1]
    turns = np.flatnonzero(turn)
    shape = run_hashes(kinds[turns], np.searchsorted(turns, starts))
    # where each text's words begin
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(inside[starts], ends)])

    def previous(a: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros_like(a)
        out[n:] = a[:-n] if n else a
        return out

    same = (word == previous(word, 1)).astype(np.uint64)
    salt = lambda a, k: mixed(a + constant(k))
    two, shape2 = word + previous(word, 1) * R1, shape + previous(shape, 1) * R1
    shape3 = shape2 + previous(shape, 2) * R2
    runs = same * np.uint64(4) + previous(same, 1) * np.uint64(2) + previous(same, 2)
    grams = [(salt(word, 1), 0), (salt(two, 2), 1), (salt(shape, 3), 0), (salt(shape2, 4), 1), (salt(shape3, 5), 2), (salt(runs, 6), 3)]
    numbers = [((g & np.uint64(DIM - 1)).astype(np.int32), skip) for g, skip in grams]
    out, owner = [], np.zeros(DIM, dtype=np.int32)
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        own = np.concatenate([n[min(lo + skip, hi):hi] for n, skip in numbers])
        if len(own) == 0:
            out.append(none)
            continue
        order = np.arange(len(own), dtype=np.int32)
        owner[own] = order  # the last occurrence owns the number
        out.append(own[owner[own] == order])
    return out


def features(texts: pd.Series) -> Iterator[np.ndarray]:
    """Distinct feature numbers of each text, in order; null as empty."""
    chunk, held = [], 0
    for text in texts:
        data = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if chunk and held + len(data) > CHUNK_BYTES:
            yield from chunk_features(chunk)
            chunk, held = [], 0
        chunk.append(data)
        held += len(data) + 1
    if chunk:
        yield from chunk_features(chunk)


class Model(NamedTuple):
    """score = logistic(slope * (weights . unit indicators + bias) + offset)."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, numbers: np.ndarray) -> float:
        if len(numbers) == 0:
            return self.bias
        return float(self.weights[numbers].sum()) / len(numbers) ** 0.5 + self.bias

    def score(self, numbers: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(numbers) + self.offset, -500, 500))))


def log_count_ratio(rows: list[np.ndarray], good: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Per feature the log of its share among good rows' indicators over its share among bad rows'."""
    counts = []
    for side in (good, ~good):
        held = [r for r, g in zip(rows, side, strict=True) if g]
        c = smoothing + np.bincount(np.concatenate(held) if held else np.empty(0, dtype=np.int64), minlength=DIM)
        counts.append(c / c.sum())
    return np.log(counts[0] / counts[1])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, cost: np.ndarray,
                            epochs: int = 30, tolerance: float = 1e-3, seed: int = 5) -> tuple[np.ndarray, float]:
    """Minimises |w|^2/2 + sum cost_i * max(0, 1 - sign_i * (w . x_i + bias)), the bias as a constant feature.

    One dual variable is solved at a time in a fresh random order, clipped to [0, cost_i]; the weights follow.
    """
    w, bias = np.zeros(DIM), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for v in values])
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in draw.permutation(len(rows)):
            gradient = signs[i] * (float(w[rows[i]] @ values[i]) + bias) - 1.0
            moved = min(max(alpha[i] - gradient / square[i], 0.0), cost[i]) - alpha[i]
            if moved:
                alpha[i] += moved
                w[rows[i]] += moved * signs[i] * values[i]
                bias += moved * signs[i]
                worst = max(worst, abs(moved) / cost[i])
        if worst < tolerance:
            break
    return w, bias


def _logistic(margins: np.ndarray, good: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps on smoothed targets with a light ridge."""
    n_good, n_bad = good.sum(), (~good).sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    theta, ridge = np.array([1.0, 0.0]), np.diag([1e-3, 1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - target) + ridge @ theta)
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 1e-6)), float(theta[1])


def fit(rows: list[np.ndarray], good: np.ndarray, c: float = 1.0) -> Model:
    """A model from feature numbers and labels.  Without both classes every text gets the same score."""
    good = np.asarray(good, dtype=bool)
    if len(good) < 10 or good.all() or not good.any():
        share = (good.sum() + 1) / (len(good) + 2)
        return Model(np.zeros(DIM, dtype=np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    aside = np.zeros(len(rows), dtype=bool)
    for side in (good, ~good):  # every fifth row of either class shapes the curve only
        aside[np.flatnonzero(side)[::5]] = True
    inner = ~aside if (good & ~aside).any() and (~good & ~aside).any() else np.ones(len(rows), dtype=bool)
    own = [r for r, k in zip(rows, inner, strict=True) if k]
    ratio = log_count_ratio(own, good[inner])
    signs = np.where(good[inner], 1.0, -1.0)
    share = good[inner].mean()
    cost = c * np.where(good[inner], 0.5 / share, 0.5 / (1 - share))  # the classes weigh the same
    values = [ratio[r] / max(1, len(r)) ** 0.5 for r in own]
    w, bias = dual_coordinate_descent(own, values, signs, cost)
    raw = Model((w * ratio).astype(np.float32), bias, 1.0, 0.0)
    slope, offset = _logistic(np.array([raw.margin(r) for r, k in zip(rows, aside, strict=True) if k]), good[aside])
    return raw._replace(slope=slope, offset=offset)


def held_out(ident: str | Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves remainder 0 by 5."""
    return F.crc32(F.coalesce((F.col(ident) if isinstance(ident, str) else ident).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", max_rows: int = 4000, seed: int = 3) -> Model:
    """Fits on at most `max_rows` labelled documents that are not held out, half of either class if there are as many.

    Which ones hash order decides, so a rerun takes the same.  Their feature numbers are made on the executors; the
    driver gets those of the sample only.  Rows whose id, quality or document is missing teach nothing.
    """
    bounded_batches(docs.sparkSession)
    known = labels.where(F.col(ident).isNotNull() & F.col("quality").isin(0, 1) & ~held_out(ident)) \
        .select(F.col(ident).alias("label_id"), F.col("quality").alias("good")).dropDuplicates()
    keyed = known.withColumn("key", uniform_key(seed, "label_id", "good"))
    sample = None
    for value in (0, 1):
        side = keyed.where(F.col("good") == value).orderBy("key", "label_id").limit(max_rows // 2)
        sample = side if sample is None else sample.unionByName(side)
    rows = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("text")) \
        .join(sample, F.col("doc_id") == F.col("label_id")).select("key", "good", "text")

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.sort(f).astype(np.int32) for f in features(batch["text"])]
            yield pd.DataFrame({"key": batch["key"], "good": batch["good"], "mark": [zlib.crc32(f.tobytes()) for f in found], "numbers": found})

    # an id may stand in any number of rows: the first ones in hash order count
    found = rows.mapInPandas(numbers, "key long, good int, mark long, numbers array<int>") \
        .orderBy("key", "good", "mark").limit(max_rows).toPandas()
    return fit([np.asarray(n, dtype=np.int32) for n in found["numbers"]], found["good"].to_numpy() == 1)


def scorer(docs: DataFrame, model: Model):
    """A column function: the score of a text column, whole texts, null as empty."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM floats, a megabyte

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = shared.value
        for texts in batches:
            yield pd.Series([held.score(f) for f in features(texts)], dtype="float64")

    return score


def scored(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """One row per document: (doc_id, held_out, score, predicted).

    Only the text is scored: equal texts get equal scores.  Null and empty texts get the score of
    a text without n-grams; repeated rows are scored each; an empty table gives no rows; other columns of `docs` are
    not read.  With no labels of one class all scores are the smoothed share of good labels.
    """
    score = scorer(docs, train(docs, labels, ident, text, **options))
    return docs.select(F.col(ident).alias("doc_id"), held_out(ident).alias("held_out"), score(F.col(text)).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """The rows of `docs` with a score of `threshold` or more, their columns as they were."""
    score = scorer(docs, train(docs, labels, text=text, **options))
    own = free_name(docs, "quality_score")
    return docs.withColumn(own, score(F.col(text))).where(F.col(own) >= threshold).select(*docs.columns)
