"""Quality rules as weak supervision: rules vote or abstain, and their accuracies are learned without labels.

Each rule looks at a few statistics of the text and votes good, bad, or not at all.  Expectation-
maximisation over the counts of vote patterns (at most 3 to the number of rules, however large the
corpus) estimates how often each rule votes, and how, on good and on bad texts; a text is kept if its
posterior probability of being good is high enough.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import SPACES, free_prefix, text_or_empty
from tallyloom.scale import written

SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _hashes_joined(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def window_hashes(words: Column) -> Column:
    """A hash of every five-word window: of two words first, then four, then five, each array walked once."""
    one = F.transform(words, lambda w: F.xxhash64(w))
    n = F.size(words)
    two = _hashes_joined(one, F.slice(one, 2, F.greatest(n, F.lit(1))))
    four = _hashes_joined(two, F.slice(two, 3, F.greatest(n, F.lit(1))))
    five = _hashes_joined(four, F.slice(one, 5, F.greatest(n, F.lit(1))))
    return F.slice(five, F.lit(1), F.greatest(n - 4, F.lit(0)))  # the tail has no five words


def text_statistics(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """`docs` with the statistics BASE, each named with `prefix`; the whole text is read, null as empty.

    Steps are separate projections over arrays that later steps use twice, so none is computed twice.
    """
    body = text_or_empty(text)
    names = {c: f"{prefix}{c}" for c in BASE}
    plain, w, lines, h, srt, pos = (f"{prefix}_{c}" for c in ("plain", "words", "lines", "windows", "sorted", "at"))
    blank = F.translate(body, SPACES, " " * len(SPACES))
    out = docs.withColumn(plain, blank).withColumns({
        w: F.filter(F.split(plain, " "), lambda x: x != ""),
        lines: F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\t-\r ]")),
        names["word_chars"]: F.length(F.replace(F.col(plain), F.lit(" "), F.lit(""))).cast("long"),
        names["n_symbols"]: (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
    }).withColumns({
        names["n_words"]: F.size(w).cast("long"),
        names["n_dup_lines"]: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        h: window_hashes(F.col(w)),
    })
    # most texts repeat no window: the rest is done for the others only
    repeats = F.size(F.array_distinct(F.col(h))) < F.size(h)
    some = F.when(repeats, F.col(h)).otherwise(F.array().cast("array<long>"))
    # sorted by hash: a window is repeated if a neighbour has its hash
    out = out.withColumn(srt, F.array_sort(F.transform(some, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    shifted = F.slice(F.col(srt), F.lit(2), F.greatest(F.size(srt), F.lit(1)))
    pairs = F.zip_with(F.col(srt), shifted, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    out = out.withColumn(pos, F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))))
    after = F.slice(F.col(pos), F.lit(2), F.greatest(F.size(pos), F.lit(1)))
    covered = F.zip_with(F.col(pos), after, lambda a, b: F.least(F.lit(5), F.coalesce(b - a, F.lit(5))))
    out = out.withColumn(names["n_repeat_words"], F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0).cast("long")))
    # a generator of one row stands between the statistics and their readers: the optimiser would else write the
    # expressions above into each of the many places, filters among them, that mention a statistic
    once = F.struct(*[F.col(names[c]) for c in BASE])
    return out.select(*docs.columns, F.inline(F.array(once)))


def base_failed(prefix: str = "") -> Column:
    n = F.col(f"{prefix}n_words")
    return (n < 10) | (100 * F.col(f"{prefix}n_repeat_words") > 20 * n)


def votes(prefix: str = "") -> dict[str, Column]:
    """Rules by name: 1 votes good, -1 votes bad, 0 abstains.  Bounds leave a gap in which a rule abstains."""
    c = lambda name: F.col(f"{prefix}{name}")
    n = F.greatest(c("n_words"), F.lit(1))

    def between(value: Column, good: Column, bad: Column) -> Column:
        return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))

    length, symbols = c("word_chars") / n, c("n_symbols") / n
    repeats, dup = c("n_repeat_words") / n, c("n_dup_lines")
    return {
        "long_enough": between(n, c("n_words") >= 50, c("n_words") < 10),
        "word_length": between(length, (length >= 3) & (length <= 9), (length < 2) | (length > 12)),
        "few_symbols": between(symbols, symbols <= 0.05, symbols > 0.2),
        "symbol_chars": between(symbols, c("n_symbols") * 100 <= c("word_chars"), c("n_symbols") * 10 > c("word_chars")),
        "few_repeats": between(repeats, repeats <= 0.05, repeats > 0.2),
        "few_copied_lines": between(dup, (dup == 0) & (c("n_words") >= 50), 4 * dup > n / 10),
    }


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50, prior_good: float = 0.85,
              strength: float = 0.02) -> tuple[float, np.ndarray]:
    """EM over vote patterns: (log prior odds, per rule and vote the log-likelihood ratio good to bad).

    Every round re-estimates, for good and for bad texts, the chances of each rule's three votes.  The
    pseudo-counts are a share `strength` of the corpus with votes that lean to the truth, so the classes
    keep their meaning and the answer does not hang on the corpus size.
    """
    total = counts.sum()
    if total == 0:
        return math.log(prior_good / (1 - prior_good)), np.zeros((patterns.shape[1], 3))
    lean_good, lean_bad = np.array([0.02, 0.28, 0.70]), np.array([0.45, 0.45, 0.10])  # votes -1, 0, 1
    onehot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    good = np.where((patterns < 0).sum(1) > 0, 0.3, 0.95)  # first guess: any bad vote is a doubt
    prior, ratio = prior_good, None
    for _ in range(rounds):
        g, b = counts * good, counts * (1 - good)
        extra = strength * total
        p_good = (np.einsum("p,prv->rv", g, onehot) + extra * lean_good) / (g.sum() + extra)
        p_bad = (np.einsum("p,prv->rv", b, onehot) + extra * lean_bad) / (b.sum() + extra)
        prior = (g.sum() + extra * prior_good) / (total + extra)
        ratio = np.log(p_good) - np.log(p_bad)
        odds = math.log(prior / (1 - prior)) + np.einsum("prv,rv->p", onehot, ratio)
        good = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return math.log(prior / (1 - prior)), ratio


def judge(docs: DataFrame, keep: list[str], text: str = "text", threshold: float = 0.5, prefix: str = "") -> DataFrame:
    """The columns `keep` of `docs` with BASE, `base_failed`, `p_good` and `kept` (these named with `prefix`), row by row.

    The texts are read once: the statistics are written to the shared folder beside `keep`; vote patterns are counted
    over the whole corpus from there, and what they teach is applied there.
    Null and empty texts have no words and fail the base rules; repeated rows get equal verdicts; an empty
    table gives no rows; long texts are read whole.  Take a `prefix` that no column of `keep` begins with.
    """
    known = written(text_statistics(docs, text, prefix).select(*keep, *[f"{prefix}{c}" for c in BASE]))
    rules = votes(prefix)
    seen = known.select(*[v.alias(k) for k, v in rules.items()]).groupBy(*rules).count().collect()
    patterns = np.array([[r[k] for k in rules] for r in seen], dtype=np.int64).reshape(-1, len(rules))
    prior, ratio = fit_votes(patterns, np.array([r["count"] for r in seen], dtype=float))
    odds = F.lit(float(prior))
    for vote, line in zip(rules.values(), ratio, strict=True):
        odds = odds + F.get(F.array(*[F.lit(float(x)) for x in line]), vote + 1)
    return known.withColumn(f"{prefix}base_failed", base_failed(prefix)) \
        .withColumn(f"{prefix}p_good", 1 / (1 + F.exp(-odds))) \
        .withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & (F.col(f"{prefix}p_good") >= threshold))


def judged(docs: DataFrame, ident: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: (doc_id, BASE, base_failed, p_good, kept)."""
    return judge(docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("text")), ["doc_id"], "text", threshold)


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that the rules keep, with their columns as they were."""
    own = free_prefix(docs, "rules")
    return judge(docs, docs.columns, text, threshold, prefix=own).where(F.col(f"{own}kept")).select(*docs.columns)
