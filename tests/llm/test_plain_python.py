"""The classifier's score, the fingerprints and the rules' posterior against plain Python, and users' columns with our names."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import classifier, fingerprint, jaccard, mixing, weak_rules

ROOT = "/root/testdata/sf0.01"
MASK = (1 << 64) - 1
R = 0x9E3779B97F4A7C15


def mix(h):
    h = ((h ^ (h >> 31)) * 0xBF58476D1CE4E5B9) & MASK
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & MASK
    return h ^ (h >> 29)


def run_hash(symbols):
    power, total = 1, 0
    for s in symbols:
        power = power * R & MASK
        total = (total + (s + 1) * power) & MASK
    return mix(total)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{ROOT}/documents.parquet")


def plain_features(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    lower = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]

    def kind(c):
        return 1 if c >= 128 or chr(c).isalpha() else 2 if 48 <= c <= 57 else 3 if c == 0 else c

    def shape(w):
        return [k for i, k in enumerate(map(kind, w)) if i == 0 or k != kind(w[i - 1])]

    hashes, shapes = [run_hash(w) for w in lower], [run_hash(shape(w)) for w in words]
    same = [i > 0 and lower[i] == lower[i - 1] for i in range(len(words))]
    out = set()
    put = lambda value, salt: out.add(mix((value + salt * R) & MASK) % classifier.DIM)
    for i in range(len(words)):
        put(hashes[i], 1)
        put(shapes[i], 3)
        if i >= 1:
            put(hashes[i] + hashes[i - 1] * R, 2)
            put(shapes[i] + shapes[i - 1] * R, 4)
        if i >= 2:
            put(shapes[i] + shapes[i - 1] * R + shapes[i - 2] * (R * R & MASK), 5)
        if i >= 3:
            put(same[i] * 4 + same[i - 1] * 2 + same[i - 2], 6)
    return out


def test_scores_against_plain_features(spark, docs):
    model = classifier.train(docs, spark.read.parquet(f"{ROOT}/labels.parquet"))
    rows = docs.where("doc_id % 5 = 0").select("doc_id", "text", classifier.scorer(docs, model)(F.col("text")).alias("score")).collect()
    assert len(rows) == 200
    for r in rows:
        found = plain_features(r["text"])
        margin = model.bias + (sum(float(model.weights[n]) for n in found) / len(found) ** 0.5 if found else 0)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(model.slope * margin + model.offset))), rel=1e-6, abs=1e-12)


def test_ratios_against_counts():
    rows = [np.array(x, dtype=np.int32) for x in ([1, 2, 3], [1, 2], [3], [4, 1])]
    good = np.array([True, False, True, False])
    got = classifier.log_count_ratio(rows, good)
    counts = [Counter(n for r, g in zip(rows, good, strict=True) if g == side for n in r.tolist()) for side in (True, False)]
    sums = [sum(c.values()) + classifier.DIM for c in counts]
    for n in range(6):
        assert got[n] == pytest.approx(math.log((counts[0][n] + 1) / sums[0] / ((counts[1][n] + 1) / sums[1])))


def plain_parse(symbols, rounds):
    if len(symbols) == 1:
        return symbols
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    symbols = [s if n == 1 else mix((s + n * (3 * R & MASK)) & MASK) for s, n in runs]
    labels = symbols
    for _ in range(rounds):
        fresh = []
        for i, v in enumerate(labels):
            differ = v ^ (labels[i - 1] if i else v ^ 1)
            place = (differ & -differ).bit_length() - 1
            fresh.append(2 * place + (v >> place & 1))
        labels = fresh
    cuts = [0] + [i for i in range(2, len(labels) - 1) if labels[i] > labels[i - 1] and labels[i] > labels[i + 1]]
    return [run_hash(symbols[a:b]) for a, b in zip(cuts, [*cuts[1:], len(symbols)], strict=True)]


def plain_signature(text):
    if not text:
        return 0, [fingerprint.EMPTY] * fingerprint.BINS
    symbols, level, least = [ord(c) for c in text], 0, {}
    while level <= max(fingerprint.SKETCH_LEVELS) or len(symbols) > 1:
        symbols = plain_parse(symbols, 4 if level else 3)
        level += 1
        if level in fingerprint.SKETCH_LEVELS:
            for s in symbols:
                name = mix((s + (level * R & MASK)) & MASK)
                least[name >> 58] = min(least.get(name >> 58, MASK), name & ((1 << 58) - 1))
    return symbols[0], [mix(least[b]) & 0xFFFF if b in least else fingerprint.EMPTY for b in range(fingerprint.BINS)]


def plain_likeness(a, b):
    either = [(x, y) for x, y in zip(a, b, strict=True) if x != fingerprint.EMPTY or y != fingerprint.EMPTY]
    return sum(x == y for x, y in either) / len(either) if either else 1.0


def test_fingerprints_against_a_plain_parse(spark):
    odd = ["", "a", "aa", "aaaaaaaa", "ab", "abab" * 30, "é漢😀" * 40, "x" * 500 + "y", "one two three " * 50]
    source = spark.read.parquet(f"{ROOT}/documents.parquet").where("length(text) < 1500").select("text")
    rows = [(k, t) for k, t in enumerate(odd + [r["text"] for r in source.collect()][:150])]
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    spell = lambda s: f"{s[0]:016x}-" + "".join("...." if x == fingerprint.EMPTY else f"{x:04x}" for x in s[1])
    signatures = [plain_signature(t) for _, t in rows]
    for k, t in rows:
        following = (k + 1) % len(rows)
        half = len(t) // 2
        other = plain_signature(t[:len(t) - half] + rows[following][1][:half])
        r = got[k]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (spell(signatures[k]), spell(other))
        assert r["near_edited"] == pytest.approx(plain_likeness(signatures[k][1], other[1]))
        assert r["near_next"] == pytest.approx(plain_likeness(signatures[k][1], signatures[following][1]))


def test_posteriors_against_plain_em(spark, docs):
    """Votes and expectation-maximisation over documents, one by one, in place of patterns."""
    rows = weak_rules.judged(docs).collect()
    vote = lambda good, bad: -1 if bad else 1 if good else 0
    ballots = []
    for r in rows:
        n = max(1, r["n_words"])
        length, symbols, repeats, dup = r["word_chars"] / n, r["n_symbols"] / n, r["n_repeat_words"] / n, r["n_dup_lines"]
        ballots.append((vote(r["n_words"] >= 50, r["n_words"] < 10), vote(3 <= length <= 9, length < 2 or length > 12), vote(symbols <= 0.05, symbols > 0.2),
                        vote(r["n_symbols"] * 100 <= r["word_chars"], r["n_symbols"] * 10 > r["word_chars"]), vote(repeats <= 0.05, repeats > 0.2),
                        vote(dup == 0 and r["n_words"] >= 50, 4 * dup > n / 10)))
    total = len(ballots)
    good = [0.3 if min(b) < 0 else 0.95 for b in ballots]
    lean = {True: {-1: 0.02, 0: 0.28, 1: 0.70}, False: {-1: 0.45, 0: 0.45, 1: 0.10}}
    prior = 0.85
    for _ in range(50):
        weight = {True: sum(good), False: total - sum(good)}
        chance = {}
        for rule in range(6):
            for v in (-1, 0, 1):
                for side in (True, False):
                    mass = sum(g if side else 1 - g for g, b in zip(good, ballots, strict=True) if b[rule] == v)
                    chance[rule, v, side] = (mass + 0.02 * total * lean[side][v]) / (weight[side] + 0.02 * total)
        prior = (weight[True] + 0.02 * total * 0.85) / (1.02 * total)
        good = [1 / (1 + math.exp(-max(-50, min(50, math.log(prior / (1 - prior)) + sum(math.log(chance[k, v, True] / chance[k, v, False]) for k, v in enumerate(b)))))) for b in ballots]
    final = {b: math.log(prior / (1 - prior)) + sum(math.log(chance[k, v, True] / chance[k, v, False]) for k, v in enumerate(b)) for b in set(ballots)}
    for r, b in zip(rows, ballots, strict=True):
        assert r["p_good"] == pytest.approx(1 / (1 + math.exp(-final[b])), rel=1e-6)
        assert r["kept"] == (not r["base_failed"] and r["p_good"] >= 0.5)


def test_users_columns_keep_their_values(spark):
    names = ["_quality_score", "_rules_n_words", "_RULES_kept", "_own_size", "_mix_copies", "_own_row", "_kept_row", "_from", "_slice", "__own_x"]
    text = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(80)) + "."
    rows = spark.createDataFrame([(k, text if k < 3 else f"{text} {k} " + "other " * k, "s", *[f"{c}{k}" for c in names]) for k in range(6)],
                                 "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in names))
    labels = spark.createDataFrame([(k, 1) for k in range(6)], "doc_id long, quality int")
    whole = {r["doc_id"]: r for r in rows.collect()}
    for kept in (classifier.keep_good(rows, labels), weak_rules.keep_good(rows), jaccard.keep_one(rows), mixing.mixed_documents(rows)):
        assert kept.columns == rows.columns
        got = kept.collect()
        assert got and all(r == whole[r["doc_id"]] for r in got)
