"""Katz scores, fill-in-the-middle cuts and conversation repair against brute force, and their edge rows."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import blobs, fill_middle, katz, queries, turn_repair, wavelet

ROOT = "/root/testdata/sf0.001"
EXTRA = "chunk int, p int, train int, ids string, form string, n int, output string, h0 int, kind string, part int, seg int, place int, code int, key string, what string"
VALUES = (1, 2, 3, "i", "f", 4, "o", 5, "k", 6, 7, 8, 9, "y", "w")
DOCS = "doc_id long, text string, " + EXTRA
LONG = " ".join(f"Word{k} goes on." for k in range(30_000))
ROWS = [(1, "one two three"), (2, ""), (2, ""), (3, LONG), (4, "x"), (None, None), (None, "one two"), (5, " \t\n "), (6, "é ü 漢字 😀! " * 9), (7, "a <S> b"),
        (8, "ONE Two three"), (8, "ONE Two three"), (9, "x" * 200_000), (10, "line\nline\n"), (11, "a. b? c! d")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *VALUES) for r in ROWS], DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


# ---- Katz backoff


def by_hand(docs, train):
    """(rows, probability of a word after a context, words, contexts) of Katz's model, from dictionaries of words."""
    lower = {c: c + 32 for c in range(65, 91)}
    tokens = [[w.translate(lower) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [" "] for _, t in docs]
    one, two, context = Counter(), Counter(), Counter()
    for is_train, ts in zip(train, tokens, strict=True):
        if is_train:
            one.update(ts)
            two.update(zip(["", *ts], ts))
            context.update(["", *ts[:-1]])
    total = sum(one.values())

    def factors(counter):
        n = [0] + [sum(c == r for c in counter.values()) for r in range(1, 7)]
        b = min(0.9, n[1] / (n[1] + 2 * n[2])) if n[1] else 0.0
        out = {}
        for r in range(1, 6):
            d = None
            if n[1] and n[r] and 6 * n[6] != n[1]:
                a = 6 * n[6] / n[1]
                d = ((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a)
            out[r] = d if d is not None and 0 < d < 1 else (r - b) / r
        return lambda c: out.get(c, 1.0)

    d1, d2 = factors(one), factors(two)
    p1 = {w: d1(c) * c / (total + 1) for w, c in one.items()}
    unknown = 1 - math.fsum(p1.values())
    after = defaultdict(list)
    for (h, w), c in two.items():
        after[h].append((w, c))

    def probability(h, w):
        if h not in context:
            return p1.get(w, unknown)
        if (h, w) in two:
            return d2(two[h, w]) * two[h, w] / (context[h] + 1)
        left = 1 - math.fsum(d2(c) * c / (context[h] + 1) for _, c in after[h])
        return left / (1 - math.fsum(p1[x] for x, _ in after[h])) * p1.get(w, unknown)

    cache = {}
    p = lambda h, w: cache[h, w] if (h, w) in cache else cache.setdefault((h, w), probability(h, w))
    rows = [(i, not t, len(ts), sum(one[w] > 0 for w in ts), total, math.fsum(math.log10((one[w] + 0.1) / (total + 0.1 * (len(one) + 1))) for w in ts),
             math.fsum(math.log10(p(h, w)) for h, w in zip(["", *ts], ts))) for (i, _), t, ts in zip(docs, train, tokens, strict=True)]
    return rows, p, list(one), list(context)


def same(got, want):
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2:4], round(r[6], 4)))
    got, want = order(tuple(r) for r in got), order(want)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def held(i):
    return zlib.crc32(str("null" if i is None else i).encode()) % 10 == 0


def in_training():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) % 10 != 0


def test_scores_against_brute_force(spark):
    table = spark.read.parquet(f"{ROOT}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in table.collect()]
    want, p, words, contexts = by_hand(texts, [not held(i) for i, _ in texts])
    same(queries.op11_katz(spark, ROOT).collect(), want)
    # small chunks and groups, and contexts of 20 and more dealt over several
    split, tables = katz.learn_and_score(table.repartition(3), in_training(), chunk_bytes=20_000, group_items=2_000, split=20)
    same(split.collect(), want)
    assert tables.words.count() > 3 and tables.pairs.count() > 3
    assert sum(len(r["words"]) // 8 for r in tables.words.collect()) == len(words) == tables.unigrams.size
    # what is said of every context adds up to one
    random.seed(3)
    for h in ["", *random.sample(contexts, 5), "never seen"]:
        assert math.fsum(p(h, w) for w in words) + p(h, "\x00never") == pytest.approx(1, rel=1e-9)


def test_scores_tell_held_out_texts_better_than_the_base(spark):
    got = [r for r in queries.op11_katz(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert len(got) > 50 and sum(r["score"] for r in got) > 0.8 * sum(r["base_score"] for r in got)


def test_scores_of_edge_rows(docs, nothing, spark):
    texts = [r[:2] for r in ROWS]
    got = katz.learn_and_score(docs, F.col("doc_id") % 2 == 0)[0].collect()  # a null id is no training row
    same(got, by_hand(texts, [i is not None and i % 2 == 0 for i, _ in texts])[0])
    alone = katz.learn_and_score(docs, F.lit(False))[0].collect()
    assert len(alone) == len(ROWS) and all(r["score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in alone)
    assert katz.learn_and_score(nothing, F.lit(True))[0].count() == 0


def test_discounts_outside_their_range_are_replaced():
    assert katz.discounts([0, 100, 30, 12, 6, 4, 2])[1] == pytest.approx((2 * 30 / 100 - 0.12) / 0.88)
    assert katz.discounts([0, 5, 0, 0, 0, 0, 0])[1] == pytest.approx(0.1)
    assert (katz.discounts([0] * 7)[1:] == 1).all()
    found = katz.discounts([0, 10, 20, 20, 0, 30, 1])
    assert ((found[1:] > 0) & (found[1:] <= 1)).all()


def test_packed_numbers_return():
    for values in ([], [0], [1, 300, 70_000, 5], [2**40 + 7, 0]):
        assert blobs.unpack(blobs.pack(np.array(values, dtype=np.int64))).tolist() == values
    assert len(blobs.pack(np.arange(1000) % 3)) < 300


# ---- fill in the middle


def test_ranks_and_bisection():
    rng = np.random.default_rng(4)
    symbols = rng.integers(0, 8, 1000).astype(np.uint8)
    matrix = wavelet.WaveletMatrix(symbols, 3)
    at = np.arange(1001)
    for s in range(8):
        assert (matrix.rank(s, at) == np.concatenate([[0], np.cumsum(symbols == s)])).all()
    some = np.concatenate([[0], np.cumsum(np.isin(symbols, (1, 4, 6)))])
    assert (matrix.rank_any((1, 4, 6), at) == some).all() and (matrix.rank_any((0, 2, 3, 5, 7), at) == at - some).all()
    k = np.arange(some[-1] + 2)
    want = [int(np.searchsorted(some, x)) if x <= some[-1] else 1000 for x in k]
    assert matrix.after((1, 4, 6), k, np.zeros_like(k), np.full_like(k, 1000)).tolist() == want


def unit_ends(text, unit):
    if unit == "char":
        return list(range(1, len(text) + 1))
    if unit == "word":
        begins = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        return begins[1:] + [len(text)] if begins else []
    ends = [m.end() for m in re.finditer(r"\n" if unit == "line" else "[.!?]", text)]
    return ends + [len(text)] if (ends[-1] if ends else 0) < len(text) else ends


def form_of(ident, text):
    digest = hashlib.sha256(f"1:{'null' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    plain = not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
    return h, "plain" if plain else "spm" if h[3] % 100 < 20 else "psm"


@pytest.mark.parametrize("unit", ["char", "word", "line", "sentence"])
def test_cuts_against_brute_force(spark, docs, unit, monkeypatch):
    monkeypatch.setattr(fill_middle, "CHUNK_BYTES", 5_000)
    table = spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    texts = Counter((r["doc_id"], r["text"] or "") for r in table.collect())
    want = Counter()
    for (i, t), n in texts.items():
        ends = [0, *unit_ends(t, unit)]
        h, form = form_of(i, t)
        a, b = sorted((h[0] % len(ends), h[1] % len(ends)))
        p, m, s = t[:ends[a]], t[ends[a]:ends[b]], t[ends[b]:]
        if form == "plain":
            row = (i, len(ends) - 1, form, None, None, None, None, t, t)
        else:
            out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
            row = (i, len(ends) - 1, form, a, b - a, len(p), len(m), out, t)
        want[row] += n
    got = fill_middle.fill_middle(table, unit=unit).withColumn("back", fill_middle.restored("output", "form"))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_cuts_of_edge_rows(docs, nothing):
    got = fill_middle.fill_middle(docs).collect()
    assert len(got) == len(ROWS) and all(r["form"] == "plain" and r["output"] == "" for r in got if r["n"] == 0)
    assert all(r["form"] == "plain" for r in got if r["doc_id"] == 7)
    assert len({r["output"] for r in got if r["doc_id"] == 8}) == 1
    assert fill_middle.fill_middle(nothing).count() == 0


# ---- conversation repair


def cheapest(codes, extras):
    """(cost, edits) by searching all edits in order of cost, then of letters."""
    messages = []
    for i, c in enumerate(codes):
        messages += [c] + [c & 3 | turn_repair.REPEATED << 2] * extras.get(i, 0)
    todo, met = [(0, b"", 0, "")], set()
    while True:
        cost, edits, i, end = heapq.heappop(todo)
        if (i, end) in met:
            continue
        met.add((i, end))
        if i == len(messages) and end in ("", "a"):
            return cost, edits
        nxt = "a" if end == "u" else "u"
        heapq.heappush(todo, (cost + 2, edits + b"I", i, nxt))
        if i < len(messages):
            kind, fault = messages[i] & 3, messages[i] >> 2
            heapq.heappush(todo, (cost + 3, edits + b"D", i + 1, end))
            if fault < 2:
                if "sua?"[kind] == nxt or (kind == 0 and end == ""):
                    heapq.heappush(todo, (cost + fault, edits + b"K", i + 1, "sua?"[kind]))
                heapq.heappush(todo, (cost + 2 + fault, edits + b"R", i + 1, nxt))


def test_edits_are_the_cheapest_and_least():
    random.seed(2)
    for _ in range(4000):
        codes = bytes(random.randint(0, 3) + 4 * random.choice([0, 0, 0, 1, 2, 3]) for _ in range(random.randint(0, 9)))
        extras = {i: random.randint(1, 2) for i in range(len(codes)) if random.random() < 0.15}
        edits, _, cost = turn_repair.walk(codes, extras, turn_repair.AT_END, True, [0])[0]
        assert (cost, edits) == cheapest(codes, extras)


def results(fixed):
    return (sorted((tuple(r) for r in fixed.report.collect()), key=repr), sorted((tuple(r) for r in turn_repair.text_digests(fixed.messages).collect()), key=repr))


def test_segments_change_nothing(spark):
    """A conversation with a third of all messages, cut into many segments in several tasks, against the same in one."""
    chat = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    hot = chat.withColumns({"turn": F.col("turn") * 1000 + F.col("conv_id"), "conv_id": F.lit(-5).cast("long")})
    rows = queries.damaged(chat.unionByName(hot)).cache()
    small, large = results(turn_repair.repair(rows, segment_bytes=2_000)), results(turn_repair.repair(rows.coalesce(1)))
    assert small == large and len(large[0]) == 101
    report = next(r for r in large[0] if r[0] == -5)
    assert len(report[-1]) > 500


CHAT = "conv_id long, turn long, role string, text string, " + EXTRA


def told(spark, rows, **options):
    fixed = turn_repair.repair(spark.createDataFrame([(*r, *VALUES) for r in rows], CHAT), **options)
    messages = defaultdict(list)
    for r in sorted(fixed.messages.collect(), key=lambda r: (r["part"], r["seg"], r["place"])):
        messages[r["conv_id"]].append((r["role"], r["text"], r["edit"]))
    return {r["conv_id"]: r.asDict() for r in fixed.report.collect()}, messages


@pytest.mark.parametrize("limit", [1 << 20, 1])
def test_repairs_of_edge_rows(spark, limit):
    long = "x" * 100_000
    reports, messages = told(spark, [
        (1, 0, "user", "hello."), (1, 1, "assistant", "hi."), (2, 5, "user", "hello"), (2, 9, "assistant", " \n"), (3, None, None, None), (3, None, "user", long),
        (None, 1, "assistant", "late."), (None, 4, "assistant", "late."), (4, 1, "user", "again."), (4, 1, "user", "again."), (4, 1, "user", "again."),
        (5, 1, "system", "be kind."), (5, None, "tool", "data.")], segment_bytes=limit)
    assert reports[1] == {"conv_id": 1, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "KK"}
    assert messages[1] == [("user", "hello.", "K"), ("assistant", "hi.", "K")]
    # the blank answer goes; deleting both (6) and keeping the question (1 + 3 + 2) cost the same, and D comes first
    assert (reports[2]["audit"], reports[2]["cost"], reports[2]["gaps"], reports[2]["blank"], reports[2]["truncated"]) == ("DD", 6, 3, 1, 1)
    assert 2 not in messages
    assert (reports[3]["gaps"], reports[3]["blank"], reports[3]["truncated"], reports[3]["illegal"]) == (0, 1, 1, 1)
    assert (reports[None]["gaps"], reports[None]["duplicate"], reports[None]["illegal"], reports[None]["audit"]) == (2, 1, 1, "IKD")
    assert messages[None] == [("user", "", "I"), ("assistant", "late.", "K")]
    assert (reports[4]["duplicate"], reports[4]["illegal"], reports[4]["audit"]) == (2, 2, "KDDI")
    assert (reports[5]["illegal"], reports[5]["gaps"]) == (1, 0)


def test_no_messages_at_all(spark):
    reports, messages = told(spark, [])
    assert reports == {} and messages == {}


def test_dropped_conversations_are_still_reported(spark, tmp_path):
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(lost, 0, "user", "gone."), (None, None, "user", None)], "conv_id long, turn long, role string, text string") \
        .write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in queries.op13_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {lost, None}
    assert tuple(got[lost])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
