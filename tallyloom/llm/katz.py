"""Language-model scores by Katz backoff over words and pairs of words.

Counts are discounted by Good-Turing, and what that frees goes to words not seen after a context, in proportion to their
own probability and normalised exactly.  Nothing of the model has to fit one machine: texts are cut into chunks of bounded
size, a chunk asks for each of its distinct words and pairs once, and partitions of the vocabulary and of the contexts
count what all chunks bring and answer them.  Words get numbers by falling count, so a number says how often its word
occurs through a table of distinct counts, which grows with the square root of the corpus at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.blobs import pack, unpack
from tallyloom.llm.common import SPACES, bounded_batches
from tallyloom.llm.hashes import R1, mixed, run_hashes
from tallyloom.scale import written

CHUNK_BYTES = 8 << 20  # of text; a longer text is a chunk by itself
HASH_BYTES = 2 << 20  # hashed at a time inside a chunk
GROUP_ITEMS = 1_000_000  # words or pairs asked for in a partition of the model
MOST_GROUPS = 1 << 17  # so that a chunk's question to a partition holds several items on any corpus
SPLIT = 1_000_000  # a context seen more often is dealt over a partition for each so many times
LARGEST = 5  # counts up to this are discounted

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[ord(c) for c in SPACES]] = True
END = int(run_hashes(np.array([32], dtype=np.uint8), np.array([0]))[0])  # a blank is no word


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and the number of words of each."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    inside = np.flatnonzero(~_SPACE[raw])
    if not len(inside):
        return np.empty(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    letters = raw[inside]
    letters = np.where((letters >= 65) & (letters <= 90), letters + 32, letters)
    starts = np.flatnonzero(np.diff(inside, prepend=-2) != 1)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return run_hashes(letters, starts), np.diff(np.searchsorted(inside[starts], ends), prepend=0)


CHUNK = ("chunk long, ids array<long>, train array<boolean>, sizes binary, tokens binary, slots binary, words binary, counts binary, "
         "n_words long, n_tokens long, n_train long")
_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(),
          "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}


def _table(rows: list[dict], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array([r.get(c) for r in rows], type=_TYPES[t]) for c, t in fields], names=[c for c, _ in fields])


def _batches(rows: list[dict], schema: str) -> Iterator[pa.RecordBatch]:
    yield from _table(rows, schema).to_batches()


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one: those of chunks are large."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


class _Chunk:
    """Documents taken up so far; their texts are dropped as soon as they are hashed."""

    def __init__(self):
        self.ids, self.train, self.hashes, self.sizes, self.texts = [], [], [], [], []
        self.held = self.waiting = 0

    def add(self, ident, train: bool, text: bytes) -> None:
        self.ids.append(ident)
        self.train.append(train)
        self.texts.append(text)
        self.held += len(text)
        self.waiting += len(text)
        if self.waiting > HASH_BYTES:
            self.hash()

    def hash(self) -> None:
        if self.texts:
            hashes, sizes = word_hashes(self.texts)
            self.hashes.append(hashes)
            self.sizes.append(sizes)
            self.texts, self.waiting = [], 0

    def row(self, number: int) -> dict:
        """A CHUNK row: words by falling count in the chunk, tokens as places in that list, one end after each text."""
        self.hash()
        sizes = np.concatenate(self.sizes) + 1
        ends = np.cumsum(sizes) - 1
        tokens = np.full(int(sizes.sum()), END, dtype=np.uint64)
        inner = np.ones(len(tokens), dtype=bool)
        inner[ends] = False
        tokens[inner] = np.concatenate(self.hashes)
        words, local, often = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        local, words = place[local], words[order]
        train = np.array(self.train, dtype=bool)
        counts = np.bincount(local[np.repeat(train, sizes)], minlength=len(words))
        return {"chunk": number, "ids": self.ids, "train": self.train, "sizes": pack(sizes), "tokens": pack(local), "slots": pack(words >> np.uint64(40)),
                "words": words.tobytes(), "counts": pack(counts), "n_words": len(words), "n_tokens": len(tokens), "n_train": int(sizes[train].sum())}


def _chunked(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number, held = TaskContext.get().partitionId() << 32, 0, _Chunk()
        for batch in batches:
            for ident, train, text in zip(batch.column("id").to_pylist(), batch.column("train").to_pylist(),
                                          batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                if held.ids and held.held + len(text) > limit:
                    yield from _batches([held.row(first + number)], CHUNK)
                    number, held = number + 1, _Chunk()
                held.add(ident, train, text)
        if held.ids:
            yield from _batches([held.row(first + number)], CHUNK)

    return run


def _owner(slots: np.ndarray, groups: int) -> np.ndarray:
    """The group of each 24-bit slot."""
    return slots.astype(np.int64) * groups >> 24


def _runs(sorted_keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(key, slice) of each run of equal keys."""
    starts = np.flatnonzero(np.diff(sorted_keys, prepend=-1))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(sorted_keys)], strict=False):
        yield int(sorted_keys[a]), slice(a, b)


ASKED_WORDS = "p int, chunk long, words binary, counts binary"
WORDS = "what string, p int, chunk long, ranks binary, r long, n long, start long, words binary, counts binary"


def _ask_words(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _each(batch):
                words, counts = np.frombuffer(r["words"], dtype=np.uint64), unpack(r["counts"])
                owner = _owner(words >> np.uint64(40), groups)
                order = np.argsort(owner, kind="stable")
                yield from _batches([{"p": p, "chunk": r["chunk"], "words": words[order[s]].tobytes(), "counts": pack(counts[order[s]])}
                                     for p, s in _runs(owner[order])], ASKED_WORDS)

    return run


def _answer_words(asked: pa.Table) -> pa.Table:
    """Counts the words of a group and ranks those of training texts by falling count; a chunk gets rank + 1, or 0 for words not seen."""
    rows = asked.to_pylist()
    p = rows[0]["p"]
    lists = [np.frombuffer(r["words"], dtype=np.uint64) for r in rows]
    words, at = np.unique(np.concatenate(lists), return_inverse=True)
    counts = np.zeros(len(words), dtype=np.int64)
    np.add.at(counts, at, np.concatenate([unpack(r["counts"]) for r in rows]))
    order = np.lexsort((words, -counts))
    order = order[counts[order] > 0]
    rank = np.zeros(len(words), dtype=np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    bounds = np.cumsum([0, *map(len, lists)])
    out = [{"what": "reply", "p": p, "chunk": r["chunk"], "ranks": pack(rank[at[a:b]])} for r, a, b in zip(rows, bounds[:-1], bounds[1:], strict=True)]
    falling = counts[order]
    out += [{"what": "step", "p": p, "r": r, "n": s.stop - s.start, "start": s.start} for r, s in _runs(falling)]
    out.append({"what": "model", "p": p, "words": words[order].tobytes(), "counts": pack(falling)})
    return _table(out, WORDS)


NUMBERED = "chunk long, p int, numbers binary"


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks inside a group become numbers among all words, plus one; 0 stays."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            ranks = unpack(r["ranks"])
            steps = np.array([(s["start"], s["shift"]) for s in r["steps"] or []], dtype=np.int64).reshape(-1, 2)
            known = ranks > 0
            if known.any():
                ranks[known] += steps[np.searchsorted(steps[:, 0], ranks[known] - 1, side="right") - 1, 1]
            out.append({"chunk": r["chunk"], "p": r["p"], "numbers": pack(ranks)})
        yield from _batches(out, NUMBERED)


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing's factors of counts 0 to LARGEST, from n[r], the number of types seen r times (r up to LARGEST + 1).

    A factor outside (0, 1), as sparse or copied data give it, is replaced by that of absolute discounting,
    (r - b) / r with b = n1 / (n1 + 2 n2), 0.9 at most.
    """
    b = min(0.9, n[1] / (n[1] + 2 * n[2])) if n[1] else 0.0
    over = (LARGEST + 1) * n[LARGEST + 1] / n[1] if n[1] else 1.0
    out = [1.0]
    for r in range(1, LARGEST + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - over) / (1 - over) if n[r] and over != 1 else 0.0
        out.append(d if 0 < d < 1 else (r - b) / r)
    return np.array(out)


class Unigrams(NamedTuple):
    """Probabilities of words by number; `size` is the number of words, also the number of the start of a text, and size + 1 that of unknown words."""

    starts: np.ndarray  # least number of each count, rising
    counts: np.ndarray  # that count, falling
    size: int
    total: int
    texts: int  # training texts, so often the start is a context
    factors: np.ndarray

    def count(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers), dtype=np.int64)
        known = numbers < self.size
        if self.size:
            out[known] = self.counts[np.searchsorted(self.starts, numbers[known], side="right") - 1]
        return np.where(numbers == self.size, self.texts, out)

    def probability(self, numbers: np.ndarray) -> np.ndarray:
        c = self.count(numbers)
        seen = np.where(c <= LARGEST, self.factors[np.minimum(c, LARGEST)], 1.0) * c / (self.total + 1)
        return np.where(numbers > self.size, self.unknown(), seen)

    def unknown(self) -> float:
        """What the words seen leave over: the discounts, and one word more than there are."""
        freed = sum((1 - self.factors[r]) * r * n for r, n in self.low().items() if r <= LARGEST)
        return (1 + freed) / (self.total + 1)

    def low(self) -> dict[int, int]:
        widths = np.diff(np.append(self.starts, self.size))
        return {int(r): int(n) for r, n in zip(self.counts, widths, strict=True) if r <= LARGEST + 1}


class Pairs:
    """The distinct pairs (context, word) of a chunk, in the order in which it asks for them."""

    def __init__(self, row: dict, groups: int, split: int, model: Unigrams):
        self.sizes, tokens, slots = unpack(row["sizes"]), unpack(row["tokens"]), unpack(row["slots"])
        numbers = np.zeros(len(slots) + 1, dtype=np.int64)
        owner = _owner(slots, row["word_groups"])
        order = np.argsort(owner, kind="stable")
        replies = sorted(row["replies"], key=lambda r: r["p"])
        numbers[order] = np.concatenate([unpack(r["numbers"]) for r in replies])
        numbers = np.where(numbers > 0, numbers - 1, model.size + 1)
        numbers[-1] = model.size  # the start
        self.words = numbers[tokens]
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        self.starts = np.cumsum(self.sizes) - self.sizes
        before[self.starts] = len(slots)
        self.train = np.repeat(np.array(row["train"], dtype=bool), self.sizes)
        keys, self.at = np.unique(before << 32 | tokens, return_inverse=True)
        self.h, self.w = numbers[keys >> 32], numbers[keys & 0xFFFFFFFF]
        self.times = model.count(self.h)
        self.counts = np.bincount(self.at[self.train], minlength=len(keys))
        # contexts not seen go back to the word at once
        self.asked = np.flatnonzero(self.times > 0)
        h, w = self.h[self.asked], self.w[self.asked]
        parts = (self.times[self.asked] // split + 1).astype(np.uint64)
        group = _owner(mixed(h.astype(np.uint64) * R1 + mixed(w.astype(np.uint64)) % parts) >> np.uint64(40), groups)
        order = np.lexsort((w, h, group))
        self.asked, self.group = self.asked[order], group[order]


ASKED_PAIRS = "q int, chunk long, h binary, w binary, n binary"
LOW = [f"n{r}" for r in range(1, LARGEST + 1)]
STATS = ", ".join(f"{c} long" for c in LOW) + ", big long, seen double"
PAIRS = f"what string, q int, chunk long, counts binary, few binary, seen_of binary, h long, r long, n long, hs binary, ws binary, {STATS}"


def _ask_pairs(groups: int, split: int, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _each(batch):
                pairs = Pairs(r, groups, split, model.value)
                out = []
                for q, s in _runs(pairs.group):
                    own = pairs.asked[s]
                    out.append({"q": q, "chunk": r["chunk"], "h": pack(np.diff(pairs.h[own], prepend=0)), "w": pack(pairs.w[own]), "n": pack(pairs.counts[own])})
                yield from _batches(out, ASKED_PAIRS)

    return run


def _answer_pairs(split: int, model):
    """Counts the pairs of a group.  A chunk gets the count of each pair it asked for, and for contexts with a pair not seen what their
    backoff weight is made of; those of contexts dealt over several groups are told as rows and summed up later."""

    def run(asked: pa.Table) -> pa.Table:
        known, rows = model.value, asked.to_pylist()
        q = rows[0]["q"]
        hs = [np.cumsum(unpack(r["h"])) for r in rows]
        h, w = np.concatenate(hs), np.concatenate([unpack(r["w"]) for r in rows])
        order = np.lexsort((w, h))
        fresh = np.flatnonzero((np.diff(h[order], prepend=-1) != 0) | (np.diff(w[order], prepend=-1) != 0))
        sums = np.add.reduceat(np.concatenate([unpack(r["n"]) for r in rows])[order], fresh)
        count = np.empty(len(h), dtype=np.int64)
        count[order] = np.repeat(sums, np.diff(np.append(fresh, len(h))))
        types = fresh[sums > 0]
        th, tw, tc = h[order[types]], w[order[types]], sums[sums > 0]
        contexts, of = np.unique(th, return_inverse=True)
        sized = lambda mask, weights: np.bincount(of[mask], weights=weights[mask], minlength=len(contexts))
        ones = np.ones(len(tc))
        few = np.stack([sized(tc == r, ones) for r in range(1, LARGEST + 1)] + [sized(tc > LARGEST, tc.astype(float))], axis=1).astype(np.int64)
        seen = sized(tc > 0, known.probability(tw))
        shared = known.count(contexts) >= split
        out = [{"what": "hist", "q": q, "r": r, "n": int((tc == r).sum())} for r in range(1, LARGEST + 2)]
        out.append({"what": "model", "q": q, "hs": pack(np.diff(th, prepend=0)), "ws": pack(tw), "counts": pack(tc)})
        for k in np.flatnonzero(shared):
            out.append({"what": "part", "h": int(contexts[k]), "seen": float(seen[k]), "big": int(few[k, -1])} | dict(zip(LOW, few[k, :-1].tolist(), strict=True)))
        begin = 0
        for r, own in zip(rows, hs, strict=True):
            c = count[begin:begin + len(own)]
            begin += len(own)
            missing = np.unique(own[c == 0])
            dealt = known.count(missing) >= split
            at = np.searchsorted(contexts, missing[~dealt])
            out.append({"what": "reply", "q": q, "chunk": r["chunk"], "counts": pack(c), "few": pack(few[at].reshape(-1)), "seen_of": seen[at].tobytes()})
            out += [{"what": "need", "chunk": r["chunk"], "h": x} for x in missing[dealt].tolist()]
        return _table(out, PAIRS)

    return run


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _backoff(pairs: Pairs, row: dict, unknown: np.ndarray, split: int, factors: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 of the backoff weight of the context of each pair in `unknown` (places among the asked, whose `counts` are 0)."""
    h, times = pairs.h[pairs.asked], pairs.times[pairs.asked]
    hs, few, seen = [], [], []
    bounds = {q: s for q, s in _runs(pairs.group)}
    for r in row["pair_replies"]:
        s = bounds[r["q"]]
        missing = (counts[s] == 0) & (times[s] < split)
        hs.append(np.unique(h[s][missing]))
        few.append(unpack(r["few"]).reshape(-1, LARGEST + 1)[:, :-1])
        seen.append(np.frombuffer(r["seen_of"], dtype=np.float64))
    for r in row["shared"] or []:
        hs.append(np.array([r["h"]]))
        few.append(np.array([[r[c] for c in LOW]]))
        seen.append(np.array([r["seen"]]))
    all_h, all_few, all_seen = np.concatenate(hs), np.concatenate(few), np.concatenate(seen)
    order = np.argsort(all_h)
    at = order[np.searchsorted(all_h[order], h[unknown])]
    freed = 1 + (all_few[at] * (1 - factors[1:]) * np.arange(1, LARGEST + 1)).sum(axis=1)
    return np.log10(freed / (times[unknown] + 1)) - np.log10(1 - all_seen[at])


def _scored(groups: int, split: int, model, factors: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            for r in _each(batch):
                pairs = Pairs(r, groups, split, known)
                log_p = np.log10(known.probability(pairs.w))
                if len(pairs.asked):
                    r["pair_replies"].sort(key=lambda x: x["q"])
                    counts = np.concatenate([unpack(x["counts"]) for x in r["pair_replies"]])
                    seen, unknown = np.flatnonzero(counts > 0), np.flatnonzero(counts == 0)
                    c = counts[seen]
                    d = np.where(c <= LARGEST, factors[np.minimum(c, LARGEST)], 1.0)
                    log_p[pairs.asked[seen]] = np.log10(d * c / (pairs.times[pairs.asked[seen]] + 1))
                    if len(unknown):
                        log_p[pairs.asked[unknown]] += _backoff(pairs, r, unknown, split, factors, counts)
                token_counts = known.count(pairs.words)
                base = np.log10((token_counts + 0.1) / (known.total + 0.1 * (known.size + 1)))
                of_text = lambda x: np.add.reduceat(x, pairs.starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], type=pa.int64()), pa.array([not t for t in r["train"]]), pa.array(pairs.sizes),
                     pa.array(of_text((token_counts > 0).astype(np.int64))), pa.array(np.full(len(pairs.sizes), known.total)),
                     pa.array(of_text(base)), pa.array(of_text(log_p[pairs.at]))], names=[f.split()[0] for f in RESULT.split(", ")])

    return run


class Model(NamedTuple):
    """The tables of a model: `words` (p, words, counts: 64-bit hashes by falling count, numbers of a group), `pairs` (q, hs, ws, counts:
    numbers of context, as differences, and word), and what the driver knows of all of them."""

    words: DataFrame
    pairs: DataFrame
    unigrams: Unigrams
    pair_factors: np.ndarray


def _groups(items: int, per_group: int) -> int:
    return min(MOST_GROUPS, items // per_group + 1)


def learn_and_score(docs: DataFrame, train: Column, ident: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES,
                    group_items: int = GROUP_ITEMS, split: int = SPLIT) -> tuple[DataFrame, Model]:
    """RESULT for every document, by a model of those for which `train` holds, and the model's tables.

    Tokens are words (runs of what is no white space, A-Z lower-cased) and one end a text; the context of a token is the one before,
    or the start.  With c the count of a pair, c(h) that of its context, d Good-Turing's discount (`discounts`):
    P(w|h) = d c / (c(h) + 1) if the pair is seen, else a(h) P(w), and P(w) if the context is not; P(w) = d c(w) / (N + 1),
    and all words never seen share what is left as one word.  a(h) makes the words after h add up to 1; the one in
    the denominators leaves something over even where no count is small enough for a discount.  `score` is the sum of log10 P.
    `base_score` adds log10((c + 0.1) / (N + 0.1 (V + 1))) of the same tokens.

    Words are told apart by 64-bit hashes.  A chunk's words and pairs move once each, however often they occur; a context seen `split`
    times or more is dealt over several groups.  On a much larger corpus, raise `chunk_bytes` and `group_items` with
    the memory of the tasks: a question to a group should hold many items.

    Null texts count as empty: one end.  Rows alike are scored alike and counted each; without training rows every word is
    unknown and scores 0.  An empty table gives no rows; columns other than id and text are read only by `train`.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(ident).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chunks = written(rows.mapInArrow(_chunked(chunk_bytes), CHUNK))
    n_words, n_tokens, total, texts = chunks.agg(
        F.sum("n_words"), F.sum("n_tokens"), F.sum("n_train"), F.sum(F.size(F.filter("train", lambda t: t)))).first()
    word_groups, groups = _groups(n_words or 0, group_items), _groups(n_tokens or 0, group_items)
    words = written(chunks.select("chunk", "words", "counts").mapInArrow(_ask_words(word_groups), ASKED_WORDS).groupBy("p").applyInArrow(_answer_words, WORDS))
    # numbers by falling count: how many words have a greater count, then those of earlier groups with the same
    steps = words.where("what = 'step'").select("p", "r", "n", "start")
    falling = Window.orderBy(F.desc("r")).rowsBetween(Window.unboundedPreceding, -1)
    levels = written(steps.groupBy("r").agg(F.sum("n").alias("n")).select("r", F.col("n").alias("all"), F.coalesce(F.sum("n").over(falling), F.lit(0)).alias("above")))
    earlier = Window.partitionBy("r").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    shifts = steps.join(levels, "r").withColumn("shift", F.col("above") + F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("start")) \
        .groupBy("p").agg(F.array_sort(F.collect_list(F.struct("start", "shift"))).alias("steps"))
    numbers = words.where("what = 'reply'").select("p", "chunk", "ranks").join(shifts, "p", "left").mapInArrow(_number, NUMBERED)
    by_chunk = written(numbers.groupBy("chunk").agg(F.collect_list(F.struct("p", "numbers")).alias("replies")))
    table = levels.orderBy("above").collect()  # a row per distinct count
    size = sum(x["all"] for x in table)
    unigrams = Unigrams(np.array([x["above"] for x in table], dtype=np.int64), np.array([x["r"] for x in table], dtype=np.int64), size, total or 0, texts or 0, np.ones(LARGEST + 1))
    low = unigrams.low()
    unigrams = unigrams._replace(factors=discounts([0] + [low.get(r, 0) for r in range(1, LARGEST + 2)]))
    model = spark.sparkContext.broadcast(unigrams)
    numbered = chunks.select("chunk", "ids", "train", "sizes", "tokens", "slots", F.lit(word_groups).alias("word_groups")).join(by_chunk, "chunk")
    pairs = written(numbered.mapInArrow(_ask_pairs(groups, split, model), ASKED_PAIRS).groupBy("q").applyInArrow(_answer_pairs(split, model), PAIRS))
    hist = {r["r"]: r["n"] for r in pairs.where("what = 'hist'").groupBy("r").agg(F.sum("n").alias("n")).collect()}
    factors = discounts([0] + [hist.get(r, 0) for r in range(1, LARGEST + 2)])
    stats = [*LOW, "big", "seen"]
    parts = pairs.where("what = 'part'").groupBy("h").agg(*[F.sum(c).alias(c) for c in stats])
    shared = pairs.where("what = 'need'").select("chunk", "h").distinct().join(parts, "h") \
        .groupBy("chunk").agg(F.collect_list(F.struct("h", *stats)).alias("shared"))
    replies = pairs.where("what = 'reply'").groupBy("chunk").agg(F.collect_list(F.struct("q", "counts", "few", "seen_of")).alias("pair_replies"))
    answered = numbered.join(replies, "chunk", "left").join(shared, "chunk", "left")
    tables = Model(words.where("what = 'model'").select("p", "words", "counts"), pairs.where("what = 'model'").select("q", "hs", "ws", "counts"), unigrams, factors)
    return answered.mapInArrow(_scored(groups, split, model, factors), RESULT), tables
