"""Document fingerprints by locally consistent parsing.

A text is cut into phrases, the phrases' names into longer phrases, and so on up to one root name.  Where to cut is
decided by deterministic coin tossing: a symbol's label is the place and value of the lowest bit in which it differs
from the symbol before, repeated until labels are tiny; phrases begin where labels peak.  A cut depends on a few
symbols around it only, so equal substrings get equal names inside, at whatever offset they stand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import bounded_batches
from tallyloom.llm.hashes import constant, mixed, run_hashes
from tallyloom.scale import written

BINS = 64
SKETCH_LEVELS = (2, 3)  # phrases of about ten and thirty characters
CHUNK_CHARS = 1 << 20
EMPTY = np.uint32(1 << 16)  # a bin without phrases; names take 16 bits


def _coin_labels(values: np.ndarray, first: np.ndarray, rounds: int) -> np.ndarray:
    """Labels under 6 in which neighbours differ, from values in which neighbours differ."""
    for _ in range(rounds):
        before = np.empty_like(values)
        before[1:] = values[:-1]
        before[first] = values[first] ^ np.uint64(1)  # a text's first symbol has none before it: its lowest bit counts
        differ = values ^ before
        low = differ & (~differ + np.uint64(1))
        place = (np.frexp(low.astype(np.float64))[1] - 1).astype(np.uint64)
        values = place * np.uint64(2) + ((values >> place) & np.uint64(1))
    return values


def _parse(symbols: np.ndarray, starts: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """One level: the phrases' names, and where each text's names begin.  A text of one symbol stays as it is."""
    alone = np.diff(np.append(starts, len(symbols))) == 1
    roots = symbols[starts[alone]]
    first = np.zeros(len(symbols), dtype=bool)
    first[starts] = True
    # a run of one symbol becomes a symbol of its own
    change = first.copy()
    change[1:] |= symbols[1:] != symbols[:-1]
    runs = np.flatnonzero(change)
    if len(runs) < len(symbols):
        lengths = np.diff(np.append(runs, len(symbols))).astype(np.uint64)
        symbols = np.where(lengths > 1, mixed(symbols[runs] + lengths * constant(3)), symbols[runs])
        first, starts = first[runs], np.searchsorted(runs, starts)
    labels = _coin_labels(symbols, first, rounds).astype(np.int8)
    n = len(symbols)
    peak = np.zeros(n, dtype=bool)
    peak[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # not beside a text's ends, so that every phrase has two symbols where the text has
    peak[starts] = False
    peak[np.minimum(starts + 1, n - 1)] = False
    ends = np.append(starts[1:], n)
    peak[ends - 1] = False
    peak[starts] = True
    cuts = np.flatnonzero(peak)
    names, starts = run_hashes(symbols, cuts), np.searchsorted(cuts, starts)
    names[starts[alone]] = roots
    return names, starts


def signatures(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Root name and sketch of each text: per bin 16 bits of the least phrase name, or EMPTY."""
    roots = np.zeros(len(texts), dtype=np.uint64)
    least = np.full((len(texts), BINS), np.iinfo(np.uint64).max, dtype=np.uint64)
    own = np.flatnonzero([len(t) > 0 for t in texts])
    if len(own):
        symbols = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        sizes = np.array([len(texts[i]) for i in own])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        level = 0
        while level <= max(SKETCH_LEVELS) or len(symbols) > len(own):
            rounds = 4 if level else 3  # code points have 21 bits: one round less
            symbols, starts = _parse(symbols, starts, rounds)
            level += 1
            if level in SKETCH_LEVELS:
                counts = np.diff(np.append(starts, len(symbols)))
                names = mixed(symbols + constant(level))
                bins = (names >> np.uint64(58)).astype(np.int64)
                np.minimum.at(least.reshape(-1), np.repeat(own, counts) * BINS + bins, names & np.uint64((1 << 58) - 1))
        roots[own] = symbols
    empty = least == np.iinfo(np.uint64).max
    return roots, np.where(empty, EMPTY, (mixed(least) & np.uint64(0xFFFF)).astype(np.uint32)).astype(np.uint32)


def chunked_signatures(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """`signatures` over chunks of bounded size; a text longer than a chunk is one chunk."""
    parts, chunk, held = [], [], 0
    for t in texts:
        if chunk and held + len(t) > CHUNK_CHARS:
            parts.append(signatures(chunk))
            chunk, held = [], 0
        chunk.append(t)
        held += len(t)
    if chunk or not parts:
        parts.append(signatures(chunk))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of the bins, among those either text fills, in which the sketches agree; 1 for two empty ones."""
    either = (a != EMPTY) | (b != EMPTY)
    equal = ((a == b) & either).sum(axis=1)
    return np.where(either.any(axis=1), equal / np.maximum(either.sum(axis=1), 1), 1.0)


def spelled(roots: np.ndarray, sketches: np.ndarray) -> list[str]:
    """Fingerprints as text: the root name, then four digits a bin, dots for an empty one."""
    return [f"{int(r):016x}-" + "".join("...." if x == EMPTY else f"{x:04x}" for x in s.tolist()) for r, s in zip(roots, sketches, strict=True)]


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by the first as many of the following text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
STAGED = "part int, kind string, text string, " + RESULT
_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _batch(columns: dict, schema: str) -> pa.RecordBatch:
    """A record batch in the order of `schema`; columns not given are null."""
    fields = [f.split() for f in schema.split(", ")]
    rows = max(len(v) for v in columns.values())
    return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * rows), type=_TYPES[t]) for c, t in fields], names=[c for c, _ in fields])


def _results(ids: list, texts: list[str], sketches: tuple[np.ndarray, np.ndarray], following: list[str], next_sketch: np.ndarray) -> dict:
    other = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    roots, bins = sketches
    other_roots, other_bins = chunked_signatures(other)
    return {
        "doc_id": ids, "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in other],
        "fingerprint": spelled(roots, bins), "edited_fingerprint": spelled(other_roots, other_bins),
        "near_edited": likeness(bins, other_bins), "near_next": likeness(bins, next_sketch)}


def _sorted_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of a sorted partition but for its last row, whose successor is elsewhere; its ends go along as texts."""
    part = TaskContext.get().partitionId()
    held = None  # the last row so far: id, text, root, sketch
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
        if not texts:
            continue
        roots, bins = chunked_signatures(texts)
        if held is None:
            yield _batch({"part": [part], "kind": ["head"], "doc_id": [ids[0]], "text": [texts[0]]}, STAGED)
        else:
            ids, texts = [held[0], *ids], [held[1], *texts]
            roots, bins = np.concatenate([[held[2]], roots]), np.concatenate([[held[3]], bins])
        n = len(texts) - 1
        if n:
            found = _results(ids[:-1], texts[:-1], (roots[:-1], bins[:-1]), texts[1:], bins[1:])
            yield _batch(found | {"part": [part] * n, "kind": ["done"] * n}, STAGED)
        held = (ids[-1], texts[-1], roots[-1], bins[-1])
    if held is not None:
        yield _batch({"part": [part], "kind": ["tail"], "doc_id": [held[0]], "text": [held[1]]}, STAGED)


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, following = (batch.column(c).to_pylist() for c in ("doc_id", "text", "next_text"))
        if texts:
            yield _batch(_results(ids, texts, chunked_signatures(texts), following, chunked_signatures(following)[1]), RESULT)


def in_order(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """(doc_id, text) range-sorted by id, then by the text's hash; rows alike in both are told apart by where they were read, so ranges split them."""
    order = ["at", "tie", "place"]
    keyed = docs.select(F.col(ident).cast("long").alias("at"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie"),
                        F.monotonically_increasing_id().alias("place"), F.col(text).alias("text"))
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(F.col("at").alias("doc_id"), "text")


def fingerprints(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: RESULT, for the text itself and for its edited form (see `edited`).

    The next document is that with the next higher id; after the last comes the first.  Null ids come
    before all others, rows of equal id in order of their texts' hashes.  The table is range-sorted
    once; each partition is read as a stream, and only its first and last texts meet their neighbours in a
    second step.  Null texts count as empty; an empty text has the root 0 and no phrases; a text alone is
    its own next; an empty table gives no rows; columns other than id and text are not read.
    """
    bounded_batches(docs.sparkSession)
    staged = written(in_order(docs, ident, text).mapInArrow(_sorted_run, STAGED))
    names = [c.split()[0] for c in RESULT.split(", ")]
    done = staged.where("kind = 'done'").select(*names)
    # one row per partition, without its texts
    order = Window.orderBy("part")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = staged.where("kind = 'head'").select("part") \
        .withColumn("next_part", F.coalesce(F.lead("part").over(order), F.first("part").over(everything)))
    heads = staged.where("kind = 'head'").select(F.col("part").alias("head_part"), F.col("text").alias("next_text"))
    tails = staged.where("kind = 'tail'").select(F.col("part").alias("tail_part"), "doc_id", "text")
    last = tails.join(parts, F.col("tail_part") == F.col("part")).join(heads, F.col("next_part") == F.col("head_part")) \
        .select("doc_id", "text", "next_text")
    return done.unionByName(last.mapInArrow(_stitched, RESULT))
