"""Conversation structure repair: the cheapest edits that make a conversation an optional system message and turns of user and assistant.

The edits are the ASCII-least among the cheapest.  A dynamic programme runs backward over the messages, with the least cost
to the end from each of four states (nothing yet, after system, after user, after assistant).  Its cost vectors are stored
only at checkpoints, as many as the square root of the length; the blocks between are recomputed while walking forward to
emit the edits.  The same holds across tasks: conversations are range-sorted, each task holds a bounded segment of one at a
time, and a segment that does not hold its whole conversation leaves a 4 x 4 matrix of costs and a byte a message.  The
vectors between such segments come from the matrices alone, and each segment is then walked by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from math import isqrt
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import SPACES, bounded_batches
from tallyloom.scale import written

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.  The role that may be inserted leads to NEXT[state].
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
SYSTEM, USER, ASSISTANT, OTHER = range(4)
# state to which keeping a message of the class leads
KEPT = {SYSTEM: {0: 1}, USER: {0: 2, 1: 2, 3: 2}, ASSISTANT: {2: 3}, OTHER: {}}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
CLEAN, TRUNCATED, BLANK, REPEATED = range(4)  # what is wrong with a message; the last two must go
REROLE, DELETE, INSERT = 2, 3, 2
# least cost from each state when nothing follows: nothing and assistant may end, else user and assistant are inserted
AT_END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 60
SEGMENT_BYTES = 32 << 20  # of messages held by a task at once
ROW_BYTES = 100  # what a message takes besides its text

Vector = tuple[int, int, int, int]


def before(after: Vector, code: int, extra: int) -> Vector:
    """Least costs before a message from those after it; `extra` copies of it follow, which must go."""
    a0, a1, a2, a3 = (c + DELETE * extra for c in after)
    b0, b1, b2, b3 = a0 + DELETE, a1 + DELETE, a2 + DELETE, a3 + DELETE
    kind, fault = code & 3, code >> 2
    if fault < BLANK:
        to_user, to_assistant = a2 + fault, a3 + fault  # a truncated message that stays costs one
        if kind == ASSISTANT:
            b2 = min(b2, to_assistant)
        else:
            b2 = min(b2, to_assistant + REROLE)
        if kind != USER:
            to_user += REROLE
        b0, b1, b3 = min(b0, to_user), min(b1, to_user), min(b3, to_user)
        if kind == SYSTEM:
            b0 = min(b0, a1 + fault)
    # insertions in front of it
    c2, c3 = min(b2, b3 + INSERT), min(b3, b2 + INSERT)
    return min(b0, c2 + INSERT), min(b1, c2 + INSERT), c2, c3


def walk(codes: bytes, extras: dict[int, int], end: Vector, last: bool, entries: Sequence[int]) -> list[tuple[bytes, int, int]]:
    """(edits, state after, cost) from each of the entry states; `end` holds the costs after the messages, `last` whether nothing follows.

    Keeps one vector a block of the square root of the length, and those of one block at a time.
    """
    n = len(codes)
    block = isqrt(max(n - 1, 0)) + 1
    stored, v = {n: end}, end
    for i in range(n - 1, -1, -1):
        v = before(v, codes[i], extras.get(i, 0))
        if i % block == 0:
            stored[i] = v
    states, edits, costs = list(entries), [bytearray() for _ in entries], [0] * len(entries)
    for start in range(0, n, block):
        stop = min(start + block, n)
        inside = [stored[stop]]
        for i in range(stop - 1, start - 1, -1):
            inside.append(before(inside[-1], codes[i], extras.get(i, 0)))
        for i in range(start, stop):
            here, after = inside[stop - i], inside[stop - i - 1]
            code, extra = codes[i], extras.get(i, 0)
            kind, fault = code & 3, code >> 2
            for k, q in enumerate(states):
                # the least letter that keeps the cost least: D, I, K, R
                while here[q] != after[q] + DELETE * (extra + 1) and here[q] == here[NEXT[q]] + INSERT:
                    edits[k].append(73)
                    costs[k] += INSERT
                    q = NEXT[q]
                if here[q] == after[q] + DELETE * (extra + 1):
                    edits[k].append(68)
                    costs[k] += DELETE
                elif q in KEPT[kind] and here[q] == after[KEPT[kind][q]] + fault + DELETE * extra:
                    edits[k].append(75)
                    costs[k] += fault
                    q = KEPT[kind][q]
                else:
                    edits[k].append(82)
                    costs[k] += REROLE + fault
                    q = NEXT[q]
                if extra:
                    edits[k] += b"D" * extra
                    costs[k] += DELETE * extra
                states[k] = q
    if last:
        for k, q in enumerate(states):
            while AT_END[q]:
                edits[k].append(73)
                costs[k] += INSERT
                q = NEXT[q]
            states[k] = q
    return [(bytes(e), q, c) for e, q, c in zip(edits, states, costs, strict=True)]


def across(codes: bytes, extras: dict[int, int]) -> list[int]:
    """Sixteen costs: from state q before the messages to state e after them, at 4 q + e."""
    columns = []
    for e in range(4):
        v = tuple(0 if q == e else FAR for q in range(4))
        for i in range(len(codes) - 1, -1, -1):
            v = before(v, codes[i], extras.get(i, 0))
        columns.append(v)
    return [min(columns[e][q], FAR) for q in range(4) for e in range(4)]


def applied(edits: bytes, codes: bytes, extras: dict[int, int], entry: int) -> Iterator[tuple[int | None, str | None, str]]:
    """(message, new role, letter) of each message of the result in order: no message for an insertion, no role where it is kept."""
    q, k = entry, 0
    i = 0
    while i < len(edits):
        letter = edits[i:i + 1].decode()
        i += 1
        if letter == "I":
            q = NEXT[q]
            yield None, ROLE[q], letter
            continue
        if letter == "K":
            q = KEPT[codes[k] & 3][q]
            yield k, None, letter
        elif letter == "R":
            q = NEXT[q]
            yield k, ROLE[q], letter
        i += extras.get(k, 0)
        k += 1


class Segment:
    """Messages of one conversation, in order, as a task holds them."""

    def __init__(self, conv, at_start: bool):
        self.conv, self.open, self.held = conv, at_start, 0
        self.codes, self.extras, self.rows = bytearray(), {}, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn, role: str, text: str, n: int, code: int) -> None:
        kind, fault = code & 3, code >> 2
        if self.codes:
            self.illegal += (self.codes[-1] & 3, kind) not in LEGAL
        self.illegal += n - 1
        if n > 1:
            self.extras[len(self.codes)] = n - 1
        self.codes.append(code)
        self.rows.append((role, text))
        self.held += ROW_BYTES + len(text) + len(role)
        if fault == BLANK:
            self.blank += n
        else:
            self.duplicate += n if fault == REPEATED else n - 1
            self.truncated += fault == TRUNCATED
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def summary(self) -> dict:
        return {"blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "first_kind": self.codes[0] & 3, "last_kind": self.codes[-1] & 3, "turns": self.turns,
                "first_turn": self.first_turn, "last_turn": self.last_turn}


SUMMARY = "blank long, duplicate long, truncated long, illegal long, first_kind int, last_kind int, turns long, first_turn long, last_turn long"
STAGED = ("what string, part int, seg int, conv_id long, place long, role string, text string, edit string, "
          "codes binary, extra_at binary, extra_n binary, matrix array<long>, audit string, cost long, " + SUMMARY)
_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
          "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], type=_TYPES[t]) for c, t in fields], names=[c for c, _ in fields])


def _unpacked(row: dict) -> tuple[bytes, dict[int, int]]:
    at, n = (np.frombuffer(row[c], dtype=np.int64).tolist() for c in ("extra_at", "extra_n"))
    return row["codes"], dict(zip(at, n, strict=True))


def _closed(s: Segment, at: dict, whole: bool) -> list[dict]:
    """Staged rows of a segment: its result if it is a whole conversation, else what later steps need."""
    codes = bytes(s.codes)
    if whole:
        edits, _, cost = walk(codes, s.extras, AT_END, True, [0])[0]
        out = [at | s.summary() | {"what": "piece", "audit": edits.decode(), "cost": cost}]
        for place, (k, role, letter) in enumerate(applied(edits, codes, s.extras, 0)):
            out.append(at | {"what": "message", "place": place, "edit": letter, "role": role or s.rows[k][0], "text": "" if k is None else s.rows[k][1]})
        return out
    pack = lambda x: np.array(list(x), dtype=np.int64).tobytes()
    out = [at | s.summary() | {"what": "open", "codes": codes, "extra_at": pack(s.extras), "extra_n": pack(s.extras.values()),
                               "matrix": across(codes, s.extras)}]
    return out + [at | {"what": "raw", "place": k, "role": role, "text": text} for k, (role, text) in enumerate(s.rows)]


def _segments(limit: int):
    """Reads a sorted partition and closes a segment where the conversation changes, the partition ends or `limit` bytes are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, number, out, size = None, 0, [], 0

        def close(whole: bool) -> None:
            nonlocal number, size
            out.extend(_closed(held, {"part": part, "seg": number, "conv_id": held.conv}, whole))
            size += held.held
            number += 1

        for batch in batches:
            for conv, turn, role, text, n, code in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "code")), strict=True):
                if held is None:
                    held = Segment(conv, True)
                elif conv != held.conv:
                    close(not held.open)
                    held = Segment(conv, False)
                elif held.held > limit:
                    close(False)
                    held = Segment(conv, True)
                if size > limit or len(out) > 5000:
                    yield _batch(out, STAGED)
                    out.clear()
                    size = 0
                held.add(turn, role, text, n, code)
        if held is not None:
            close(False)
            yield _batch(out, STAGED)

    return run


def _ends(group: pd.DataFrame) -> pd.DataFrame:
    """Costs after each open segment of a conversation, from the segments behind it."""
    ordered = group.sort_values(["part", "seg"], ascending=False)
    end, ends = AT_END, []
    for matrix in ordered["matrix"]:
        ends.append(list(end))
        end = tuple(min(int(matrix[4 * q + e]) + end[e] for e in range(4)) for q in range(4))
    last = [True] + [False] * (len(ends) - 1)
    return pd.DataFrame({"part": ordered["part"], "seg": ordered["seg"], "end": ends, "last": last})


def _entries(group: pd.DataFrame) -> pd.DataFrame:
    """The state in which the walk enters each open segment of a conversation."""
    ordered = group.sort_values(["part", "seg"])
    q, entries = 0, []
    for exits in ordered["exits"]:
        entries.append(q)
        q = int(exits[q])
    return pd.DataFrame({"part": ordered["part"], "seg": ordered["seg"], "entry": entries})


WALKED = "part int, seg int, conv_id long, audits array<string>, exits array<int>, costs array<long>"
PLACED = "part int, seg int, at long, place long, role string, edit string"


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            codes, extras = _unpacked(r)
            found = walk(codes, extras, tuple(r["end"]), r["last"], range(4))
            rows.append({c: r[c] for c in ("part", "seg", "conv_id")} |
                        {"audits": [a.decode() for a, _, _ in found], "exits": [q for _, q, _ in found], "costs": [c for _, _, c in found]})
        yield _batch(rows, WALKED)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which message of an open segment, by its number there, takes which place; none for insertions."""
    for batch in batches:
        for r in batch.to_pylist():
            codes, extras = _unpacked(r)
            rows = []
            for place, (k, role, letter) in enumerate(applied(r["audit"].encode(), codes, extras, r["entry"])):
                rows.append({"part": r["part"], "seg": r["seg"], "at": k, "place": place, "role": role, "edit": letter})
                if len(rows) == 50_000:
                    yield _batch(rows, PLACED)
                    rows = []
            yield _batch(rows, PLACED)


class Repair(NamedTuple):
    """`report`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.  `messages`: conv_id, part, seg, place, role, text, edit,
    in the order of (part, seg, place) within a conversation."""

    report: DataFrame
    messages: DataFrame


def _has_word(text: str) -> Column:
    return F.length(F.translate(text, SPACES, "")) > 0


def coded(rows: DataFrame) -> DataFrame:
    """Distinct messages (conv_id, turn, role, text, key) with their number `n`, and `code`: the role's class and the first fault."""
    folded = written(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n")).withColumn("key", F.sha2("text", 256)))
    # roles and texts of a conversation that come at several turns: the first of them stays
    again = written(folded.groupBy("conv_id", "role", "key")
                    .agg(F.count("*").alias("turns"), F.max(F.col("turn").isNull()).alias("at_null"), F.min("turn").alias("at_turn")).where("turns > 1")
                    .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), "at_null", "at_turn"))
    joined = folded.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k")), "left")
    first = F.col("k").isNull() | F.col("turn").isNull() | (~F.col("at_null") & (F.col("turn") == F.col("at_turn")))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    whole = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1).isin(".", "!", "?")
    fault = F.when(~_has_word("text"), BLANK).when(~first, REPEATED).when(whole, CLEAN).otherwise(TRUNCATED)
    return joined.select("conv_id", "turn", "role", "text", "key", "n", (kind + 4 * fault).alias("code"))


def repair(rows: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> Repair:
    """Reports on the conversations of `rows` (conv_id, turn, role, text) and their repaired messages.

    Messages are taken by turn, nulls first, those of one turn by role and SHA-256 of the text.  The first fault of a message
    counts: blank (nothing but white space), duplicate (its role and text seen earlier), truncated (the last character
    that is no white space is none of .!?).  `gaps` is the number of turns missing between the least and the greatest;
    `illegal` counts neighbours whose roles' initials are not su, ua or au.  Edits: keep K (free), delete D (3; blank and
    duplicate messages must go), give another role R (2), insert an empty message I (2); a truncated message that stays costs 1.
    The initials of the roles become `(s?(ua)+)?`; `audit` is the least string of edits among the cheapest.

    Null roles and texts count as one space; a null conv_id is a conversation of its own; rows alike are counted before
    they move, however many there are; texts of any length stay whole; an empty table gives empty results; other columns are
    not read.  A conversation larger than `segment_bytes`, or cut by the range sort, goes through several tasks; its result is the same.
    """
    bounded_batches(rows.sparkSession)
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    order = ["conv_id", "turn", "role", "key"]
    ranged = coded(plain).repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "n", "code")
    staged = written(ranged.mapInArrow(_segments(segment_bytes), STAGED))
    place = ["part", "seg"]
    opened = staged.where("what = 'open'")
    ends = opened.select(*place, "conv_id", "matrix").groupBy("conv_id").applyInPandas(_ends, "part int, seg int, end array<long>, last boolean")
    shapes = opened.select(*place, "conv_id", "codes", "extra_at", "extra_n")
    walked = written(shapes.join(ends, place).mapInArrow(_walked, WALKED))
    entries = walked.select(*place, "conv_id", "exits").groupBy("conv_id").applyInPandas(_entries, "part int, seg int, entry int")
    at = F.col("entry") + 1
    chosen = written(walked.join(entries, place)
                     .select(*place, "entry", F.element_at("audits", at).alias("audit"), F.element_at("costs", at).alias("cost")))
    facts = [f.split()[0] for f in SUMMARY.split(", ")]
    pieces = staged.where("what = 'piece'").select(*place, "conv_id", "audit", "cost", *facts) \
        .unionByName(opened.select(*place, "conv_id", *facts).join(chosen.drop("entry"), place))
    placed = shapes.join(chosen, place).select(*place, "codes", "extra_at", "extra_n", "audit", "entry").mapInArrow(_placed, PLACED)
    raw = staged.where("what = 'raw'").select(*place, F.col("place").alias("at"), "conv_id", F.col("role").alias("old"), "text")
    kept = raw.join(placed.where("at is not null"), [*place, "at"]).select("conv_id", *place, "place", F.coalesce("role", "old").alias("role"), "text", "edit")
    new = placed.where("at is null").join(opened.select(*place, "conv_id"), place) \
        .select("conv_id", *place, "place", "role", F.lit("").alias("text"), "edit")
    done = staged.where("what = 'message'").select("conv_id", *place, "place", "role", "text", "edit")
    return Repair(_report(pieces), done.unionByName(kept).unionByName(new))


def _report(pieces: DataFrame) -> DataFrame:
    """One row per conversation from one row per segment of it."""
    back = Window.partitionBy("conv_id").orderBy("part", "seg")
    legal = " or ".join(f"(last_before = {a} and first_kind = {b})" for a, b in sorted(LEGAL))
    joint = F.when(F.col("last_before").isNull() | F.expr(legal), 0).otherwise(1)
    shared = F.when(F.col("turn_before") == F.col("first_turn"), 1).otherwise(0)
    met = pieces.withColumns({"last_before": F.lag("last_kind").over(back), "turn_before": F.lag("last_turn").over(back)})
    told = met.groupBy("conv_id").agg(
        (F.max("last_turn") - F.min("first_turn") + 1 - F.sum(F.col("turns") - shared)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.sum(F.col("illegal") + joint).alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    return told.withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))


def text_digests(messages: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of `Repair.messages`: SHA-256 of the lines `role:text`, joined by newlines.

    SHA-256 is serial in its bytes, so a conversation's messages stream through one task, which holds a batch and a digest.
    """
    order = ["conv_id", "part", "seg", "place"]
    lines = messages.select(*order, F.concat_ws(":", "role", "text").alias("line"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        schema = "conv_id long, repaired_sha256 string"
        for batch in batches:
            out = []
            for c, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if digest is not None and c == conv:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                    conv, digest = c, hashlib.sha256()
                digest.update(line.encode("utf-8", "surrogatepass"))
            yield _batch(out, schema)
        if digest is not None:
            yield _batch([{"conv_id": conv, "repaired_sha256": digest.hexdigest()}], schema)

    return lines.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(digests, "conv_id long, repaired_sha256 string")
