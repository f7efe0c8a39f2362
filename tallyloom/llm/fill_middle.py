"""Fill-in-the-middle: a text is cut at two places and its parts are put in an order that asks for the middle last.

Both cuts are counted in units: code points, words, lines or sentences.  Every byte of a text gets one of seven
classes (what it is and whether a word begins there); a wavelet matrix over the classes counts the units before
any place as a sum of ranks, and bisection on those ranks finds the byte where a given number of units ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import SPACES, bounded_batches
from tallyloom.llm.wavelet import WaveletMatrix

CONTINUATION, NEWLINE, BLANK, BODY, HEAD, MARK, MARK_HEAD = range(7)
CLASS_BITS = 3
# unit: the classes that count it, and whether they begin a unit or end one
UNITS = {"char": ((NEWLINE, BLANK, BODY, HEAD, MARK, MARK_HEAD, 7), "begin"), "word": ((HEAD, MARK_HEAD), "begin"),
         "line": ((NEWLINE,), "end"), "sentence": ((MARK, MARK_HEAD), "end")}
MARKERS = ("<P>", "<S>", "<M>")
CHUNK_BYTES = 4 << 20  # texts are handled so many bytes at a time, or one by one if they are longer

RESULT = ("doc_id long, n long, form string, prefix_units long, middle_units long, prefix_chars long, middle_chars long, output string")


def _byte_table() -> np.ndarray:
    table = np.full(256, BODY, dtype=np.uint8)
    table[0x80:0xC0] = CONTINUATION
    table[[ord(c) for c in SPACES]] = BLANK
    table[ord("\n")] = NEWLINE
    table[[ord(c) for c in ".!?"]] = MARK
    return table


BYTE_CLASS = _byte_table()


def classes_of(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each byte of concatenated texts that begin at `starts`."""
    kind = BYTE_CLASS[raw]
    space = (kind == BLANK) | (kind == NEWLINE)
    fresh = np.ones(len(raw), dtype=bool)
    fresh[1:] = space[:-1]
    fresh[starts] = True
    kind[fresh & (kind == BODY)] = HEAD
    kind[fresh & (kind == MARK)] = MARK_HEAD
    return kind


class Units:
    """Counts of units in texts laid end to end, and where they end."""

    def __init__(self, texts: list[bytes], unit: str):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.matrix = WaveletMatrix(classes_of(raw, self.starts[sizes > 0]), CLASS_BITS)
        self.symbols, self.side = UNITS[unit]
        marks = self.matrix.rank_any(self.symbols, self.ends) - self.matrix.rank_any(self.symbols, self.starts)
        if self.side == "end":  # what follows the last mark is a unit of its own
            marks = marks + (self.matrix.after(self.symbols, marks, self.starts, self.ends) < self.ends)
        self.counts = marks

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Bytes of each text before its (k+1)-th unit; all where k is the number of units.

        What stands before the first unit that begins (blanks before the first word) goes with it, unless
        there is no unit at all: then every cut is at 0.
        """
        if self.side == "begin":
            at = self.matrix.after(self.symbols, k + 1, self.starts, self.ends) - (k < self.counts)
            at = np.where(k == 0, self.starts, at)
        else:
            at = self.matrix.after(self.symbols, k, self.starts, self.ends)
        return at - self.starts

    def chars(self, at: np.ndarray) -> np.ndarray:
        """Code points before byte `at` of each text."""
        symbols = UNITS["char"][0]
        return self.matrix.rank_any(symbols, self.starts + at) - self.matrix.rank_any(symbols, self.starts)


def _chunks(texts: list[bytes]) -> Iterator[slice]:
    begin, held = 0, 0
    for k, t in enumerate(texts):
        if k > begin and held + len(t) > CHUNK_BYTES:
            yield slice(begin, k)
            begin, held = k, 0
        held += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def _formed(ids: list, texts: list[bytes], draws: np.ndarray, unit: str, rate: int, spm: int, markers: tuple[str, str, str]) -> pa.RecordBatch:
    units = Units(texts, unit)
    places = draws[:, :2] % (units.counts + 1)[:, None]
    low, high = places.min(axis=1), places.max(axis=1)
    first, second = units.cut(low), units.cut(high)
    chars = units.chars(first), units.chars(second)
    p, s, m = (x.encode() for x in markers)
    rows = []
    for k, text in enumerate(texts):
        if not text or p in text or s in text or m in text or draws[k, 2] % 100 >= rate:
            rows.append(("plain", None, None, None, None, text))
            continue
        prefix, middle, suffix = text[:first[k]], text[first[k]:second[k]], text[second[k]:]
        form = "spm" if draws[k, 3] % 100 < spm else "psm"
        parts = (s, suffix, p, prefix, m, middle) if form == "spm" else (p, prefix, s, suffix, m, middle)
        rows.append((form, int(low[k]), int(high[k] - low[k]), int(chars[0][k]), int(chars[1][k] - chars[0][k]), b"".join(parts)))
    form, a, b, c, d, out = zip(*rows, strict=True)
    longs = [pa.array(x, type=pa.int64()) for x in (a, b, c, d)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, type=pa.int64()), pa.array(units.counts), pa.array(form), *longs, pa.array(out, type=pa.binary()).cast(pa.string())],
        names=[f.split()[0] for f in RESULT.split(", ")])


def fill_middle(docs: DataFrame, ident: str = "doc_id", text: str = "text", unit: str = "char", seed: int = 1, rate: int = 90, spm: int = 20,
                markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """One row per document: RESULT, for the whole text in `n` units.

    h1 to h4 are the first four groups of eight digits, as unsigned integers, of the hexadecimal SHA-256 of `seed:id`, so
    reruns and retried tasks agree.  The prefix ends after the smaller of h1 % (n+1) and h2 % (n+1) units, the middle
    after the larger; the suffix is the rest.  `form` is "plain" (output: the text; counts null) for empty texts, texts
    that contain a marker, and where h3 % 100 >= `rate`; "spm" (suffix, prefix, middle) where h4 % 100 < `spm`, else
    "psm".  Prefix, suffix and middle each follow their marker; `markers` are those of the three parts.

    `unit` is "char" (code points), "word" (a word and the blanks after it; blanks before the first go with it), "line" or
    "sentence" (up to and with a newline, or one of .!?).  Null texts count as empty; the id "null" stands for a null one;
    rows alike get rows alike; an empty table gives none; columns other than id and text are not read.
    """
    bounded_batches(docs.sparkSession)
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(ident).cast("string"), F.lit("null"))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k}") for k in range(4)]
    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *draws)

    def formed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            h = np.stack([batch.column(f"h{k}").to_numpy(zero_copy_only=False) for k in range(4)], axis=1)
            for part in _chunks(texts):
                yield _formed(ids[part], texts[part], h[part], unit, rate, spm, markers)

    return rows.mapInArrow(formed, RESULT)


def restored(output: str | Column, form: str | Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that `output` was made of.  No part holds a marker, so the first of each kind is where it was put."""
    out, kind = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    p, s, m = markers
    head, middle = F.substring_index(out, m, 1), F.substring_index(out, m, -1)

    def two(first: str, second: str) -> tuple[Column, Column]:
        body = head.substr(F.lit(len(first) + 1), F.length(head))
        return F.substring_index(body, second, 1), F.substring_index(body, second, -1)

    prefix, suffix = two(p, s)
    suffix2, prefix2 = two(s, p)
    return F.when(kind == "psm", F.concat(prefix, middle, suffix)).when(kind == "spm", F.concat(prefix2, middle, suffix2)).otherwise(out)
