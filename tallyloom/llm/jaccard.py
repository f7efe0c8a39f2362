"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide.

Equal texts are folded into one node first.  Nodes that share the hash of any band are brought
together (as a component of "same bucket as", so that nobody lists the pairs of a bucket) and compared on the texts'
whole n-gram sets.  A component too large for one task is cut into blocks; each pair of blocks is compared by itself,
among the texts that share a bucket across it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import free_name, bounded_batches
from tallyloom.llm.components import connected_components
from tallyloom.llm.hashes import constant, mixed, run_hashes
from tallyloom.scale import written

NGRAM = 5
CHUNK_BYTES = 2 << 20
BLOCK_WEIGHT = 8 << 20  # characters, with DOC_WEIGHT more for each text, that one side of a comparison holds
DOC_WEIGHT = 500
TILE_ROWS, TILE_CELLS = 512, 8 << 20
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def bands_for(threshold: float, recall: float, rows: int = 7) -> int:
    """Bands of `rows` hashes with which a pair at the threshold shares one with probability `recall`."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


def chunk_grams(texts: list[bytes], width: int = NGRAM) -> list[np.ndarray]:
    """Hashes of each text's word n-grams, in order; a text of fewer words has one gram, all its words."""
    none = np.empty(0, dtype=np.uint64)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    inside = np.flatnonzero(~_BLANK[raw])
    if len(inside) == 0:
        return [none] * len(texts)
    first = np.empty(len(inside), dtype=bool)
    first[0] = True
    np.not_equal(np.diff(inside), 1, out=first[1:])
    starts = np.flatnonzero(first)
    words = run_hashes(raw[inside], starts)
    gram = words.copy()
    for k in range(1, width):
        gram[: len(words) - k] += words[k:] * constant(2 * k + 1)
    gram = mixed(gram)
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(inside[starts], ends)])
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        if hi - lo >= width:
            out.append(gram[lo:hi - width + 1])
        elif hi > lo:
            own = np.array([hi - lo], dtype=np.uint64) * constant(99)
            for k in range(hi - lo):
                own = mixed(own + words[lo + k:lo + k + 1] * constant(2 * k + 1))
            out.append(own)
        else:
            out.append(none)
    return out


def grams(texts: Iterator[str | None], width: int = NGRAM) -> Iterator[np.ndarray]:
    """`chunk_grams` over chunks of bounded size; null as empty."""
    chunk, held = [], 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if chunk and held + len(data) > CHUNK_BYTES:
            yield from chunk_grams(chunk, width)
            chunk, held = [], 0
        chunk.append(data)
        held += len(data) + 1
    if chunk:
        yield from chunk_grams(chunk, width)


def band_hashes(sets: list[np.ndarray], bands: int, rows: int, seed: int = 11) -> list[np.ndarray | None]:
    """Per text one hash per band of the least values of `rows` hash functions each; None without grams."""
    full = [k for k, s in enumerate(sets) if len(s)]
    out: list[np.ndarray | None] = [None] * len(sets)
    if not full:
        return out
    draw = np.random.default_rng(seed)
    factors = draw.integers(0, 1 << 32, size=bands * rows, dtype=np.uint32) | np.uint32(1)
    offsets = draw.integers(0, 1 << 32, size=bands * rows, dtype=np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(sets[k]) for k in full])[:-1]])
    x = (np.concatenate([sets[k] for k in full]) >> np.uint64(32)).astype(np.uint32)
    found = np.empty((bands, len(full)), dtype=np.uint64)
    buffer = np.empty_like(x)
    with np.errstate(over="ignore"):
        for b in range(bands):
            h = np.full(len(full), constant(b + 1), dtype=np.uint64)
            for r in range(b * rows, (b + 1) * rows):
                np.multiply(x, factors[r], out=buffer)
                buffer += offsets[r]
                # the product's low bits are weak: fold the high half in before taking the least
                buffer ^= buffer >> np.uint32(15)
                np.multiply(buffer, np.uint32(0x2C1B3C6D), out=buffer)
                h = mixed(h + np.minimum.reduceat(buffer, starts).astype(np.uint64))
            found[b] = h
    for k, h in zip(full, found.T, strict=True):
        out[k] = h.view(np.int64)
    return out


def text_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("key")


def text_nodes(docs: DataFrame, ident: str, text: str, bands: int, rows: int) -> DataFrame:
    """One row per distinct text: (node, key, copies, least_id, size, bands); written, so that node numbers stay."""
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(text_key(text), F.col(ident).cast("long").alias("doc_id"), body.alias("text"))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            hashes: list = []
            chunk, held = [], 0
            for own_grams in grams(iter(texts)):
                chunk.append(own_grams)
                held += len(own_grams)
                if held > 1 << 17:
                    hashes += band_hashes(chunk, bands, rows)
                    chunk, held = [], 0
            hashes += band_hashes(chunk, bands, rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), pa.array([len(t) for t in texts], type=pa.int64()),
                 pa.array(hashes, type=pa.list_(pa.int64()))], names=["key", "doc_id", "size", "bands"])

    found = own.mapInArrow(signed, "key binary, doc_id long, size long, bands array<long>")
    return written(found.groupBy("key").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least_id"), F.first("size").alias("size"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()))


def candidate_components(nodes: DataFrame) -> DataFrame:
    """(node, component) of the nodes that share a band with another; each bucket only points at its least node."""
    hashed = nodes.select("node", F.explode("bands").alias("band"))
    # written: an aggregate beside the rows it is made of would keep a band that a third of the texts share in one task
    centres = written(hashed.groupBy("band").agg(F.min("node").alias("centre"), F.count("*").alias("members")).where("members > 1").select("band", "centre"))
    stars = hashed.join(centres, "band").where("node <> centre").select("node", "centre").distinct()
    # a node has a centre per band at most: it and its other centres point at its least one, so that the members of a
    # large group bring one edge each, and the few centres bring the rest
    least = stars.withColumn("least", F.min("centre").over(Window.partitionBy("node")))
    edges = least.select(F.explode(F.array("node", "centre")).alias("node"), "least").where("node <> least").distinct()
    return connected_components(edges, "node", "least").withColumnRenamed("label", "component")


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, copies: np.ndarray, threshold: float) -> tuple:
    """Over the pairs of texts left x right (or within one list, if both are the same): per text the links to other
    texts and to their copies, and a label that linked texts share."""
    n = len(sets)
    texts, docs, label = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.arange(n)
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    within = left is right
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    every = np.concatenate(sets) if n else np.empty(0, dtype=np.uint64)
    # grams numbered by value; one that only one text has cannot be shared
    order = np.argsort(every, kind="stable")
    value, owner = every[order], owner[order]
    new = np.concatenate([[True], value[1:] != value[:-1]]) if len(value) else np.empty(0, dtype=bool)
    number = np.cumsum(new) - 1
    shared = np.bincount(number)[number] > 1 if len(number) else np.empty(0, dtype=bool)
    owner, number = owner[shared], number[shared]
    if len(number):
        number = np.cumsum(np.concatenate([[True], number[1:] != number[:-1]])) - 1
    grams_seen = int(number[-1]) + 1 if len(number) else 0
    place_left, place_right = np.full(n, -1), np.full(n, -1)
    place_right[right] = np.arange(len(right))
    width = max(1, TILE_CELLS // max(1, len(right) + TILE_ROWS))
    for top in range(0, len(left), TILE_ROWS):
        rows = left[top:top + TILE_ROWS]
        place_left[:] = -1
        place_left[rows] = np.arange(len(rows))
        common = np.zeros((len(rows), len(right)), dtype=np.float32)
        for lo in range(0, grams_seen, width):
            a, b = np.searchsorted(number, [lo, lo + width])
            who, column = owner[a:b], number[a:b] - lo
            mine, theirs = place_left[who] >= 0, place_right[who] >= 0
            if not mine.any() or not theirs.any():
                continue
            # only grams that both sides have
            present = np.zeros(width, dtype=bool)
            present[column[mine]] = True
            on_both = np.zeros(width, dtype=bool)
            on_both[column[theirs]] = True
            on_both &= present
            new_place = np.cumsum(on_both) - 1
            k = int(on_both.sum())
            if not k:
                continue
            mine &= on_both[column]
            theirs &= on_both[column]
            x = np.zeros((len(rows), k), dtype=np.float32)
            x[place_left[who[mine]], new_place[column[mine]]] = 1
            y = np.zeros((len(right), k), dtype=np.float32)
            y[place_right[who[theirs]], new_place[column[theirs]]] = 1
            common += x @ y.T
        union = sizes[rows][:, None] + sizes[right][None, :] - common
        linked = (common >= threshold * union - 1e-9) & (union > 0)
        if within:
            linked[np.arange(len(rows)), top + np.arange(len(rows))] = False
        texts[rows] += linked.sum(axis=1)
        docs[rows] += linked @ copies[right]
        if not within:
            texts[right] += linked.sum(axis=0)
            docs[right] += copies[rows] @ linked
        for k in np.flatnonzero(linked.any(axis=1)):
            met = np.append(right[linked[k]], rows[k])
            names = np.unique(label[met])
            if len(names) > 1:
                label[np.isin(label, names)] = names[0]
    return texts, docs, label


VERIFIED = "node long, root long, text_links long, doc_links long"


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (component, i, j, node): each run of one (component, i, j) is a comparison."""

    def compared(groups: list[list[tuple]]) -> pa.RecordBatch:
        flat = [row for g in groups for row in g]
        sets = [np.unique(s) for s in grams(row[2] for row in flat)]
        out, at = [], 0
        for g in groups:
            own, copies = sets[at:at + len(g)], np.array([r[1] for r in g], dtype=np.int64)
            at += len(g)
            sides = np.array([r[3] for r in g])
            everyone = np.arange(len(g))
            if sides.min() == sides.max():
                texts, docs, label = _links(own, everyone, everyone, copies, threshold)
            else:
                texts, docs, label = _links(own, everyone[sides == sides.min()], everyone[sides == sides.max()], copies, threshold)
            out += [(r[0], g[label[k]][0], int(texts[k]), int(docs[k])) for k, r in enumerate(g) if texts[k]]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=["node", "root", "text_links", "doc_links"])

    at, group, waiting, held = None, [], [], 0
    for batch in batches:
        names = ("component", "i", "j", "node", "copies", "text", "block")
        for component, i, j, node, copies, text, block in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if at != (component, i, j):
                if group:
                    waiting.append(group)
                if held > CHUNK_BYTES:
                    yield compared(waiting)
                    waiting, held = [], 0
                at, group = (component, i, j), []
            if not group or group[-1][0] != node:  # a row repeated with its id brings its text twice
                group.append((node, copies, text, block))
                held += len(text)
    if group:
        waiting.append(group)
    if waiting:
        yield compared(waiting)


def comparisons(nodes: DataFrame, components: DataFrame) -> DataFrame:
    """(node_key, least_id, node, copies, component, i, j, block): the pairs of blocks, i and j, in which a text is compared.

    A text's block follows from its hash, so that links do not hang on how the input is dealt out.  Every block meets itself.  A text goes to another block of its component only if a text there shares a bucket
    with it: a group of near copies meets as a whole, while a component that is a long chain of loosely similar
    texts costs its buckets and not its square.  A bucket brings a list of its blocks; it has all of them where a
    group is large, and then the list is not carried on.
    """
    components = written(components)
    weights = components.groupBy("component").agg(F.ceil(F.sum(F.col("size") + DOC_WEIGHT) / BLOCK_WEIGHT).alias("blocks"))
    placed = written(components.join(weights, "component").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks"))))
    large = written(placed.where("blocks > 1").select("node", "block", "blocks"))  # written: mostly small, and then known to be
    hashed = large.join(nodes.select("node", "bands"), "node").select("node", "block", "blocks", F.explode("bands").alias("band"))
    spread = written(hashed.groupBy("band").agg(F.collect_set("block").alias("held")).where(F.size("held") > 1))
    full = F.size("held") == F.col("blocks")
    others = hashed.join(spread, "band").groupBy("node", "block", "blocks") \
        .agg(F.max(full).alias("all"), F.flatten(F.collect_set(F.when(~full, F.col("held")))).alias("some")) \
        .select("node", "block", F.explode(F.when(F.col("all"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
                                           .otherwise(F.array_distinct("some"))).alias("other")) \
        .where("other <> block").select("node", "other")
    met = placed.join(others, "node").unionByName(placed.withColumn("other", F.col("block")))
    return met.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")) \
        .select(F.col("key").alias("node_key"), "least_id", "node", "copies", "component", "i", "j", "block")


def joined_nodes(docs: DataFrame, ident: str, text: str, threshold: float, recall: float, rows: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, found): the distinct texts, and (node, label, text_links, doc_links) of those with links."""
    bounded_batches(docs.sparkSession)
    nodes = text_nodes(docs, ident, text, bands_for(threshold, recall, rows), rows)
    components = candidate_components(nodes).join(nodes.select("node", "key", "least_id", "copies", "size"), "node")
    met = comparisons(nodes, components)
    texts = docs.select(text_key(text), F.col(ident).cast("long").alias("own_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # never broadcast: the candidates grow with the corpus
    carried = texts.join(written(met).hint("merge"), (F.col("key") == F.col("node_key")) & F.col("own_id").eqNullSafe(F.col("least_id"))) \
        .select("component", "i", "j", "node", "copies", "text", "block")
    dealt = carried.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "node")
    verified = written(dealt.mapInArrow(lambda batches: _verify(batches, threshold), VERIFIED))
    labels = connected_components(verified, "node", "root")
    links = verified.groupBy("node").agg(F.sum("text_links").alias("text_links"), F.sum("doc_links").alias("doc_links"))
    return nodes, links.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def near_duplicates(docs: DataFrame, ident: str = "doc_id", text: str = "text", threshold: float = 0.8,
                    recall: float = 0.9999, rows: int = 7) -> DataFrame:
    """One row per document: (doc_id, class_id, n_links, text_links, copies).

    `class_id` is the least id among the documents that are linked to it, directly or through others; `copies`
    the documents with its very text, itself included; `text_links` the different texts whose word 5-gram
    sets have a Jaccard similarity of `threshold` or more with its own; `n_links` all documents linked to it, copies of
    its own text and of those texts.  `rows` hashes make a band; the number of bands follows from `recall`.

    A text of fewer than five words is one gram.  Texts without words, null among them (it counts as empty), have
    no grams: they are linked to equal texts only.  Repeated rows are copies.  A class of null ids only has
    a null id.  An empty table gives no rows; columns other than id and text are not read.
    """
    nodes, found = joined_nodes(docs, ident, text, threshold, recall, rows)
    return _membership(docs.select(text_key(text), F.col(ident).cast("long").alias("doc_id")), nodes, found) \
        .select("doc_id", "class_id", (F.coalesce("doc_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("text_links", F.lit(0)).cast("long").alias("text_links"), "copies")


def _membership(rows: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """`rows` (with key) with their node's label, class_id, copies and links."""
    named = nodes.select("node", "key", "copies", "least_id").join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    linked = written(named)
    least = linked.where("text_links is not null").groupBy("label").agg(F.min("least_id").alias("class_least")).withColumnRenamed("label", "class_label")
    classes = linked.join(least, F.col("label") == F.col("class_label"), "left") \
        .select(F.col("key").alias("class_key"), "label", "copies", "text_links", "doc_links",
                F.when(F.col("text_links").isNull(), F.col("least_id")).otherwise(F.col("class_least")).alias("class_id"))
    return rows.join(classes, F.col("key") == F.col("class_key"))


def keep_one(docs: DataFrame, ident: str = "doc_id", text: str = "text", threshold: float = 0.8, recall: float = 0.9999, rows: int = 7) -> DataFrame:
    """One document of each class stays, its columns as they were: that of the least id, null ids last.

    Among rows of equal id the one with the least text hash stays, then the least hash of all columns; of rows
    alike in everything, one.
    """
    nodes, found = joined_nodes(docs, ident, text, threshold, recall, rows)
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("null")) if t not in ("binary",) and not t.startswith(("array", "map", "struct"))
             else F.xxhash64(c).cast("string") for c, t in docs.dtypes if not t.startswith("map")]
    row_key = F.unhex(F.md5(F.concat_ws("/", *[F.md5(p) for p in plain])))
    own, kept = free_name(docs, "own_row"), free_name(docs, "kept_row")
    narrow = docs.select(text_key(text), F.col(ident).cast("long").alias("doc_id"), row_key.alias("row"))
    winners = _membership(narrow, nodes, found).groupBy("label") \
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "row")).alias("first")) \
        .select(F.col("first.row").alias(kept))
    keyed = docs.withColumn(own, row_key)
    return keyed.join(written(winners), F.col(own) == F.col(kept), "left_semi") \
        .dropDuplicates([own]).select(*docs.columns)
