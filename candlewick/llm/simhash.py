"""SimHash near-duplicates by anchor-point covering.

The anchors are the words of a covering code: the Hamming code of length 63 with one free
bit, so every fingerprint of 64 bits lies within one bit of an anchor (covering radius
1). Two fingerprints that differ in at most t bits have a midpoint within t/2 (rounded up)
of either; the anchor next to the midpoint lies within 1 + t/2 of both. So every
fingerprint goes to all anchors within that radius, about 33 for t = 2, and pairs are
compared per anchor only. (Covering radius plus all of t would do as well, at twenty
times the copies.) However many fingerprints there are, at most as many as the
ball around an anchor holds can meet there: 2081 for t = 2.
"""

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.components import components
from candlewick.llm.texts import column, fresh_name, id_and_text, map_pieces, octets, with_computed
from candlewick.workspace import written

SHINGLE = 3
MAX_BITS = 2
SEED = 42


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """64 bits: each set if in over half of the XXH64 of the word shingles; 0 without a word."""
    words = raw.lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fp`` (the 64 bits as a bigint); one row per input row, null texts as empty ones."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            prints = np.array([fingerprint(t, size) for t in octets(batch)], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(prints)], ["doc_id", "fp"])

        return work

    return map_pieces(id_and_text(df, id_col, text_col), "doc_id bigint, fp bigint", make)


class Code:
    """The anchors: words of the Hamming code on bits 0 to 62, with bit 63 free.

    Bit i stands at place i + 1; a fingerprint's syndrome is the exclusive or of the
    places of its set bits, and the anchor next to it differs at the place that the
    syndrome names (0: it is an anchor).
    """

    def __init__(self, radius: int) -> None:
        if radius < 1:
            raise ValueError("the covering radius is 1")
        flips = [0]
        for weight in range(1, radius):
            flips += [sum(1 << b for b in bits) for bits in combinations(range(64), weight)]
        self.flips = np.array(flips, np.uint64)
        self.place_bits = [np.uint64(sum(1 << (p - 1) for p in range(1, 64) if p >> k & 1)) for k in range(6)]
        self.masks = np.array([0] + [1 << (p - 1) for p in range(1, 64)], np.uint64)
        self.flip_syndromes = self.syndrome(self.flips)

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape, np.uint8)
        for k, mask in enumerate(self.place_bits):
            out |= (np.bitwise_count(x & mask) & 1).astype(np.uint8) << k
        return out

    def anchors(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All anchors within the radius of each fingerprint: the anchors next to it and to everything fewer bits away.

        As row numbers of ``x`` and anchors, each pair once.
        """
        syndromes = self.syndrome(x)[:, None] ^ self.flip_syndromes[None, :]
        near = np.sort(x[:, None] ^ self.flips[None, :] ^ self.masks[syndromes], axis=1)
        first = np.ones(near.shape, bool)
        first[:, 1:] = near[:, 1:] != near[:, :-1]
        return np.nonzero(first)[0], near[first]


def replicas(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``anchor``, ``fp`` and ``node`` for every anchor that a fingerprint goes to."""
    radius = 1 + (max_bits + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(radius)
        step = max(1, (1 << 18) // len(code.flips))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                x = column(part, "fp").to_numpy().view(np.uint64)
                rows, anchors = code.anchors(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors.view(np.int64)), pa.array(x[rows].view(np.int64)), column(part, "node").take(pa.array(rows))], ["anchor", "fp", "node"]
                )

    return prints.mapInArrow(run, "anchor bigint, fp bigint, node bigint")


def links_at_anchors(placed: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``a``, ``b`` that join the nodes of each anchor as far as their fingerprints link.

    Of every connected group at an anchor come as many edges as it has nodes, less one; not all its pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # an anchor's rows that the last batch may not have ended
        for batch in batches:
            rows = np.stack([column(batch, c).to_numpy() for c in ("anchor", "fp", "node")])
            if kept is not None:
                rows = np.hstack([kept, rows])
            last = int(np.searchsorted(rows[0], rows[0, -1])) if rows.shape[1] else 0
            kept = rows[:, last:]
            yield _linked(rows[:, :last], max_bits)
        if kept is not None:
            yield _linked(kept, max_bits)

    return placed.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "a bigint, b bigint")


def _linked(rows: np.ndarray, max_bits: int) -> pa.RecordBatch:
    anchors, prints, nodes = rows[0], rows[1].view(np.uint64), rows[2]
    cuts = np.r_[0, np.flatnonzero(anchors[1:] != anchors[:-1]) + 1, len(anchors)] if len(anchors) else np.zeros(1, int)
    sizes = np.diff(cuts)
    two = cuts[:-1][sizes == 2]
    near = np.bitwise_count(prints[two] ^ prints[two + 1]) <= max_bits if len(two) else np.zeros(0, bool)
    a, b = [nodes[two][near]], [nodes[two + 1][near]]
    for start, size in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        left, right = _forest(prints[start : start + size], max_bits)
        a.append(nodes[start + left])
        b.append(nodes[start + right])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def _forest(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the fingerprints that link, found breadth first."""
    left, right, todo = [], [], np.arange(len(prints))
    while len(todo):
        queue, todo = [int(todo[0])], todo[1:]
        while queue and len(todo):
            at = queue.pop()
            near = np.bitwise_count(prints[todo] ^ prints[at]) <= max_bits
            found, todo = todo[near], todo[~near]
            left += [at] * len(found)
            right += found.tolist()
            queue += found.tolist()
    return np.array(left, np.int64), np.array(right, np.int64)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``fp`` (bigint) and ``component_id``: the smallest doc_id reachable over links of ``max_bits`` or fewer bits.

    One row per input row. Documents without a word share the fingerprint 0 and link like
    any others. A null id stays in its component, and links others, without naming it; a component
    of nothing else has a null ``component_id``. Texts are read once; equal
    fingerprints become one node before anything is copied or compared.
    """
    prints = written(fingerprints(df, id_col, text_col, size), "fingerprints")
    return prints.join(classes(prints, max_bits), "fp").select("doc_id", "fp", "component_id")


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp``, ``component_id`` for every fingerprint of a stored table of them; the fingerprints are the nodes."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    edges = written(links_at_anchors(replicas(nodes.select("fp", F.col("fp").alias("node")), max_bits), max_bits).distinct(), "links")
    linked = written(components(edges), "components").join(nodes.withColumnRenamed("fp", "node"), "node")
    named = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    of_linked = linked.join(named, "component").select(F.col("node").alias("fp"), F.lit(True).alias("linked"), "component_id")
    return nodes.join(of_linked, "fp", "left").select("fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))


def hex_print(fp: str = "fp"):
    """Sixteen lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with all its columns, less every document that is in a class with a smaller id; one row per class stays.

    Rows that share an id are told apart by their fingerprints: each class keeps one row of the id that names
    it. Rows without an id can't be told apart and all stay.
    """
    prints = written(fingerprints(docs, id_col, text_col, size), "fingerprints")
    of_prints = written(classes(prints, max_bits), "classes")
    named = prints.join(of_prints, "fp").select("doc_id", "component_id")
    gone = named.where("doc_id != component_id").select(F.col("doc_id").alias(id_col)).distinct()
    shared = prints.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select(F.col("doc_id").alias(id_col))
    if shared.isEmpty():
        return docs.join(gone, id_col, "left_anti")
    shared = written(shared, "shared-ids")
    alone = docs.join(gone.unionByName(shared).distinct(), id_col, "left_anti")
    # Only rows of shared ids have their fingerprints taken again, to be met one by one.
    fp, component = fresh_name(docs, "fp"), fresh_name(docs, "component_id")

    def make():
        return lambda batch: pa.array(np.array([fingerprint(t, size) for t in octets(batch, text_col)], np.uint64).view(np.int64))

    printed = with_computed(docs.join(shared, id_col, "left_semi").select(docs.columns), fp, "bigint", make, text_col)
    of_class = printed.join(of_prints.select(F.col("fp").alias(fp), F.col("component_id").alias(component)), fp)
    first = of_class.where(F.col(id_col) == F.col(component)).dropDuplicates([component])
    return alone.select(docs.columns).unionByName(first.select(docs.columns))
