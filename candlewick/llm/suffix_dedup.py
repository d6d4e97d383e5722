"""Exact substring deduplication by a depth-limited radix sort.

Two windows of ``length`` bytes are the same if their suffixes agree to that depth, so
suffixes are ordered no further. The digits of the sort, the most significant one first:

1. a gram of the window, the one with the least hash among its grams. It depends on the
   window's bytes alone, so equal windows have it at the same place. Neighbouring
   windows mostly share it: they are carried as one run, with the hash of the bytes that
   the run spans as
2. the second digit. Runs alone in their gram are done with, equal runs are repeats
   throughout; what is left are runs that share a gram and differ elsewhere.
3. Their windows are told apart by all their bytes.

What falls together on the last digit is exactly a repeated window. Before each
shuffle a task keeps the first of the equal runs or windows that it holds and settles the others on
its own, so the most frequent passage leaves a task once. A gram with very many different runs, as a common
beginning has, leaves a task with two of them; the others are dealt out by both digits.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.texts import column, fresh_name, octets, pieces
from candlewick.workspace import written

LENGTH = 100
CHUNK_BITS = 18
"""Bytes hashed at a time, as a power of two."""
TAG_BITS = 24
START_BITS = 39
"""Documents below half a terabyte."""
UNDER_GRAM = 2
"""Different runs of a gram in a piece of texts that are dealt out by the gram; two show that it has several."""
SECOND_DIGIT = (1 << 32) - 1
"""Of a window's hash, the part beside the first 64 bits: 96 bits tell windows apart, and shuffle smaller than 128."""

_BASE = 0x9E3779B97F4A7C15 | 1


class Grams:
    """Runs of windows with the same least gram."""

    def __init__(self, length: int) -> None:
        if length < 2:
            raise ValueError("windows have at least two bytes")
        self.length = length
        self.window = 1 << ((2 * length // 3) or 1).bit_length() - 1  # grams in a window
        self.gram = length - self.window + 1
        n = (1 << CHUNK_BITS) + 1
        inverse = pow(_BASE, -1, 1 << 64)
        self.powers = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE, np.uint64)], dtype=np.uint64)
        self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, inverse, np.uint64)], dtype=np.uint64)
        self.low = np.uint64((1 << CHUNK_BITS) - 1)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """Of the gram at each place: a polynomial in its bytes, mixed."""
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        n = len(data) - self.gram + 1
        h = (sums[self.gram :] - sums[:n]) * self.inverses[:n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xA0761D6478BD642F)
        h ^= h >> np.uint64(32)
        return h

    def runs(self, data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gram hash, first window and number of windows of every run of valid windows; a gap parts runs."""
        h = self.hashes(data)
        least = (h & ~self.low) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while step < self.window:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        cut = np.flatnonzero((least[1:] != least[:-1]) | (valid[1:] != valid[:-1])) + 1
        starts = np.r_[0, cut]
        sizes = np.diff(np.r_[starts, len(least)])
        real = valid[starts]
        starts, sizes = starts[real], sizes[real]
        return h[(least[starts] & self.low).astype(np.int64)], starts, sizes


def _chunks(lengths: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Stretches (text, from, to) that together fit one chunk; a longer text in several, which overlap by a window less one byte."""
    room = 1 << CHUNK_BITS
    chunk, used = [], 0
    for i in np.flatnonzero(lengths >= length).tolist():
        size, start = int(lengths[i]), 0
        while True:
            stop = min(size, start + room)
            if chunk and used + stop - start > room:
                yield chunk
                chunk, used = [], 0
            chunk.append((i, start, stop))
            used += stop - start
            if stop == size:
                break
            start = stop - length + 1
    if chunk:
        yield chunk


def _firsts(keys: list[np.ndarray], key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the first row by (key, at) of every group of equal ``keys``, and of the rest.

    Rows at the place of the first come from a repeated document; they are neither.
    """
    order = np.lexsort((at, key, *reversed(keys)))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return order[new], order[(key[order] != key[first]) | (at[order] != at[first])]


def _dealt(h: np.ndarray, g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First digits to deal out by, and sizes, of the different runs of a piece in order of ``h`` and ``g``.

    All but ``UNDER_GRAM`` runs of a gram get a first digit made of both, so that no task gets them all, and a
    negative size: they have company in their gram, wherever they are compared. As two runs are left under the gram, those that other
    pieces send there find company too. Equal runs under different first digits both go on to
    the last pass, which tells them by their windows.
    """
    places = np.arange(len(h))
    opens = np.r_[True, h[1:] != h[:-1]][: len(h)]
    apart = places - np.maximum.accumulate(np.where(opens, places, 0)) >= UNDER_GRAM
    both = h.view(np.uint64) ^ g.view(np.uint64) * np.uint64(_BASE)
    return np.where(apart, both.view(np.int64), h), np.where(apart, -n, n)


def _key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """Orders documents as their ids do, and is never null: without an id, a large number made of the text."""
    unnamed = F.xxhash64(docs[text_col].cast("string")).bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    return F.coalesce(docs[id_col].cast("bigint"), unnamed).alias("key")


def _tag(text: bytes) -> int:
    """Tells apart texts of rows that share an id."""
    return xxhash.xxh3_64_intdigest(text) & ((1 << TAG_BITS) - 1)


_RESULT = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "spans": "array<struct<start:bigint,stop:bigint>>", "kept": "binary"}
_ROW = "h bigint, g bigint, key bigint, at bigint, n bigint"
_NAMES = ["h", "g", "key", "at", "n"]


def _rows(*arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in arrays], _NAMES)


def _settled(key: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows for stretches of ``n`` bytes to remove, overlapping ones as one; they have no second digit, and any first."""
    order = np.lexsort((at, key))
    key, at, stop = key[order], at[order], (at + n)[order]
    if len(key):
        group = np.r_[True, (key[1:] != key[:-1]) | (at[1:] >> START_BITS != at[:-1] >> START_BITS)]
        reach, shift = stop.copy(), 1  # furthest stop so far within a document, over ever more rows before
        while shift < len(key):
            same = (key[shift:] == key[:-shift]) & (at[shift:] >> START_BITS == at[:-shift] >> START_BITS)
            reach[shift:] = np.where(same, np.maximum(reach[shift:], reach[:-shift]), reach[shift:])
            shift *= 2
        new = group.copy()
        new[1:] |= at[1:] > reach[:-1]
        first = np.flatnonzero(new)
        last = np.r_[first[1:] - 1, len(key) - 1]
        key, at, n = key[first], at[first], reach[last] - at[first]
    return _rows(key * 7 + at, pa.nulls(len(key), pa.int64()), key, at, n)


def runs_of(docs: DataFrame, length: int) -> DataFrame:
    """First pass: runs with both digits, and the stretches that a task could settle on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(length)
        for batch in batches:
            for piece in pieces(batch):
                yield from _runs_of_piece(grams, octets(piece), column(piece, "key").to_numpy())

    return docs.mapInArrow(run, _ROW)


def _runs_of_piece(grams: Grams, texts: list[bytes], keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    length = grams.length
    found: list[list[np.ndarray]] = [[], [], [], [], []]
    tags = np.array([_tag(t) if len(t) >= length else 0 for t in texts], np.int64) << START_BITS
    for chunk in _chunks(np.array([len(t) for t in texts]), length):
        data = b"".join(texts[i][a:b] for i, a, b in chunk)
        sizes = np.array([b - a for _, a, b in chunk])
        ends = np.cumsum(sizes)
        edges = np.zeros(len(data) + 1, np.int8)
        np.add.at(edges, ends - sizes, 1)
        np.add.at(edges, ends - length + 1, -1)
        valid = np.cumsum(edges, dtype=np.int8)[: len(data) - length + 1].astype(bool)
        h, starts, n = grams.runs(np.frombuffer(data, np.uint8), valid)
        view = memoryview(data)
        digest = xxhash.xxh3_64_intdigest
        g = np.array([digest(view[a:b]) for a, b in zip(starts.tolist(), (starts + n + length - 1).tolist(), strict=True)], np.uint64)
        part = np.searchsorted(ends, starts, side="right")
        text = np.array([i for i, _, _ in chunk])[part]
        within = starts - (ends - sizes)[part] + np.array([a for _, a, _ in chunk])[part]
        for out, values in zip(found, (h.view(np.int64), g.view(np.int64), keys[text], tags[text] | within, n), strict=True):
            out.append(values)
    if not found[0]:
        return
    h, g, key, at, n = (np.concatenate(x) for x in found)
    first, rest = _firsts([h, g], key, at)
    dealt, sizes = _dealt(h[first], g[first], n[first])
    yield _rows(dealt, g[first], key[first], at[first], sizes)
    yield _settled(key[rest], at[rest], n[rest] + length - 1)


def compared(rows: DataFrame, length: int, last: bool) -> DataFrame:
    """Rows with equal digits: all but the first become stretches to remove.

    The first stays as it is (``g`` set) where its gram has other second digits as well, which a
    negative size says of itself, unless this is the ``last`` pass. Rows are read in order; no group is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the digits of the row before this batch, and where its group begins
        waiting = None  # the first row of a gram of which no other second digit has come
        for batch in batches:
            done = column(batch, "g").is_null()
            yield batch.filter(done)
            batch = batch.filter(pa.compute.invert(done))
            if not batch.num_rows:
                continue
            h, g, key, at, n = (column(batch, c).to_numpy() for c in _NAMES)
            company, n = n < 0, np.abs(n)
            new_h = np.r_[before is None or h[0] != before[0], h[1:] != h[:-1]]
            new = new_h | np.r_[before is None or g[0] != before[1], g[1:] != g[:-1]]
            opened = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))  # the first row of each group; -1: in a batch before
            first_key, first_at = (np.where(opened >= 0, x[opened], 0 if before is None else old) for x, old in ((key, before and before[2]), (at, before and before[3])))
            before = h[-1], g[-1], first_key[-1], first_at[-1]
            later = (key != first_key) | (at != first_at)  # not the same place of a repeated document
            yield _settled(key[later], at[later], n[later] + length - 1)
            if last:
                continue
            first = np.flatnonzero(new)
            if not len(first):
                continue
            opens = new_h[first]
            if waiting is not None and not opens[0]:
                yield waiting
            mixed = ~opens | company[first]
            mixed[:-1] |= ~opens[1:]
            waiting = None if mixed[-1] else batch.slice(int(first[-1]), 1)
            kept = first[mixed]
            yield _rows(h[kept], g[kept], key[kept], at[kept], n[kept])

    return rows.repartition("h").sortWithinPartitions("h", "g", "key", "at").mapInArrow(run, _ROW)


def windows_of(wanted: DataFrame, text: str, key: str, runs: str, length: int) -> DataFrame:
    """Last pass: every window of the ``runs`` listed with a document, with a hash of all its bytes as both digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                yield from _windows_of_piece(octets(piece, text), column(piece, key).to_numpy(), column(piece, runs), length)

    return wanted.mapInArrow(run, _ROW)


def _windows_of_piece(texts: list[bytes], keys: np.ndarray, lists: pa.ListArray, length: int) -> Iterator[pa.RecordBatch]:
    offsets, flat = lists.offsets.to_numpy(), lists.flatten()
    offsets = offsets - offsets[0]
    ats, ns = flat.field("at").to_numpy(), flat.field("n").to_numpy()
    digests, key, at = [], [], []
    digest = xxhash.xxh3_128_digest
    for i, text in enumerate(texts):
        tag, view = _tag(text) if len(text) >= length else 0, memoryview(text)
        own = slice(offsets[i], offsets[i + 1])
        mine = ats[own] >> START_BITS == tag
        starts = ats[own][mine] & ((1 << START_BITS) - 1)
        places = np.unique(np.concatenate([np.arange(a, a + n) for a, n in zip(starts.tolist(), ns[own][mine].tolist(), strict=True)])) if len(starts) else starts
        digests += [digest(view[s : s + length]) for s in places.tolist()]
        at.append(places | (tag << START_BITS))
        key.append(np.full(len(places), keys[i]))
    if not digests:
        return
    both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2) & np.array([-1, SECOND_DIGIT])
    key, at = np.concatenate(key), np.concatenate(at)
    first, rest = _firsts([both[:, 0], both[:, 1]], key, at)
    yield _rows(both[first, 0], both[first, 1], key[first], at[first], np.ones(len(first), np.int64))
    yield _settled(key[rest], at[rest], np.full(len(rest), length))


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (removed, maximal, in bytes), ``kept`` (the other bytes), and the columns in ``keep``.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a
    document with a smaller id, or before in its own. Strings are judged on the input;
    none crosses documents. One row per input row; a null text counts as empty. Rows
    that share id and text count as one document, so neither is a repeat of the other, and both get
    the same result; rows that share an id only are ordered by a hash of their texts. A null id
    comes after all others. With ``as_text`` the kept bytes come as text, without what a cut has
    left of a character.

    The documents are dealt out by id once: the last pass and the cutting both use that exchange, so
    both join the same columns.
    """
    names = [k for k in keep or [] if k not in ("doc_id", *_RESULT)]
    text, key, runs, cuts = (fresh_name(df, x) for x in ("_text", "_key", "runs", "_cuts"))
    first = written(compared(runs_of(df.select(_key(df, id_col, text_col), df[text_col].cast("string").alias("text")), length), length, last=False), "runs")
    whole = df.select(df[id_col].cast("bigint").alias("doc_id"), df[text_col].cast("string").alias(text), _key(df, id_col, text_col).alias(key), *[df[k] for k in names])
    mixed = first.where("g is not null").groupBy(F.col("key").alias(key)).agg(F.collect_list(F.struct("at", "n")).alias(runs))
    windows = compared(windows_of(whole.join(mixed, key), text, key, runs, length), length, last=True)
    stretches = first.where("g is null").select("key", "at", "n").union(windows.select("key", "at", "n"))
    by_document = stretches.groupBy(F.col("key").alias(key)).agg(F.collect_list(F.struct("at", "n")).alias(cuts))
    joined = whole.join(by_document, key, "left")
    kind = pa.string() if as_text else pa.binary()
    shown = (lambda b: b.decode("utf-8", "ignore")) if as_text else (lambda b: b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                results = [_cut(t, c, length) for t, c in zip(octets(piece, text), _lists(column(piece, cuts)), strict=True)]
                spans = pa.array([[{"start": a, "stop": b} for a, b in r[3]] for r in results], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
                numbers = [pa.array([r[j] for r in results], pa.int64()) for j in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [column(piece, "doc_id"), *numbers, spans, pa.array([shown(r[4]) for r in results], kind), *[column(piece, k) for k in names]],
                    ["doc_id", *_RESULT, *names],
                )

    fields = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in whole.schema if f.name in names)
    result = ", ".join(f"{c} {kind}" for c, kind in (_RESULT | {"kept": "string" if as_text else "binary"}).items())
    return joined.mapInArrow(run, f"doc_id bigint, {result}{fields}")


def _lists(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    offsets, flat = lists.offsets.to_numpy(), lists.values
    ats, ns = (flat.field(c).to_numpy() for c in ("at", "n"))
    empty = lists.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(lists)):
        yield None if empty[i] else (ats[offsets[i] : offsets[i + 1]], ns[offsets[i] : offsets[i + 1]])


def _cut(text: bytes, cuts: tuple[np.ndarray, np.ndarray] | None, length: int) -> tuple[int, int, int, list[tuple[int, int]], bytes]:
    """Size, removed bytes, number of removed runs, the runs, and what is left."""
    if cuts is None or len(text) < length:
        return len(text), 0, 0, [], text
    ats, ns = cuts
    mine = ats >> START_BITS == _tag(text)
    starts = ats[mine] & ((1 << START_BITS) - 1)
    if not len(starts):
        return len(text), 0, 0, [], text
    edges = np.zeros(len(text) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + ns[mine], -1)
    gone = np.cumsum(edges)[:-1] > 0
    turns = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
    spans = list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))
    return len(text), int(gone.sum()), len(spans), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()

