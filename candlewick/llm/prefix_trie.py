"""The prefix trie of conversations, as a node table numbered by minimal perfect hashes.

A node is a sequence of turns that some conversation starts with. It is known by the
digest of that sequence: a polynomial of the turns' digests modulo a Mersenne prime, whose value after a block of turns
follows from the value before it, so conversations are cut in blocks and carried on from block to
block, however long one is.

A task takes the prefixes of some thousand blocks as a shard. It enumerates the different digests, gives each
a slot by a minimal perfect hash, verified by the digest that is kept in the slot, and scatters counts and smallest
members into flat arrays by slot. Summing the shards by digest gives the nodes. What is counted once
per node (being a leaf, tokens saved) goes to the path of its smallest member; there a
second pass accumulates it through the array of parent slots, deepest first, and again the shards are summed by
digest. So no node, however many conversations it has, is one task's work.
"""

import hashlib
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.texts import column, list_array, octets, pieces
from candlewick.workspace import written

FAMILY = 20
HEAD = 3
"""Turns that the first of a family may lend to the others."""
BLOCK_TURNS = 256
SHARD_NODES = 1 << 17
IDS_IN_CHUNK = 12
"""Ends of a node are joined for ids that differ in these last bits only, before a node's are brought together."""

# The chain of digests: state -> state * BASE + digest of the turn, modulo a prime.
PRIME = (1 << 127) - 1
BASE = 0x5BD1E9955BD1E995A2AA033B9E3779B9
ROOT = 0x2545F4914F6CDD1D
_LOW = (1 << 64) - 1


def turn_digests(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id``, ``turn``, ``key`` (digest of role and text), ``words``; rows without a conversation are left out."""
    named = [(conv_col, "conv_id", "bigint"), (turn_col, "turn", "bigint"), (role_col, "role", "string"), (text_col, "text", "string")]
    narrow = df.select(*[df[c].cast(kind).alias(name) for c, name, kind in named]).where("conv_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                keys, words = [], []
                for role, text in zip(octets(piece, "role"), octets(piece), strict=True):
                    keys.append(hashlib.blake2b(b"%d %s%s" % (len(role), role, text), digest_size=16).digest())
                    words.append(len(text.split()))
                columns = [column(piece, "conv_id"), column(piece, "turn"), pa.array(keys, pa.binary()), pa.array(words, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "key", "words"])

    return narrow.mapInArrow(run, "conv_id bigint, turn bigint, key binary, words bigint")


def turn_blocks(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``conv_id``, ``start`` (turns before), ``keys``, ``words`` (of the block's turns), ``last``: blocks of at most ``block_turns``.

    Turns come by number, null first; turns with one number by their digests. Sorting is by
    range of all of these, so a long conversation is spread; what its earlier ranges hold is added
    for the conversations at the ends of ranges, two a range at most.
    """
    order = ["conv_id", "turn", "key"]
    spread = turns.withColumn("row", F.monotonically_increasing_id())  # equal turns may be any number
    ranges = spread.repartitionByRange(*order, "row").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held, before = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()
            if not rows:
                continue
            # The last conversation may go on in the next batch: of it only whole blocks are done.
            conv = column(rows[0], "conv_id").to_numpy()
            opened = int(np.searchsorted(conv, conv[-1]))
            stop = opened + (len(conv) - 1 - opened) // block_turns * block_turns
            held = rows[0].slice(stop)
            if stop:
                yield _cut(rows[0].slice(0, stop), before, part, block_turns, conv[-1] if stop > opened else None)
            before = (before if opened == 0 else 0) + stop - opened
        if held is not None:
            yield _cut(held, before, part, block_turns, None)

    kept = written(ranges.mapInArrow(run, "conv_id bigint, part int, start bigint, keys binary, words array<bigint>, last boolean"), "turn-blocks")
    spans = _spans(kept)
    if not spans:
        return kept.drop("part")
    found = kept.sparkSession.createDataFrame(spans, "conv_id bigint, part int, earlier bigint, ends boolean")
    joined = kept.join(F.broadcast(found), ["conv_id", "part"], "left")
    return joined.select(
        "conv_id", (F.col("start") + F.coalesce("earlier", F.lit(0))).alias("start"), "keys", "words", (F.col("last") & F.coalesce("ends", F.lit(True))).alias("last")
    )


def _cut(rows: pa.RecordBatch, before: int, part: int, block_turns: int, goes_on: int | None) -> pa.RecordBatch:
    """Blocks of sorted turns; ``before`` turns of the first conversation are done, and the last may go on."""
    conv, words = column(rows, "conv_id").to_numpy(), column(rows, "words").to_numpy()
    keys = column(rows, "key").to_pylist()
    first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    place = np.arange(len(conv)) - np.repeat(first, np.diff(np.r_[first, len(conv)]))
    starts = np.flatnonzero(place % block_turns == 0)
    stops = np.r_[starts[1:], len(conv)]
    last = np.r_[conv[starts[1:]] != conv[starts[:-1]], True]
    if goes_on is not None:
        last &= conv[starts] != goes_on
    columns = [
        pa.array(conv[starts]),
        pa.array(np.full(len(starts), part, np.int32)),
        pa.array(place[starts] + np.where(starts < (first[1] if len(first) > 1 else len(conv)), before, 0)),
        pa.array([b"".join(keys[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], pa.binary()),
        list_array(words, stops - starts, pa.int64()),
        pa.array(last),
    ]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "start", "keys", "words", "last"])


def _spans(blocks: DataFrame) -> list[tuple]:
    """Of conversations in several ranges, for each range: turns in earlier ranges, and whether it is the last.

    Such a conversation is the first or the last of its range, so there are two a range at most.
    """
    ends = blocks.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    some = ends.select("part", F.explode(F.array_distinct(F.array("low", "high"))).alias("conv_id"))
    several = some.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select("conv_id")
    counts = blocks.join(F.broadcast(several), "conv_id", "left_semi").groupBy("conv_id", "part").agg(F.sum(F.size("words")).alias("n")).collect()
    rows = sorted((r["conv_id"], r["part"], r["n"]) for r in counts)
    out, earlier = [], 0
    for i, (conv, part, n) in enumerate(rows):
        earlier = earlier if i and rows[i - 1][0] == conv else 0
        out.append((conv, part, earlier, i + 1 == len(rows) or rows[i + 1][0] != conv))
        earlier += n
    return out


def _lent(conv: int) -> int:
    """How many turns a conversation takes from the first of its family."""
    return zlib.crc32(b"%d" % conv) % (HEAD + 1)


def rebuilt(blocks: DataFrame, family: int = FAMILY) -> DataFrame:
    """The blocks of every conversation with its first turns replaced by those of its family's first one.

    ``conv_id``, ``start``, ``depth`` (of the first turn here), ``keys``, ``words``, ``last``. Conversation c takes
    crc32 of c, modulo four, turns of conversation c - c % family in place of as many of its own: all if that has
    fewer, none if there is no such.
    """
    short = blocks.where(F.col("start") < HEAD)
    heads = short.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("start", F.substring("keys", 1, 16 * HEAD).alias("keys"), F.slice("words", 1, HEAD).alias("words")))).alias("head"))
    conv = F.col("conv_id")
    joined = blocks.withColumn("family", conv - conv % family).join(heads.withColumnRenamed("conv_id", "family"), "family", "left").drop("family")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in ("conv_id", "start", "depth", "keys", "words", "last")}
            for row in batch.to_pylist():
                lent = _lent(row["conv_id"])
                head = row["head"] or []
                keys, words = b"".join(h["keys"] for h in head)[: 16 * lent], [w for h in head for w in h["words"]][:lent]
                skipped = min(max(lent - row["start"], 0), len(row["words"]))
                length = len(words) + max(row["start"] + len(row["words"]) - lent, 0)
                own_keys, own_words = row["keys"][16 * skipped :], row["words"][skipped:]
                if row["start"] == 0:
                    own_keys, own_words = keys + own_keys, words + own_words
                values = (row["conv_id"], row["start"], length - len(own_words) + 1, own_keys, own_words, row["last"])
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, pa.schema(_REBUILT))

    return joined.mapInArrow(run, "conv_id bigint, start bigint, depth bigint, keys binary, words array<bigint>, last boolean")


_REBUILT = [("conv_id", pa.int64()), ("start", pa.int64()), ("depth", pa.int64()), ("keys", pa.binary()), ("words", pa.list_(pa.int64())), ("last", pa.bool_())]


def chain(state: int, keys: bytes) -> list[int]:
    """The digests after each turn."""
    out = []
    for i in range(0, len(keys), 16):
        state = (state * BASE + int.from_bytes(keys[i : i + 16])) % PRIME
        out.append(state)
    return out


def _carried(blocks: DataFrame) -> DataFrame:
    """``conv_id``, ``start``, ``before`` (the digest before the block) for blocks of conversations that have several.

    Only a summary of a block is brought to the others of its conversation, and these
    are gone over in order with one number in memory.
    """
    several = blocks.where("start > 0").select("conv_id").distinct()

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [(chain(0, k) or [0])[-1].to_bytes(16) for k in column(batch, "keys").to_pylist()]
            sizes = [len(k) // 16 for k in column(batch, "keys").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "conv_id"), column(batch, "start"), pa.array(sizes, pa.int64()), pa.array(values, pa.binary())], ["conv_id", "start", "n", "value"])

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, ROOT
        for batch in batches:
            before = []
            for conv, n, value in zip(*(column(batch, c).to_pylist() for c in ("conv_id", "n", "value")), strict=True):
                if conv != at:
                    at, state = conv, ROOT
                before.append(state.to_bytes(16))
                state = (state * pow(BASE, n, PRIME) + int.from_bytes(value)) % PRIME
            yield pa.RecordBatch.from_arrays([column(batch, "conv_id"), column(batch, "start"), pa.array(before, pa.binary())], ["conv_id", "start", "before"])

    found = blocks.join(several, "conv_id", "left_semi").select("conv_id", "start", "keys").mapInArrow(summaries, "conv_id bigint, start bigint, n bigint, value binary")
    return found.repartition("conv_id").sortWithinPartitions("conv_id", "start").mapInArrow(carry, "conv_id bigint, start bigint, before binary")


_PATHS = "conv_id bigint, start bigint, depth bigint, d1 array<bigint>, d2 array<bigint>, words array<bigint>, p1 bigint, p2 bigint, e1 bigint, e2 bigint"


def paths(blocks: DataFrame) -> DataFrame:
    """Every block's nodes, from the first (at ``depth``) down: halves of their digests (``d1``, ``d2``) and words of their last turns.

    A conversation's first block begins with the root; others name the node above (``p1``, ``p2``). ``e1``, ``e2``
    is the node where the conversation ends, in its last block.
    """
    joined = blocks.join(_carried(blocks), ["conv_id", "start"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name.split()[0]: [] for name in _PATHS.split(", ")}
            for row in batch.to_pylist():
                state = int.from_bytes(row["before"]) if row["before"] else ROOT
                nodes = chain(state, row["keys"])
                words, above, depth = row["words"], _halves(state), row["depth"]
                end = _halves(nodes[-1] if nodes else state) if row["last"] else (None, None)
                if row["start"] == 0:
                    nodes, words, above, depth = [ROOT, *nodes], [0, *words], (None, None), 0
                halves = [_halves(n) for n in nodes]
                values = (row["conv_id"], row["start"], depth, [h[0] for h in halves], [h[1] for h in halves], words, *above, *end)
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)
            kinds = [pa.list_(pa.int64()) if k.split()[1] == "array<bigint>" else pa.int64() for k in _PATHS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

    return joined.mapInArrow(run, _PATHS)


def _halves(state: int) -> tuple[int, int]:
    return (state >> 64) - (1 << 63), (state & _LOW) - (1 << 63)


class SlotTable:
    """A minimal perfect hash: n different digests have the slots 0 to n - 1.

    Digests that fall alone in a cell of the first level have their place there; the rest go
    on to the next level. A slot is the number of taken cells before the digest's. The digest
    in the slot is compared, so a digest that isn't in the table is an error, not a wrong slot.
    """

    def __init__(self, digests: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        taken, left = 0, np.arange(len(digests))
        order = np.empty(len(digests), np.int64)
        while len(left):
            cells = np.bincount(self._cell(digests[left], len(self.levels), 2 * len(left)), minlength=2 * len(left))
            alone = cells == 1
            slots = taken + np.cumsum(alone) - 1
            at = self._cell(digests[left], len(self.levels), len(cells))
            order[slots[at[alone[at]]]] = left[alone[at]]
            self.levels.append((alone, slots))
            taken += int(alone.sum())
            left = left[~alone[at]]
            if len(self.levels) > 64:
                raise ValueError("digests are not different")
        self.digests = digests[order]

    @staticmethod
    def _cell(digests: np.ndarray, level: int, cells: int) -> np.ndarray:
        mixed = digests[:, 0] ^ (digests[:, 1] * np.uint64(0x9E3779B97F4A7C15 + 2 * level)) ^ np.uint64(level * 0x632BE59BD9B4E019 & _LOW)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(cells)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.digests)

    def __getitem__(self, digests: np.ndarray) -> np.ndarray:
        out, left = np.full(len(digests), -1), np.arange(len(digests))
        for level, (alone, slots) in enumerate(self.levels):
            at = self._cell(digests[left], level, len(alone))
            out[left[alone[at]]] = slots[at[alone[at]]]
            left = left[~alone[at]]
        if len(left) or (self.digests[out] != digests).any():
            raise KeyError("a digest is not in the table")
        return out


class Shard(NamedTuple):
    """The prefixes of some blocks: a row per block and node, and what is known of each slot."""

    slots: np.ndarray
    first: np.ndarray  # of each slot, its row with the smallest conversation
    parent: np.ndarray  # of each slot, that of the node above; -1 above a block
    conv: np.ndarray
    start: np.ndarray
    depth: np.ndarray
    words: np.ndarray
    digests: np.ndarray
    above: np.ndarray
    is_root: np.ndarray
    block: np.ndarray


def _flat(rows: pa.RecordBatch, name: str) -> np.ndarray:
    return column(rows, name).flatten().to_numpy(zero_copy_only=False)


def _shard(rows: pa.RecordBatch) -> Shard:
    sizes = column(rows, "d1").value_lengths().to_numpy()
    block = np.repeat(np.arange(rows.num_rows), sizes)
    total = len(block)
    begins = (np.cumsum(sizes) - sizes)[sizes > 0]
    digests = np.stack([_flat(rows, "d1"), _flat(rows, "d2")], axis=1).view(np.uint64)
    each = lambda name: column(rows, name).fill_null(0).to_numpy(zero_copy_only=False)[block]
    conv, start = each("conv_id"), each("start")
    depth = each("depth") + np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    above = np.empty_like(digests)
    above[1:] = digests[:-1]
    tops = np.stack([each("p1"), each("p2")], axis=1).view(np.uint64)
    above[begins] = tops[begins]
    # What a later block sums up ends at its top, so its slots are its own unless another begins as deep.
    known = digests.copy()
    known[:, 0] ^= np.where(start > 0, each("depth"), 0).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    order = np.lexsort((conv, known[:, 1], known[:, 0]))
    new = np.r_[True, (known[order[1:]] != known[order[:-1]]).any(axis=1)] if total else np.zeros(0, bool)
    table = SlotTable(known[order[new]])
    slots = table[known]
    first = np.empty(len(table), np.int64)
    first[slots[order[new]]] = order[new]
    parent = np.full(len(table), -1)
    inner = np.ones(total, bool)
    inner[begins] = False
    parent[slots[inner]] = slots[np.flatnonzero(inner) - 1]
    return Shard(slots, first, parent, conv, start, depth, _flat(rows, "words"), digests, above, depth == 0, block)


def _shards(batches: Iterator[pa.RecordBatch], nodes: int) -> Iterator[pa.RecordBatch]:
    """Rows of several batches together, as long as they have not more than about ``nodes`` nodes."""
    held, size = [], 0
    for batch in batches:
        lengths = np.cumsum(column(batch, "d1").value_lengths().to_numpy())
        at = 0
        while at < batch.num_rows:
            done = lengths[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(lengths, done + nodes - size, side="right")))
            held.append(batch.slice(at, stop - at))
            size += int(lengths[stop - 1] - done)
            at = stop
            if size >= nodes:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _mapped(rows: DataFrame, schema: str, work: Callable[[pa.RecordBatch], list], nodes: int) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, nodes):
            yield pa.RecordBatch.from_arrays(work(shard), names)

    return rows.mapInArrow(run, schema)


def _counted(rows: pa.RecordBatch) -> list:
    """Counts and smallest members by slot, scattered into flat arrays."""
    s = _shard(rows)
    counts = np.bincount(s.slots, minlength=len(s.first))
    one = s.first
    half = lambda a, i: pa.array(a[one, i].view(np.int64), mask=s.is_root[one] if a is s.above else None)
    return [half(s.digests, 0), half(s.digests, 1), pa.array(s.depth[one]), half(s.above, 0), half(s.above, 1), pa.array(s.words[one]), pa.array(counts), pa.array(s.conv[one]), pa.array(s.start[one])]


def _same(name: str) -> Column:
    """A value that all shards must agree on, or two different prefixes have one digest."""
    return F.when(F.min(name).eqNullSafe(F.max(name)), F.min(name)).otherwise(F.raise_error(F.lit("two prefixes share a digest")).cast("bigint")).alias(name)


def nodes_of(found: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """A row per node: digest, ``depth``, the digest above, ``words``, ``n_convs``, and ``conv_id``, ``start``: the smallest member and its block."""
    partial = _mapped(found, "d1 bigint, d2 bigint, depth bigint, p1 bigint, p2 bigint, words bigint, n bigint, conv_id bigint, start bigint", _counted, shard_nodes)
    grouped = partial.groupBy("d1", "d2").agg(*map(_same, ("depth", "p1", "p2", "words")), F.sum("n").alias("n_convs"), F.min(F.struct("conv_id", "start")).alias("least"))
    return grouped.select("*", "least.conv_id", "least.start").drop("least")


def _accumulated(rows: pa.RecordBatch) -> list:
    """Sums over subtrees: what paths bring, added from slot to parent slot, deepest first."""
    s = _shard(rows)
    sums = {name: np.zeros(len(s.first), np.int64) for name in ("leaf", "saved")}
    sizes = column(rows, "d1").value_lengths().to_numpy()
    begins = np.cumsum(sizes) - sizes
    owned = column(rows, "owned")
    counts = owned.value_lengths().fill_null(0).to_numpy()
    own = owned.flatten()
    owner = np.repeat(np.arange(rows.num_rows), counts)
    own_depth = own.field("depth").to_numpy(zero_copy_only=False)
    at = s.slots[begins[owner] + own_depth - column(rows, "depth").to_numpy()[owner]]
    some = sizes > 0
    for name, total in sums.items():
        np.add.at(total, at, own.field(name).to_numpy(zero_copy_only=False))
        # What later blocks of the conversation bring passes through the last node of this one.
        np.add.at(total, s.slots[(begins + sizes - 1)[some]], column(rows, f"{name}_later").to_numpy()[some])
    depth = s.depth[s.first]
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(depth[order]) != 0, True]) if len(order) else np.zeros(1, int)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        level = order[a:b][s.parent[order[a:b]] >= 0]
        for total in sums.values():
            np.add.at(total, s.parent[level], total[level])
    return [pa.array(s.digests[s.first, i].view(np.int64)) for i in (0, 1)] + [pa.array(sums["leaf"]), pa.array(sums["saved"])]


def subtree_sums(found: DataFrame, nodes: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Digest, ``n_leaves``, ``saved_tokens`` of every node. ``nodes`` have ``n_children`` too."""
    leaf = (F.col("n_children") == 0).cast("bigint")
    saved = (F.col("n_convs") - 1) * F.col("words")
    own = nodes.select("conv_id", "start", "depth", leaf.alias("leaf"), saved.alias("saved")).where("leaf > 0 or saved > 0")
    # A block has few nodes, so these lists are short.
    owned = own.groupBy("conv_id", "start").agg(F.collect_list(F.struct("depth", "leaf", "saved")).alias("owned"), F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    owned = written(owned, "owned-nodes")
    several = found.where("start > 0").select("conv_id").distinct()
    after = Window.partitionBy("conv_id").orderBy("start").rowsBetween(1, Window.unboundedFollowing)
    keys = found.select("conv_id", "start").join(several, "conv_id", "left_semi").join(owned.drop("owned"), ["conv_id", "start"], "left")
    later = keys.select("conv_id", "start", F.sum("leaf").over(after).alias("leaf_later"), F.sum("saved").over(after).alias("saved_later"))
    rows = found.join(owned.select("conv_id", "start", "owned"), ["conv_id", "start"], "left").join(later, ["conv_id", "start"], "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("leaf_later", "saved_later")})
    partial = _mapped(rows, "d1 bigint, d2 bigint, leaf bigint, saved bigint", _accumulated, shard_nodes)
    return partial.groupBy("d1", "d2").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def ends_digests(found: DataFrame) -> DataFrame:
    """Digest, ``ends_sha256``: of the conversations that end at a node, the ids in order, comma-joined, as a hash.

    Ids that share all but the last bits are joined first. A node's pieces then go through the
    hash in order, one at a time; its bytes are inherently one sequence.
    """
    ends = found.where("e1 is not null").select(F.col("e1").alias("d1"), F.col("e2").alias("d2"), F.shiftright("conv_id", IDS_IN_CHUNK).alias("chunk"), "conv_id")
    text = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = ends.groupBy("d1", "d2", "chunk").agg(text.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            out = []
            for d1, d2, ids in zip(*(column(batch, c).to_pylist() for c in ("d1", "d2", "ids")), strict=True):
                if (d1, d2) != at:
                    if at is not None:
                        out.append((*at, state.hexdigest()))
                    at, state = (d1, d2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _ended(out)
        if at is not None:
            yield _ended([(*at, state.hexdigest())])

    ordered = chunks.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "chunk")
    return ordered.mapInArrow(run, "d1 bigint, d2 bigint, ends_sha256 string")


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["d1", "d2", "ends_sha256"])


def trie(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", family: int = FAMILY,
    block_turns: int = BLOCK_TURNS, shard_nodes: int = SHARD_NODES,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see :func:`rebuilt`).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. A null role or text is empty, a null turn comes first, turns
    with one number are ordered by a digest of role and text, and repeated rows are repeated turns. Rows without a
    conversation id belong to none. Without any conversation there is no node, not even a root.
    """
    turns = turn_digests(df, conv_col, turn_col, role_col, text_col)
    blocks = written(rebuilt(turn_blocks(turns, block_turns), family), "rebuilt-blocks")
    found = written(paths(blocks), "paths")
    nodes = written(nodes_of(found, shard_nodes), "nodes")
    children = nodes.where("depth > 0").groupBy("p1", "p2").agg(F.count("*").alias("n_children")).select(F.col("p1").alias("d1"), F.col("p2").alias("d2"), "n_children")
    nodes = written(nodes.join(children, ["d1", "d2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))), "counted-nodes")
    parents = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    summed = nodes.join(subtree_sums(found, nodes, shard_nodes), ["d1", "d2"])
    complete = summed.join(ends_digests(found), ["d1", "d2"], "left").join(parents, ["p1", "p2"], "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return complete.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
