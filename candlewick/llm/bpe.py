"""Byte-level BPE, encoding and decoding, with an index of pair occurrences.

The different pre-tokens of a block of texts are laid out in one array of symbols. An
index maps every mergeable pair to all its positions. The ranks that have positions are
applied in ascending order; each application merges all positions of the pair at once
and lists the pairs that arise under their ranks. A merge makes a symbol that no
earlier rank can use, so one ascending sweep does for every pre-token what repeated
lowest-rank merging does.
"""

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.texts import Numbers, column, list_array, map_pieces, octets, strings

# The pattern that byte-level BPE vocabularies of this format split by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BLOCK_BYTES = 8 << 20
"""Text bytes whose pre-tokens share one pair index."""


def byte_letters() -> dict[str, int]:
    """The characters that stand for the 256 bytes in vocabulary files: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary as arrays, read on the driver and sent to the tasks (its size is that of the file).

    ``path`` is a tokenizers JSON file without normalizer.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        ids: dict[str, int] = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.none = self.size  # stands for no symbol
        letters = byte_letters()
        self.byte_ids = np.zeros(256, np.int32)
        for letter, byte in letters.items():
            self.byte_ids[byte] = ids[letter]
        self.spelling = [b""] * self.size
        for token, i in ids.items():
            self.spelling[i] = bytes(letters[x] for x in token)
        for token, i in self.special.items():
            self.spelling[i] = token.encode()
        merges = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in merges], np.int64)
        self.right = np.array([ids[b] for _, b in merges], np.int64)
        self.made = np.array([ids[a + b] for a, b in merges], np.int32)
        keys = self.left * (self.size + 1) + self.right
        self.rank_order = np.argsort(keys)
        self.keys = keys[self.rank_order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 where it has none."""
        keys = left.astype(np.int64) * (self.size + 1) + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_order[at], -1)


class PairIndex:
    """Symbols of many pre-tokens as linked lists, and the positions of every mergeable pair by rank."""

    def __init__(self, vocabulary: Vocabulary, words: list[bytes]) -> None:
        self.v = vocabulary
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        n = self.n = int(self.sizes.sum())
        self.sym = np.empty(n + 1, np.int32)  # the last place stands for the end of a word
        self.sym[:n] = vocabulary.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        self.sym[n] = vocabulary.none
        self.next = np.arange(1, n + 2, dtype=np.int32)
        self.prev = np.arange(-1, n, dtype=np.int32)
        self.ends = np.cumsum(self.sizes)
        filled = self.sizes > 0
        self.next[self.ends[filled] - 1] = n
        self.prev[(self.ends - self.sizes)[filled]] = n
        self.positions: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._list(np.arange(n, dtype=np.int32))

    def _list(self, at: np.ndarray) -> None:
        """Enter the pairs that start at these positions."""
        ranks = self.v.ranks(self.sym[at], self.sym[self.next[at]])
        found = ranks >= 0
        at, ranks = at[found], ranks[found]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for part, rank in zip(np.split(at, cuts), ranks[np.r_[0, cuts]].tolist(), strict=True):
            if rank not in self.positions:
                self.positions[rank] = []
                heapq.heappush(self.active, rank)
            self.positions[rank].append(part)

    def merge(self) -> None:
        """Apply the active ranks in ascending order until none is left."""
        sym, following, previous, none = self.sym, self.next, self.prev, self.v.none
        while self.active:
            rank = heapq.heappop(self.active)
            a, b = self.v.left[rank], self.v.right[rank]
            at = np.concatenate(self.positions.pop(rank))
            at.sort()
            at = at[np.r_[True, at[1:] != at[:-1]]]
            after = following[at]
            valid = (sym[at] == a) & (sym[after] == b)
            at, after = at[valid], after[valid]
            if a == b and len(at) > 1:  # in a run of equal symbols every second pair goes with the one before
                heads = np.r_[True, at[1:] != after[:-1]]
                place = np.arange(len(at))
                first = np.maximum.accumulate(np.where(heads, place, 0))
                free = (place - first) % 2 == 0
                at, after = at[free], after[free]
            if not len(at):
                continue
            beyond = following[after]
            sym[at] = self.v.made[rank]
            sym[after] = none
            following[at] = beyond
            inner = beyond < self.n
            previous[beyond[inner]] = at[inner]
            before = previous[at]
            self._list(np.concatenate([before[before < self.n], at]))

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words one after the other, and how many each word has."""
        alive = self.sym[: self.n] != self.v.none
        upto = np.r_[0, np.cumsum(alive)]
        return self.sym[: self.n][alive], upto[self.ends] - upto[self.ends - self.sizes]


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one run after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


# Every white-space character but the space.
_BLANKS = "\t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

KNOWN_CHUNKS = 1 << 18
"""Chunks whose ids a task remembers; beyond, it starts anew."""


class Encoder:
    """From texts to token ids, for use within a task.

    Texts are cut before every space into chunks. No pre-token holds a space after
    another character, so the pattern gives the same pre-tokens within each chunk,
    unless the space stands beside other white space: such texts, and those with
    special tokens, are cut by the pattern itself. Different chunks go through the pair index.

    With ``literal``, text that spells a special token is ordinary text.
    """

    def __init__(self, vocabulary: Vocabulary, literal: bool = False) -> None:
        self.vocabulary = vocabulary
        self.pattern = regex.compile(PATTERN)
        self.special_ids = {} if literal else vocabulary.special
        special = "|".join(map(regex.escape, sorted(self.special_ids, key=len, reverse=True)))
        self.special = regex.compile(f"({special})") if special else None
        self._forget()

    def _forget(self) -> None:
        self.numbers = Numbers()
        self.ids = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)

    def _chunks(self, text: str) -> list[str]:
        special = any(s in text for s in self.special_ids)
        if not special and "  " not in text and "\0" not in text and not any(b in text and (f" {b}" in text or f"{b} " in text) for b in _BLANKS):
            return text.replace(" ", "\0 ").removeprefix("\0").split("\0")
        if not special:
            return self.pattern.findall(text)
        parts = self.special.split(text)  # odd ones are special tokens
        return [t for i, part in enumerate(parts) for t in ([part] if i % 2 else self.pattern.findall(part))]

    def _learn(self, chunks: list[str]) -> None:
        """Ids of chunks that were not met before."""
        special = self.special_ids
        split = [[] if c in special else self.pattern.findall(c) for c in chunks]
        pairs = PairIndex(self.vocabulary, [t.encode() for tokens in split for t in tokens])
        pairs.merge()
        ids, sizes = pairs.result()
        upto = np.r_[0, np.cumsum(sizes)]
        ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
        starts, ends = upto[np.r_[0, ends[:-1]]], upto[ends]
        counts = ends - starts
        for i, chunk in enumerate(chunks):
            if chunk in special:
                starts[i], counts[i] = len(ids), 1
                ids = np.append(ids, np.int32(special[chunk]))
        self.starts = np.concatenate([self.starts, starts + len(self.ids)])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one after the other, and the number of ids of each text."""
        if len(self.numbers) > KNOWN_CHUNKS:
            self._forget()
        number, known = self.numbers.__getitem__, len(self.numbers)
        spots = []
        for text in texts:
            chunks = self._chunks(text)
            spots.append(np.fromiter(map(number, chunks), np.int32, len(chunks)))
        if len(self.numbers) > known:
            self._learn(list(self.numbers)[known:])
        flat = np.concatenate(spots) if spots else np.empty(0, np.int32)
        lengths = np.fromiter(map(len, spots), np.int64, len(spots))
        counts = self.counts[flat]
        sums, ends = np.r_[0, np.cumsum(counts)], np.cumsum(lengths)
        return self.ids[gather(self.starts[flat], counts)], sums[ends] - sums[ends - lengths]


def encode(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc_id``, ``ids`` (array of token ids), and after them the columns in ``keep``; one row per input row.

    Text that spells a special token becomes that token. A null or empty text has no
    ids. Any text length does: a block holds at least one whole text.
    """
    names = [k for k in keep or [] if k not in ("doc_id", "ids")]
    spec = df.select(df[id_col].cast("bigint").alias("doc_id"), df[text_col].cast("string").alias("_text"), *[df[k] for k in names])
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        to_ids = Encoder(sent.value)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, counts = to_ids(strings(batch, "_text"))
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), list_array(ids, counts, pa.int32()), *[column(batch, k) for k in names]], ["doc_id", "ids", *names])

        return work

    schema = "doc_id bigint, ids array<int>" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in spec.schema if f.name in names)
    return map_pieces(spec, schema, make, "_text", BLOCK_BYTES)


def decode(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id``, ``ids`` and ``text``: the bytes of the tokens, special ones included, read as UTF-8.

    Bytes that are no UTF-8 become U+FFFD. Null or empty ids give the empty text; an id
    outside the vocabulary spells nothing.
    """
    narrow = df.select(df[id_col].cast("bigint").alias("doc_id"), df[ids_col].cast("array<int>").alias("ids"))
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = sent.value.spelling
        sizes = np.fromiter(map(len, spelling), np.int64, len(spelling))
        letters, starts = np.frombuffer(b"".join(spelling) or b"\0", np.uint8), np.cumsum(sizes) - sizes
        for batch in batches:
            for rows in _rows_of(batch, BLOCK_BYTES // 4):
                lists = column(rows, "ids")
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                known = (ids >= 0) & (ids < len(sizes))
                ids, upto = ids[known], np.r_[0, np.cumsum(known)]
                ends = np.cumsum(counts)
                bounds = np.r_[0, np.cumsum(sizes[ids])][upto[np.r_[0, ends]]]
                data = letters[gather(starts[ids], sizes[ids])].tobytes()
                texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([column(rows, "doc_id"), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return narrow.mapInArrow(run, "doc_id bigint, ids array<int>, text string")


def _rows_of(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` ids each."""
    offsets, start = column(batch, "ids").offsets.to_numpy().astype(np.int64), 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def ids_digest(ids: str = "ids"):
    """Lowercase hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256)
