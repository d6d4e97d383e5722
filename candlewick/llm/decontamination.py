"""Benchmark decontamination: test items found in documents with up to a budget of edits.

An item with a budget of k edits is split into k + 1 pieces. However k edits fall, one
piece stays whole, so exact hits of pieces (all of them searched at once by an
Aho-Corasick automaton) give every possible place. Each place is verified with Myers'
bit-parallel edit distance. Items and documents are compared in lower case, with runs
of white space as one space.
"""

from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.texts import fresh_name, id_and_text, strings, with_computed
from candlewick.workspace import written

EDIT_RATE = 0.08
"""Edits allowed for each character of an item."""
SHORT_CHARS = 24
"""Normalised items shorter than this match as they are and as whole words only: edits would make other words of them."""
BLOCK_CHARS = 1_000_000
"""Characters of items searched in one go; what is sent to the tasks is bounded by it."""

MATCH = "array<struct<item_id:bigint,start:int,stop:int,distance:int>>"
_MATCH_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("distance", pa.int32())]))


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def budget(item: str, rate: float = EDIT_RATE) -> int:
    return int(len(item) * rate) if len(item) >= SHORT_CHARS else 0


def split_item(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 pieces that cover the item, with their offsets; fewer where the item has fewer characters."""
    n = min(edits + 1, len(item))
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Pattern:
    """Myers' bit-parallel search for one item: least edit distance to any substring of a text."""

    def __init__(self, item: str) -> None:
        self.size = len(item)
        self.masks: dict[str, int] = {}
        for i, letter in enumerate(item):
            self.masks[letter] = self.masks.get(letter, 0) | 1 << i

    def distances(self, text: str) -> np.ndarray:
        """After every character: the least distance of the item to a substring that ends there."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, score = full, 0, self.size
        scores = array("i")
        get, add = self.masks.get, scores.append
        for letter in text:
            equal = get(letter, 0)
            across = (((equal & up) + up) ^ up) | equal
            vertical = equal | down
            plus = down | (full & ~(across | up))
            minus = up & across
            if plus & top:
                score += 1
            elif minus & top:
                score -= 1
            add(score)
            plus, minus = plus << 1 & full, minus << 1 & full
            up = minus | (full & ~(vertical | plus))
            down = plus & vertical
        return np.array(scores, np.int32)

    def best(self, text: str) -> tuple[int, int]:
        """The least distance, and where the first substring with it ends."""
        scores = self.distances(text)
        end = int(scores.argmin()) if len(scores) else 0
        return (int(scores[end]), end + 1) if len(scores) and scores[end] < self.size else (self.size, 0)


class Block:
    """Items to search, and the automaton of their pieces; built within a task."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float) -> None:
        self.items = items
        self.edits = [budget(text, rate) for _, text in items]
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(items):
            for offset, piece in split_item(text, self.edits[i]):
                places.setdefault(piece, []).append((i, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        if places:
            self.automaton.make_automaton()

    def search(self, text: str) -> list[dict]:
        """All matches in a normalised text, by item and place."""
        if not self.items:
            return []
        starts: dict[int, set[int]] = {}
        for last, where in self.automaton.iter(text):
            for i, end in where:
                starts.setdefault(i, set()).add(last + 1 - end)
        found = []
        for i, at in starts.items():
            item, k = self.items[i][1], self.edits[i]
            exact = sorted(s for s in at if s >= 0 and text.startswith(item, s))
            if len(item) < SHORT_CHARS:
                exact = [s for s in exact if _whole_words(text, s, s + len(item))]
            taken, free = [], -1
            for s in exact:
                if s >= free:
                    free = s + len(item)
                    taken.append((s, free))
            found += [{"item_id": self.items[i][0], "start": s, "stop": e, "distance": 0} for s, e in taken]
            if k:
                others = sorted(at.difference(s for s, _ in taken))  # an exact copy that overlaps one stays a place to look
                for low, high in _without(_joined(others, len(item), k), taken, len(text)):
                    found += self._verified(i, text, low, high)
        return sorted(found, key=lambda m: (m["start"], m["stop"], m["item_id"] is not None, m["item_id"] or 0))

    def _verified(self, i: int, text: str, low: int, high: int) -> Iterator[dict]:
        """The best match between two places, then those on either side of it, until none is left.

        A match cuts off what follows it, which changes distances for an item's length behind it only.
        """
        item, k = self.items[i][1], self.edits[i]
        if high - low < len(item) - k:
            return
        if i not in self.patterns:
            self.patterns[i] = Pattern(item), Pattern(item[::-1])
        ahead, back = self.patterns[i]
        scores = ahead.distances(text[low:high])
        todo = [(low, high)]
        while todo:
            begin, end = todo.pop()
            if end - begin < len(item) - k:
                continue
            part = scores[begin - low : end - low]
            at = int(part.argmin())
            if part[at] > k:
                continue
            stop = begin + at + 1
            start = stop - back.best(text[max(begin, stop - len(item) - k) : stop][::-1])[1]
            yield {"item_id": self.items[i][0], "start": start, "stop": stop, "distance": int(part[at])}
            todo += [(begin, start), (stop, end)]
            again = min(end, stop + len(item) + k)
            scores[stop - low : again - low] = ahead.distances(text[stop:again])


def _whole_words(text: str, start: int, stop: int) -> bool:
    return (start == 0 or not text[start - 1].isalnum()) and (stop == len(text) or not text[stop].isalnum())


def _without(stretches: list[tuple[int, int]], taken: list[tuple[int, int]], size: int) -> Iterator[tuple[int, int]]:
    """What of the stretches (in order, apart) lies within the text and outside the taken spans (in order, apart)."""
    first = 0
    for low, high in stretches:
        low, high = max(0, low), min(size, high)
        while first < len(taken) and taken[first][1] <= low:
            first += 1
        at = first
        while at < len(taken) and taken[at][0] < high:
            if low < taken[at][0]:
                yield low, taken[at][0]
            low = taken[at][1]
            at += 1
        if low < high:
            yield low, high


def _joined(starts: list[int], size: int, edits: int) -> list[tuple[int, int]]:
    """The stretches that hold every match whose expected start is listed; overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for s in starts:
        low, high = s - edits, s + size + edits
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], high
        else:
            out.append((low, high))
    return out


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """The normalised items in blocks of bounded size, fetched a partition at a time."""
    block, size = [], 0
    for row in items.select(items[id_col].cast("bigint"), items[text_col].cast("string")).toLocalIterator():
        text = normalised(row[1] or "")
        if not text:
            continue
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row[0], text))
        size += len(text)
    yield block


def with_matches(docs: DataFrame, items: DataFrame, name: str, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with all its columns and, as one more, the matches of every item: id, span in the normalised text, edits.

    One row per input row; a null or empty text has no match, and neither has a null or empty
    item. An item of fewer than 24 characters matches without edits, between characters that are no letters or digits.
    Exact copies are taken first, from the left; what lies between them is searched for
    others, so a copy with edits counts beside an exact one. Repeated items are reported for each of their
    rows. No shuffle: a block of items of bounded size goes to the documents, and what it has
    found is stored with them before the next block is sent.
    """
    before = None
    for block in item_blocks(items, item_id_col, item_text_col, block_chars):
        if before is not None:
            docs = written(docs, "decontaminated")  # ends the last block's work
            before.unpersist()
        before = sent = docs.sparkSession.sparkContext.broadcast(block)

        def make(sent=sent):
            search = Block(sent.value, rate).search
            return lambda batch: pa.array([search(normalised(t)) for t in strings(batch, text_col)], _MATCH_TYPE)

        if name in docs.columns:
            part = fresh_name(docs, f"{name}_more")
            docs = with_computed(docs, part, MATCH, make, text_col).withColumn(name, F.concat(name, part)).drop(part)
        else:
            docs = with_computed(docs, name, MATCH, make, text_col)
    return docs


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id`` and ``matches``, for every document."""
    return with_matches(id_and_text(docs, id_col, text_col), items, "matches", **options).drop("text")
