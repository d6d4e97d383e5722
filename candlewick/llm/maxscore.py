"""Exact top-k search by inner product, with MaxScore.

A dimension is a query term, and a shard keeps its postings by dimension: the values that the
shard's rows have there, and the least and the largest of these. For a query with weight q
the term adds at most the larger of q times either, at least the smaller. What a
term can add above its least is its bound. Sorted by bound, the smallest terms whose bounds together,
above the sum of all least contributions, stay below the threshold are non-essential: a row at
its least in all others can't be among the best. The essential postings are traversed for all
rows; the others are probed, largest bound first, for those rows alone that can still
reach the threshold, which is the k-th best score so far. Rows that tie with it stay, as the smaller id wins.

A task goes over the shards of its partition with thresholds that rise from shard to shard, and gives
its k best of each query; these are merged by query. Queries come in blocks of bounded size, one block's
results stored before the next is sent.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.texts import column
from candlewick.llm.vectors import SCALE, largest, matrix, whole_vectors
from candlewick.workspace import written

BEST = 5
SHARD_VALUES = 1 << 20
"""Components in a shard: 16,384 vectors of 64."""
PACK_VALUES = 1 << 15
BLOCK_VALUES = 1 << 22
"""Components in the queries of a block (32 MB of longs): what is broadcast at a time."""
TOGETHER = 64
"""Queries that a task scores at a time."""
PROBES = 4
NO_ID = np.iinfo(np.int64).max
"""Stands for a null id: after all others, and no query's own."""
_FLOAT, _DOUBLE, _LONG = 1 << 24, 1 << 53, 1 << 61
NONE = -_LONG
"""Below every score."""


@dataclass
class Queries:
    """A block of queries: ``numbers`` name their rows, ``ids`` are their vectors' own."""

    numbers: np.ndarray
    ids: np.ndarray
    weights: np.ndarray
    start: np.ndarray
    """Scores that the k best reach at least."""


def _kind(weights: np.ndarray, most: int) -> type:
    """The fastest numbers in which no score, nor any part of one, is rounded."""
    bound = int(np.abs(weights.astype(object) if largest(weights) > 1 << 40 else weights).sum(axis=1).max()) * most if weights.size else 0
    if bound >= _LONG:
        raise OverflowError("scores don't fit a long")
    return np.float32 if bound < _FLOAT else np.float64 if bound < _DOUBLE else np.int64


class Best:
    """The k best of each query so far: scores (falling), ids (rising among equal scores)."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.scores = np.full((queries, k), NONE)
        self.ids = np.full((queries, k), NO_ID)
        self.filled = np.zeros(queries, np.int64)

    def add(self, query: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Found rows, as many per query as there may be."""
        touched = np.unique(query)
        kept = np.arange(self.k)[None, :] < self.filled[touched][:, None]
        owner = np.repeat(touched, self.k).reshape(kept.shape)
        query = np.r_[query, owner[kept]]
        scores = np.r_[scores, self.scores[touched][kept]]
        ids = np.r_[ids, self.ids[touched][kept]]
        order = np.lexsort((ids, ~scores, query))
        query, scores, ids = query[order], scores[order], ids[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        top = place < self.k
        self.scores[query[top], place[top]] = scores[top]
        self.ids[query[top], place[top]] = ids[top]
        self.filled[touched] = np.minimum(np.bincount(query, minlength=len(self.filled))[touched], self.k)

    def thresholds(self) -> np.ndarray:
        """The k-th best score of each query; below all scores where there are fewer."""
        return self.scores[:, -1]


class Shard:
    """Postings by dimension, and their extremes."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.postings = ids, np.ascontiguousarray(x.T)
        self.low, self.high = self.postings.min(axis=1), self.postings.max(axis=1)
        self.most = largest(x)

    def search(self, queries: Queries, rows: slice, best: Best) -> None:
        """Put the rows of the shard that belong to the best of some queries among them."""
        weights, own = queries.weights[rows], queries.ids[rows]
        kind = _kind(weights, self.most)
        ends = weights * self.low, weights * self.high
        least, bounds = np.minimum(*ends), np.abs(ends[1] - ends[0])
        # Scores count from the least that any row can have, so no contribution is negative.
        base = least.sum(axis=1)
        start = np.maximum(best.thresholds()[rows], queries.start[rows])
        threshold = np.where(start > base, start - np.minimum(base, start), 0)
        order = np.argsort(bounds, axis=1, kind="stable")
        rising = np.cumsum(np.take_along_axis(bounds, order, axis=1), axis=1)
        non_essential = (rising < threshold[:, None]).sum(axis=1)
        asked = np.flatnonzero(non_essential < weights.shape[1])  # others can't reach the threshold at all
        if not len(asked):
            return
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
        place = np.arange(len(self.ids))
        weights, rank, rising = weights[asked], rank[asked], rising[asked]
        cuts = [np.minimum(non_essential[asked] * (PROBES - i) // PROBES, weights.shape[1]) for i in range(PROBES + 1)]
        postings = self.postings.astype(kind)
        before = np.full(len(asked), weights.shape[1])
        total = None
        for cut in cuts:
            part = np.where((rank >= cut[:, None]) & (rank < before[:, None]), weights, 0).astype(kind) @ postings
            total = part if total is None else total + part
            before = cut
            # What the terms that are left can add at most, over their share of the base.
            left = rank < cut[:, None]
            rest = np.where(left, np.maximum(*(e[asked] for e in ends)), 0).sum(axis=1)
            alive = total >= (start[asked] - rest).astype(kind)[:, None]
            some = alive.any(axis=0)
            if not some.all():
                total, alive, place, postings = total[:, some], alive[:, some], place[some], postings[:, some]
            if not len(place):
                return
        query, row = np.nonzero(alive & (self.ids[place][None, :] != own[asked][:, None]))
        if len(query):
            best.add(rows.start + asked[query], total[query, row].astype(np.int64), self.ids[place[row]])


def _ids(batch: pa.RecordBatch, name: str = "vec_id") -> np.ndarray:
    return column(batch, name).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _packed(queries: DataFrame, dims: int) -> DataFrame:
    """``pack``, ``ids``, ``weights``: some queries a row, as bytes; a pack is named after its task and place."""
    rows = max(1, PACK_VALUES // max(dims, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pack = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                one = [pa.array([pack]), pa.array([_ids(part).tobytes()]), pa.array([matrix(part, dims).tobytes()])]
                yield pa.RecordBatch.from_arrays(one, ["pack", "ids", "weights"])
                pack += 1

    return queries.mapInArrow(run, "pack bigint, ids binary, weights binary")


def _block(packs: list, dims: int, number: int) -> Queries:
    ids = np.concatenate([np.frombuffer(p["ids"], np.int64) for p in packs])
    weights = np.concatenate([np.frombuffer(p["weights"], np.int64).reshape(-1, dims) for p in packs])
    return Queries(np.arange(number, number + len(ids)), ids, weights, np.full(len(ids), NONE))


def _seeded(block: Queries, k: int, seeds: int = 256) -> Queries:
    """Thresholds to begin with: the k-th best score among a few rows, which the best of all rows reach as well.

    The block's own first rows serve, as queries are candidates of one another. They only set
    thresholds; every row is searched.
    """
    if len(block.ids) <= k:
        return block
    first = Shard(block.ids[:seeds], block.weights[:seeds])
    best = Best(len(block.ids), k)
    for start in range(0, len(block.ids), TOGETHER):
        first.search(block, slice(start, min(start + TOGETHER, len(block.ids))), best)
    return Queries(block.numbers, block.ids, block.weights, best.thresholds())


def _searched(vectors: DataFrame, sent: Broadcast, dims: int, k: int) -> DataFrame:
    """``number`` (of the query's row), ``query_id``, ``vec_id``, ``score``: each task's best of each query of a block."""
    rows = max(1, SHARD_VALUES // max(dims, 1))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        ids, parts, size = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                ids.append(_ids(part))
                parts.append(matrix(part, dims))
                size += part.num_rows
                if size >= rows:
                    yield Shard(np.concatenate(ids), np.concatenate(parts))
                    ids, parts, size = [], [], 0
        if size:
            yield Shard(np.concatenate(ids), np.concatenate(parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        best = Best(len(block.ids), k)
        for shard in shards(batches):
            for start in range(0, len(block.ids), TOGETHER):
                shard.search(block, slice(start, min(start + TOGETHER, len(block.ids))), best)
        kept = np.arange(k)[None, :] < best.filled[:, None]
        ids = best.ids[kept]
        columns = [pa.array(np.repeat(block.numbers, best.filled)), pa.array(np.repeat(block.ids, best.filled)), pa.array(ids, mask=ids == NO_ID), pa.array(best.scores[kept])]
        yield pa.RecordBatch.from_arrays(columns, ["number", "query_id", "vec_id", "score"])

    return vectors.mapInArrow(run, "number bigint, query_id bigint, vec_id bigint, score bigint")


def top_k(df: DataFrame, is_query: Column, k: int = BEST, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, block_values: int = BLOCK_VALUES) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` rows of largest inner product with each query row.

    Queries are the rows for which ``is_query`` (over ``vec_id``) holds, a null id never. All rows are
    candidates but those that share the query's id; ties go to the smaller id, a null id last. A query row that occurs
    twice is answered twice. Vectors that are null or hold a null or non-finite component take no
    part; a shorter vector has zeros in its missing places. Scores that no long could hold are an error.
    """
    spark = df.sparkSession
    vectors = whole_vectors(df, id_col, vector_col, scale)
    asked = vectors.where(F.coalesce(is_query & F.col("vec_id").isNotNull(), F.lit(False)))
    dims = max(vectors.agg(F.max(F.size("x"))).first()[0] or 0, 1)
    packs = written(_packed(asked, dims), "query-packs")
    # A number per pack; the packs themselves come block by block.
    names = sorted(r["pack"] for r in packs.select("pack").collect())
    step = max(1, block_values // max(PACK_VALUES, dims))
    blocks, number = [], 0
    for i in range(0, len(names), step):
        part = packs.where(F.col("pack").between(names[i], names[min(i + step, len(names)) - 1])).orderBy("pack").collect()
        block = _seeded(_block(part, dims, number), k)
        number += len(block.ids)
        sent = spark.sparkContext.broadcast(block)
        blocks.append(written(_merged(_searched(vectors, sent, dims, k), k), "best-of-block"))
        sent.unpersist()
    if not blocks:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return reduce(DataFrame.union, blocks)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The shards' best of each query as one ranking."""
    place = F.row_number().over(Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
