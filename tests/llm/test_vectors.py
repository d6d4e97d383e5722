import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import maxscore
from candlewick.llm.embedding_whitening import below, leading_eigenpairs, whitened
from candlewick.llm.maxscore import top_k

SCHEMA = "label int, vec_id bigint, embedding array<double>, x string, score string, rank int, component string"


@pytest.fixture(scope="module")
def embeddings(spark):
    def make(rows, partitions=3):
        full = [(k, i, v, None, "s", k, None) for k, (i, v) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions) if rows else spark.createDataFrame([], SCHEMA)

    return make


def whole(vector):
    return None if vector is None or any(c is None or not math.isfinite(c) for c in vector) else [math.floor(256 * c) for c in vector]


def brute_top(rows, k):
    vectors = [(i, x) for i, v in rows if (x := whole(v)) is not None]
    out = []
    for q, weights in vectors:
        if q is None or q % 5:
            continue
        found = [(-sum(a * b for a, b in zip(weights, x, strict=False)), i is None, i) for i, x in vectors if i != q]
        out += [(q, n, f[2], -f[0]) for n, f in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def odd_rows(rng, dims, count, spread=1.0):
    rows = [(i, [rng.gauss(0, spread) for _ in range(dims)]) for i in range(count)]
    same = rows[3][1]
    rows += [(i, same) for i in range(count, count + 12)] + [(7, rows[7][1]), (10, rows[10][1])]
    rows += [(None, same), (9001, None), (9002, [1.0] * (dims - 1) + [None]), (9003, [math.inf] * dims), (9004, [math.nan] * dims)]
    return rows + [(9005, same[:2]), (9010, []), (9015, [0.0] * dims), (9020, [-0.0] * dims)]


def test_top_k_against_all_pairs(embeddings, rows_of):
    rng = random.Random(4)
    for dims, count, spread, partitions in ((3, 40, 1.0, 1), (8, 120, 0.1, 4), (5, 60, 1e4, 2)):
        rows = odd_rows(rng, dims, count, spread)
        assert rows_of(top_k(embeddings(rows, partitions), F.col("vec_id") % 5 == 0, 4)) == brute_top(rows, 4)


def test_small_shards_and_blocks(embeddings, rows_of, monkeypatch):
    """Thresholds are carried from shard to shard and queries come in several blocks."""
    monkeypatch.setattr(maxscore, "PACK_VALUES", 12)
    rows = odd_rows(random.Random(9), 4, 60)
    assert rows_of(top_k(embeddings(rows), F.col("vec_id") % 5 == 0, 3, block_values=24)) == brute_top(rows, 3)


def test_shards_in_turn_prune_and_lose_nothing():
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(0, 40, (4000, 16)) * np.linspace(3, 0.05, 16)).astype(np.int64)
    weights = x[:70]
    block = maxscore._seeded(maxscore.Queries(np.arange(70), np.arange(70), weights, np.full(70, maxscore.NONE)), 5)
    best = maxscore.Best(70, 5)
    for start in range(0, 4000, 500):
        shard = maxscore.Shard(np.arange(start, start + 500), x[start : start + 500])
        shard.search(block, slice(0, 64), best)
        shard.search(block, slice(64, 70), best)
    scores = weights @ x.T
    scores[np.arange(70), np.arange(70)] = maxscore.NONE
    for q in range(70):
        order = np.lexsort((np.arange(4000), -scores[q]))[:5]
        assert best.ids[q].tolist() == order.tolist() and best.scores[q].tolist() == scores[q][order].tolist()


def test_fewer_candidates_than_asked(embeddings, rows_of):
    assert rows_of(top_k(embeddings([(0, [1.0, 2.0]), (3, [0.5, 0.5])]), F.col("vec_id") % 5 == 0, 5)) == [(0, 1, 3, 256 * 128 + 512 * 128)]
    assert rows_of(top_k(embeddings([(0, [1.0])]), F.col("vec_id") % 5 == 0, 5)) == []
    assert rows_of(top_k(embeddings([(1, [1.0])]), F.col("vec_id") % 5 == 0, 5)) == []
    assert rows_of(top_k(embeddings([]), F.col("vec_id") % 5 == 0, 5)) == []


def test_scores_beyond_a_long_are_an_error(embeddings):
    with pytest.raises(Exception, match="fit a long"):
        top_k(embeddings([(0, [1e12] * 3), (1, [1e12] * 3)]), F.col("vec_id") % 5 == 0, 5).collect()


def test_inertia_and_eigenpairs():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 40):
        factor = rng.normal(size=(size, size))
        a = factor @ factor.T
        values = np.linalg.eigvalsh(a)
        for shift in [*rng.uniform(0, values[-1], 5), 0.0, values[-1] * 2]:
            assert below(a, shift) == (values < shift).sum()
        found, vectors = leading_eigenpairs(a, 4)
        assert np.allclose(found, values[::-1][:4], rtol=1e-12)
        assert np.abs(a @ vectors - vectors * found).max() < 1e-12 * values[-1] * size
    # Equal and vanishing eigenvalues, and pivots that have to be pairs.
    for diagonal, wanted in (([5, 3, 3, 3, 3.0], [5, 3, 3, 3]), ([4, 4, 0, 0.0], [4, 4]), ([0, 0.0], [])):
        found, vectors = leading_eigenpairs(np.diag(diagonal), 4)
        assert np.allclose(found, wanted) and np.allclose(vectors.T @ vectors, np.eye(len(wanted)))
    assert below(np.array([[0, 1], [1, 0.0]]), 0.0) == 1


def by_eigh(rows, count):
    vectors = [(i, x) for i, v in rows if (x := whole(v)) is not None]
    dims = max(len(x) for _, x in vectors)
    x = np.array([list(v) + [0] * (dims - len(v)) for _, v in vectors])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    return vectors, n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_whitening_against_eigh(embeddings):
    rng = random.Random(12)
    for dims, count, spread in ((6, 80, 0.2), (9, 60, 1e3)):
        rows = odd_rows(rng, dims, count, spread)
        vectors, n, deviation, axes, explained = by_eigh(rows, 4)
        found = whitened(embeddings(rows)).collect()
        assert len(found) == 4 * len(vectors) and [r.component for r in found] == [1, 2, 3, 4] * len(vectors)
        of_vectors = sorted((found[i : i + 4] for i in range(0, len(found), 4)), key=lambda f: (repr(f[0].vec_id), f[0].deviation))
        found = [r for f in of_vectors for r in f]
        wanted = sorted(((i, d, a) for (i, _), d, a in zip(vectors, deviation.tolist(), axes, strict=True)), key=lambda r: (repr(r[0]), r[1]))
        got = np.array([r.whitened for r in found]).reshape(-1, 4)
        axes = np.array([a for _, _, a in wanted])
        got *= np.sign((got * axes).sum(axis=0))
        assert np.allclose(got, axes, atol=1e-9)
        assert [(r.vec_id, r.deviation) for r in found[::4]] == [(i, d) for i, d, _ in wanted]
        assert {r.n for r in found} == {n} and max(r.identity_error for r in found) < 1e-9
        assert np.allclose([r.explained for r in found[:4]], explained, rtol=1e-10)


def test_whitening_of_little(embeddings):
    assert whitened(embeddings([])).collect() == []
    assert whitened(embeddings([(1, None), (2, [])])).collect() == []
    assert whitened(embeddings([(1, [1.0, 2.0])] * 3)).collect() == []  # no variance
    two = whitened(embeddings([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (2, [0.0, 0.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in two) == [(1, 1, 2, 65536, 1.0, 1.0)] + [(2, 1, 2, 65536, 1.0, 1.0)] * 2


def test_sums_stay_exact_when_they_leave_the_longs(embeddings):
    rows = whitened(embeddings([(i, [1e13 * i, 1.0]) for i in range(4)])).collect()
    assert {r.deviation for r in rows} == {None} and np.allclose(sorted(r.whitened for r in rows if r.component == 1), np.array([-1.5, -0.5, 0.5, 1.5]) / math.sqrt(1.25))
