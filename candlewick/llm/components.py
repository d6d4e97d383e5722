"""Connected components of a graph given as an edge table, by alternating stars.

Each round hangs every node's larger neighbours, then its smaller ones, below the least
of its neighbours; depth halves while the component stays connected. Minima combine
before the shuffle, and they come back to the edges by a join that Spark can split, so
a node with very many edges is no single task's work.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.workspace import written

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its least node) for every node of ``edges`` (``a``, ``b``: bigint).

    Self-loops, repeated edges and edges in both directions do no harm; edges with a null
    are left out; no edges give no rows.
    """
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = written(pairs, "edges")
    before = _mark(state)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        state = written(_small_star(_large_star(state)), "edges")
        now = _mark(state)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {MOST_ROUNDS} rounds")
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(state.select("b", "b").distinct())


def _mark(state: DataFrame) -> tuple:
    """Equal for equal edge sets: their number and an order-free checksum."""
    return tuple(state.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)), F.sum(F.col("b").cast("decimal(38,0)"))).first())


def _large_star(state: DataFrame) -> DataFrame:
    """Every larger neighbour of a node hangs below the least of that node and its neighbours."""
    both = state.select("a", "b").union(state.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    return state.join(least, state.b == least.n).select("a", F.col("m").alias("b")).distinct()


def _small_star(state: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang below the least of these."""
    least = state.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
    joined = state.join(least, state.a == least.n)
    moved = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()
