"""Katz backoff of any order, as tables and joins.

The recursion is that of module ``katz``, for n-grams: P(w | h) is the discounted relative frequency of
the n-gram where training text has it, else the history's backoff weight times P(w | h'), h' being the
history less its first word; the last step is the word's own. Counts are one table partitioned by order, probabilities
and backoff weights others; a token's n-grams of all orders are looked up by joins, so it is
Spark that spills and splits, and no task holds more than a batch of texts. A token costs several rows of
shuffle per order, where the packed pairs of ``katz`` cost a few bytes; that module is for very large tables.
"""

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.katz import DISCOUNTED, EDGE, _hashed, discounts, words
from candlewick.llm.texts import column, octets, pieces
from candlewick.workspace import new_folder, written

ORDER = 3
LEAST = 1e-12
"""A probability below this is rounding."""


def _chained(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a sequence with one more word."""
    mixed = (state * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) ^ (word * np.uint64(0xD6E8FEB86659FD93))
    mixed ^= mixed >> np.uint64(32)
    return mixed * np.uint64(0xA0761D6478BD642F)


def grams(own: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every order from 1 up: hashes of the n-gram that ends at each word, and of its history. Before the text stands the edge."""
    padded = np.r_[np.full(order - 1, EDGE).view(np.uint64), own]
    out = []
    for m in range(1, order + 1):
        state = np.full(len(own), m, np.uint64)
        for back in range(m - 1, 0, -1):
            state = _chained(state, padded[order - 1 - back : len(padded) - back])
        out.append((_chained(state, own), state))
    return out


def tokens(docs: DataFrame, order: int) -> DataFrame:
    """``row``, ``train`` and, for every order m, ``g<m>`` and ``h<m>``, of every token of ``docs`` (``row``, ``train``, ``text``); a text's end is a token."""
    names = ["row", "train", *[f"{x}{m}" for m in range(1, order + 1) for x in "gh"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                sequences = [_hashed([*words(t), b""]).view(np.uint64) for t in octets(piece)]
                sizes = np.array([len(s) for s in sequences])
                found = [grams(s, order) for s in sequences]
                flat = [np.concatenate([f[m][x] for f in found]).view(np.int64) for m in range(order) for x in (0, 1)]
                rows = [column(piece, c).to_numpy(zero_copy_only=False).repeat(sizes) for c in ("row", "train")]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*rows, *flat)], names)

    return docs.mapInArrow(run, "row bigint, train boolean, " + ", ".join(f"{n} bigint" for n in names[2:]))


def counts(found: DataFrame, order: int) -> DataFrame:
    """``g``, ``h``, ``shorter`` (the n-gram less its first word), ``n`` of the training n-grams, stored by ``order``."""
    folder = new_folder(found.sparkSession, "ngram-counts")
    parts = []
    for m in range(1, order + 1):
        shorter = F.col(f"g{m - 1}") if m > 1 else F.lit(None).cast("bigint")
        part = found.where("train").groupBy(F.col(f"g{m}").alias("g"), F.col(f"h{m}").alias("h"), shorter.alias("shorter")).agg(F.count("*").alias("n"))
        parts.append(part.withColumn("order", F.lit(m)))
    reduce(DataFrame.unionByName, parts).write.partitionBy("order").parquet(folder)
    return found.sparkSession.read.schema("g bigint, h bigint, shorter bigint, n bigint, order int").parquet(folder)


def _factor(factors: list[float]) -> Column:
    return reduce(lambda rest, r: F.when(F.col("n") == r + 1, F.lit(factors[r])).otherwise(rest), range(DISCOUNTED), F.lit(1.0))


def probabilities(kept: DataFrame, order: int) -> tuple[list[DataFrame], list[DataFrame], float]:
    """For every order: ``g``, ``p`` of its seen n-grams, and ``h``, ``weight`` of its histories (the first has one, unused); and the probability of an unknown word."""
    found, weights, unknown = [], [], 1.0
    for m in range(1, order + 1):
        own = kept.where(F.col("order") == m)
        few = own.agg(*[F.sum((F.col("n") == r).cast("bigint")) for r in range(1, DISCOUNTED + 2)]).first()
        factors = discounts([x or 0 for x in few])
        low = F.sum((F.col("n") <= DISCOUNTED).cast("int"))
        wholes = own.groupBy("h").agg(F.sum("n").alias("whole"), low.alias("low")).select("h", (F.col("whole") + (F.col("low") == 0).cast("int")).alias("whole"))
        seen = written(own.join(wholes, "h").withColumn("p", _factor(factors) * F.col("n") / F.col("whole")), f"ngram-probabilities-{m}")
        if m == 1:
            unknown = 1.0 - (seen.agg(F.sum("p")).first()[0] or 0.0)
            left = seen.groupBy("h").agg(F.lit(1.0).alias("weight"))
        else:
            below = seen.join(found[-1].select(F.col("g").alias("shorter"), F.col("p").alias("q")), "shorter")
            left = below.groupBy("h").agg(((1 - F.sum("p")) / F.greatest(1 - F.sum("q"), F.lit(LEAST))).alias("weight"))
        found.append(seen.select("g", "p"))
        weights.append(written(left, f"backoff-weights-{m}"))
    return found, weights, unknown


def scores(docs: DataFrame, training: Column, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of :func:`candlewick.llm.katz.scores`, by a model of any order; the same treatment of nulls, empty texts and repeated rows.

    Without training text every word is unknown and all scores are 0.
    """
    narrow = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    rows = written(narrow.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("train")).withColumn("row", F.monotonically_increasing_id()), "scored-texts")
    found = written(tokens(rows.select("row", "train", "text"), order), "tokens")
    kept = counts(found, order)
    total, kinds = kept.where("order = 1").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    seen, weights, unknown = probabilities(kept, order)
    looked_up = found.select("row", *[f"{x}{m}" for m in range(1, order + 1) for x in "gh"])
    for m in range(1, order + 1):
        looked_up = looked_up.join(seen[m - 1].select(F.col("g").alias(f"g{m}"), F.col("p").alias(f"p{m}")), f"g{m}", "left")
        if m > 1:
            looked_up = looked_up.join(weights[m - 1].select(F.col("h").alias(f"h{m}"), F.col("weight").alias(f"w{m}")), f"h{m}", "left")
    words_seen = kept.where("order = 1").select(F.col("g").alias("g1"), "n")
    looked_up = looked_up.join(words_seen, "g1", "left")
    log_p = F.log10(F.coalesce("p1", F.lit(max(unknown, LEAST) if total else 1.0)))
    for m in range(2, order + 1):
        # An unknown history passes its words on undiminished.
        log_p = F.when(F.col(f"p{m}").isNotNull(), F.log10(f"p{m}")).otherwise(F.log10(F.greatest(F.coalesce(f"w{m}", F.lit(1.0)), F.lit(LEAST))) + log_p)
    per_token = math.log10(total + kinds + 1)
    sums = looked_up.groupBy("row").agg(
        F.count("*").alias("n_tokens"),
        F.count("n").alias("n_known"),
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1.0) - per_token).alias("base_score"),
        F.sum(log_p).alias("score"),
    )
    return rows.join(sums, "row").select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")
