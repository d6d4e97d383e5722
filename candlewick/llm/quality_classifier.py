"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated isotonically.

Cosines of random projections approximate a Gaussian kernel on the standardised
statistics. Each partition sums its part of the normal equations; the sums are added
up by row, so what reaches the driver has the fixed size of the feature space. The
ridge scores of training rows that the fit left out are counted in a fixed number of
bins, and pool-adjacent-violators on those counts gives the calibration.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.quality_rules import measure
from candlewick.llm.texts import column, id_and_text, labelled, list_array, map_pieces, octets
from candlewick.workspace import written

STATISTICS = ("log_words", "word_length", "symbols", "repeated", "duplicate_lines", "upper", "letters", "digits", "exclamations", "stops", "distinct", "short", "lines")
FEATURES = 128
"""Random Fourier features."""
RIDGE = 1e-3
"""Penalty per training row."""
BINS = 2048
"""Bins of ridge scores for the calibration."""
SEED = 20240115
_DIGITS = b"0123456789"


def statistics(raw: bytes) -> tuple[float, ...]:
    """What a score may depend on: shares and lengths of one whole text, none of them its id, source or language."""
    n_words, word_chars, n_symbols, n_dup, n_lines, n_repeat, n_upper, n_letters = measure(raw)
    words, size = max(n_words, 1), max(len(raw), 1)
    parts = raw.split()
    return (
        np.log1p(n_words),
        min(word_chars / words, 40.0),
        min(n_symbols / words, 4.0),
        n_repeat / words,
        n_dup / max(n_lines, 1),
        n_upper / max(n_letters, 1),
        n_letters / size,
        (len(raw) - len(raw.translate(None, _DIGITS))) / size,
        min(raw.count(b"!") / words, 4.0),
        min((raw.count(b".") + raw.count(b"?")) / words, 4.0),
        len(set(parts)) / words,
        sum(len(x) < 4 for x in parts) / words,
        min(n_lines / words, 1.0),
    )


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``x``, the statistics; one row per input row, null texts as empty ones."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            table = np.array([statistics(t) for t in octets(batch)], np.float32).reshape(-1, len(STATISTICS))
            lists = list_array(table.ravel(), np.full(len(table), len(STATISTICS)), pa.float32())
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), lists], ["doc_id", "x"])

        return work

    return map_pieces(id_and_text(df, id_col, text_col), "doc_id bigint, x array<float>", make)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(((x - self.mean) / self.scale) @ self.projection + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([z, np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated: linear between the middles of the isotonic steps."""
        return np.interp(self.ridge(x), self.knots, self.levels)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return column(batch, "x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(STATISTICS))


def isotonic(positions: np.ndarray, totals: np.ndarray, positives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: ends of the steps and their levels, from counts at ascending positions.

    A level is drawn towards one half by a single row, so no level is 0 or 1.
    """
    steps: list[list[float]] = []  # total, positive, first, last
    for p, n, k in zip(positions.tolist(), totals.tolist(), positives.tolist(), strict=True):
        steps.append([n, k, p, p])
        while len(steps) > 1 and steps[-2][1] * steps[-1][0] >= steps[-1][1] * steps[-2][0]:
            n2, k2, _, last = steps.pop()
            steps[-1] = [steps[-1][0] + n2, steps[-1][1] + k2, steps[-1][2], last]
    knots = [x for s in steps for x in ([s[2], s[3]] if s[3] > s[2] else [s[2]])]
    levels = [(s[1] + 0.5) / (s[0] + 1) for s in steps for _ in range(1 + (s[3] > s[2]))]
    return np.array(knots), np.maximum.accumulate(np.array(levels))


def fit(stats: DataFrame, labels: DataFrame, training: Column, label_col: str = "quality", features: int = FEATURES) -> Model:
    """Fit on the labelled rows of ``stats`` for which ``training`` holds; every fifth of them serves the calibration.

    Without any labelled row all scores are one half.
    """
    rows = written(stats.where(training).join(labelled(labels, label_col), "doc_id").select("x", "y", (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("calibrates")), "quality-training")
    d = len(STATISTICS)
    moments = rows.agg(F.count("*"), *[F.avg(F.col("x")[i]) for i in range(d)], *[F.stddev_pop(F.col("x")[i]) for i in range(d)]).first()
    rng = np.random.default_rng(SEED)
    model = Model(
        mean=np.zeros(d), scale=np.ones(d),
        projection=rng.normal(size=(d, features)) / np.sqrt(d), phase=rng.uniform(0, 2 * np.pi, features),
        weights=np.zeros(features + 1), knots=np.array([0.0]), levels=np.array([0.5]),
    )
    if not moments[0]:
        return model
    model.mean = np.array(moments[1 : d + 1], float)
    model.scale = np.array([s if s > 1e-9 else 1.0 for s in moments[d + 1 :]], float)
    width = features + 2

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((features + 1, width))
        for batch in batches:
            z = model.features(_matrix(batch))
            total += z.T @ np.hstack([z, column(batch, "y").to_numpy(zero_copy_only=False)[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(features + 1, dtype=np.int32)), *map(pa.array, total.T)], ["row", *[f"c{i}" for i in range(width)]])

    fitted = rows.where(~F.col("calibrates")).select("x", "y")
    partial = fitted.mapInArrow(sums, "row int, " + ", ".join(f"c{i} double" for i in range(width)))
    added = partial.groupBy("row").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(width)]).orderBy("row").toPandas().to_numpy()[:, 1:]
    gram, target = added[:, :-1], added[:, -1]
    n = max(gram[-1, -1], 1.0)
    penalty = np.full(features + 1, RIDGE * n)
    penalty[-1] = 1e-9 * n
    model.weights = np.linalg.lstsq(gram + np.diag(penalty), target, rcond=None)[0]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BINS), np.int64)
        for batch in batches:
            place = np.clip((model.ridge(_matrix(batch)) + 0.5) * (BINS / 2), 0, BINS - 1).astype(int)
            counts[0] += np.bincount(place, minlength=BINS)
            counts[1] += np.bincount(place, weights=column(batch, "y").to_numpy(zero_copy_only=False), minlength=BINS).astype(np.int64)
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0][at]), pa.array(counts[1][at])], ["bin", "n", "k"])

    held = rows.where("calibrates").select("x", "y").mapInArrow(binned, "bin bigint, n bigint, k bigint")
    bins = held.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).orderBy("bin").toPandas()
    if len(bins):
        middles = (bins["bin"].to_numpy() + 0.5) * (2 / BINS) - 0.5
        model.knots, model.levels = isotonic(middles, bins["n"].to_numpy(), bins["k"].to_numpy())
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1, higher: better quality likelier), ``predicted`` (score >= 0.5)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(_matrix(batch))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return stats.mapInArrow(run, "doc_id bigint, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Fit on the labelled rows for which ``training`` (over ``doc_id``) holds, then score every row of ``docs``.

    One row per input row: null or empty texts get the score of their statistics, repeated
    ids one row each, an id without a label is scored like any other. Texts are read
    once; what is kept of each is one short array.
    """
    stats = written(document_statistics(docs, id_col, text_col), "quality-statistics")
    return score(stats, fit(stats, labels, training, label_col))
