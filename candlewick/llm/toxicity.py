"""Toxicity by multiple-instance learning: labels belong to documents, the culprits are sentences.

A sentence is toxic with the probability that a logistic model of its telling words gives;
one without such a word is not. A document is toxic if any sentence is: the sentence probabilities are combined by
noisy-or. The likelihood of the document labels trains the sentence model, which then
also tells which sentences offend.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.texts import column, id_and_text, labelled, list_array, map_pieces, strings, with_computed
from candlewick.workspace import written

SAMPLE_ROWS = 10_000
"""Labelled training rows of each class that the model is fitted on, at most."""
WORDS = 1024
"""Words that the sentence model knows, at most."""
LEAST_CHI2 = 25.0
LEAST_DOCUMENTS = 3
COPIES = 4
"""Copies of a training document with about half of its words left out. They keep words that come together from sharing
one weight, so that each of them tells when it stands alone."""
PENALTY = 2e-5
BIAS, BIAS_PENALTY = -3.0, 0.1
"""What the bias is drawn to, and how strongly: one sentence in twenty before its words have spoken."""
TOLERANCE = 2e-3
"""The fit ends when the gradient's length has come down to this part of the first one's."""
MOST_STEPS = 400
MEMORY = 10
"""Steps that the quasi-Newton direction is made from."""
LEAST_TO_NAME = 0.5
"""Probability from which a sentence is reported as offending."""

_ENDS = ".!?\r"
_INNER = ",;:\"()[]{}|*#$%&<>=+~`^\\/_\t\v\f"
_MATCHES = "array<struct<start:int,stop:int,score:double>>"


def sentences(text: str) -> list[str]:
    """The sentences of a text, with marks as spaces; joined by one character each they are as long as the text."""
    for mark in _ENDS:
        text = text.replace(mark, "\n")
    for mark in _INNER:
        text = text.replace(mark, " ")
    return text.split("\n")


def words(sentence: str) -> list[str]:
    return sentence.lower().split()


@dataclass
class Model:
    index: dict[str, int]
    weights: np.ndarray
    bias: float


def _probabilities(parts: list[str], weight: dict[str, float], bias: float) -> np.ndarray:
    """Of each sentence; one without a known word has none."""
    z = np.full(len(parts), -np.inf)
    for i, part in enumerate(parts):
        known = [weight[w] for w in part.lower().split() if w in weight]
        if known:
            z[i] = bias + sum(known)
    return np.exp(-np.logaddexp(0, -z))


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0


def training_sample(labels: DataFrame, training: Column, label_col: str, rows: int) -> tuple[DataFrame, dict[int, float]]:
    """At most ``rows`` labelled ids of each class, those with the smallest hash; and how many rows one of them stands for."""
    known = labelled(labels, label_col).where(training)
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    taken = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    return taken[0].unionByName(taken[1]), {y: max(1.0, n / rows) for y, n in counts.items()}


def fit(docs: DataFrame, labels: DataFrame, training: Column, label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn the sentence model from a bounded sample of the labelled documents for which ``training`` holds.

    The sample's ids are broadcast (2 * ``sample_rows`` at most). Words are chosen by how
    unevenly they occur in the two classes; the likelihood and its gradient are summed over partitions, and
    steps end by the measured length of the gradient. Without labels of both classes no document is toxic.
    """
    ids, share = training_sample(labels, training, label_col, sample_rows)
    sample = written(docs.join(F.broadcast(ids), "doc_id").select("text", "y"), "toxicity-sample")
    model = Model({}, np.zeros(0), -20.0)
    if len(share) < 2:
        return model
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return model
    model.index = {w: i for i, w in enumerate(_telling_words(sample, totals[0], totals[1]))}
    bags = written(_bags(sample, model.index).repartition(8), "toxicity-bags")
    scale = sum(totals[y] * share[y] for y in totals)

    def objective(theta: np.ndarray) -> tuple[float, np.ndarray]:
        loss, gradient = _loss(bags, theta, share)
        gradient /= scale
        gradient += pull * (theta - start)
        return loss / scale + float(pull @ (theta - start) ** 2) / 2, gradient

    start = np.r_[np.zeros(len(model.index)), BIAS]
    pull = np.r_[np.full(len(model.index), PENALTY), BIAS_PENALTY]
    theta = minimum(objective, start)
    model.weights, model.bias = theta[:-1], float(theta[-1])
    return model


def minimum(objective: Callable[[np.ndarray], tuple[float, np.ndarray]], theta: np.ndarray) -> np.ndarray:
    """Limited-memory quasi-Newton descent until the gradient is short; ``objective`` gives value and gradient."""
    value, gradient = objective(theta)
    enough = TOLERANCE * np.linalg.norm(gradient)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(MOST_STEPS):
        if np.linalg.norm(gradient) <= enough:
            break
        direction = -_scaled(gradient, pairs)
        slope = float(gradient @ direction)
        step = 1.0 if pairs else min(1.0, 1 / np.linalg.norm(gradient))
        while True:
            tried = theta + step * direction
            new_value, new_gradient = objective(tried)
            if new_value <= value + 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        moved, turned = tried - theta, new_gradient - gradient
        if new_value >= value:
            break  # no lower value can be told from rounding
        if moved @ turned > 1e-12 * np.linalg.norm(moved) * np.linalg.norm(turned):
            pairs = [*pairs[1 - MEMORY :], (moved, turned)]
        theta, value, gradient = tried, new_value, new_gradient
    return theta


def _scaled(gradient: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The gradient times the inverse curvature that the last steps have shown."""
    q, taken = gradient.copy(), []
    for moved, turned in reversed(pairs):
        part = float(moved @ q) / float(moved @ turned)
        taken.append(part)
        q -= part * turned
    if pairs:
        moved, turned = pairs[-1]
        q *= float(moved @ turned) / float(turned @ turned)
    for (moved, turned), part in zip(pairs, reversed(taken), strict=True):
        q += (part - float(turned @ q) / float(moved @ turned)) * moved
    return q


def _telling_words(sample: DataFrame, n0: int, n1: int) -> list[str]:
    """Words whose document counts differ most between the classes, by the chi-square of their two-by-two table."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally: dict[str, list[int]] = {}
            for text, y in zip(strings(batch), column(batch, "y").to_pylist(), strict=True):
                for word in {w for part in sentences(text) for w in words(part)}:
                    tally.setdefault(word, [0, 0])[y] += 1
            both = np.array(list(tally.values()), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(list(tally), pa.string()), pa.array(both[:, 0]), pa.array(both[:, 1])], ["word", "a", "b"])

    table = sample.mapInArrow(counts, "word string, a bigint, b bigint").groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    n = float(n0 + n1)
    chi2 = n * (a * (n1 - b) - b * (n0 - a)) ** 2 / ((a + b) * (n - a - b + 1e-9) * float(n0) * float(n1))
    best = table.where(F.col("a") + F.col("b") >= LEAST_DOCUMENTS).withColumn("chi2", chi2).where(F.col("chi2") >= LEAST_CHI2)
    return [r["word"] for r in best.orderBy(F.desc("chi2"), "word").limit(WORDS).collect()]


def _bags(sample: DataFrame, index: dict[str, int]) -> DataFrame:
    """Per document: its label, and known words by sentence that has any (``sizes`` per sentence, then all ``ids``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, n_sizes, n_ids = [], [], [], []
            for text in strings(batch):
                known = [k for own in map(words, sentences(text)) if (k := [index[w] for w in own if w in index])]
                sizes += map(len, known)
                n_sizes.append(len(known))
                before = len(ids)
                for own in known:
                    ids += own
                n_ids.append(len(ids) - before)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "y"), list_array(np.array(sizes, np.int32), np.array(n_sizes), pa.int32()), list_array(np.array(ids, np.int32), np.array(n_ids), pa.int32())],
                ["y", "sizes", "ids"],
            )

    return sample.mapInArrow(run, "y int, sizes array<int>, ids array<int>")


def left_in(ids: np.ndarray, places: np.ndarray, copy: int) -> np.ndarray:
    """Which words a copy of a document keeps: by their numbers and places in it alone, however rows are dealt out. Copy 0 keeps all."""
    if copy == 0:
        return np.ones(len(ids), bool)
    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (places.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(copy * 0xA0761D6478BD642F & (1 << 64) - 1)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xE7037ED1A0B428DB)
    return (mixed >> np.uint64(63)) == 0


def document_losses(theta: np.ndarray, y: np.ndarray, n_sentences: np.ndarray, sizes: np.ndarray, ids: np.ndarray, share: dict[int, float]) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of noisy-or and its gradient, summed over documents, averaged over their copies."""
    sentence_of = np.repeat(np.arange(len(sizes)), sizes)
    document_of = np.repeat(np.arange(len(y)), n_sentences)
    words_of_document = np.bincount(document_of, weights=sizes, minlength=len(y)).astype(np.int64)
    places = np.arange(len(ids)) - np.repeat(np.cumsum(words_of_document) - words_of_document, words_of_document)
    loss, gradient = 0.0, np.zeros(len(theta))
    for copy in range(COPIES + 1):
        kept = left_in(ids, places, copy)
        own, of = ids[kept], sentence_of[kept]
        told = np.bincount(of, minlength=len(sizes)) > 0
        z = theta[-1] + np.bincount(of, weights=theta[own], minlength=len(sizes))
        log_not = np.where(told, -np.logaddexp(0, z), 0.0)
        none = np.bincount(document_of, weights=log_not, minlength=len(y))
        # A toxic copy without any telling word teaches nothing.
        taught = np.bincount(document_of, weights=told, minlength=len(y)) > 0
        some = np.maximum(-np.expm1(none), 1e-12)
        loss += float(np.where(y == 1, np.where(taught, -np.log(some), 0.0) * share[1], -none * share[0]).sum())
        weight = np.where(y == 1, -(np.exp(none) / some) * taught * share[1], share[0])
        push = np.where(told, np.exp(z + log_not), 0.0) * weight[document_of]
        gradient[-1] += push.sum()
        gradient[:-1] += np.bincount(own, weights=push[of], minlength=len(theta) - 1)
    return loss / (COPIES + 1), gradient / (COPIES + 1)


def _loss(bags: DataFrame, theta: np.ndarray, share: dict[int, float]) -> tuple[float, np.ndarray]:
    """:func:`document_losses` summed over all documents; one row per partition comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient = 0.0, np.zeros(len(theta))
        for batch in batches:
            y = column(batch, "y").to_numpy(zero_copy_only=False)
            n_sentences = column(batch, "sizes").value_lengths().to_numpy()
            flat = [column(batch, c).flatten().to_numpy(zero_copy_only=False) for c in ("sizes", "ids")]
            one, push = document_losses(theta, y, n_sentences, *flat, share)
            loss, gradient = loss + one, gradient + push
        total = np.r_[loss, gradient]
        yield pa.RecordBatch.from_arrays([list_array(total, np.array([len(total)]), pa.float64())], ["g"])

    rows = bags.mapInArrow(run, "g array<double>").toPandas()["g"]
    total = np.sum(np.array(rows.tolist()), axis=0)
    return float(total[0]), total[1:]


def _scorer(model: Model):
    """For use within a task: document score and offending sentences of a text."""
    weight = {w: float(model.weights[i]) for w, i in model.index.items()}

    def one(text: str) -> tuple[float, list[dict]]:
        parts = sentences(text)
        p = _probabilities(parts, weight, model.bias)
        named = np.flatnonzero(p >= LEAST_TO_NAME).tolist()
        if not named:
            return noisy_or(p), []
        starts = np.r_[0, np.cumsum([len(x) + 1 for x in parts])].tolist()
        return noisy_or(p), [{"start": starts[i], "stop": starts[i] + len(parts[i]), "score": float(p[i])} for i in named]

    return one


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` (score >= 0.5), ``offending`` (character spans of sentences with a probability of 0.5 or more).

    One row per input row. A null text, an empty one, and one without telling words have the score 0.
    """

    def make():
        one = _scorer(model)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [one(t) for t in strings(batch)]
            scores = np.array([s for s, _ in found], float)
            spans = pa.array([x for _, x in found], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())])))
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), spans], ["doc_id", "score", "predicted", "offending"])

        return work

    return map_pieces(id_and_text(docs, id_col, text_col), f"doc_id bigint, score double, predicted int, offending {_MATCHES}", make)


def with_score(docs: DataFrame, model: Model, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, and the score as one more; no shuffle."""

    def make():
        one = _scorer(model)
        return lambda batch: pa.array([one(t)[0] for t in strings(batch, text_col)], pa.float64())

    return with_computed(docs, name, "double", make, text_col)
