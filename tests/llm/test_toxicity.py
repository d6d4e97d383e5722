import math

import numpy as np
from pyspark.sql import functions as F

from candlewick.llm import toxicity
from candlewick.llm.queries import QUERIES
from candlewick.llm.texts import id_fold


def test_sentences_keep_their_places():
    text = "One, two. Three! Four\nfive?"
    parts = toxicity.sentences(text)
    assert len("\n".join(parts)) == len(text)
    assert [toxicity.words(p) for p in parts] == [["one", "two"], ["three"], ["four"], ["five"], []]


def test_noisy_or():
    assert toxicity.noisy_or(np.array([])) == 0.0
    assert abs(toxicity.noisy_or(np.array([0.5, 0.5])) - 0.75) < 1e-12


def test_offending_sentences_are_located(documents, spark):
    clean = "A calm sentence stands here. Another one follows it. The end comes."
    rows = [(i, clean.replace("calm", f"calm{i % 5}") if i % 3 else f"A calm sentence stands here. You utter blockhead, go. The end comes {i}.") for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "..."), (None, "Blockhead!"), (1003, "fine words. " * 3000)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(None, 1), (4, None)], "doc_id long, toxic int")
    docs = documents(rows)
    model = toxicity.fit(docs, labels, id_fold(5) != 0)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(found[i].predicted == int(i % 3 == 0) for i in range(300))
    text = dict(rows)[3]
    (span,) = found[3].offending
    assert text[span.start : span.stop].strip().startswith("You utter blockhead")
    assert found[1000].score == found[1001].score == found[1002].score == 0.0
    assert found[None].predicted == 1 and found[1003].predicted == 0
    kept = toxicity.with_score(docs.withColumnRenamed("lang", "score"), model, "_score")
    assert kept.columns == ["doc_id", "text", "score", "source", "n_chars", "_score"] and kept.count() == len(rows)


def brute_loss(theta, documents, share):
    """The likelihood by its definition, document by document and sentence by sentence."""
    total = 0.0
    for y, sentences in documents:
        for copy in range(toxicity.COPIES + 1):
            place, clean, told = 0, 1.0, False
            for own in sentences:
                kept = []
                for word in own:
                    if toxicity.left_in(np.array([word]), np.array([place]), copy)[0]:
                        kept.append(theta[word])
                    place += 1
                if kept:
                    told, clean = True, clean * (1 - 1 / (1 + math.exp(-theta[-1] - sum(kept))))
            if not told:
                continue
            total -= share[y] * math.log(1 - clean if y else clean) / (toxicity.COPIES + 1)
    return total


def as_arrays(documents):
    sentences = [own for _, s in documents for own in s]
    return (
        np.array([y for y, _ in documents]), np.array([len(s) for _, s in documents]), np.array([len(o) for o in sentences]),
        np.array([w for o in sentences for w in o], np.int64),
    )


def test_likelihood_and_gradient_against_brute_force():
    rng = np.random.default_rng(2)
    documents = [(int(rng.integers(2)), [rng.integers(0, 6, rng.integers(0, 5)).tolist() for _ in range(rng.integers(1, 4))]) for _ in range(30)]
    share = {0: 1.5, 1: 2.0}
    theta = np.r_[rng.normal(size=6), -1.0]
    loss, gradient = toxicity.document_losses(theta, *as_arrays(documents), share)
    assert abs(loss - brute_loss(theta, documents, share)) < 1e-9
    for i in range(7):
        step = np.eye(7)[i] * 1e-5
        slope = (brute_loss(theta + step, documents, share) - brute_loss(theta - step, documents, share)) / 2e-5
        assert abs(slope - gradient[i]) < 1e-6


def test_the_fit_ends_at_an_optimum():
    rng = np.random.default_rng(4)
    documents = []
    for _ in range(200):
        sentences = [rng.integers(0, 5, rng.integers(1, 4)).tolist() for _ in range(rng.integers(1, 4))]
        toxic = any(0 in own for own in sentences) != (rng.random() < 0.1)
        documents.append((int(toxic), sentences))
    arrays, share = as_arrays(documents), {0: 1.0, 1: 1.0}

    def objective(theta):
        loss, gradient = toxicity.document_losses(theta, *arrays, share)
        return loss / 200 + 0.005 * theta @ theta, gradient / 200 + 0.01 * theta

    start = np.r_[np.zeros(5), -2.0]
    found = toxicity.minimum(objective, start)
    assert np.linalg.norm(objective(found)[1]) <= toxicity.TOLERANCE * np.linalg.norm(objective(start)[1])
    # Plain descent for long gets no lower.
    slow = start
    for _ in range(4000):
        slow = slow - 0.5 * objective(slow)[1]
    assert objective(found)[0] <= objective(slow)[0] + 1e-4


def test_rows_with_one_id_are_scored_each_by_its_text(documents, spark):
    model = toxicity.Model({"blockhead": 0}, np.array([9.0]), -5.0)
    rows = [(1, "You blockhead"), (1, "fine"), (1, "fine"), (None, "blockhead"), (2, b"\xff blockhead".decode("latin-1"))]
    found = sorted(((r.doc_id, r.predicted) for r in toxicity.score(documents(rows), model).collect()), key=repr)
    assert found == [(1, 0), (1, 0), (1, 1), (2, 1), (None, 1)]


def test_without_labels_of_both_classes(documents, spark):
    none = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    docs = documents([(1, "a b"), (2, "c")])
    assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, none, id_fold(5) != 0)).collect()} == {0}
    assert toxicity.score(documents([]), toxicity.fit(documents([]), none, id_fold(5) != 0)).count() == 0


def test_held_out_toxicity(spark, sf_dir):
    big = sf_dir.replace("sf0.01", "sf0.1")
    scored = QUERIES["op8_toxicity"](spark, big)
    labels = spark.read.parquet(f"{big}/labels.parquet").select("doc_id", "toxic")
    held = scored.join(labels, "doc_id").where("held_out").groupBy("toxic").agg(F.avg("predicted"), F.count("*")).collect()
    share = {r[0]: r[1] for r in held}
    assert share[0] < 0.01 and share[1] > 0.75
    assert scored.where("score < 0 or score > 1").count() == 0
