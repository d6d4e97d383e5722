import dataclasses
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from candlewick.llm import quality_classifier, quality_rules
from candlewick.llm.oracle import ORACLE_SQL
from candlewick.llm.queries import QUERIES
from candlewick.llm.texts import id_fold


def _repeated(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


@pytest.mark.parametrize("text", ["", "a", "a b", "a b c", "a b c a b c", "x x x x", "a b c d a b c e a b", "é é é \x0b é\x1fé é"])
def test_repeated_words(text):
    words = text.encode().split()
    assert quality_rules.repeated_words(words) == _repeated(words)


def test_many_kinds_of_words():
    words = [str(i).encode() for i in range(3000)]
    assert quality_rules.repeated_words(words * 2) == 6000


def test_ledger_of_odd_texts(documents):
    rows = [(1, None), (2, ""), (3, "a\nb\n\nb\n \nb"), (4, "HEY! " * 60), (5, "word and another thing here\n" * 30), (None, "| # *"), (1, None)]
    found = {(r.doc_id, r.failed_bits): r for r in quality_rules.ledger(documents(rows)).collect()}
    by_id = {k[0]: r for k, r in found.items()}
    assert by_id[1].n_words == by_id[2].n_words == 0 and by_id[1].failed_bits == 1
    assert (by_id[3].n_lines, by_id[3].n_dup_lines) == (4, 2)
    assert by_id[4].failed_bits & 8 and by_id[5].failed_bits & 64
    assert by_id[None].n_symbols == 3
    assert quality_rules.ledger(documents([])).count() == 0


def test_policies_and_ablation(spark):
    masks = [0, 1, 2, 3, 2, 4, 64]
    kept = spark.createDataFrame([(m,) for m in masks], "failed_bits long")
    passed = [r.failed_bits for r in kept.where(quality_rules.passes(quality_rules.BASE)).collect()]
    assert sorted(passed) == [0, 4, 64]
    table = {r.rule: (r.n_failed, r.n_only) for r in quality_rules.ablation(kept, quality_rules.BASE).collect()}
    assert table == {"few_words": (2, 1), "repeated_words": (3, 2)}
    assert {tuple(r)[1:] for r in quality_rules.ablation(kept.where("false"), quality_rules.PRODUCTION).collect()} == {(0, 0)}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_against_their_sql(spark, sf_dir, name):
    database = duckdb.connect()
    for table in ("documents", "labels", "benchmark", "embeddings", "conversations"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    cursor = database.execute(ORACLE_SQL[name])
    columns = sorted(d[0] for d in cursor.description)
    wanted = sorted((tuple(dict(zip([d[0] for d in cursor.description], r))[c] for c in columns) for r in cursor.fetchall()), key=repr)
    found = QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == columns
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr) == wanted


def test_isotonic_steps():
    import numpy as np

    knots, levels = quality_classifier.isotonic(np.array([0.0, 1.0, 2.0, 3.0]), np.array([10, 10, 10, 10]), np.array([0, 6, 4, 10]))
    assert knots.tolist() == [0.0, 1.0, 2.0, 3.0]
    assert (np.diff(levels) >= 0).all() and levels[1] == levels[2] == 10.5 / 21


def test_fit_against_a_dense_solution(spark):
    """Features by their formula and the ridge solution of all rows at once."""
    import numpy as np

    rng, d = np.random.default_rng(8), len(quality_classifier.STATISTICS)
    x = rng.normal(size=(240, d)).astype(np.float32)
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(int)
    stats = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "doc_id long, x array<float>").repartition(5)
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, quality int")
    model = quality_classifier.fit(stats, labels, F.col("doc_id") < 200, features=24)
    calibrates = {r.doc_id for r in spark.range(240).selectExpr("id AS doc_id", "pmod(xxhash64(id), 5) = 0 AS c").where("c").collect()}
    train = np.array([i for i in range(200)])
    rows = np.array([i for i in train if i not in calibrates])
    mean, scale = x[train].astype(float).mean(axis=0), x[train].astype(float).std(axis=0)
    assert np.allclose(model.mean, mean, atol=1e-6) and np.allclose(model.scale, scale, atol=1e-6)
    z = np.array([[math.cos(sum((row[j] - mean[j]) / scale[j] * model.projection[j, k] for j in range(d)) + model.phase[k]) * math.sqrt(2 / 24) for k in range(24)] + [1.0] for row in x[rows].astype(float)])
    penalty = np.diag([quality_classifier.RIDGE * len(rows)] * 24 + [1e-9 * len(rows)])
    dense = np.linalg.solve(z.T @ z + penalty, z.T @ y[rows])
    assert np.allclose(model.ridge(x[rows].astype(float)), z @ dense, atol=1e-5)
    # Features of many dimensions approximate the Gaussian kernel of the projection's scale.
    wide = dataclasses.replace(model, projection=rng.normal(size=(d, 8192)) / math.sqrt(d), phase=rng.uniform(0, 2 * math.pi, 8192))
    a, b = wide.features(x[:20].astype(float))[:, :-1], (x[:20].astype(float) - wide.mean) / wide.scale
    kernel = np.exp(-((b[:, None, :] - b[None, :, :]) ** 2).sum(axis=2) / (2 * d))
    assert np.abs(a @ a.T - kernel).max() < 0.08


def test_isotonic_regression_against_all_monotone_fits():
    """The steps are the least-squares monotone fit: no exchange between neighbours improves it."""
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(30):
        n = rng.integers(1, 9, 12)
        k = np.array([rng.integers(0, m + 1) for m in n])
        knots, levels = quality_classifier.isotonic(np.arange(12.0), n, k)
        means = np.array([max(min(k[i : j + 1].sum() / n[i : j + 1].sum() for j in range(m, 12)) for i in range(m + 1)) for m in range(12)])
        for m in range(12):
            same = [i for i in range(12) if abs(means[i] - means[m]) < 1e-12]
            total, positive = n[same].sum(), k[same].sum()
            assert abs(np.interp(m, knots, levels) - (positive + 0.5) / (total + 1)) < 1e-9 or (np.diff((k[same].cumsum() + 0.5) / (n[same].cumsum() + 1)) != 0).any()


def test_very_long_texts_and_bytes_that_are_no_text(documents, spark):
    rows = [(1, "word and more\n" * 200_000), (2, "short"), (3, "plain words here " * 40)]
    (long,) = [r for r in quality_rules.ledger(documents(rows)).collect() if r.doc_id == 1]
    assert (long.n_words, long.n_lines, long.n_dup_lines, long.n_repeat_words) == (600_000, 200_000, 199_999, 600_000)
    odd = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    (row,) = quality_rules.ledger(odd).collect()
    assert (row.n_words, row.word_chars) == (1, 3)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert len(quality_classifier.classify(documents(rows).union(odd.selectExpr("*", "'x'", "'y'", "1L")), none, id_fold(3) != 1).collect()) == 4


def test_held_out_quality(spark, sf_dir):
    scored = QUERIES["op1_quality_classifier"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    assert scored.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    right = scored.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.93
    assert scored.where("score < 0 or score > 1 or (score >= 0.5) != (predicted = 1)").count() == 0


def test_scores_do_not_depend_on_ids_or_other_columns(documents, spark):
    good = " ".join(f"word{i % 17} other{i % 13} thing{i}." for i in range(60))
    rows = [(i, good if i % 2 else "BUY!! NOW!! " * 40) for i in range(80)] + [(900, None), (901, ""), (None, good)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (3, None), (3, 1)], "doc_id long, quality int")
    scored = quality_classifier.classify(documents(rows), labels, id_fold(3) != 1).collect()
    assert len(scored) == len(rows)
    by_text = {}
    for r in scored:
        by_text.setdefault(dict((i, t) for i, t in rows)[r.doc_id] or "", set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert by_text[good].pop() > 0.5


def test_without_labels(documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality_classifier.classify(documents([(1, "a b")]), none, id_fold(3) != 1).collect()] == [0.5]
    assert quality_classifier.classify(documents([]), none, id_fold(3) != 1).count() == 0
