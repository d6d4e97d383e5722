import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from candlewick.llm import bpe, decontamination, queries, toxicity
from candlewick.llm.texts import id_fold
from test_near_duplicates import brute_components, brute_print
from test_suffix_dedup import brute

ROOT = Path(__file__).resolve().parents[2]


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.fit(queries.table(spark, sf_dir, "documents"), queries.table(spark, sf_dir, "labels"), id_fold(5) != 0)
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    kept = {i: r.text for i, r in rows.items() if i not in toxic}
    least = brute_components({i: brute_print(t) for i, t in kept.items()})
    kept = {i: t for i, t in kept.items() if least[i] == i}
    kept = {i: data.decode("utf-8", "ignore") for i, (_, data) in brute(kept).items()}
    items = [(i, decontamination.normalised(t)) for i, t in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    search = decontamination.Block(items, decontamination.EDIT_RATE).search
    kept = {i: t for i, t in kept.items() if not search(decontamination.normalised(t))}
    encoder = bpe.Encoder(queries.vocabulary())
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert {i: r.text for i, r in found.items()} == kept
    for i, r in found.items():
        assert r.ids == encoder([kept[i]])[0].tolist() and r.n_tokens == len(r.ids)
        assert (r.lang, r.source) == (rows[i].lang, rows[i].source)
        assert r.n_chars == (rows[i].n_chars if kept[i] == rows[i].text else len(kept[i]))


def test_stages_take_odd_documents_and_give_their_columns(spark, sf_dir, documents):
    odd = [(1, None), (2, ""), (3, "word " * 30_000), (None, "some text"), (5, "same words here"), (5, "same words here"), (6, "é" * 300)]
    for frame in (documents(odd), documents([])):
        clashing = frame.withColumns({"toxicity": F.lit(1), "matches": F.lit("m"), "key": F.lit(2), "cuts": F.lit(3), "kept": F.lit(4)})
        for _, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, clashing, sf_dir)
            assert result.columns == clashing.columns
            result.collect()
        last = corpus_pipeline.STAGES[-1][1](spark, clashing, sf_dir)
        assert {"doc_id", "text", "ids", "n_tokens"} <= set(last.columns)
        last.collect()


def test_the_rest_works_without_this_subpackage(tmp_path):
    """A copy of the repository without the two folders and the pipeline imports and lists its queries."""
    import shutil

    for name in ("candlewick", "__spark_entry__.py"):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "candlewick" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') and k[2].isdigit() for k in q); assert 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
