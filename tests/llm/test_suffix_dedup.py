import hashlib
import random

import numpy as np
import pytest
from pyspark.sql.functions import spark_partition_id

from candlewick.llm import suffix_dedup
from candlewick.llm.queries import QUERIES


def brute(texts, length=100):
    """{id: (removed spans, kept bytes)} by a set of all strings so far."""
    seen, out = set(), {}
    for i, text in sorted(texts.items()):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s : s + length] = True
            else:
                seen.add(window)
        turns = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(int)))
        out[i] = list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True)), bytes(b for b, g in zip(data, gone, strict=True) if not g)
    return out


def _check(documents, texts, length):
    found = {r.doc_id: r for r in suffix_dedup.deduplicated(documents(list(texts.items()), 4), length=length).collect()}
    wanted = brute(texts, length)
    assert {i: ([tuple(s) for s in r.spans], bytes(r.kept)) for i, r in found.items()} == wanted
    for i, r in found.items():
        assert r.n_spans == len(wanted[i][0]) and r.n_bytes == len((texts[i] or "").encode())
        assert r.n_removed == r.n_bytes - len(wanted[i][1])


@pytest.mark.parametrize("length", [2, 7, 16, 100])
def test_random_texts(documents, length):
    rng = random.Random(length)
    passages = ["".join(rng.choices("ab é", k=rng.randint(1, 4 * length))) for _ in range(8)]
    texts = {i: "".join(rng.choice(passages) + rng.choice(["", "x", f"{i}"]) for _ in range(rng.randint(0, 5))) for i in range(40)}
    _check(documents, texts, length)


def test_odd_texts(documents):
    rng = random.Random(1)
    line = "".join(chr(rng.randrange(97, 123)) for _ in range(150))
    texts = {
        1: None, 2: "", 3: "short", 4: line, 5: line, 6: "head " + line[:120] + " tail", 7: "ab" * 400, 8: "z" + "ab" * 130, 9: "é" * 99, 10: "é" * 120,
        11: line[:99], 12: line[25:125], 13: line[1:] + "?" + line[:-1], -4: line[:110],
    }
    _check(documents, texts, 100)


def test_texts_longer_than_a_chunk(documents):
    rng = random.Random(4)
    long = "".join(rng.choices("abcdefghij klmnop", k=600_000))
    texts = {1: long, 2: long[250_000:] + "!" + long[:1000], 3: "?" + long[262_000:262_300] + "?"}
    found = {r.doc_id: r for r in suffix_dedup.deduplicated(documents(list(texts.items()))).collect()}
    assert found[1].n_removed == 0
    assert [tuple(s) for s in found[2].spans] == [(0, 350_000), (350_001, 351_001)]
    assert [tuple(s) for s in found[3].spans] == [(1, 301)]


def test_null_and_repeated_ids(documents):
    text = " ".join(map(str, range(80)))
    rows = [(5, text), (5, text), (None, text), (7, "other " + text), (5, None)]
    found = suffix_dedup.deduplicated(documents(rows), keep=["lang", "spans"]).collect()
    by_id = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in found)
    n = len(text)
    assert by_id == sorted([("5", n, 0), ("5", n, 0), ("None", n, n), ("7", n + 6, n), ("5", 0, 0)])
    assert "lang" in found[0].asDict()
    assert suffix_dedup.deduplicated(documents([])).count() == 0


def test_text_without_parts_of_characters(documents):
    text = "é" * 30 + "".join(chr(97 + i % 26) + str(i) for i in range(60))
    rows = [(1, text), (2, "x" + text.encode()[1:140].decode("utf-8", "ignore") + "tail"), (3, None)]
    found = {r.doc_id: r.kept for r in suffix_dedup.deduplicated(documents(rows), as_text=True).collect()}
    wanted = brute(dict(rows))
    assert found == {i: kept.decode("utf-8", "ignore") for i, (_, kept) in wanted.items()}


def test_documents_are_dealt_out_once(documents, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        left = suffix_dedup.deduplicated(documents([(i, "a passage " * (15 + i)) for i in range(9)]))
        left.collect()
        assert "ReusedExchange" in left._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_query_on_the_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    wanted = brute(texts)
    found = {r.doc_id: r for r in QUERIES["op9_suffix_dedup"](spark, sf_dir).collect()}
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in found.items()} == {
        i: (len((texts[i] or "").encode()), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, (spans, kept) in wanted.items()
    }


def test_a_gram_with_many_continuations_is_dealt_out(documents, spark):
    rng = random.Random(8)
    start = "".join(rng.choices("abcdefgh ", k=90))
    texts = {i: start + "".join(rng.choices("ijklmnop ", k=60)) for i in range(3000)}
    texts |= {3000 + i: texts[7 * i] + "tail" for i in range(60)}
    _check(documents, texts, 100)
    docs = documents(list(texts.items()), 4).selectExpr("doc_id AS key", "text")
    rows = suffix_dedup.runs_of(docs, 100)
    assert max(r["count"] for r in rows.groupBy("h").count().collect()) <= 4 * suffix_dedup.UNDER_GRAM + 60
    read = [r["count"] for r in rows.repartition(40, "h").groupBy(spark_partition_id()).count().collect()]
    assert len(read) == 40 and max(read) <= 2 * np.median(read)


def test_two_runs_of_a_gram_stay_under_it():
    h, g, n = np.array([5, 5, 5, 9]), np.array([1, 2, 3, 1]), np.array([4, 4, 4, 4])
    dealt, sizes = suffix_dedup._dealt(h, g, n)
    assert dealt[:2].tolist() == [5, 5] and dealt[3] == 9 and dealt[2] not in (5, 9)
    assert sizes.tolist() == [4, 4, -4, 4]
    assert [x.tolist() for x in suffix_dedup._dealt(h[:0], g[:0], n[:0])] == [[], []]
