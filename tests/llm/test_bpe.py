import hashlib
import random

import pytest
from pyspark.sql import functions as F

from candlewick.llm import bpe, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

ODD = [
    "", "a", "aa", "aaaaaaa", "'s", "'", " ", "  ", "\n", "\t", "\r\n", "\v", "\f", "\x00", "\x1c", "\x85", "\xa0", " ", "　", "​", "́",
    "é", "ß", "中", "٣", "²", "!", "<|endoftext|>", "<|endof", "\U0001f600", "zzzz", "1234",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary()


def test_ids_are_those_of_the_library(library, vocabulary):
    rng = random.Random(5)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 25))) for _ in range(3000)]
    ids, counts = bpe.Encoder(vocabulary)(texts)
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        at += n


def test_what_a_task_remembers_changes_nothing(library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_CHUNKS", 10)
    encoder = bpe.Encoder(vocabulary)
    for text in ["one two three " * 20, "three two four", "", "five <|endoftext|> one"]:
        assert encoder([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_literal_text_of_a_special_token(library, vocabulary):
    ids, _ = bpe.Encoder(vocabulary, literal=True)(["a <|endoftext|> b"])
    library.encode_special_tokens = True
    try:
        assert ids.tolist() == library.encode("a <|endoftext|> b", add_special_tokens=False).ids
    finally:
        library.encode_special_tokens = False


def test_runs_of_one_symbol(library, vocabulary):
    for n in range(1, 40):
        text = "a" * n + " " + "ab" * n + "=" * n
        assert bpe.Encoder(vocabulary)([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_frames(documents, vocabulary):
    texts = [(1, "Hello there"), (2, None), (3, ""), (1, "Hello there"), (None, "x" * 3000 + "é"), (5, "<|endoftext|>")]
    encoded = bpe.encode(documents(texts), vocabulary, keep=["lang", "ids", "doc_id"])
    assert encoded.columns == ["doc_id", "ids", "lang"]
    decoded = bpe.decode(encoded, vocabulary).select("doc_id", "text").collect()
    assert sorted(map(tuple, decoded), key=repr) == sorted(((i, t or "") for i, t in texts), key=repr)
    assert bpe.encode(documents([]), vocabulary).count() == 0


def test_decoding_odd_ids(spark, library, vocabulary):
    lists = [None, [], [50256], [10**6, 72], [232, 72]]
    frame = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    found = {r.doc_id: r.text for r in bpe.decode(frame, vocabulary).collect()}
    good = [library.decode(x, skip_special_tokens=False) for x in ([50256], [72], [232, 72])]
    assert [found[i] for i in range(5)] == ["", "", *good]


def test_query_on_the_whole_table(spark, sf_dir, library):
    found = {r.doc_id: r for r in queries.QUERIES["op2_bpe_round_trip"](spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(found) == len(texts)
    for row in texts:
        ids = library.encode(row.text, add_special_tokens=False).ids
        mine = found[row.doc_id]
        assert mine.n_tokens == len(ids)
        assert mine.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert mine.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
