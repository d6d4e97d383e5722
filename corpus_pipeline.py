"""From raw documents to token ids: toxicity, near duplicates, repeated passages, benchmark passages, encoding.

Every stage is a function of (session, documents, folder of the tables). Its result is written
as Parquet and read again as the documents of the next.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import bpe, decontamination, queries, simhash, suffix_dedup, toxicity
from candlewick.llm.texts import fresh_name, id_fold, ship_package
from candlewick.workspace import new_folder

ORACLE_SQL = None  # SQL can't express a trained model, edit distances or token merges; tests compare with brute force


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.5 or more go; a null or empty text stays."""
    model = toxicity.fit(docs, queries.table(spark, sf_dir, "labels"), id_fold(5) != 0)
    score = fresh_name(docs, "toxicity")
    return toxicity.with_score(docs, model, score).where(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents that SimHash links, the one with the smallest id stays."""
    ship_package(spark)
    return simhash.representatives(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats of 100 bytes or more go from the texts; a document stays even if nothing of it is left.

    ``n_chars`` follows; a null text becomes empty.
    """
    ship_package(spark)
    other = {c: f"document_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    left = suffix_dedup.deduplicated(docs.withColumnsRenamed(other), keep=list(other.values()), as_text=True)
    edited = F.col("n_removed") > 0
    result = left.select(*[F.col("kept").alias(c) if c == "text" else F.col(other.get(c, c)).alias(c) for c in docs.columns], edited.alias("document_edited"))
    if "n_chars" in other:
        kind = docs.schema["n_chars"].dataType
        result = result.withColumn("n_chars", F.when(F.col("document_edited"), F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return result.drop("document_edited")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, edits included, go."""
    matches = fresh_name(docs, "matches")
    found = decontamination.with_matches(docs, queries.table(spark, sf_dir, "benchmark"), matches)
    return found.where(F.size(matches) == 0).drop(matches)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids (``ids``) and the number of these (``n_tokens``)."""
    ship_package(spark)
    encoded = bpe.encode(docs, queries.vocabulary(), keep=docs.columns)
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
