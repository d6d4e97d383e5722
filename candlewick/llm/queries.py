"""One query per operator of this folder, over the whole of its tables, with production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import (
    bpe, decontamination, embedding_whitening, katz, licenses, maxscore, prefix_trie, quality_classifier, quality_rules, simhash, suffix_dedup, token_counts, toxicity,
)
from candlewick.llm.texts import id_fold, ship_package

VOCABULARY = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary(public_tokenizers.path(VOCABULARY))


@query
def op1_quality_classifier(spark, sf_dir):
    held_out = id_fold(3) == 1
    scored = quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op2_bpe_round_trip(spark, sf_dir):
    known = vocabulary()
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), known), known)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        bpe.ids_digest("ids").alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op3_quality_rules(spark, sf_dir):
    ledger = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return ledger.select(
        *["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.PRODUCTION).alias("kept"),
        "failed_bits",
    )


@query
def rule_ablation(spark, sf_dir):
    """What each rule of the production policy rejects, and rejects alone."""
    return quality_rules.ablation(quality_rules.ledger(table(spark, sf_dir, "documents")), quality_rules.PRODUCTION)


@query
def op4_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", simhash.hex_print().alias("fingerprint"), "component_id")


@query
def op5_katz_scores(spark, sf_dir):
    return katz.scores(table(spark, sf_dir, "documents"), id_fold(7) != 2)


@query
def op6_decontamination(spark, sf_dir):
    found = decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("matches") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct("matches.item_id")).alias("item_ids"),
        F.array_min("matches.distance").alias("least_distance"),
        F.size("matches").cast("bigint").alias("n_matches"),
    )


@query
def op7_license_scan(spark, sf_dir):
    files = table(spark, sf_dir, "documents")
    return licenses.scan(files, F.concat_ws("/", "source", "lang", "doc_id"))


@query
def op8_toxicity(spark, sf_dir):
    held_out = id_fold(5) == 0
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", F.size("offending").cast("bigint").alias("n_offending"))


@query
def op9_suffix_dedup(spark, sf_dir):
    left = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_token_counts(spark, sf_dir):
    known = vocabulary()
    return token_counts.counts_by_document(table(spark, sf_dir, "documents"), known, known.special["<|endoftext|>"])


@query
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query
def op12_maxscore(spark, sf_dir):
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query
def op13_embedding_whitening(spark, sf_dir):
    return embedding_whitening.whitened(table(spark, sf_dir, "embeddings"), components=4)
