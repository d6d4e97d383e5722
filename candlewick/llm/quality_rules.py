"""Quality rules as a ledger: every rule is evaluated once per document, its failure kept as one bit.

The ledger holds the measurements and a bit mask of the failed rules. A policy is a
named, versioned mask of the rules that count; applying one, or taking a rule away
from it (ablation), works on the masks alone and never touches a text again.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.texts import column, id_and_text, map_pieces, octets

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_upper", "n_letters")

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


def rules() -> dict[str, Column]:
    """Rule name to the condition under which a document fails it; the order gives the bits.

    The measurements are integers, so every condition is exact.
    """
    n, c = F.col("n_words"), F.col
    return {
        "few_words": n < 50,
        "repeated_words": 100 * c("n_repeat_words") > 50 * n,
        "symbols": 10 * c("n_symbols") > 2 * n,
        "shouting": (c("n_letters") > 0) & (2 * c("n_upper") > c("n_letters")),
        "short_words": c("word_chars") < 2 * n,
        "long_words": c("word_chars") > 20 * n,
        "duplicate_lines": 10 * c("n_dup_lines") > 5 * c("n_lines"),
    }


RULES = ("few_words", "repeated_words", "symbols", "shouting", "short_words", "long_words", "duplicate_lines")


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES.index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
PRODUCTION = Policy("production", 2, RULES)


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words that lie in a window of ``size`` words found at least twice in ``words``."""
    n = len(words)
    if n <= size:
        return 0
    index = dict.fromkeys(words)
    for i, word in enumerate(index):
        index[word] = i
    ids = np.fromiter(map(index.__getitem__, words), np.int64, n)
    keys, kinds = ids[: n - size + 1], len(index)
    for k in range(1, size):
        if kinds * len(index) >= 1 << 62:
            _, keys = np.unique(keys, return_inverse=True)
            kinds = int(keys.max()) + 1
        keys, kinds = keys * len(index) + ids[k : n - size + 1 + k], kinds * len(index)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(size):
        covered[k : n - size + 1 + k] |= twice
    return int(covered.sum())


def measure(raw: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of :data:`MEASURES`."""
    text, words = raw.decode(), raw.split()
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        len(lines),
        repeated_words(words),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _LETTERS)),
    )


def _measurer():
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = np.array([measure(x) for x in octets(batch)], np.int64).reshape(-1, len(MEASURES))
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), *map(pa.array, table.T)], ["doc_id", *MEASURES])

    return work


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measurements, and ``failed_bits`` (bit i: rule i of :data:`RULES` failed).

    One row per input row, repeated ids included. A null or empty text has no words and
    so fails ``few_words`` alone. No shuffle.
    """
    schema = "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)
    measured = map_pieces(id_and_text(df, id_col, text_col), schema, _measurer)
    conditions = rules()
    bits = sum((F.when(conditions[r], F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)), F.lit(0))
    return measured.withColumn("failed_bits", bits.cast("bigint"))


def passes(policy: Policy, bits: str = "failed_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) == 0


def ablation(kept: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of a policy does: ``rule``, ``n_failed``, ``n_only`` (documents that this rule alone rejects).

    Documents are first counted by mask, with a combine before the shuffle: at most one row for each set of rules
    leaves a task. An empty ledger gives every rule with zeros.
    """
    masks = kept.groupBy(F.col("failed_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count("*").alias("n"))
    sums = masks.agg(
        *[F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.lit(1 << RULES.index(r))) != 0, F.col("n"))), F.lit(0)).alias(f"failed_{r}") for r in policy.rules],
        *[F.coalesce(F.sum(F.when(F.col("bits") == (1 << RULES.index(r)), F.col("n"))), F.lit(0)).alias(f"only_{r}") for r in policy.rules],
    )
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"failed_{r}").alias("n_failed"), F.col(f"only_{r}").alias("n_only")) for r in policy.rules])
    return sums.select(F.explode(rows).alias("x")).select("x.*")
