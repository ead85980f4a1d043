"""Rule bitmask ledger: measure and grade every document once, decide later.

``rule_ledger`` reads each text once and stores its measurements and one bit per failed
rule. A policy is a versioned set of rules, applied to the stored bits by one bitwise
``and``; ablations come from counting the distinct bit patterns. Neither reads a text again.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cardlake.llm.common import _BLANK, col, corpus_hashes, gram_hashes, map_batches, utf8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper")

# Rules in the order of their bits: a document fails where the condition holds.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 50 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "shouting": "100 * n_upper > 80 * n_letters and n_letters >= 50",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE_RULES = ("few_words", "repeated_words")
POLICIES = {"1-base": BASE_RULES, "2-all": tuple(RULES)}
CURRENT_POLICY = "2-all"

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_HEAD = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122))


def measure(texts: list[bytes]) -> dict[str, list[int]]:
    """The measurements of each text."""
    out: dict[str, list[int]] = {name: [] for name in MEASURES}
    for i, words in corpus_hashes(texts):
        text = texts[i]
        seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        repeated = np.zeros(len(words), bool)
        if len(words) > 3:
            _, at, n = np.unique(gram_hashes(words, 3), return_inverse=True, return_counts=True)
            twice = n[at] > 1
            for j in range(3):
                repeated[j:len(words) - 2 + j] |= twice
        lines = [line for line in text.split(b"\n") if line.strip()]
        for name, value in zip(MEASURES, (
                len(words), seen[_HEAD & ~_BLANK].sum(), seen[_SYMBOL].sum(), len(lines) - len(set(lines)),
                repeated.sum(), len(lines), seen[_LETTER].sum(), seen[_UPPER].sum())):
            out[name].append(int(value))
    return out


def rule_ledger(docs: DataFrame, text_col: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """row (struct of the ``carry`` columns), the measurements, and failed: a bit per rule.

    One row per input row, in one pass without a shuffle. Null text counts as empty, with all
    measurements 0; empty texts fail ``few_words``. Repeated rows are graded each. Other
    columns are not looked at; carried ones cannot clash, as they sit in a struct.
    """
    rows = docs.select(F.struct(*[col(c).alias(c) for c in carry]).alias("row"), utf8(text_col).alias("bytes"))

    def grade(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = measure(batch.column("bytes").to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), *[pa.array(got[m], pa.int64()) for m in MEASURES]], ["row", *MEASURES])

    schema = StructType([rows.schema["row"], *[StructField(m, LongType()) for m in MEASURES]])
    failed = sum((F.when(F.expr(rule), BIT[name]).otherwise(0) for name, rule in RULES.items()), F.lit(0))
    return map_batches(rows, grade, schema).withColumn("failed", failed.cast("long"))


def policy_mask(policy: str | Sequence[str]) -> int:
    return sum(BIT[rule] for rule in (POLICIES[policy] if isinstance(policy, str) else policy))


def apply_policy(ledger: DataFrame, policy: str | Sequence[str] = CURRENT_POLICY) -> DataFrame:
    """The ledger with policy (its version), base_failed and kept."""
    return (ledger.withColumn("policy", F.lit(policy if isinstance(policy, str) else "+".join(policy)))
            .withColumn("base_failed", F.col("failed").bitwiseAND(policy_mask(BASE_RULES)) != 0)
            .withColumn("kept", ~F.col("base_failed") & (F.col("failed").bitwiseAND(policy_mask(policy)) == 0)))


def ablation(ledger: DataFrame, policy: str | Sequence[str] = CURRENT_POLICY) -> DataFrame:
    """Per rule of the policy: n_failed, n_only (rejected by no other rule, so kept without it),
    n_rejected (by the whole policy), n_documents. Sums over the distinct bit patterns."""
    mask = policy_mask(policy)
    patterns = ledger.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                                for r in RULES if BIT[r] & mask])).alias("r")
    hit = F.col("failed").bitwiseAND(F.lit(mask).cast("long"))

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return patterns.select("failed", "n", rules).groupBy(F.col("r.rule").alias("rule")).agg(
        total(F.col("failed").bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
        total(hit == F.col("r.bit")).alias("n_only"), total(hit != 0).alias("n_rejected"),
        F.sum("n").alias("n_documents"))
