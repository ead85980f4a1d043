"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame: all but the last the columns
of ``docs``, the last those and token_ids and n_tokens (replacing columns of these names).

1. quality rules: documents that the current policy rejects go.
2. exact dedup: of documents of equal normalised text one stays, that with the smallest doc_id.
3. MinHash near-dedup: of each group of near-duplicates the document with the smallest doc_id stays.
4. mixing: a document is repeated as often as the mix takes it; those taken 0 times go.
5. SentencePiece: token_ids and n_tokens; text is the decoded text of the ids.

Null texts count as empty, which the quality rules reject; a later stage run on its own keeps
them (stage 4 drops rows only as the mix says; stage 5 gives no tokens and an empty text). Rows
that repeat a doc_id are rows of their own, told apart by a row number. Empty tables pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from cardlake.llm import exact_dedup, mixing, near_dedup, quality, sp_codec
from cardlake.llm.common import col, materialise

MODEL = "piece_bpe_32k.model"
ORACLE_SQL = None   # the mix draws at random and the tokens need the model file: tested stage by stage against brute force


def _numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows with a unique number, fixed by writing them, and the number's column."""
    row = "row_number"
    while row in docs.columns:
        row += "_"
    return materialise(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.apply_policy(quality.rule_ledger(docs, carry=docs.columns)).where("kept").select("row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = _numbered(docs, "exact-input")
    kept = exact_dedup.exact_dedup(rows, carry=[row]).where("kept").select(F.col("row")[row].alias(row))
    return rows.join(kept, row, "left_semi").drop(row)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = _numbered(docs, "near-input")
    kept = near_dedup.near_duplicates(rows, row_col=row).where("kept").select(F.col("rid").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = _numbered(docs, "mix-input")
    copies = mixing.mix_sources(rows, row_col=row).where("copies > 0").select(F.col("rid"), F.array_repeat(F.lit(0), F.col("copies")).alias("times"))
    joined = rows.select(F.struct(*[col(c).alias(c) for c in docs.columns]).alias("row"), F.col(row).alias("rid")).join(copies, "rid")
    return joined.select("row", F.explode("times").alias("copy")).select("row.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(MODEL)
    carried = [c for c in docs.columns if c not in ("text", "token_ids", "n_tokens")]
    coded = sp_codec.round_trip(docs, path, carry=carried)
    named = {c: F.col("row")[c].alias(c) for c in carried} | {"text": F.col("bytes").cast("string").alias("text")}
    return coded.select(*[named[c] for c in docs.columns if c in named],
                        F.col("ids").alias("token_ids"), F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("minhash near-dedup", near_stage),
    ("mixing", mix_stage),
    ("sentencepiece", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{i + 1}")
    return docs
