"""Corpus pipeline over ``documents``.

Stages, each on all rows the one before kept, written as Parquet and read
again in between:

1. quality classifier: documents it rejects go;
2. MinHash near-duplicates: one document of each group stays;
3. benchmark decontamination: documents holding a benchmark window go;
4. mixing: documents are repeated or left out so that sources meet their target
   weights;
5. token ids: the mixed documents become id blocks; the rows read back from
   the blocks are the result (doc_id, start, n_tokens, ids_crc32).

Rows with NULL ids stay rows of their own, repeated rows of one id fall to one
in stage 2, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratelake.llm import decontaminate, mixing, neardup, quality, tokenids
from ratelake.llm.common import fold, scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return quality.drop_low_quality(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "pipeline-ids")
    tokenids.write_token_ids(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return tokenids.read_token_digests(spark, path)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

#: SQL cannot express the classifier or the coder; tests/llm checks the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
