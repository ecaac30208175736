"""Registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm import decontaminate, divergence, katz, langid, mixing, neardup, pieces, pii, prefixtrie, quality, tokenids, topk, toxicity
from ratelake.llm.common import fold, scratch, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    out = toxicity.toxicity_scores(docs, model)
    return out.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence"
    )


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-ids")
    tokenids.write_token_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return tokenids.read_token_digests(spark, path)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_rows(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest_rows(decontaminate.find_benchmark(docs, items))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.select("doc_id", "text", "lang"), fold("doc_id", 3) != 1)
    out = langid.predict(docs, model)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = katz.corpus_scores(table(spark, sf_dir, "documents"), fold("doc_id", 5) != 1)
    held_out = (fold("doc_id", 5) == 1).alias("held_out")
    return out.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    out = quality.quality_scores(docs, model)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digest_rows(pieces.encode(table(spark, sf_dir, "documents"), model, decode=True))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_token_ids": op2_token_ids,
    "op3_pii": op3_pii,
    "op4_near_dedup": op4_near_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_language": op6_language,
    "op7_katz": op7_katz,
    "op8_quality": op8_quality,
    "op9_top_k": op9_top_k,
    "op10_mixing": op10_mixing,
    "op11_divergence": op11_divergence,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE = {
    "op9_top_k": topk.ORACLE_SQL,
    "op10_mixing": mixing.ORACLE_SQL,
    "op11_divergence": divergence.ORACLE_SQL,
    "op13_prefix_trie": prefixtrie.ORACLE_SQL,
}
