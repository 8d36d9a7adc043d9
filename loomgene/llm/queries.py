"""The queries of this subpackage, each a thin call of its operator, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgene.llm import collocations, cover_topk, decontaminate, hard_negatives, hmm_lm, langid, line_dedup, minmax_dedup, packing, secret_scan, substring_dedup, token_count, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.annotate(docs, _table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.array_distinct(F.expr("filter(transform(matches, m -> cast(m.item_id as string)), x -> x is not null)")))
    return out.select("doc_id", "n_words", "n_hit", F.size(ids).cast("bigint").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_cover_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_topk.top_k(_table(spark, sf_dir, "embeddings"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(_table(spark, sf_dir, "documents"))


def _bpe_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _bpe_file())


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op6_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return hmm_lm.score(docs.select("doc_id", F.coalesce(langid.part_of(parts=10) == 0, F.lit(False)).alias("held_out"), "text"))


def op7_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), _bpe_file()).withColumn("over_limit", F.col("n_tokens") > 512)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(langid.part_of() == 2, F.lit(False))
    model = langid.train(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return line_dedup.apply(docs, line_dedup.keep_bitmaps(docs), text=False)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    moved = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(hard_negatives.participants(_table(spark, sf_dir, "embeddings"), F.col("vec_id"), moved, F.col("embedding")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination,
        op2_cover_tree_topk,
        op3_secret_scans,
        op4_best_fit_packing,
        op5_url_filters,
        op6_hmm_scoring,
        op7_minmax_near_dedup,
        op8_substring_dedup,
        op9_token_counts,
        op10_language_id,
        op11_line_dedup,
        op12_hard_negatives,
        op13_collocations,
    )
}
SQL: dict[str, str] = {
    "op1_benchmark_decontamination": decontaminate.sql(),
    "op2_cover_tree_topk": cover_topk.SQL,
    "op5_url_filters": url_filter.sql(),
    "op7_minmax_near_dedup": minmax_dedup.sql(),
    "op8_substring_dedup": substring_dedup.sql(),
    "op11_line_dedup": line_dedup.sql(),
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_collocations": collocations.SQL,
}
