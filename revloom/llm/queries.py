"""The registered queries: each operator over its whole table, digested to its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm import audit, decontam, jaccard, langid, lexical, line_dedup, lm, nearest, packing, pii, quality, stream_files, suffixes
from revloom.llm.shared import prepare


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(_documents(spark, sf_dir))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir)).drop("ids")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir))


def _remainder(count: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % count


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = langid.identify(docs, langid.train(docs.where(_remainder(4) != 2)))
    return found.select("doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = lm.score(docs, lm.train(docs.where(_remainder(10) != 0)))
    return found.withColumn("held_out", _remainder(10) == 0).drop("bits_per_byte")


def op6_stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_files.write_and_read(_documents(spark, sf_dir)).drop("file")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_repeats(_documents(spark, sf_dir))
    kept = F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256)
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", kept.alias("kept_sha256"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_documents(spark, sf_dir))
    names = F.array(*map(F.lit, pii.KINDS))

    def written(spans: str):
        one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        return F.array_join(F.transform(spans, one), ",")

    def count(number: int):
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("bigint")

    counts = [count(number).alias(f"n_{name}") for number, name in enumerate(pii.KINDS)]
    digest = F.sha2(written("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, written("spans").alias("spans"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return decontam.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_documents(spark, sf_dir))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return lexical.search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return audit.audit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_packing": op2_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_id": op4_language_id,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_stream_files": op6_stream_files,
    "op7_line_dedup": op7_line_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_personal_data": op9_personal_data,
    "op10_decontamination": op10_decontamination,
    "op11_ranked_search": op11_ranked_search,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_filter_audit": op13_filter_audit,
}

#: The other operators are tested against brute force, round trips and held-out texts.
ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": suffixes.REMOVED_SQL,
    "op3_quality_rules": quality.JUDGE_SQL,
    "op7_line_dedup": line_dedup.REMOVED_SQL,
    "op8_jaccard_join": jaccard.JOIN_SQL,
    "op11_ranked_search": lexical.SEARCH_SQL,
    "op13_filter_audit": audit.AUDIT_SQL,
}
