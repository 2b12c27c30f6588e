"""From documents to packed sequences: five stages, each stored and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm import decontam, jaccard, langid, line_dedup, packing
from revloom.llm.shared import keep, prepare

#: A document stays if its language has at least this probability.
MIN_LANGUAGE_SCORE = 0.5


def _row(docs: DataFrame) -> DataFrame:
    """The whole row as one column beside what the operators read, so that no name can clash."""
    return docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", "lang")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those no language explains better than all others together."""
    trees = langid.train(docs)
    found = langid.identify(_row(docs), trees, passed=("row",))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated runs of lines; drops a document of which nothing is left. ``n_chars`` follows the text."""
    found = line_dedup.remove_repeats(_row(docs), passed=("row",))
    found = found.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"\S"))
    text = F.col("kept_text")
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.char_length(text)).otherwise(F.col("row.n_chars"))}
    return found.select(
        *(changed.get(name, F.col("row").getField(name)).cast(kind).alias(name) for name, kind in docs.dtypes)
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked documents."""
    return jaccard.first_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that cover a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.contamination(_row(docs), benchmark, passed=("row",))
    return found.where(~F.col("contaminated")).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a training sequence."""
    return packing.pack(docs).drop("ids")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Context trees, tiling and tokenization are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        prepare(spark)
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
