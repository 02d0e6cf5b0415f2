"""From documents to packed training sequences: five stages, each one operator over all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm import jaccard, line_dedup, mixing, packing, quality
from linkwright.llm.shared import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, n_chars after the text as it is now."""
    return df.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(*COLUMNS)


def _small_batches(spark: SparkSession) -> None:
    """Arrow batches of 4 MB at most in the session: five stages share an executor's memory, and what 10,000 texts need depends on their lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (score of at least 0.3)."""
    _small_batches(spark)
    docs = docs.select(*COLUMNS)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, out_col="__score").where("__score >= 0.3").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them have."""
    _small_batches(spark)
    return _documents(line_dedup.drop_repeated_lines(docs.select(*COLUMNS)))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; five-word shingles, a Jaccard of 0.8 or more."""
    _small_batches(spark)
    docs = docs.select(*COLUMNS)
    found = jaccard.near_duplicates(docs, measure=jaccard.Measure(words=5, percent=80))
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents kept at the rates that bring the languages' tokens to mixing.WEIGHTS."""
    _small_batches(spark)
    docs = docs.select(*COLUMNS)
    labelled = mixing.labelled_languages(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.resample(docs, labelled, mixing.WEIGHTS).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document, packed into training sequences; with small memos, as the executors have run four stages."""
    _small_batches(spark)
    from public_tokenizers import path

    with open(path("word_bpe_49k.json"), "rb") as f:
        return packing.pack(docs, f.read(), slice_bytes=500_000, memo=20_000, block_tokens=400_000)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", keep_one_of_near_duplicates),
    ("mixing sources to target weights", mix_languages),
    ("packing", pack_sequences),
]

#: Learned scores, rates and tokens can't be had in SQL; tests/llm/test_pipeline.py tests the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
