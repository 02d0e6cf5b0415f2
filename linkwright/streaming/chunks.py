"""Restartable batch output: new files of query-side entities are resolved once each, as Spark's checkpoint knows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.schemas import ENTITY


def resolve_stream(spark: SparkSession, folder: str, out: str, checkpoint: str, resolve: Callable[[DataFrame], DataFrame], files: int = 1) -> None:
    """Run resolve() over each `files` new Parquet files of entities below folder and write its rows below out, a folder
    per batch. A restart goes on after the last finished batch; an unfinished one is written anew over its folder."""

    def one(batch: DataFrame, number: int) -> None:
        resolve(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    rows = spark.readStream.schema(ENTITY).option("maxFilesPerTrigger", files).parquet(folder)
    rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def chunk_ids(entities: DataFrame, chunks: int) -> DataFrame:
    """entities with chunk_id, by hash: the same chunk in every run."""
    return entities.withColumn("chunk_id", F.pmod(F.xxhash64("entity_id"), F.lit(chunks)).cast("int"))


def finished(spark: SparkSession, out: str) -> DataFrame:
    """What all finished batches wrote, with their number."""
    return spark.read.parquet(out)
