"""Connected components of an edge table by minimum labels with shortcuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """The folder that all executors share; a local one only where none is set and the master is local."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        where = "file:///tmp/checkpoints"
    return where.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again, so that loops keep short plans and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_at = path
    return out


def forget(df: DataFrame) -> None:
    """Delete the files of a table from cut() that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.cut_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clusters(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, cluster (its smallest reachable node) of every node of edges(a, b)."""
    pairs = edges.select("a", "b").where("a <> b").distinct()
    both = cut(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both")
    label = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("cluster")).withColumnRenamed("a", "node"), "label")
    for _ in range(rounds):
        near = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("cluster").alias("m"))
        new = label.join(near, F.col("node") == F.col("a")).select("node", F.col("cluster").alias("old"), F.least("cluster", "m").alias("c"))
        jump = new.select(F.col("node").alias("k"), F.col("c").alias("further"))
        new = cut(new.join(jump, F.col("c") == F.col("k"), "left").select("node", "old", F.least("c", F.coalesce("further", "c")).alias("cluster")), "label")
        forget(label)
        label, changed = new, new.where("cluster <> old").limit(1).count()
        if not changed:
            forget(both)
            return label.select("node", "cluster")
    raise RuntimeError("the clusters did not settle")
