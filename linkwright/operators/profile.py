"""Profiles of entity tables and truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.functions.normalize import script


def distribution(c: Column) -> list[Column]:
    """mean, std, min, p25, median, p75, p95, max; zeros when there are no values."""
    z = lambda x, n: F.coalesce(x.cast("double"), F.lit(0.0)).alias(n)
    return [z(F.avg(c), "mean"), z(F.stddev_pop(c), "std"), z(F.min(c), "least"), *[z(F.percentile(c, F.lit(q)), n) for q, n in ((0.25, "p25"), (0.5, "median"), (0.75, "p75"), (0.95, "p95"))], z(F.max(c), "most")]


def entity_profile(e: DataFrame) -> DataFrame:
    """One row per source: rows, distinct and repeated ids, empty fields, repeated names and addresses, name lengths."""
    blank = lambda c: F.count_if(F.trim(F.coalesce(c, F.lit(""))) == "")
    f = e.withColumn("source", F.substring("entity_id", 1, 2))
    return f.groupBy("source").agg(
        F.count("*").alias("n_rows"), F.count_distinct("entity_id").alias("ids"), (F.count("*") - F.count_distinct("entity_id")).alias("repeated_ids"),
        *[blank(F.col(c)).alias(f"empty_{c}") for c in ("business_name", "business_address", "country")],
        (F.count("*") - F.count_distinct("business_name")).alias("repeated_names"), (F.count("*") - F.count_distinct("business_address")).alias("repeated_addresses"), F.count_distinct("country").alias("countries"),
        *[x for x in distribution(F.length("business_name"))],
    )


def histogram(e: DataFrame, column: str) -> DataFrame:
    return e.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def scripts(e: DataFrame, column: str = "business_name") -> DataFrame:
    return e.groupBy(script(F.col(column)).alias("script")).agg(F.count("*").alias("n"))


def truth_profile(truth: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: singletons, ones and many, by source, and distinct matches."""
    ids = truth.groupBy("s1_id").agg(F.count_distinct("cand_id").alias("n"), F.count_if(F.col("cand_id").startswith("S2")).alias("s2"), F.count_if(F.col("cand_id").startswith("S3")).alias("s3"))
    f = universe.select("s1_id").distinct().join(ids, "s1_id", "left").fillna(0)
    one = f.agg(
        F.count("*").alias("entities"), F.count_if(F.col("n") == 0).alias("singletons"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") > 1).alias("many"),
        F.count_if((F.col("s2") > 0) & (F.col("s3") == 0)).alias("s2_only"), F.count_if((F.col("s3") > 0) & (F.col("s2") == 0)).alias("s3_only"), F.count_if((F.col("s2") > 0) & (F.col("s3") > 0)).alias("both"),
        F.avg("n").alias("mean_links"), F.max("n").alias("most_links"),
    )
    return one.join(truth.agg(F.count_distinct("cand_id").alias("matched_ids")))


def name_overlaps(e: DataFrame) -> DataFrame:
    """sources (joined by +), names: distinct names by the sources that hold them."""
    g = e.where("business_name <> ''").groupBy("business_name").agg(F.array_join(F.array_sort(F.collect_set(F.substring("entity_id", 1, 2))), "+").alias("sources"))
    return g.groupBy("sources").agg(F.count("*").alias("names"))


def collisions(norm: DataFrame) -> DataFrame:
    """Distinct raw and normalized names, and the share of degenerate ones."""
    return norm.agg(F.count_distinct("business_name").alias("raw_names"), F.count_distinct("name_norm").alias("norm_names"), F.avg(F.col("name_is_degenerate").cast("double")).alias("degenerate_rate"))


def submission_stats(matches: DataFrame, universe: DataFrame) -> DataFrame:
    """One row over all entities: cardinalities and source patterns of the returned matches."""
    n = matches.groupBy("s1_id").agg(F.count("*").alias("n"), F.count_if(F.col("cand_id").startswith("S2")).alias("s2"), F.count_if(F.col("cand_id").startswith("S3")).alias("s3"))
    f = universe.select("s1_id").distinct().join(n, "s1_id", "left").fillna(0)
    c = F.col("n")
    return f.agg(*[F.count_if(x).alias(k) for k, x in (("zero", c == 0), ("one", c == 1), ("two_to_five", c.between(2, 5)), ("six_up", c > 5), ("s2_only", (F.col("s2") > 0) & (F.col("s3") == 0)), ("s3_only", (F.col("s3") > 0) & (F.col("s2") == 0)), ("both", (F.col("s2") > 0) & (F.col("s3") > 0)))], F.max("n").alias("most"), F.avg("n").alias("mean"), F.percentile("n", F.lit(0.5)).alias("median"))
