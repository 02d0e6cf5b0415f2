"""Readers and writers of entity, truth, candidate and manifest files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwright.functions.normalize import id_list
from linkwright.operators.validate import check_entities, truth_report
from linkwright.schemas import ENTITY, TRUTH, DataValidationError


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Tab-separated UTF-8 with a header; every field a string, empty ones kept as empty. Gzip is read as it is."""
    r = spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).option("enforceSchema", False)
    return (r.schema(schema) if schema else r).csv(path).fillna("")


def read_entities(spark: SparkSession, path: str, source: str, strict: bool = True) -> DataFrame:
    e = read_tsv(spark, path)
    return check_entities(e, source) if strict else e


def read_truth(spark: SparkSession, path: str, s1: DataFrame | None = None, pool: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """The wide truth table, checked."""
    t = read_tsv(spark, path, TRUTH)
    if strict:
        bad = {k: v for k, v in truth_report(t, s1, pool).first().asDict().items() if k not in ("n_rows", "links") and v}
        if bad:
            raise DataValidationError(f"{path}: {bad}")
    return t


def links(wide: DataFrame, key: str = "source1_entity_id", ids: str = "matched_entity_ids") -> DataFrame:
    """s1_id, cand_id of a wide table."""
    return wide.select(F.trim(key).alias("s1_id"), F.explode(id_list(F.col(ids))).alias("cand_id"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """s1_id, ids of a file whose lines are an id, a tab and a list; other lines and the header are left out."""
    p = F.split(F.rtrim("value"), "\t", -1)
    return spark.read.text(path).where(F.size(p) == 2).select(p[0].alias("s1_id"), p[1].alias("ids")).where("s1_id <> 'source1_entity_id'")


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """s1_id, cand_id, p of a scored-pair file; what isn't a number is 0."""
    f = read_tsv(spark, path)
    return f.select("s1_id", "cand_id", F.coalesce(F.expr("try_cast(prob AS double)"), F.lit(0.0)).alias("p"))


def widen(universe: DataFrame, pairs: DataFrame, ids: str = "matched_entity_ids", order: str | None = None) -> DataFrame:
    """source1_entity_id and a comma-joined list: each entity of universe(s1_id) once, sorted or in `order`."""
    item = F.struct(F.col(order).alias("o"), F.col("cand_id").alias("c")) if order else F.struct(F.col("cand_id").alias("o"), F.col("cand_id").alias("c"))
    g = pairs.groupBy("s1_id").agg(F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_set(item)), lambda x: x["c"])), ",").alias(ids))
    return universe.select("s1_id").distinct().join(g, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(ids, F.lit("")).alias(ids))


def with_matches(cands: DataFrame, matches: DataFrame) -> DataFrame:
    """Candidates and all matches: a superset by construction."""
    return cands.select("s1_id", "cand_id").unionByName(matches.select("s1_id", "cand_id")).distinct()


def write_tsv(f: DataFrame, path: str, compress: bool = False) -> None:
    w = f.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("nullValue", "")
    (w.option("compression", "gzip") if compress else w).csv(path)


def write_scored(f: DataFrame, path: str) -> None:
    write_tsv(f.select("s1_id", "cand_id", F.format_string("%.6f", "p").alias("prob")), path)


def write_manifest(f: DataFrame, path: str, meta: dict | None = None) -> None:
    """By suffix: parquet (with its metadata beside it), json, csv, tsv, tsv.gz."""
    if path.endswith(".parquet"):
        f.write.mode("overwrite").parquet(path)
        if meta is not None:
            import json

            f.sparkSession.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.meta.json")
    elif path.endswith(".json"):
        f.write.mode("overwrite").json(path)
    elif path.endswith((".tsv", ".tsv.gz")):
        write_tsv(f, path, path.endswith(".gz"))
    elif path.endswith(".csv"):
        f.write.mode("overwrite").option("header", True).csv(path)
    else:
        raise ValueError(f"no manifest format for {path}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".json"):
        return spark.read.json(path)
    if path.endswith((".tsv", ".tsv.gz")):
        return read_tsv(spark, path)
    if path.endswith(".csv"):
        return spark.read.option("header", True).csv(path).fillna("")
    raise ValueError(f"no manifest format for {path}")


def read_meta(spark: SparkSession, path: str) -> dict:
    """The metadata beside a Parquet manifest."""
    import json

    return json.loads(spark.read.text(f"{path}.meta.json").first().value)


def fingerprint(f: DataFrame) -> DataFrame:
    """n_rows and a checksum of the rows that doesn't depend on their order."""
    return f.agg(F.count("*").alias("n_rows"), F.sum(F.xxhash64(*f.columns).cast("decimal(38,0)")).cast("string").alias("checksum"))


def report(f: DataFrame) -> DataFrame:
    """json: each row of a report as a JSON object."""
    return f.select(F.to_json(F.struct("*")).alias("json"))


def markdown(f: DataFrame, title: str) -> str:
    """A report of a few rows as a Markdown table, on the driver."""
    rows = f.collect()
    line = lambda cells: "| " + " | ".join(map(str, cells)) + " |"
    return "\n".join([f"# {title}", "", line(f.columns), line("---" for _ in f.columns), *[line(r) for r in rows], ""])


def empty_entities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ENTITY)
