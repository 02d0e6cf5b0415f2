"""Line dedup: explode normalised lines, hash, count distinct documents per hash, drop lines over the threshold, reassemble by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space stripped from a line's ends, and the letters that fold.
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The form under which lines are equal: ends stripped, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def _hash(key: Column, min_chars: int) -> Column:
    """96 bits of a key as one string-free struct; null where the key is too short to count."""
    return F.when(F.length(key) >= min_chars, F.struct(F.xxhash64(key).alias("a"), F.hash(key).alias("b")))


def drop_repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Docs without the lines whose key occurs in at least min_docs different documents.

    Every input column comes back, text_col with its remaining lines joined by a line feed; `n_lines` (before) and
    `n_dropped` follow and replace input columns of those names. A null or empty text is one empty line and stays an
    empty text. Rows that repeat an id are one document in the counts, each row is filtered on its own; null ids are
    together one document. An empty table gives an empty table. Keys are compared by 96 hash bits.

    Only hashes are exploded and shuffled; the count is partially aggregated before its shuffle, so a line that stands
    in a third of all documents sends one row per map task. The text moves once, by id.
    """
    raw = docs.select(F.struct("*").alias("r"))
    lines = F.split(F.coalesce(F.col(f"r.`{text_col}`"), F.lit("")), "\n", -1)
    hashes = F.transform(F.transform(lines, line_key), lambda k: _hash(k, min_chars))
    keys = raw.select(F.col(f"r.`{id_col}`").alias("id"), F.explode(F.array_distinct(F.filter(hashes, lambda h: h.isNotNull()))).alias("h"))
    keys = keys.select("id", "h.a", "h.b").distinct()
    hot = keys.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("a", "b")
    drops = keys.join(hot, ["a", "b"], "left_semi").groupBy("id").agg(F.collect_list(F.struct("a", "b")).alias("hot"))
    out = raw.join(drops, F.col(f"r.`{id_col}`").eqNullSafe(drops["id"]), "left")
    kept = F.when(F.col("hot").isNull(), lines).otherwise(F.filter(lines, lambda x: F.coalesce(~F.array_contains(F.col("hot"), _hash(line_key(x), min_chars)), F.lit(True))))
    out = out.select("r", F.size(lines).cast("long").alias("n"), kept.alias("kept"))
    added = {"n_lines": F.col("n"), "n_dropped": F.col("n") - F.size("kept")}
    same = [F.array_join("kept", "\n").alias(c) if c == text_col else F.col(f"r.`{c}`").alias(c) for c in docs.columns if c not in added]
    return out.select(*same, *[v.alias(k) for k, v in added.items()])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, hot.key IS NOT NULL AS gone FROM k LEFT JOIN hot ON k.key = hot.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
