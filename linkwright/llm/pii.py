"""PII: regular expressions propose spans, checksum validators confirm them, nearby context words adjust the score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The kinds in their order, with the pattern of each. Repeats are possessive and runs start at their left
#: end (or where the match before ended), which matches the same spans without backtracking or recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Cheap tests that every text with a span of the kind passes.
NEEDED = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]{2}-[0-9]"}
BASE = ("email", "ip", "card", "phone")
#: Score of a confirmed span before context, and the words that raise it when near.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = {
    "email": "mail|contact|write|address",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|mastercard|amex|payment|credit|debit",
    "phone": "phone|call|tel|mobile|fax|contact",
    "iban": "iban|bank|account|transfer|konto|cuenta|compte",
    "ssn": "ssn|social|security",
}


@dataclass(frozen=True)
class Scoring:
    """near: code points looked at before and after a span; boost: what a context word adds; least: score that an added kind needs."""

    near: int = 40
    boost: float = 0.2
    least: float = 0.5


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits of match pass the Luhn check."""
    d = F.reverse(_digits(match))
    at = F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: F.struct((i % 2).alias("odd"), F.substring(d, i, F.lit(1)).cast("int").alias("x")))
    doubled = F.transform(at, lambda s: F.when(s.odd == 1, s.x).when(s.x > 4, s.x * 2 - 9).otherwise(s.x * 2))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(match: Column) -> Column:
    """Whether match passes the mod-97 check of account numbers."""
    s = F.replace(match, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))
    each = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    return F.aggregate(F.filter(each, lambda x: x.isNotNull()), F.lit(0), lambda a, x: F.when(x > 9, a * 100 + x).otherwise(a * 10 + x) % 97) == 1


def confirmed(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(match, r"\."), lambda p: (F.length(part(p)) <= 3) & (part(p).cast("int") <= 255))
    if kind == "card":
        return F.when(n.between(14, 19), luhn(match)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    if kind == "iban":
        return F.length(F.replace(match, F.lit(" "), F.lit(""))).between(15, 34) & mod97(match)
    return F.lit(True)


def spans(text: Column, kind: str, scoring: Scoring) -> Column:
    """array<struct<start, end, kind, rank, score>> of the confirmed spans of a kind, in code points."""
    regex = F.lit(PATTERNS[kind])
    hits, gaps = F.regexp_extract_all(text, regex, F.lit(0)), F.split(text, PATTERNS[kind], -1)
    both = F.zip_with(hits, gaps, lambda h, g: F.struct(h.alias("h"), F.length(g).alias("g")))
    none = F.array().cast("array<struct<start:int,end:int,m:string>>")

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["g"]
        end = start + F.length(x["h"])
        return F.struct(end.alias("at"), F.concat(a["got"], F.array(F.struct(start.alias("start"), end.alias("end"), x["h"].alias("m")))).alias("got"))

    placed = F.aggregate(F.filter(both, lambda x: x["h"].isNotNull()), F.struct(F.lit(0).alias("at"), none.alias("got")), step, lambda a: a["got"])
    good = F.filter(placed, lambda s: confirmed(kind, s["m"]))

    def scored(s: Column) -> Column:
        first = F.greatest(s["start"] - scoring.near, F.lit(0))
        around = F.concat(F.substring(text, first + 1, s["start"] - first), F.lit("\n"), F.substring(text, s["end"] + 1, F.lit(scoring.near)))
        score = F.lit(PRIOR[kind]) + F.when(around.rlike(rf"(?i)\b(?:{CONTEXT[kind]})"), F.lit(scoring.boost)).otherwise(F.lit(0.0))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(list(PATTERNS).index(kind)).alias("rank"), F.least(score, F.lit(1.0)).alias("score"))

    out = F.transform(good, scored)
    if kind not in BASE:
        out = F.filter(out, lambda s: s["score"] >= scoring.least)
    return F.when(text.rlike(NEEDED[kind]), out).otherwise(F.array().cast("array<struct<start:int,end:int,kind:string,rank:int,score:double>>"))


def find_pii(docs: DataFrame, *, text_col: str = "text", out_col: str = "pii", scoring: Scoring = Scoring()) -> DataFrame:
    """Docs with out_col: array<struct<start, end, kind, score>> of personal data, by start and then kind.

    Spans of a kind are leftmost and don't overlap; a match that its validator refuses is dropped and not tried again.
    Base kinds stay whatever their score; added kinds (iban by mod-97, ssn) need a score of scoring.least. Positions are
    code points, ends exclusive. A null text is an empty text without spans. An input column named out_col is replaced.
    Built-in functions only; one narrow pass, no shuffle.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    by_kind = [spans(text, k, scoring) for k in PATTERNS]
    order = F.array_sort(F.transform(F.concat(*by_kind), lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["score"])))
    return docs.withColumn(out_col, F.when(text.rlike("[0-9@]"), F.transform(order, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["score"].alias("score")))).otherwise(F.array().cast("array<struct<start:int,end:int,kind:string,score:double>>")))


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return docs.select(
        "doc_id",
        *[n(k) for k in BASE],
        F.sha2(_joined(F.filter("pii", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        _joined(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"),
    )
