"""Text normalization as column expressions: no Python on the executors."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.functions.vocab import ADDRESS_STOPWORDS, PHONETIC, PHONETIC_DIAGNOSTIC_OMITS, Vocabulary


@lru_cache(1)
def _accents() -> tuple[str, str, dict[str, str], str]:
    """Translation pairs, longer expansions and the class of combining marks, by the rule: compatibility decomposition
    without combining marks, over Latin, its extensions, letter-like signs and full-width forms."""
    one, many = {}, {}
    for c in (chr(i) for a, b in ((0xA0, 0x250), (0x1E00, 0x1F00), (0x2070, 0x20A0), (0x2100, 0x2190), (0xFB00, 0xFB07), (0xFF01, 0xFF5F)) for i in range(a, b)):
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain != c and plain:
            (one if len(plain) == 1 else many)[c] = plain
    marks = [i for i in range(0x300, 0xFFFF) if unicodedata.combining(chr(i))]
    runs: list[list[int]] = []
    for i in marks:
        if runs and i == runs[-1][1] + 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return "".join(one), "".join(one.values()), many, "[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs) + "]"


def strip_accents(c: Column) -> Column:
    source, target, many, marks = _accents()
    out = F.translate(c, source, target)
    expanded = out
    for k, v in many.items():
        if unicodedata.category(k).startswith("L"):
            expanded = F.replace(expanded, F.lit(k), F.lit(v))
    letters = "".join(k for k in many if unicodedata.category(k).startswith("L"))
    plain = F.when(out.rlike(f"[{letters}]"), expanded).otherwise(out)
    return F.when(c.rlike("[^\\x00-\\x7f]"), F.regexp_replace(plain, marks, "")).otherwise(c)


def squeeze(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"^ | $", "")


def _symbols(c: Column, extra: str = "") -> Column:
    c = F.replace(F.replace(c, F.lit("&"), F.lit(" and ")), F.lit("@"), F.lit(" at "))
    return squeeze(F.regexp_replace(F.translate(c, "/.," + extra, " " * (3 + len(extra))), r"[^\p{L}\p{N}_\s\-]", " "))


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), key)


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda t: t != "")


def canonical_tokens(parts: Column, mapping: dict[str, str]) -> Column:
    """Left to right, a known pair of tokens or else a known token is replaced by its words."""
    single = lambda t: F.coalesce(_lookup({k: v for k, v in mapping.items() if " " not in k}, t), t)
    pairs = {k: v for k, v in mapping.items() if k.count(" ") == 1 and v != " ".join(mapping.get(t, t) for t in k.split())}
    if not pairs:
        one = F.transform(parts, single)
        return F.flatten(F.transform(one, lambda t: F.split(t, " "))) if any(" " in v for k, v in mapping.items() if " " not in k) else one
    empty = F.array().cast("array<string>")
    words = lambda t: F.split(single(t), " ")

    def step(a: Column, t: Column) -> Column:
        both = _lookup(pairs, F.concat_ws(" ", a["held"], t))
        return (
            F.when(a["held"].isNull(), F.struct(a["out"].alias("out"), t.alias("held")))
            .when(both.isNotNull(), F.struct(F.concat(a["out"], F.split(both, " ")).alias("out"), F.lit(None).cast("string").alias("held")))
            .otherwise(F.struct(F.concat(a["out"], words(a["held"])).alias("out"), t.alias("held")))
        )

    start = F.struct(empty.alias("out"), F.lit(None).cast("string").alias("held"))
    return F.aggregate(parts, start, step, lambda a: F.when(a["held"].isNull(), a["out"]).otherwise(F.concat(a["out"], words(a["held"]))))


def clean_name(raw: Column) -> Column:
    """Folded name before legal forms: accents, case, single-letter dots, symbols, blanks."""
    text = F.lower(strip_accents(F.coalesce(raw, F.lit(""))))
    return _symbols(F.regexp_replace(text, r"(?<=\b[a-zA-Z0-9])\.(?=[a-zA-Z0-9]\b|\.|\s|$)", ""))


def clean_address(raw: Column) -> Column:
    return _symbols(F.lower(strip_accents(F.coalesce(raw, F.lit("")))), "#")


def landmark(text: Column, v: Vocabulary) -> Column:
    pattern = r"\b(?:" + "|".join(re.escape(m).replace("\\ ", " ") for m in sorted(v.landmarks, key=len, reverse=True)) + r")\b\s*(.*)"
    return F.regexp_extract(text, pattern, 0)


def normalize_country(raw: Column, v: Vocabulary = Vocabulary()) -> Column:
    c = strip_accents(F.lower(F.regexp_replace(F.coalesce(raw, F.lit("")), r"^\s+|\s+$", "")))
    return F.when(c == "", F.lit("unknown")).otherwise(F.coalesce(_lookup(v.countries, c), c))


def name_columns(raw: Column, v: Vocabulary = Vocabulary()) -> dict[str, Column]:
    parts = canonical_tokens(tokens(clean_name(raw)), v.legal)
    other = F.filter(parts, lambda t: ~t.isin(*v.legal_tokens))
    degenerate = (F.size(other) == 0) | ((F.size(parts) == 1) & (F.length(parts[0]) <= 1))
    return {"name_norm": F.array_join(parts, " "), "name_tokens": parts, "name_tokens_sorted": F.array_join(F.array_sort(parts), " "), "name_is_degenerate": degenerate}


def address_columns(raw: Column, v: Vocabulary = Vocabulary()) -> dict[str, Column]:
    text = clean_address(raw)
    mark = landmark(text, v)
    before = F.regexp_replace(F.substring(text, F.lit(1), F.length(text) - F.length(mark)), r"\s+$", "")
    parts = F.transform(tokens(text), lambda t: F.coalesce(_lookup(v.abbreviations, t), t))
    norm = F.array_join(parts, " ")
    return {
        "addr_norm": norm,
        "addr_core": F.when((mark == "") | (before == ""), text).otherwise(before),
        "addr_landmark": mark,
        "addr_numbers": F.regexp_extract_all(text, F.lit(r"\b\d+[a-zA-Z]?\b"), F.lit(0)),
        "addr_tokens": parts,
        "addr_is_degenerate": F.length(norm) <= 2,
    }


def phonetic(name: Column, omit: tuple[str, ...] = ()) -> Column:
    """Spelling variants of frequent words made one, repeated letters made single."""
    c = F.lower(name)
    for words, target in PHONETIC:
        if target not in omit:
            c = F.regexp_replace(c, r"\b(?:" + words + r")\b", target)
    return F.trim(F.regexp_replace(c, r"([a-z])\1+", "$1"))


def phonetic_diagnostic(name: Column) -> Column:
    return phonetic(name, PHONETIC_DIAGNOSTIC_OMITS)


def postal_code(raw: Column, norm: Column) -> Column:
    pattern = r"\b(?:[1-9][0-9]{5}|[0-9]{5})\b"
    return F.coalesce(F.nullif(F.regexp_extract(raw, pattern, 0), F.lit("")), F.regexp_extract(norm, pattern, 0), F.lit(""))


def script(text: Column) -> Column:
    """One of seven names for the script of most letters; blanks and punctuation don't count."""
    n = lambda cls: F.length(text) - F.length(F.regexp_replace(text, cls, ""))
    latin, deva, digits = n(r"\p{IsLatin}"), n(r"(?=\p{IsDevanagari})[^\p{Nd}\p{P}]"), n(r"\p{Nd}")
    total = F.length(F.regexp_replace(text, r"[\s\p{P}\p{Nd}]", ""))
    return (
        F.when(text.isNull() | (squeeze(text) == ""), "EMPTY")
        .when(total == 0, F.when(digits > 0, "NUMERIC_ONLY").otherwise("PUNCTUATION_ONLY"))
        .when(latin / total > 0.8, "LATIN")
        .when(deva / total > 0.8, "DEVANAGARI")
        .when((latin > 0) & (deva > 0), "MIXED_LATIN_DEVANAGARI")
        .otherwise("OTHER")
    )


def country_group(country: Column) -> Column:
    c = F.upper(F.trim(country))
    return F.when(c.isin("US", "USA", "UNITED STATES"), "US").when(c.isin("IN", "IND", "INDIA"), "IN").when(c.isin("FR", "FRA", "FRANCE"), "FR").otherwise("OTHER")


def cardinality_bucket(n: Column) -> Column:
    return F.when(n == 0, "0").when(n == 1, "1").when(n <= 5, "2-5").otherwise("6+")


def match_pattern(ids: Column) -> Column:
    s2, s3 = F.exists(ids, lambda x: x.startswith("S2")), F.exists(ids, lambda x: x.startswith("S3"))
    return F.when(s2 & s3, "both_s2_s3").when(s2, "s2_only").when(s3, "s3_only").otherwise("none")


def id_list(text: Column) -> Column:
    """Distinct non-blank ids of a comma-joined list."""
    each = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.array_distinct(F.filter(each, lambda x: x != ""))


def distinctive(tokens_: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(tokens_, lambda t: (F.length(t) >= 4) & ~t.isin(*ADDRESS_STOPWORDS) & ~t.rlike(r"^\p{Nd}+$"))))


def source_of(entity_id: Column) -> Column:
    return F.when(entity_id.rlike("^S[123][-_]"), F.substring(entity_id, 1, 2)).otherwise("")


def normalize(entities: DataFrame, v: Vocabulary = Vocabulary()) -> DataFrame:
    """Entities with source and all derived columns; one narrow projection. Null fields count as empty."""
    raw = {c: F.coalesce(F.col(c), F.lit("")) for c in ("business_name", "business_address", "country")}
    named = entities.withColumns(raw)
    out = named.withColumns({"source": source_of(F.col("entity_id")), "country_norm": normalize_country(F.col("country"), v), **name_columns(F.col("business_name"), v), **address_columns(F.col("business_address"), v)})
    return out.withColumn("is_degenerate", F.col("name_is_degenerate") & F.col("addr_is_degenerate"))
