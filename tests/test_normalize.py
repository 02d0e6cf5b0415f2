"""Normalization: golden strings, over-normalization guards, vocabularies."""

from pyspark.sql import functions as F

from linkwright.functions import normalize as N
from linkwright.functions import vocab


def values(spark, column, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]


def names(spark, texts, v=vocab.Vocabulary()):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return rows.select("i", *[c.alias(k) for k, c in N.name_columns(F.col("t"), v).items()]).orderBy("i").collect()


def test_names(spark):
    got = names(spark, ["ABC Pvt. Ltd.", "ABC", "Café & Fils S.A.S.", "Société Générale, S.A.", "  ", None, "Ltd", "X", "ﬁrst Ｏne", "café", "a.b co", "tour s.a.s.", "शर्मा ट्रेडर्स"])
    assert [r.name_norm for r in got][:12] == ["abc private limited", "abc", "cafe and fils sas", "societe generale sa", "", "", "limited", "x", "first one", "cafe", "ab company", "tour sas"]
    assert [r.name_is_degenerate for r in got] == [False, False, False, False, True, True, True, True, False, False, False, False, False]
    assert got[0].name_tokens_sorted == "abc limited private" and got[12].name_norm == "शरम टर डरस"


def test_pairs_of_tokens_can_be_canonical(spark):
    v = vocab.Vocabulary(legal={"joint stock": "js", "ltd": "limited liability", "stock": "st"})
    got = names(spark, ["acme joint stock ltd", "joint joint stock", "stock", "joint"], v)
    assert [r.name_norm for r in got] == ["acme js limited liability", "joint js", "st", "joint"]


def test_addresses(spark):
    rows = spark.createDataFrame([(0, "12a, M.G. Rd. #4 near City Mall"), (1, "Near the Park"), (2, ""), (3, "5 bd St-Michel, 75005 Paris"), (4, None)], "i int, t string")
    got = rows.select("i", *[c.alias(k) for k, c in N.address_columns(F.col("t")).items()]).orderBy("i").collect()
    assert got[0].addr_norm == "12a m g road 4 near city mall" and got[0].addr_core == "12a m g rd 4" and got[0].addr_landmark == "near city mall"
    assert got[0].addr_numbers == ["12a", "4"] and got[1].addr_core == "near the park" and got[2].addr_is_degenerate and got[4].addr_norm == ""
    assert got[3].addr_tokens == ["5", "boulevard", "st-michel", "75005", "paris"]


def test_small_functions(spark):
    assert values(spark, N.normalize_country, ["USA", " India ", "Fránce", "", None, "Peru"]) == ["us", "india", "france", "unknown", "unknown", "peru"]
    assert values(spark, N.phonetic, ["shree laxmi traders", "aggarwal millennium", "bros agencies"]) == ["sri lakshmi trader", "agarwal milenium", "bros agency"]
    assert values(spark, N.phonetic_diagnostic, ["brothers agencies"]) == ["brothers agencies"]
    assert values(spark, N.script, ["Hello", "शर्मा", "Hello शर्मा", "123", "...", "", "漢字"]) == ["LATIN", "DEVANAGARI", "MIXED_LATIN_DEVANAGARI", "NUMERIC_ONLY", "PUNCTUATION_ONLY", "EMPTY", "OTHER"]
    assert values(spark, lambda c: N.postal_code(c, F.lit("x 90210")), ["pin 560001", "nothing", "0123456"]) == ["560001", "90210", "90210"]
    assert values(spark, N.id_list, ["a, b,,a\t", "", None]) == [["a", "b"], [], []]


def test_vocabulary_files(spark, tmp_path):
    v = vocab.Vocabulary(legal={"ooo": "llc"}, landmarks=("next to", "opp"))
    vocab.save(spark, v, str(tmp_path))
    assert vocab.load(spark, str(tmp_path)) == vocab.Vocabulary(legal={"ooo": "llc"}, landmarks=("next to", "opp"))
    assert vocab.load(spark, f"{tmp_path}/none") == vocab.Vocabulary()
