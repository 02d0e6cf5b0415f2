"""Blocking: every channel is rows of (index, key) on either side, and one capped equi-join serves them all."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkwright.functions.normalize import distinctive, phonetic, postal_code, tokens

CHANNELS = "ABCDEGHIJKLMN"
#: Channels that batch inference uses.
INFERENCE = "ABCDEGHIJK"


@dataclass(frozen=True)
class Caps:
    """per_key and total are the wide caps; the others bound single channels' keys. max_df: tokens more frequent are left out."""

    per_key: int = 100
    total: int = 100
    narrow: int = 30
    pair: int = 25
    anchor: int = 20
    max_df: int = 5000
    pair_df: int = 2000
    gram_df: int = 5000
    distinctive_df: int = 1500
    rare_df: int = 50
    distinctive_total: int = 50


def token_df(norm: DataFrame, column: str, least: int = 3) -> DataFrame:
    """token, df: rows that hold each token of at least `least` characters."""
    return norm.select(F.explode(F.array_distinct(tokens(F.col(column)))).alias("token")).where(F.length("token") >= least).groupBy("token").agg(F.count("*").alias("df"))


def gram_counts(norm: DataFrame, column: str = "name_norm", n: int = 3) -> DataFrame:
    """gram, df: occurrences of character n-grams, blanks included and repeats counted."""
    c = F.col(column)
    grams = F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, F.lit(n)))
    return norm.where(F.length(c) >= n).select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("df"))


def _with_df(norm: DataFrame, column: str, df: DataFrame, out: str) -> DataFrame:
    """norm with out: array<struct<pos, t, df>> of the column's tokens in order; df is 0 where unknown."""
    each = norm.select("entity_id", F.posexplode(tokens(F.col(column))).alias("pos", "t")).join(df.withColumnRenamed("token", "t"), "t", "left")
    each = each.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("pos", "t", F.coalesce("df", F.lit(0)).alias("df")))).alias(out))
    return norm.join(each, "entity_id", "left").withColumn(out, F.coalesce(out, F.array().cast("array<struct<pos:int,t:string,df:bigint>>")))


def _gram_pairs(norm: DataFrame, grams: DataFrame, caps: Caps) -> DataFrame:
    """norm with gram_pairs: for each name token of five or more characters its two rarest grams, ties by the gram."""
    t = norm.select("entity_id", F.posexplode(tokens(F.col("name_norm"))).alias("pos", "t")).where(F.length("t") >= 5)
    each = t.select("entity_id", "pos", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("t") - 2), lambda i: F.substring(F.col("t"), i, F.lit(3))))).alias("gram")).join(grams, "gram", "left")
    two = F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram"))), 1, 2)
    pairs = each.groupBy("entity_id", "pos").agg(two.alias("two")).where(F.size("two") == 2).where(F.forall("two", lambda g: g["df"] <= caps.gram_df))
    pairs = pairs.groupBy("entity_id").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.array_join(F.array_sort(F.transform("two", lambda g: g["gram"])), "|").alias("k")))), lambda x: x["k"])).alias("gram_pairs"))
    return norm.join(pairs, "entity_id", "left").withColumn("gram_pairs", F.coalesce("gram_pairs", F.array().cast("array<string>")))


def _pairs(items: Column) -> Column:
    """All 2-combinations of an array, in order, joined by a bar."""
    return F.flatten(F.transform(items, lambda x, i: F.transform(F.slice(items, i + 2, F.size(items)), lambda y: F.concat_ws("|", x, y))))


def _keep(arr: Column, test) -> Column:
    return F.transform(F.filter(arr, test), lambda x: x["t"])


def _columns(norm: DataFrame, stats: tuple[DataFrame, DataFrame, DataFrame] | None, channels: str, caps: Caps) -> DataFrame:
    """The frame that keys are read from: token frequencies only where a channel needs them."""
    out = norm
    if stats:
        name_df, addr_df, grams = stats
        if set(channels) & set("EJ"):
            out = _with_df(out, "name_norm", name_df, "name_df")
        if set(channels) & set("DGKN"):
            out = _with_df(out, "addr_norm", addr_df, "addr_df")
        if "M" in channels:
            out = _gram_pairs(out, grams, caps)
    return out


def _keys(channels: str, caps: Caps, probe: bool) -> list[tuple[str, str, Column, int]]:
    """(channel, index, array of keys, cap per key). Keys are null-free strings without the country."""
    c, empty = F.col, F.array().cast("array<string>")
    name, toks, n3 = c("name_norm"), tokens(c("name_norm")), F.substring("name_norm", 1, 3)
    sound = (name != "") & ~c("name_is_degenerate")
    num = F.lower(F.coalesce(F.try_element_at("addr_numbers", F.lit(1)), F.lit("")))
    one = lambda cond, *parts: F.when(sound & cond, F.array(F.concat_ws("|", *parts))).otherwise(empty)
    many = lambda cond, arr: F.when(cond, arr).otherwise(empty)
    prefix2 = F.concat_ws(" ", F.try_element_at(toks, F.lit(1)), F.try_element_at(toks, F.lit(2)))
    ph = phonetic(name)
    pt = tokens(ph)
    pin = postal_code(c("business_address"), c("addr_norm"))
    out: list[tuple[str, str, Column, int]] = []

    def add(channel: str, index: str, keys: Column, cap: int) -> None:
        if channel in channels or not probe and "G" in channels and channel in "CD":  # G reads the indexes of C and D
            out.append((channel, index, keys, cap))

    add("A", "name", one(F.lit(True), name), caps.per_key)
    add("B", "sorted", one(F.lit(True) if probe else c("name_tokens_sorted") != name, c("name_tokens_sorted")), caps.per_key)
    add("B", "prefix2", one(F.size(toks) >= 2, prefix2), caps.per_key)
    add("C", "num3", one(num != "", num, n3), caps.per_key)
    if set(channels) & set("DG"):
        high = lambda x: (F.length(x["t"]) >= 3) & (x["df"] <= caps.max_df) & ((x["df"] >= 2) if probe else F.lit(True))
        add("D", "addr3", many(sound & (c("addr_norm") != ""), F.transform(F.array_distinct(_keep(c("addr_df"), high)), lambda t: F.concat_ws("|", t, n3))), caps.narrow)
    if "E" in channels:
        good = lambda x: (F.length(x["t"]) >= 3) & x["df"].between(2, caps.max_df)
        add("E", "token", many(sound & (F.lit(True) if probe else F.size(toks) >= 2), F.array_distinct(_keep(c("name_df"), good))), caps.narrow)
    if probe and "G" in channels:
        add("G", "num3", one((num != "") & (F.length(name) >= 4), num, n3), caps.narrow)
        first = F.slice(_keep(c("addr_df"), lambda x: F.length(x["t"]) >= 3), 1, 3)
        add("G", "addr3", many(sound & (F.length(name) >= 4), F.transform(F.array_distinct(first), lambda t: F.concat_ws("|", t, n3))), caps.anchor)
    add("H", "land3", one(c("addr_landmark") != "", c("addr_landmark"), n3), caps.per_key)
    add("H", "land", one(c("addr_landmark") != "", c("addr_landmark")), caps.narrow)
    add("I", "ph", one(ph != "", ph), caps.per_key)
    add("I", "phsorted", one(F.size(pt) >= 2, F.array_join(F.array_sort(pt), " ")), caps.per_key)
    add("I", "phprefix2", one(F.size(pt) >= 2, F.concat_ws(" ", F.try_element_at(pt, F.lit(1)), F.try_element_at(pt, F.lit(2)))), caps.per_key)
    if "J" in channels:
        core = F.array_sort(_keep(c("name_df"), lambda x: (F.length(x["t"]) >= 3) & (x["df"] <= caps.pair_df)))
        add("J", "pair", many(sound & F.size(core).between(2, 6), F.array_distinct(_pairs(core))), caps.pair)
    if "K" in channels:
        street = F.slice(c("addr_df"), 1, 4)
        near = _keep(street, lambda x: (F.length(x["t"]) >= 3) & (x["t"] != num) & (x["df"] <= caps.pair_df))
        add("K", "numstreet", many((num != "") & ((name != "") if probe else sound), F.transform(F.array_distinct(near), lambda t: F.concat_ws("|", num, t))), caps.pair)
    add("L", "pin", one((pin != "") & (F.length(F.coalesce(F.try_element_at(toks, F.lit(1)), F.lit(""))) >= 3), pin, F.try_element_at(toks, F.lit(1))), caps.narrow)
    if "M" in channels:
        add("M", "grams", many(sound, c("gram_pairs")), caps.narrow)
    if "N" in channels:
        known = F.filter("addr_df", lambda x: x["df"].between(2, caps.distinctive_df))
        rare = F.filter("addr_df", lambda x: x["df"].between(2, caps.rare_df))
        some = distinctive(F.transform(known, lambda x: x["t"]))
        add("N", "arare", distinctive(F.transform(rare, lambda x: x["t"])), caps.pair)
        add("N", "apair", many(F.size(some).between(2, 8), _pairs(F.slice(some, 1, 6))), caps.pair)
    return out


def _exploded(frame: DataFrame, keys: list[tuple[str, str, Column, int]]) -> DataFrame:
    def row(at: int, channel: str, index: str, cap: int):
        return lambda x, i: F.struct(F.lit(CHANNELS.index(channel)).alias("channel"), F.lit(index).alias("index"), x.alias("k"), (F.lit(at * 1000) + i).alias("key_pos"), F.lit(cap).alias("cap"))

    rows = [F.transform(k, row(at, ch, ix, cap)) for at, (ch, ix, k, cap) in enumerate(keys)]
    return frame.select("entity_id", "country_norm", F.explode(F.concat(*rows)).alias("x")).select("entity_id", F.col("x.channel").alias("channel"), F.col("x.index").alias("index"), F.concat_ws("|", "x.k", "country_norm").alias("key"), F.col("x.key_pos").alias("key_pos"), F.col("x.cap").alias("cap"))


def stats_of(pool: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Name-token, address-token and gram frequencies over the whole pool."""
    return token_df(pool, "name_norm"), token_df(pool, "addr_norm"), gram_counts(pool)


def candidates_by_channel(s1: DataFrame, pool: DataFrame, channels: str = INFERENCE, caps: Caps = Caps()) -> DataFrame:
    """s1_id, cand_id, channel, list_rank: each channel's candidates, capped per key and per entity.

    The pool's rows of a key are cut to the largest cap before the join, in order of source and id, so a key that a third
    of all rows share joins no more than that many; the cut is a ranking limit that Spark applies before its shuffle too.
    An entity's candidates of a channel are ranked by the first key, then the first place in its list, that gave them.
    """
    stats = stats_of(pool)
    build = _exploded(_columns(pool, stats, channels, caps), _keys(channels, caps, False)).select("index", "key", F.col("entity_id").alias("cand_id")).distinct()
    most = max(caps.per_key, caps.narrow, caps.pair, caps.anchor)
    build = build.withColumn("list_pos", F.row_number().over(W.partitionBy("index", "key").orderBy(F.substring("cand_id", 1, 2), "cand_id"))).where(F.col("list_pos") <= most)
    probe = _exploded(_columns(s1, stats, channels, caps), _keys(channels, caps, True)).withColumnRenamed("entity_id", "s1_id")
    hits = probe.join(build, ["index", "key"]).where("list_pos <= cap")
    first = hits.groupBy("s1_id", "cand_id", "channel").agg(F.min(F.struct("key_pos", "list_pos")).alias("at"))
    ranked = first.withColumn("list_rank", F.row_number().over(W.partitionBy("s1_id", "channel").orderBy("at", "cand_id")))
    limit = {"B": 2 * caps.per_key, "I": 3 * caps.per_key, "N": caps.distinctive_total}
    total = F.coalesce(*[F.when(F.col("channel") == CHANNELS.index(k), F.lit(v)) for k, v in limit.items()], F.lit(caps.total))
    return ranked.where(F.col("list_rank") <= total).select("s1_id", "cand_id", "channel", "list_rank")


def store(by_channel: DataFrame) -> DataFrame:
    """s1_id, cand_id, channel_mask, channel_count, first_channel: the union of channels with its provenance."""
    return by_channel.groupBy("s1_id", "cand_id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("channel"))).alias("channel_mask"), F.min("channel").alias("first_channel")).select("s1_id", "cand_id", "channel_mask", F.bit_count("channel_mask").alias("channel_count"), "first_channel")


def cap_candidates(stored: DataFrame, cap: int, ranked: bool = True) -> DataFrame:
    """At most cap candidates per entity: those of most channels first, or (ranked=False) in channel order."""
    order = [F.desc("channel_count"), "first_channel", "cand_id"] if ranked else ["first_channel", "cand_id"]
    return stored.withColumn("rank", F.row_number().over(W.partitionBy("s1_id").orderBy(*order))).where(F.col("rank") <= cap)


def channel_exclusive(stored: DataFrame, channel: str) -> DataFrame:
    return stored.where(F.col("channel_mask") == F.shiftleft(F.lit(1).cast("long"), CHANNELS.index(channel)))


def channel_overlap(stored: DataFrame) -> DataFrame:
    """channel_i, channel_j, pairs: how many pairs two channels share."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(len(CHANNELS) - 1)), lambda i: F.getbit(F.col("channel_mask"), i) == 1)
    i = stored.select("s1_id", "cand_id", bits.alias("bits")).select("bits", F.explode("bits").alias("channel_i"))
    return i.select("channel_i", F.explode("bits").alias("channel_j")).groupBy("channel_i", "channel_j").agg(F.count("*").alias("pairs"))


def store_sizes(stored: DataFrame) -> DataFrame:
    return stored.agg(F.count_distinct("s1_id").alias("entities"), F.count("*").alias("pairs"))
