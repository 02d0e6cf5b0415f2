"""Evaluation: entity F0.5, blocking, calibration and error reports, all as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkwright.functions.normalize import cardinality_bucket, country_group
from linkwright.operators.decide import f05
from linkwright.operators.graph import cut


def _n(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("long")


def entity_scores(pred: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """s1_id, tp, fp, fn, n_true, n_pred, precision, recall, f05 of every entity of universe(s1_id)."""
    p = pred.select("s1_id", "cand_id").distinct().withColumn("p", F.lit(1))
    t = truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1))
    counts = p.join(t, ["s1_id", "cand_id"], "full").groupBy("s1_id").agg(F.count_if(F.col("p").isNotNull() & F.col("t").isNotNull()).alias("tp"), F.count("p").alias("n_pred"), F.count("t").alias("n_true"))
    return _scores(counts, universe)


def labelled_scores(pred: DataFrame, n_true: DataFrame, universe: DataFrame) -> DataFrame:
    """entity_scores() of pred(s1_id, link), each pair once, which says of itself whether it is a true link, and of the number
    of true links of each entity: n_true(s1_id, n_true). No pair is joined."""
    counts = pred.groupBy("s1_id").agg(F.count_if("link").alias("tp"), F.count("*").alias("n_pred"))
    return _scores(counts.join(n_true, "s1_id", "full"), universe)


def _scores(counts: DataFrame, universe: DataFrame) -> DataFrame:
    f = universe.select("s1_id").distinct().join(counts, "s1_id", "left").select("s1_id", *[_n(F.col(c)).alias(c) for c in ("tp", "n_pred", "n_true")])
    tp, fp, fn = F.col("tp"), F.col("n_pred") - F.col("tp"), F.col("n_true") - F.col("tp")
    share = lambda n, empty: F.when(F.col(n) == 0, F.when(empty, 1.0).otherwise(0.0)).otherwise(tp / F.col(n))
    return f.select("s1_id", "tp", fp.alias("fp"), fn.alias("fn"), "n_true", "n_pred", share("n_pred", F.col("n_true") == 0).alias("precision"), share("n_true", F.col("n_pred") == 0).alias("recall"), f05(tp, fp, fn).alias("f05"))


def macro(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Averages over entities, with singleton accuracy (1 without singletons) and false-merge rate (0 without)."""
    single = F.col("n_true") == 0
    rate = lambda cond, empty: F.coalesce(F.count_if(single & cond) / F.nullif(F.count_if(single), F.lit(0)), F.lit(empty))
    return scores.groupBy(*(by or [])).agg(
        F.count("*").alias("entities"), F.avg("f05").alias("macro_f05"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.count_if(single).alias("singletons"),
        rate(F.col("n_pred") == 0, 1.0).alias("singleton_accuracy"), rate(F.col("n_pred") > 0, 0.0).alias("false_merge_rate"),
        F.count_if(F.col("f05") == 1).alias("perfect"), F.stddev_pop("f05").alias("std_f05"),
        *[F.percentile("f05", F.lit(q)).alias(f"p{int(q * 100)}_f05") for q in (0.1, 0.25, 0.5)],
    )


def evaluate(scores: DataFrame, meta: DataFrame) -> DataFrame:
    """macro() overall and by cardinality, and by country group, in one pass of grouping sets. meta: s1_id, country."""
    f = scores.join(meta.select("s1_id", country_group(F.col("country")).alias("country")), "s1_id", "left").withColumn("cardinality", cardinality_bucket(F.col("n_true")))
    f = f.select("f05", "precision", "recall", F.explode(F.array(F.struct(F.lit("all").alias("kind"), F.lit("all").alias("value")), F.struct(F.lit("cardinality").alias("kind"), F.col("cardinality").alias("value")), F.struct(F.lit("country").alias("kind"), F.col("country").alias("value")))).alias("g"))
    return f.groupBy(F.col("g.kind").alias("kind"), F.col("g.value").alias("value")).agg(F.count("*").alias("entities"), F.avg("f05").alias("macro_f05"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"))


def blocking_metrics(cands: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: link recall, complete and partial coverage, and the distribution of candidates per entity."""
    s = entity_scores(cands, truth, universe)
    linked = F.col("n_true") > 0
    return s.agg(
        F.count("*").alias("entities"), F.sum("n_pred").alias("pairs"), (F.sum("tp") / F.sum("n_true")).alias("link_recall"),
        (F.count_if(linked & (F.col("fn") == 0)) / F.count_if(linked)).alias("complete_coverage"), (F.count_if(linked & (F.col("tp") > 0)) / F.count_if(linked)).alias("partial_coverage"),
        F.avg("n_pred").alias("mean"), *[F.percentile("n_pred", F.lit(q / 100)).alias(f"p{q}") for q in (50, 90, 95, 99)], F.max("n_pred").alias("most"),
        F.count_if(F.col("n_pred") == 0).alias("without"), (F.count_if(F.col("n_pred") == 0) / F.count("*")).alias("without_rate"),
    )


def marginal_recall(stored: DataFrame, truth: DataFrame, channels: int) -> DataFrame:
    """channel, pairs, links, cumulative_links, recall: what each channel adds to those before it."""
    hit = stored.join(truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1)), ["s1_id", "cand_id"], "left")
    new = hit.groupBy(F.col("first_channel").alias("channel")).agg(F.count("*").alias("pairs"), F.count("t").alias("links"))
    total = truth.select("s1_id", "cand_id").distinct().agg(F.count("*").alias("total"))
    every = stored.sparkSession.range(channels).select(F.col("id").cast("int").alias("channel")).join(new, "channel", "left").fillna(0)
    run = W.orderBy("channel").rowsBetween(W.unboundedPreceding, 0)
    return every.join(F.broadcast(total)).withColumn("cumulative_links", F.sum("links").over(run)).select("channel", "pairs", "links", "cumulative_links", (F.col("cumulative_links") / F.col("total")).alias("recall"))


def leave_one_out(stored: DataFrame, truth: DataFrame, channels: int) -> DataFrame:
    """channel, links_without: true links that the other channels still find."""
    hits = stored.join(truth.select("s1_id", "cand_id").distinct(), ["s1_id", "cand_id"])
    bit = lambda i: F.shiftleft(F.lit(1).cast("long"), i)
    return hits.agg(*[F.count_if(F.col("channel_mask").bitwiseAND(F.bitwise_not(bit(i))) != 0).alias(str(i)) for i in range(channels)]).select(F.explode(F.map_from_arrays(F.array(*[F.lit(i) for i in range(channels)]), F.array(*[F.col(str(i)) for i in range(channels)]))).alias("channel", "links_without"))


def cap_sweep(ranked: DataFrame, truth: DataFrame, universe: DataFrame, caps: list[int]) -> DataFrame:
    """cap, pairs, links, and the macro F0.5 that a perfect scorer would reach; one ranking for all caps."""
    hits = ranked.join(truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1)), ["s1_id", "cand_id"], "left")
    per = hits.select("s1_id", "rank", "t", F.explode(F.array(*[F.lit(c) for c in caps])).alias("cap")).where(F.col("rank") <= F.col("cap")).groupBy("cap", "s1_id").agg(F.count("*").alias("pairs"), F.count("t").alias("tp"))
    want = universe.select("s1_id").distinct().join(truth.select("s1_id", "cand_id").distinct().groupBy("s1_id").agg(F.count("*").alias("n_true")), "s1_id", "left").fillna(0)
    grid = want.select("s1_id", "n_true", F.explode(F.array(*[F.lit(c) for c in caps])).alias("cap")).join(per, ["cap", "s1_id"], "left").fillna(0)
    return grid.groupBy("cap").agg(F.sum("pairs").alias("pairs"), F.sum("tp").alias("links"), F.avg(f05(F.col("tp"), F.lit(0), F.col("n_true") - F.col("tp"))).alias("oracle_f05"))


def recall_by(cands: DataFrame, truth: DataFrame, meta: DataFrame) -> DataFrame:
    """kind, value, links, found: recall by country and by source, in one pass."""
    hit = truth.select("s1_id", "cand_id").distinct().join(cands.select("s1_id", "cand_id").distinct().withColumn("f", F.lit(1)), ["s1_id", "cand_id"], "left").join(meta.select("s1_id", "country"), "s1_id", "left")
    g = F.explode(F.array(F.struct(F.lit("country").alias("kind"), F.col("country").alias("value")), F.struct(F.lit("source").alias("kind"), F.substring("cand_id", 1, 2).alias("value"))))
    return hit.select("f", g.alias("g")).groupBy(F.col("g.kind").alias("kind"), F.col("g.value").alias("value")).agg(F.count("*").alias("links"), F.count("f").alias("found"))


def h1_gate(truth: DataFrame) -> DataFrame:
    """source, ids, violations, rate and holds: whether a source's ids have one owner each."""
    own = truth.select("s1_id", "cand_id").distinct().groupBy("cand_id").agg(F.count("*").alias("owners"))
    return own.groupBy(F.substring("cand_id", 1, 2).alias("source")).agg(F.count("*").alias("ids"), F.count_if(F.col("owners") > 1).alias("violations"), F.max("owners").alias("most_owners")).withColumn("rate", F.col("violations") / F.col("ids")).withColumn("holds", F.col("violations") == 0)


def h1_report(truth: DataFrame, examples: int = 10) -> DataFrame:
    """The gate's report: source (S2, S3, all), ids, single, violations, rate, the least `examples` violating ids
    (comma-joined), and whether conflicts are resolved and the one-owner invariant is enforced: both if no id at all has two
    owners. Ids of other sources count among all violations, but not among the ids."""
    own = truth.select("s1_id", "cand_id").distinct().groupBy("cand_id").agg((F.count("*") > 1).alias("multi"))
    known = F.col("cand_id").rlike("^S[23]-")
    f = own.select("cand_id", "multi", known.alias("known"), F.explode(F.array(F.lit("all"), F.when(known, F.substring("cand_id", 1, 2)))).alias("source")).where("source IS NOT NULL")
    counts = f.groupBy("source").agg(F.count_if("known").alias("ids"), F.count_if(F.col("known") & ~F.col("multi")).alias("single"), F.count_if("multi").alias("violations"))
    first = f.where("multi").withColumn("nth", F.row_number().over(W.partitionBy("source").orderBy("cand_id"))).where(F.col("nth") <= examples).groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("cand_id")), ",").alias("examples"))
    holds = own.agg((F.count_if("multi") == 0).alias("holds"))
    every = truth.sparkSession.createDataFrame([("S2",), ("S3",), ("all",)], "source string")
    g = every.join(F.broadcast(counts), "source", "left").join(F.broadcast(first), "source", "left").join(F.broadcast(holds)).fillna(0, ["ids", "single", "violations"]).fillna("", ["examples"])
    rate = F.when(F.col("ids") > 0, F.col("violations") / F.col("ids")).otherwise(0.0)
    return g.select("source", "ids", "single", "violations", rate.alias("rate"), "examples", F.col("holds").alias("conflict_resolution_enabled"), F.col("holds").alias("invariant_enforced"))


def ece(scored: DataFrame, bins: int = 10) -> DataFrame:
    """ece of (p, y) over equal bins, the last one closed."""
    b = F.least(F.floor(F.col("p") * bins), F.lit(bins - 1))
    g = scored.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg("p").alias("p"), F.avg("y").alias("y"))
    return g.agg((F.sum(F.col("n") * F.abs(F.col("p") - F.col("y"))) / F.sum("n")).alias("ece"))


def reliability(scored: DataFrame, bins: int = 10, flag: float = 0.10) -> DataFrame:
    """Rows per bin of [k/bins, (k+1)/bins); p = 1 falls in none. off: mean and share differ by more than flag."""
    g = scored.where("p < 1").groupBy(F.floor(F.col("p") * bins).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"), F.avg("y").alias("share"))
    return g.withColumn("off", F.abs(F.col("mean_p") - F.col("share")) > flag)


def losses(scored: DataFrame) -> DataFrame:
    p = F.least(F.greatest(F.col("p"), F.lit(1e-15)), F.lit(1 - 1e-15))
    return scored.agg(F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier"), (-F.avg(F.col("y") * F.log(p) + (1 - F.col("y")) * F.log(1 - p))).alias("log_loss"))


def ranking(scored: DataFrame) -> DataFrame:
    """roc_auc and average_precision over tied groups; 0.5 and the positive rate where one class is missing. Rows are
    summed by distinct p first, so the one ordered window runs over distinct scores only."""
    g = scored.groupBy("p").agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
    above = W.orderBy(F.desc("p")).rowsBetween(W.unboundedPreceding, 0)
    g = g.withColumns({"tp": F.sum("pos").over(above), "seen": F.sum("n").over(above)})
    neg, before = F.col("n") - F.col("pos"), F.col("tp") - F.col("pos")
    s = g.agg(F.sum("pos").alias("p"), F.sum(neg).alias("q"), F.sum(neg * (before + F.col("pos") / 2)).alias("area"), F.sum(F.col("pos") * F.col("tp") / F.col("seen")).alias("ap"))
    one = (F.col("p") == 0) | (F.col("q") == 0)
    return s.select(F.when(one, 0.5).otherwise(F.col("area") / (F.col("p") * F.col("q"))).alias("roc_auc"), F.when(one, F.col("p") / (F.col("p") + F.col("q"))).otherwise(F.col("ap") / F.col("p")).alias("average_precision"))


def threshold_sweep(scored: DataFrame, truth: DataFrame, universe: DataFrame, thresholds: list[float], caps: list[int] = [1]) -> DataFrame:
    """threshold, cap, macro_f05: entities' F0.5 when the likeliest `cap` of each source at or above threshold are returned."""
    grid = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(c).alias("cap")) for t in thresholds for c in caps])).alias("g")
    place = F.row_number().over(W.partitionBy("s1_id", F.substring("cand_id", 1, 2)).orderBy(F.desc("p"), "cand_id"))
    hit = scored.withColumn("place", place).join(truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1)), ["s1_id", "cand_id"], "left")
    got = hit.select("s1_id", "p", "place", "t", grid).where((F.col("p") >= F.col("g.threshold")) & (F.col("place") <= F.col("g.cap"))).groupBy("g", "s1_id").agg(F.count("*").alias("n_pred"), F.count("t").alias("tp"))
    want = universe.select("s1_id").distinct().join(truth.select("s1_id", "cand_id").distinct().groupBy("s1_id").agg(F.count("*").alias("n_true")), "s1_id", "left").fillna(0)
    every = want.select("s1_id", "n_true", grid).join(got, ["g", "s1_id"], "left").fillna(0, ["n_pred", "tp"])
    score = f05(F.col("tp"), F.col("n_pred") - F.col("tp"), F.col("n_true") - F.col("tp"))
    return every.groupBy(F.col("g.threshold").alias("threshold"), F.col("g.cap").alias("cap")).agg(F.avg(score).alias("macro_f05"))


#: The thresholds that a search tries: 0.10, 0.15, ... 0.95.
GRID = [round(0.05 * i, 2) for i in range(2, 20)]


def best_threshold(scored: DataFrame, truth: DataFrame, universe: DataFrame, thresholds: list[float] = GRID, caps: list[int] = [1]) -> DataFrame:
    """threshold, cap, macro_f05 of the best point of the sweep; the lowest threshold, then cap, among equals."""
    sweep = threshold_sweep(scored, truth, universe, thresholds, caps)
    return sweep.orderBy(F.desc(F.round("macro_f05", 12)), "threshold", "cap").limit(1)


def hard_negatives(features: DataFrame) -> DataFrame:
    """Counts of wrong pairs by what makes them hard; features with label, from pair_features(). A column n, if there is one,
    says how many pairs a row stands for."""
    n = F.col("n") if "n" in features.columns else F.lit(1)
    wrong = lambda hard=F.lit(True): F.coalesce(F.sum(F.when((F.col("label") == 0) & hard, n)), F.lit(0))
    return features.agg(
        wrong().alias("negatives"), wrong(F.col("name_exact_norm") == 1).alias("same_name"), wrong(F.col("addr_exact_norm") == 1).alias("same_address"),
        wrong(F.col("name_tok_jaccard") >= 0.5).alias("similar_name"), wrong(F.col("addr_num_disagreement") == 1).alias("other_number"),
    )


def feature_audit(features: DataFrame, columns: list[str]) -> DataFrame:
    """feature, nans, least, most, mean, std, distinct values and whether it is constant. A column n, if there is one, says
    how many rows a row stands for."""
    n = F.col("n") if "n" in features.columns else F.lit(1)
    long = features.select(n.alias("n"), *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(["n"], columns, "feature", "v")
    g = long.groupBy("feature", "v").agg(F.sum("n").alias("n"))
    known, v = F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.col("v")
    mean = g.groupBy("feature").agg((F.sum(v * F.col("n")) / known).alias("mean"))
    g = g.join(F.broadcast(mean), "feature")
    std = F.sqrt(F.sum((v - F.col("mean")) * (v - F.col("mean")) * F.col("n")) / known)
    return g.groupBy("feature").agg(F.coalesce(F.sum(F.when(F.isnan(v) | v.isNull(), F.col("n"))), F.lit(0)).alias("nans"), F.min(v).alias("least"), F.max(v).alias("most"), F.first("mean").alias("mean"), std.alias("std"), F.count(v).alias("distinct_values")).withColumn("constant", F.col("distinct_values") <= 1)


def correlated(features: DataFrame, columns: list[str], least: float = 0.95) -> DataFrame:
    """Pairs of features with |r| of at least `least`. A column n, if there is one, says how many rows a row stands for."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    n = F.col("n") if "n" in features.columns else F.lit(1)
    f = features.select(n.cast("double").alias("n"), *columns)
    mean = f.agg(*[(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c) for c in columns]).first()
    if mean[0] is None:
        mean = [0.0] * len(columns)
    d = {c: F.col(c) - F.lit(float(m)) for c, m in zip(columns, mean, strict=True)}
    s = f.agg(*[F.sum(d[a] * d[b] * F.col("n")).alias(f"{a}|{b}") for a in columns for b in columns if a <= b])
    of = lambda a, b: F.col(f"`{min(a, b)}|{max(a, b)}`")
    row = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.try_divide(of(a, b), F.sqrt(of(a, a)) * F.sqrt(of(b, b))).alias("r")) for a, b in pairs])
    return s.select(F.explode(row).alias("x")).select("x.*").where(F.abs("r") >= least)


def errors(pred: DataFrame, truth: DataFrame, cands: DataFrame, s1: DataFrame, pool: DataFrame, franchise: int = 3) -> DataFrame:
    """s1_id, cand_id, kind (fp or fn) and the first rule that explains it."""
    key = ["s1_id", "cand_id"]
    p, t = (x.select(*key).distinct() for x in (pred, truth))
    wrong = cut(p.join(t, key, "left_anti").withColumn("kind", F.lit("fp")).unionByName(t.join(p, key, "left_anti").withColumn("kind", F.lit("fn"))), "wrong")
    # candidates are many more than missed links: these go to them, an array per entity, and only what is found is shuffled
    missed = wrong.where("kind = 'fn'").groupBy("s1_id").agg(F.collect_set("cand_id").alias("ids"))
    c = cands.select(*key).join(missed.hint("shuffle_hash"), "s1_id").where(F.array_contains("ids", F.col("cand_id"))).select(*key).distinct()
    side = lambda f, k, x: f.select(F.col("entity_id").alias(k), F.col("name_norm").alias(f"{x}name"), F.col("addr_norm").alias(f"{x}addr"), F.col("addr_numbers").alias(f"{x}nums"))
    same = pool.groupBy(F.col("name_norm").alias("bname")).agg(F.count("*").alias("namesakes"))
    f = wrong.join(side(s1, "s1_id", "a"), "s1_id", "left").join(side(pool, "cand_id", "b"), "cand_id", "left").join(same, "bname", "left").join(c.withColumn("seen", F.lit(1)), key, "left")
    x = lambda n: F.col(n)
    fp = F.when((x("aname") == x("bname")) & ~F.arrays_overlap("anums", "bnums") & (F.size("anums") > 0) & (F.size("bnums") > 0), "franchise").when((x("aname") == x("bname")) & (x("namesakes") >= franchise), "common_name").when((x("aaddr") == x("baddr")) & (x("aaddr") != ""), "address_collision").otherwise("other")
    fn = F.when(x("seen").isNull(), "blocking").when((x("aaddr") == "") | (x("baddr") == ""), "missing_address").when((F.length("aname") <= 4) | (F.length("bname") <= 4), "short_name").when(F.size(F.array_intersect(F.split("aname", " "), F.split("bname", " "))) == 0, "dba").otherwise("other")
    return f.select(*key, "kind", F.when(x("kind") == "fp", fp).otherwise(fn).alias("category"))


def score_loss(truth: DataFrame, cands: DataFrame, scored: DataFrame, selected: DataFrame, final: DataFrame, low: float = 0.5) -> DataFrame:
    """stage, links: where each true link ended."""
    key = ["s1_id", "cand_id"]
    f = truth.select(*key).distinct()
    for name, x in (("c", cands), ("sel", selected), ("fin", final)):
        f = f.join(x.select(*key).distinct().withColumn(name, F.lit(1)), key, "left")
    f = f.join(scored.select(*key, "p"), key, "left")
    stage = F.when(F.col("fin") == 1, "correct").when(F.col("c").isNull(), "not_retrieved").when(F.coalesce("p", F.lit(0.0)) < low, "low_score").when(F.col("sel").isNull(), "rejected").otherwise("lost_to_conflict")
    return f.groupBy(stage.alias("stage")).agg(F.count("*").alias("links"))
