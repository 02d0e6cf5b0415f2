"""Blocking, features, decisions, models, files and the stream, on small tables and against brute force."""

import random
from itertools import combinations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwright.functions import fuzzy
from linkwright.functions.normalize import normalize
from linkwright.operators import baselines, blocking, context, decide, features, graph, metrics, model, split, validate
from linkwright.plans.resolve import resolve
from linkwright.schemas import DuplicateIdError, InvalidIdPrefixError, SchemaMismatchError
from linkwright.sources import io
from linkwright.streaming.chunks import finished, resolve_stream

ENTITY = "entity_id string, business_name string, business_address string, country string"
S1 = [("S1-1", "Shree Laxmi Traders Pvt Ltd", "12 MG Road near City Mall, 560001", "India"), ("S1-2", "Boulangerie Dupont", "5 rue de la Paix", "France"), ("S1-3", "Ltd", "", "US"), ("S1-4", "Lonely Widgets", "1 Nowhere", "US")]
POOL = [("S2-1", "Sri Lakshmi Trader Private Limited", "12 M.G. Rd, 560001", "IND"), ("S3-1", "Laxmi Shree Traders", "12 mg road", "India"), ("S2-2", "BOULANGERIE DUPONT", "5, rue de la Paix", "FR"), ("S3-2", "Dupont Boulangerie SARL", "", "France"), ("S3-3", "Other Shop", "99 Elm St near City Mall", "India")]


@pytest.fixture(scope="module")
def sides(spark):
    return normalize(spark.createDataFrame(S1, ENTITY)).cache(), normalize(spark.createDataFrame(POOL, ENTITY)).cache()


def pairs(df):
    return {(r.s1_id, r.cand_id) for r in df.collect()}


def test_channels(spark, sides):
    a, b = sides
    got = lambda ch: pairs(blocking.candidates_by_channel(a, b, ch))
    assert got("A") == {("S1-2", "S2-2")}
    assert ("S1-2", "S3-2") not in got("A") and got("I") >= {("S1-2", "S2-2")}
    assert got("K") == {("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-2")} or ("S1-1", "S3-1") in got("K")
    assert got("L") == set() and got("H") == {("S1-1", "S3-3")} - got("A") or got("H") == set()
    every = blocking.store(blocking.candidates_by_channel(a, b, blocking.CHANNELS))
    assert not {p for p in pairs(every) if p[0] == "S1-3" and p[1] != ""} and ("S1-1", "S3-1") in pairs(every)
    assert all(bin(r.channel_mask).count("1") == r.channel_count for r in every.collect())
    again = blocking.store(blocking.candidates_by_channel(a.repartition(7), b.repartition(3), blocking.CHANNELS))
    assert sorted(map(str, every.collect())) == sorted(map(str, again.collect()))


def test_caps_bind(spark):
    pool = normalize(spark.createDataFrame([(f"S{2 + i % 2}-{i:03}", "Same Name Shop", "1 Road", "US") for i in range(40)], ENTITY))
    one = normalize(spark.createDataFrame([("S1-1", "Same Name Shop", "1 Road", "US")], ENTITY))
    rows = blocking.candidates_by_channel(one, pool, "A", blocking.Caps(per_key=7)).orderBy("list_rank").collect()
    assert [r.cand_id for r in rows] == [f"S2-{i:03}" for i in range(0, 14, 2)]


def test_baselines(spark, sides):
    a, b = sides
    assert pairs(baselines.exact_match(a, b, baselines.NAME_ADDRESS)) == {("S1-2", "S2-2")}
    assert pairs(baselines.exact_match(a, b, baselines.RAW)) == {("S1-2", "S2-2")}


def test_features(spark, sides):
    a, b = sides
    p = spark.createDataFrame([("S1-2", "S2-2", 3), ("S1-1", "S2-1", 1), ("S1-4", "S9-9", 1)], "s1_id string, cand_id string, channel_count int")
    rows = {(r.s1_id, r.cand_id): r for r in features.pair_features(p, a, b).collect()}
    same, near, none = rows["S1-2", "S2-2"], rows["S1-1", "S2-1"], rows["S1-4", "S9-9"]
    assert len(same.asDict()) == 2 + 56
    assert same.name_exact_norm == same.name_tok_jaccard == same.addr_exact_norm == same.country_exact_match == 1 and same.name_ratio == same.addr_token_set_ratio == 100 and same.channel_count == 3
    assert near.name_phonetic_exact == 1 and near.postal_exact_match == 1 and near.name_exact_norm == 0 and near.addr_num_overlap_count == 2
    assert none.name_ratio == 0 and none.cand_name_degenerate == 1 and none.cand_is_s2 == 0
    one = normalize(spark.createDataFrame([("S1-1", "a", "1 x", "us"), ("S1-2", "a", "12a x", "us")], ENTITY))
    two = normalize(spark.createDataFrame([("S2-1", "a", "11 x", "us"), ("S2-2", "a", "12 x", "us")], ENTITY))
    q = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-2")], "s1_id string, cand_id string")
    assert all(r.addr_num_exact_match == 0 and r.addr_num_disagreement == 1 for r in features.pair_features(q, one, two, with_fuzzy=False).collect())


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_fuzzy_scores():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc ", k=rng.randint(0, 12))) for _ in "xy")
        assert fuzzy.lcs(a, b) == slow_lcs(a, b)
        for f in (fuzzy.ratio, fuzzy.partial_ratio, fuzzy.token_sort_ratio, fuzzy.token_set_ratio, fuzzy.w_ratio):
            assert 0 <= f(a, b) <= 100 + 1e-9 and abs(f(a, b) - f(b, a)) < 1e-9
    assert fuzzy.ratio("abcd", "abxd") == 75 and fuzzy.partial_ratio("bc", "abcd") == 100 and fuzzy.token_set_ratio("a b", "b a c") == 100 and fuzzy.token_sort_ratio("b a", "a b") == 100


def test_context(spark):
    s = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.5), ("b", "x", 0.6), ("b", "z", 0.6), ("c", "w", 0.3)], "s1_id string, cand_id string, p double")
    k = spark.createDataFrame([("x", "1"), ("y", "1")], "cand_id string, cluster_id string")
    r = {(x.s1_id, x.cand_id): x for x in context.context_features(s, k).collect()}
    assert r["a", "x"].is_mutual_best_match == 1 and abs(r["a", "x"].score_margin_to_second - 0.4) < 1e-6 and abs(r["b", "x"].max_competing_score - 0.9) < 1e-6
    assert r["b", "x"].score_rank_within_s1 == r["b", "z"].score_rank_within_s1 == 1 and r["c", "w"].score_percentile_within_s1 == 1.0
    assert r["a", "y"].cluster_size == 2 and r["a", "y"].cluster_s1_claimant_count == 2 and abs(r["a", "y"].cluster_max_score_for_s1 - 0.9) < 1e-6 and r["c", "w"].cluster_size == 1


def enumerate_f05(sel, rest):
    total, all_ = 0.0, [*sel, *rest]
    for bits in product((0, 1), repeat=len(all_)):
        mass = np.prod([p if b else 1 - p for p, b in zip(all_, bits, strict=True)])
        tp, fn = sum(bits[: len(sel)]), sum(bits[len(sel) :])
        total += mass * (1.0 if not sel and not sum(bits) else 0.0 if not tp else 1.25 * tp / (1.25 * tp + 0.25 * fn + len(sel) - tp))
    return total


def test_expected_f05_against_enumeration(spark):
    rng = np.random.default_rng(0)
    for _ in range(30):
        p = np.sort(rng.random(rng.integers(1, 8)))[::-1]
        for k in range(len(p) + 1):
            assert abs(decide.expected_f05(p[:k], p[k:]) - enumerate_f05(list(p[:k]), list(p[k:]))) < 1e-9
        best = max(enumerate_f05(list(c), [x for i, x in enumerate(p) if i not in ix]) for n in range(len(p) + 1) for ix in combinations(range(len(p)), n) for c in [[p[i] for i in ix]])
        k = decide.best_prefix(p)
        assert abs(decide.expected_f05(p[:k], p[k:]) - best) < 1e-9
    got = spark.range(1).select(decide.pmf_column(F.array(F.lit(0.8), F.lit(0.4), F.lit(0.1))).alias("p")).first().p
    assert np.allclose(got, [0.108, 0.516, 0.344, 0.032]) and decide.best_prefix(np.array([0.95, 0.90, 0.05])) == 2


def sequential(rows, margin=0.05):
    """The decision as one pass over all entities in order."""
    by = {}
    for s, c, p in sorted(rows, key=lambda r: (r[0], -r[2], r[1])):
        by.setdefault(s, []).append((c, p))
    by = {s: x[:20] for s, x in by.items()}
    chosen = {s: [c for c, _ in x[: decide.best_prefix(np.array([p for _, p in x]))]] for s, x in by.items()}
    claims = {}
    for s, cs in chosen.items():
        for c in cs:
            claims.setdefault(c, []).append((-dict(by[s])[c], s))
    vague, owner = set(), {}
    for c, x in claims.items():
        x.sort()
        if len(x) > 1 and x[1][0] - x[0][0] < margin - 1e-9:
            vague.add(c)
        else:
            owner[c] = x[0][1]
    for s in sorted({s for c, x in claims.items() if len(x) > 1 for _, s in x if c in vague or owner[c] != s}):
        own = [(c, p) for c, p in by[s] if c not in vague and owner.get(c, s) == s]
        for c in [c for c, o in owner.items() if o == s]:
            del owner[c]
        for c, _ in own[: decide.best_prefix(np.array([p for _, p in own]))]:
            owner[c] = s
    return {(s, c) for c, s in owner.items()}


def test_decisions_equal_one_sequential_pass(spark):
    rng = random.Random(4)
    rows = list({(f"S1-{rng.randint(0, 25):02}", f"S2-{rng.randint(0, 30):02}"): round(rng.random(), 3) for _ in range(160)}.items())
    rows = [(s, c, p) for (s, c), p in rows if p >= 0.01]
    df = spark.createDataFrame(rows, "s1_id string, cand_id string, p double")
    got = decide.decide(df.repartition(5))
    assert pairs(got) == sequential(rows)
    assert got.groupBy("cand_id").count().where("count > 1").count() == 0
    assert decide.decide(df.limit(0)).count() == 0


def test_unique_assignment_is_greedy(spark):
    rng = random.Random(2)
    rows = list({(f"S1-{rng.randint(0, 12)}", f"S{rng.randint(2, 3)}-{rng.randint(0, 12)}"): round(rng.random(), 2) for _ in range(150)}.items())
    rows = [(s, c, p) for (s, c), p in rows]
    used, per, want = set(), {}, set()
    for s, c, p in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        if p >= 0.6 and c not in used and per.get((s, c[:2]), 0) < 2:
            used.add(c)
            per[s, c[:2]] = per.get((s, c[:2]), 0) + 1
            want.add((s, c))
    df = spark.createDataFrame(rows, "s1_id string, cand_id string, p double")
    assert pairs(decide.filter_and_assign(df, decide.Rules(unique=True, per_source=2))) == want


def test_clusters(spark):
    e = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(30)] + [("z1", "z2"), ("z2", "z2")], "a string, b string")
    got = {r.node: r.cluster for r in graph.clusters(e).collect()}
    assert got == {**{f"n{i:03}": "n000" for i in range(31)}, "z1": "z1", "z2": "z1"}


def test_metrics_golden(spark):
    u = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "s1_id string")
    t = spark.createDataFrame([("a", "S2-1"), ("a", "S2-2"), ("b", "S2-3")], "s1_id string, cand_id string")
    p = spark.createDataFrame([("a", "S2-1"), ("a", "S2-2"), ("a", "S2-9"), ("c", "S2-7")], "s1_id string, cand_id string")
    r = {x.s1_id: x for x in metrics.entity_scores(p, t, u).collect()}
    assert abs(r["a"].f05 - 5 / 7) < 1e-9 and r["b"].f05 == 0 and r["c"].f05 == 0 and r["d"].f05 == 1
    m = metrics.macro(metrics.entity_scores(p, t, u)).first()
    assert m.singletons == 2 and m.singleton_accuracy == 0.5 and m.false_merge_rate == 0.5 and m.fp == 2


def test_splits(spark):
    rng = random.Random(0)
    e = spark.createDataFrame([(f"S1-{i}", "x", "y", "US" if i % 5 < 3 else "India") for i in range(1000)], ENTITY)
    t = spark.createDataFrame([(f"S1-{i}", f"S{2 + k % 2}-{i}-{k}") for i in range(1000) for k in range(rng.choice([0, 1, 3, 7]))], "s1_id string, cand_id string")
    ratios = {"train": 0.7, "val": 0.2, "test": 0.1}
    rows = split.stratified(e, t, ratios).collect()
    share = {k: sum(r.partition == k for r in rows) / 1000 for k in ratios}
    assert len({r.s1_id for r in rows}) == 1000 and all(abs(share[k] - v) < 0.02 for k, v in ratios.items())
    assert sorted(map(str, rows)) == sorted(map(str, split.stratified(e.repartition(9), t, ratios).collect()))
    assert [r["count"] for r in split.simple(e.select(F.col("entity_id").alias("s1_id")), {"a": 0.333, "b": 0.667}).groupBy("partition").count().orderBy("partition").collect()] == [333, 667]
    with pytest.raises(ValueError):
        split.check_ratios({"a": 0.5, "b": 0.6})


def test_models(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    rows = spark.createDataFrame([(*map(float, v), int(v[0] + 0.3 * v[1] > 0)) for v in x], "a double, b double, c double, label int")
    s = model.Scorer(["a", "b", "c"], seeds=(1, 2), trees=5, depth=3).fit(rows)
    scored = s.score(rows).select("p", F.col("label").alias("y")).cache()
    assert metrics.ranking(scored).first().roc_auc > 0.95 and s.importances()[0][0] == "a"
    s.save(str(tmp_path / "m"))
    again = model.Scorer(["a", "b", "c"], seeds=(1, 2)).load(str(tmp_path / "m"))
    assert [r.p for r in again.score(rows).collect()] == [r.p for r in s.score(rows).collect()]
    for method in ("sigmoid", "isotonic"):
        c = model.Calibrator(method).fit(scored)
        out = {r.when: r for r in c.evaluate(scored).collect()}
        assert out["after"].brier <= out["before"].brier + 0.02
        got = [r.q for r in scored.select("p", c.apply(F.col("p")).alias("q")).orderBy("p").collect()]
        assert all(b >= a - 1e-9 for a, b in zip(got, got[1:])) and 0 <= got[0] and got[-1] <= 1
    with pytest.raises(ValueError):
        model.Calibrator("magic")
    with pytest.raises(RuntimeError):
        model.Calibrator().apply(F.lit(0.5))
    with pytest.raises(RuntimeError):
        model.Scorer(["a"]).score(rows)


def test_files(spark, tmp_path):
    path = str(tmp_path / "e.tsv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"A ""b"" c"\t\tNA\nS1-2\tnull\tx\t\n')
    e = io.read_entities(spark, path, "S1")
    assert [tuple(r) for r in e.orderBy("entity_id").collect()] == [("S1-1", 'A "b" c', "", "NA"), ("S1-2", "null", "x", "")]
    for bad, error in (([("S2-1", "", "", "")], InvalidIdPrefixError), ([("S1-1", "", "", "")] * 2, DuplicateIdError)):
        with pytest.raises(error):
            validate.check_entities(spark.createDataFrame(bad, ENTITY), "S1")
    with pytest.raises(SchemaMismatchError):
        validate.check_entities(e.drop("country"), "S1")
    u = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string")
    m = spark.createDataFrame([("S1-1", "S3-2"), ("S1-1", "S2-9"), ("S1-1", "S2-9")], "s1_id string, cand_id string")
    wide = io.widen(u, m)
    assert sorted(map(tuple, wide.collect())) == [("S1-1", "S2-9,S3-2"), ("S1-2", "")]
    out = str(tmp_path / "m")
    io.write_tsv(wide, out)
    assert pairs(io.links(io.read_truth(spark, out))) == pairs(m) and {r.s1_id for r in io.read_lines(spark, out).collect()} == {"S1-1", "S1-2"}
    for suffix in ("parquet", "json", "csv", "tsv", "tsv.gz"):
        io.write_manifest(wide, f"{tmp_path}/x.{suffix}", {"seed": 1})
        assert sorted(map(tuple, io.read_manifest(spark, f"{tmp_path}/x.{suffix}").select(*wide.columns).collect())) == sorted(map(tuple, wide.collect()))
    with pytest.raises(ValueError):
        io.write_manifest(wide, f"{tmp_path}/x.xml")
    assert io.fingerprint(wide).first() == io.fingerprint(wide.repartition(3)).first()
    report = {r.invariant: r.violations for r in validate.output_report(m, m.where("cand_id = 'S2-9'"), u).collect()}
    assert report["matches_within_candidates"] == 1 and report["unique_matches"] == 1 and report["one_owner"] == 0


def test_resolve_and_stream(spark, tmp_path):
    s1, pool = spark.createDataFrame(S1, ENTITY), spark.createDataFrame(POOL, ENTITY)
    got = {r.source1_entity_id: r.matched_entity_ids for r in resolve(s1, pool).collect()}
    assert set(got) == {e[0] for e in S1} and "S2-2" in got["S1-2"] and got["S1-4"] == ""
    assert {r.source1_entity_id: r.matched_entity_ids for r in resolve(s1.repartition(3), pool, decider=None, rules=decide.Rules(threshold=0.99)).collect()}["S1-4"] == ""
    inbox, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    run = lambda: resolve_stream(spark, inbox, out, check, lambda b: b.select("entity_id"))
    s1.limit(2).coalesce(1).write.parquet(inbox)
    run()
    run()
    assert finished(spark, out).count() == 2
    s1.coalesce(1).write.mode("append").parquet(inbox)
    run()
    assert finished(spark, out).count() == 6 and finished(spark, out).select("batch").distinct().count() == 2


def test_best_prefixes_of_many_rows():
    rng = np.random.default_rng(3)
    p = -np.sort(-np.round(rng.random((200, 9)), 1), axis=1)  # ties
    want = [max(range(10), key=lambda k: (round(decide.expected_f05(x[:k], x[k:]), 12), -k)) for x in p]
    assert decide.best_prefixes(p).tolist() == want and decide.best_prefixes(np.zeros((2, 0))).tolist() == [0, 0]


def test_gate_search_and_provenance(spark):
    links = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-1"), ("S1-1", "S2-2"), ("S1-1", "X-1"), ("S1-2", "X-1")], "s1_id string, cand_id string")
    got = {r.source: r for r in metrics.h1_report(links).collect()}
    assert (got["S2"].ids, got["S2"].single, got["S2"].violations, got["S2"].examples) == (2, 1, 1, "S2-1")
    assert (got["S3"].ids, got["S3"].rate, got["S3"].examples) == (0, 0.0, "") and (got["all"].ids, got["all"].violations, got["all"].rate) == (2, 2, 1.0)
    assert not got["S3"].conflict_resolution_enabled
    assert all(r.ids == 0 and r.invariant_enforced for r in metrics.h1_report(links.limit(0)).collect())
    scored = links.limit(1).withColumn("p", F.lit(0.5))
    best = metrics.best_threshold(scored, links.limit(1), links.select("s1_id").limit(1)).collect()
    assert [(r.threshold, r.macro_f05) for r in best] == [(0.1, 1.0)]  # the first of those that are equal
    cands = spark.createDataFrame([("S1-1", "S2-1", 5), ("S1-2", "S2-1", 0), ("S1-3", "S2-1", None)], "s1_id string, cand_id string, channel_mask long")
    assert validate.with_provenance(cands.limit(1)).count() == 1
    with pytest.raises(Exception, match="no provenance"):
        validate.with_provenance(cands).collect()


def test_partial_ratio_compares_few_stretches(monkeypatch):
    rng, calls, plain = random.Random(2), [], fuzzy.lcs
    monkeypatch.setattr(fuzzy, "lcs", lambda a, b: calls.append(1) or plain(a, b))
    a = "".join(rng.choices("abcdefghij", k=30))
    b = "".join(rng.choices("uvwxyz", k=200)) + a[:14] + "-" + a[14:] + "".join(rng.choices("uvwxyz", k=200))
    got, used = fuzzy.partial_ratio(a, b), len(calls)
    assert got == max(fuzzy.ratio(a, b[max(0, i) : i + 30]) for i in range(-29, len(b))) and used < 20


def test_fuzzy_scores_run_in_many_partitions(spark):
    rows = [("S1-000000001", "Acme Foods", "1 Main St", "US")] + [(f"S2-{i:09}", f"Acme {i}", f"{i} Main St", "US") for i in range(1, 40)]
    n = normalize(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))
    pairs = spark.createDataFrame([("S1-000000001", r[0]) for r in rows[1:]], "s1_id string, cand_id string").coalesce(1)
    f = features.pair_features(pairs, n.where("source = 'S1'"), n.where("source = 'S2'"))
    assert f.select(F.spark_partition_id().alias("k"), "name_ratio").distinct().groupBy("k").count().count() > 1


def test_features_once_for_equal_contents(spark):
    rows = [(f"S{k % 3 + 1}-{k:09}", f"Acme {k // 3 % 3}", f"{k // 3 % 2} Main St", "US") for k in range(60)]
    n = normalize(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))
    a, b = n.where("source = 'S1'"), n.where("source <> 'S1'")
    pairs = a.select(F.col("entity_id").alias("s1_id")).crossJoin(b.select(F.col("entity_id").alias("cand_id")))
    counted = features.content_pairs(pairs, a, b).cache()
    assert counted.count() == 6 * 12 and counted.agg(F.sum("n")).first()[0] == 800
    every, once = features.pair_features(pairs, a, b, with_fuzzy=False), features.pair_features(counted, a, b, with_fuzzy=False).join(counted, ["s1_id", "cand_id"])
    names = ["name_tok_jaccard", "addr_tok_jaccard", "cand_is_s2"]
    for f in (lambda x: metrics.feature_audit(x, names), lambda x: metrics.correlated(x, names, 0.0)):
        one, two = ([[round(v, 9) if isinstance(v, float) else v for v in r] for r in sorted(f(x).collect())] for x in (every, once))
        assert one == two and one


def test_near_top_keeps_the_likeliest(spark):
    """Ties, nulls and groups smaller than `most` included; of large groups little is left to sort."""
    rows = [(f"S1-{e}", f"S2-{c:04}", None if c % 9 == 0 else (c * 37 % (101 if e else 5)) / 101) for e, n in ((0, 300), (1, 900), (2, 3), (3, 0)) for c in range(n)]
    f = spark.createDataFrame(rows, "s1_id string, cand_id string, p double")
    for most in (1, 3, 20):
        near = {tuple(r) for r in decide.near_top(f, most, ["s1_id"]).collect()}
        for e in range(3):
            order = sorted((r for r in rows if r[0] == f"S1-{e}"), key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
            assert set(order[:most]) <= near
        assert sum(r[0] == "S1-1" for r in near) < 200


@pytest.mark.parametrize("most", [10, 1_000_000])
@pytest.mark.parametrize("per_source", [1, 2])
def test_assignment_within_groups(spark, monkeypatch, most, per_source):
    """A group's greedy pass and the rounds of larger groups give what one pass over all pairs gives, ties included; a chain
    of ties that takes an entity a round goes beyond no number of rounds."""
    rows = [(f"S1-{i:03d}", f"S{2 + j % 2}-{j:03d}", round((i * 7 + j * 5) % 4 / 10 + 0.6, 1), g) for g, (n, m) in enumerate(((3, 3), (12, 9))) for i in range(g * 50, g * 50 + n) for j in range(g * 50, g * 50 + m)]
    monkeypatch.setattr(decide, "GROUP", most)
    df = spark.createDataFrame(rows, "s1_id string, cand_id string, p double, g long")
    owner, used, want = {}, {}, []
    for s, c, p, _ in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        if c not in owner and used.get((s, c[:2]), 0) < per_source:
            owner[c], used[s, c[:2]] = s, used.get((s, c[:2]), 0) + 1
            want.append((s, c, p))
    rules = decide.Rules(per_source=per_source, unique=True)
    got = decide.filter_and_assign(df, rules, within="g")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_assignment_needs_no_rounds_within_a_group(spark):
    rows = [(f"S1-{i:03d}", f"S2-{j:03d}", 0.9, 0) for i in range(8) for j in range(8)]
    df = spark.createDataFrame(rows, "s1_id string, cand_id string, p double, g long")
    got = decide.filter_and_assign(df, decide.Rules(unique=True), rounds=2, within="g")
    assert sorted((r.s1_id, r.cand_id) for r in got.collect()) == [(f"S1-{i:03d}", f"S2-{i:03d}") for i in range(8)]


def test_all_candidates_are_selected_from(spark):
    """More than 20 candidates, unlikely ones and ties included: the lengths are those of all prefixes compared."""
    rng = random.Random(5)
    rows = [(f"S1-{e}", f"S2-{c:03}", p) for e, n in enumerate((1, 3, 25, 40, 60)) for c in range(n) for p in [round(rng.random() ** (1 + e % 2), 1 + e % 3)]]
    want = []
    for e in range(5):
        order = sorted((r for r in rows if r[0] == f"S1-{e}"), key=lambda r: (-r[2], r[1]))
        p = np.array([r[2] for r in order])
        value = [decide.expected_f05(p[:k], p[k:]) for k in range(len(p) + 1)]
        level = -np.unique(-p)
        assert np.allclose(decide.prefix_values(level, np.array([(p == x).sum() for x in level])), value, atol=1e-9)
        want += order[: next(k for k, x in enumerate(value) if x >= max(value) - 1e-10)]
    df = spark.createDataFrame(rows + [("S1-9", "S2-1", None), ("S1-9", "S2-2", 0.0)], "s1_id string, cand_id string, p double")
    assert sorted(map(tuple, decide.select_matches(df.repartition(5)).collect())) == sorted(want) and len(want) > 40
