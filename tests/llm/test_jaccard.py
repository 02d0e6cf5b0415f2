"""The Jaccard join against brute force: random texts, copies, hot groups and edge cases."""

import re
import tracemalloc
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from linkwright.llm import jaccard
from linkwright.llm.jaccard import Measure


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute_set(text, k=4):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows):
    comp = {i: i for i, _ in rows}
    sets = [(i, brute_set(t)) for i, t in rows]

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for (i, a), (j, b) in combinations(sets, 2):
        if i == j or (a and b and 100 * len(a & b) >= 85 * len(a | b)):
            x, y = sorted((find(i), find(j)))
            comp[y] = x
    return {i: find(i) for i in comp}


def corpus(seed=0):
    rng = np.random.default_rng(seed)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 9))) for _ in range(900)]
    text = lambda n: [vocabulary[k] for k in rng.zipf(1.3, n) % 900]
    passage, out = text(60), []
    for _ in range(40):
        base = text(int(rng.integers(1, 260)))
        for _ in range(int(rng.integers(1, 5))):
            own = list(base)
            for _ in range(int(rng.integers(0, 1 + len(own) // 40))):
                own[int(rng.integers(len(own)))] = vocabulary[int(rng.integers(900))]
            out.append(" ".join(own))
    hot = text(200)
    for k in range(60):
        own = list(hot)
        for _ in range(k % 7):
            own[int(rng.integers(200))] = f"x{rng.integers(10**6)}"
        out.append(" ".join(own))
    out += [" ".join(text(40) + passage + text(30)) for _ in range(40)] + [" ".join(hot)] * 20
    out += ["", None, " \t\n", "one", "ONE", "one two", "One\x0btwo", "a b c d", "a b c d e", "abba baab abba baab", "baab abba baab abba", "w " * 9000]
    rng.shuffle(out)
    return [(i + 7, x) for i, x in enumerate(out)]


def test_against_brute_force(spark):
    rows = corpus()
    want, plain = brute(rows), dict(rows)
    df = spark.createDataFrame([(i, t, 1, 2, "c") for i, t in rows], "doc_id long, text string, n int, k1 int, component string").repartition(5)
    for options in ({}, {"trie_block": 8, "pair_block": 6, "rounds": 2}, {"rounds": 0, "trie_block": 5, "pair_block": 9}):
        got = jaccard.near_duplicates(df, **options).collect()
        assert {r.doc_id: r.component_id for r in got} == want
        assert all(r.n_shingles == len(brute_set(plain[r.doc_id])) for r in got) and len(got) == len(rows)


def test_repeated_and_null_ids(spark):
    a, b = "one two three four five six seven", "a completely different text with words in it that goes on and on for quite a while"
    df = spark.createDataFrame([(1, a), (1, b), (2, a), (3, b), (9, b + " x"), (None, a), (None, ""), (5, ""), (6, "")], "doc_id long, text string")
    got = [(r.doc_id, r.component_id) for r in jaccard.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (9, 1), (None, None), (None, None), (5, 5), (6, 6)], key=str)
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=2, max_size=14), st.sampled_from([50, 85]))
@settings(max_examples=150, deadline=None)
def test_trie_joins_what_links_join(sets, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    links = jaccard.trie_links(list(range(len(sets))), arrays, Measure(percent=percent))
    comp = list(range(len(sets)))
    mine = list(comp)

    def join(c, i, j):
        x, y = sorted((c[i], c[j]))
        return [x if v == y else v for v in c]

    for i, j in combinations(comp[:], 2):
        if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            comp = join(comp, i, j)
    for i, j in links:
        assert 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
        mine = join(mine, i, j)
    assert mine == comp and len(links) < len(sets)


@given(st.lists(st.tuples(st.sets(st.integers(0, 20), min_size=1), st.integers(0, 9)), min_size=3, max_size=14), st.integers(1, 13))
@settings(max_examples=150, deadline=None)
def test_trie_of_one_block_probed_by_another(rows, inserted):
    """With what is joined already, the pairs across the two blocks come out, and none of one component."""
    inserted = min(inserted, len(rows) - 1)
    measure, sets = Measure(percent=60), [s for s, _ in rows]
    got = jaccard.trie_links(list(range(len(rows))), [np.array(sorted(s), np.uint64) for s in sets], measure, [c for _, c in rows], inserted)

    def joined(links):
        comp = [c for _, c in rows]
        for i, j in links:
            x, y = sorted((comp[i], comp[j]))
            comp = [x if v == y else v for v in comp]
        return comp

    want = [(i, j) for i in range(inserted) for j in range(inserted, len(rows)) if 100 * len(sets[i] & sets[j]) >= 60 * len(sets[i] | sets[j])]
    assert joined(got) == joined(want) and all((j, i) in want for i, j in got)
    assert all(rows[i][1] != rows[j][1] for i, j in got)


def test_global_order_is_one_to_one():
    rng = np.random.default_rng(1)
    sets = jaccard.shingle_sets([t for _, t in corpus(2)])
    tokens = np.unique(np.concatenate(sets))
    common = np.sort(rng.choice(tokens, 200, replace=False))
    rank = rng.permutation(200).astype(np.int32)
    keys = jaccard.ordered_sets(sets, (common, rank))
    order = {int(t): (1, int(k)) for t, k in zip(common, rank, strict=True)}
    for s, k in zip(sets, keys, strict=True):
        assert len(np.unique(k)) == len(s) and (np.diff(k.astype(object)) > 0).all()
        assert [int(t) for t in sorted(s, key=lambda t: order.get(int(t), (0, int(t))))] == [int(t) if t < 1 << 63 else int(common[rank == t - np.uint64(1 << 63)][0]) for t in k]


@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=900), st.sets(st.integers(0, 2**64 - 1), max_size=900), st.integers(0, 900))
@settings(max_examples=100, deadline=None)
def test_sketches_bound_the_overlap(a, b, shared):
    b = b | set(sorted(a)[:shared])
    if b:
        x, y = (np.frombuffer(jaccard.histogram(np.array(sorted(s), np.uint64), jaccard.sketch_bins(len(s))), np.uint8) for s in (a, b))
        assert len(a & b) <= jaccard.at_most(x, y) == jaccard.at_most(y, x)
    assert jaccard.at_most(np.full(64, 255, np.uint8), np.zeros(128, np.uint8)) > 1 << 60


def test_pair_is_sent_once(spark, monkeypatch):
    """Near copies share most of their buckets; what the buckets send doesn't grow with their number."""
    sent, real = [], jaccard.materialize

    def keep(df, name):
        out = real(df, name)
        if name == "open":
            sent.append((out.count(), out.where("b IS NOT NULL").select("a", "b").count(), out.where("b IS NOT NULL").select("a", "b").distinct().count()))
        return out

    monkeypatch.setattr(jaccard, "materialize", keep)
    base = [f"word{k}" for k in range(120)]
    rows = [(i, " ".join([*base[: 4 * i], f"own{i}", *base[4 * i + 1 :]])) for i in range(24)]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), rounds=0).collect()
    assert {r.component_id for r in got} == {0}
    (every, pairs, distinct), = sent
    assert pairs <= 1.5 * distinct and every <= 24 * 23 // 2


def test_shingles_of_many_texts_need_little_memory():
    texts = [None, "", "Ab", " x\ty "] + [" ".join(f"w{i * j % 977}" for j in range(400)) for i in range(1, 2000)]
    few = [s for i in range(0, len(texts), 7) for s in jaccard.shingle_sets(texts[i : i + 7])]
    tracemalloc.start()
    all_ = jaccard.shingle_sets(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(np.array_equal(a, b) for a, b in zip(all_, few, strict=True))
    assert peak < 40_000_000
