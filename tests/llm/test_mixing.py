"""Mixing: expected totals meet the targets, rates solve the least squares, decisions take effect, edge cases hold."""

import numpy as np
import pytest

from linkwright.llm import mixing

WORDS = {"en": "the and of in with for that this", "de": "der und von mit für das nicht auch", "fr": "le et de dans avec pour que ce"}


def corpus(spark, n=240):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS), p=[0.7, 0.2, 0.1])
        rows.append((i, " ".join(rng.choice(WORDS[lang].split(), rng.integers(5, 80))), lang, 1.0, "x"))
    rows += [(1000, None, "en", 1.0, "x"), (1001, "", "de", 1.0, "x"), (None, "the and of", "en", 1.0, "x"), (0, rows[0][1], rows[0][2], 1.0, "x"), (1002, "w " * 30_000, None, 1.0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, domain string, rate double, tokens string")


def test_totals_meet_targets(spark):
    docs = corpus(spark).where("doc_id <> 1002")
    weights = {"en": 0.2, "de": 0.5, "fr": 0.3}
    rows = mixing.mix(docs, docs, weights).collect()
    assert len(rows) == docs.count()
    t, r, p = (np.array([x[c] for x in rows], float) for c in ("tokens", "rate", "posteriors"))
    assert (r >= 0).all() and np.allclose((t * r) @ p / t.sum(), list(weights.values()), atol=2e-3)
    equal = {x.rate for x in rows if x.doc_id == 0}
    assert len(equal) == 1
    assert mixing.mix(docs.limit(0), docs, weights).count() == 0
    flat = mixing.mix(docs, docs.limit(0), weights).collect()
    assert all(np.allclose(x.posteriors, 1 / 3) for x in flat)


def test_rates_solve_the_projected_problem(spark):
    rng = np.random.default_rng(1)
    p = np.round(rng.dirichlet([0.3, 0.3, 0.3], 300), 6)
    t = rng.integers(1, 500, 300)
    members = spark.createDataFrame([(int(i), int(n), [float(x) for x in q]) for i, (n, q) in enumerate(zip(t, p, strict=True))], "doc_id long, tokens long, posteriors array<double>").repartition(4)
    for targets, most in ((np.array([1.0, 5000.0, 20000.0]), np.inf), (np.array([9000.0, 9000.0, 9000.0]), 1.0)):
        rates = mixing.fit_rates(members, targets, most=most, rounds=60)
        r, plain = rates.of(p), np.full(len(p), min(rates.start, most))
        weight = np.linalg.inv((t[:, None] * p).T @ p)
        for _ in range(20_000):
            plain = np.clip(plain - p @ weight @ ((t * plain) @ p - targets), 0, most)
        miss, least = (np.abs((t * x) @ p - targets).max() for x in (r, plain))
        assert (r >= 0).all() and (r <= most).all() and miss <= least + 2e-3 * targets.sum()
        again = mixing.fit_rates(members.repartition(7), targets, most=most, rounds=60)
        assert np.array_equal(again.of(p), r)


def test_resample(spark):
    docs = corpus(spark)
    kept = mixing.resample(docs, docs, {"en": 0.34, "de": 0.33, "fr": 0.33})
    rows = kept.collect()
    assert kept.columns == docs.columns and 0 < len(rows) < docs.count()
    assert sorted(map(str, rows)) == sorted(map(str, mixing.resample(docs.repartition(5), docs, {"en": 0.34, "de": 0.33, "fr": 0.33}).collect()))
    assert mixing.resample(docs.limit(0), docs, {"en": 1.0}).count() == 0


def test_resample_keeps_the_rest_of_skewed_domains(spark):
    rng = np.random.default_rng(3)
    weights = {"en": 0.55, "de": 0.34, "fr": 0.11}
    for counts in ({"en": 300, "de": 280, "fr": 6}, {"en": 300, "de": 280}, {"fr": 40}):
        langs = [d for d, n in counts.items() for _ in range(n)]
        rows = [(i, " ".join(rng.choice(WORDS[d].split(), 40)), d) for i, d in enumerate(langs)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
        got = [r.domain for r in mixing.resample(docs, docs, weights).collect()]
        present = sum(weights[d] for d in counts)
        for d, n in counts.items():
            want = min(weights[d] / present * len(rows), n)
            assert abs(got.count(d) - want) <= 3 * np.sqrt(want * (1 - want / n)) + 0.03 * n, (counts, d, got.count(d), want)


def test_classifier_accuracy(spark):
    docs = corpus(spark)
    c = mixing.fit_classifier(docs.where("doc_id % 2 = 0"), tuple(WORDS))
    rows = docs.where("doc_id % 2 = 1 AND doc_id < 1000").collect()
    p = c.posteriors(mixing.trigram_features([r.text for r in rows])[0])
    assert np.mean([list(WORDS)[k] == r.domain for k, r in zip(p.argmax(1), rows, strict=True)]) > 0.97
