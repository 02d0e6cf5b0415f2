"""Quality: learned passages separate junk, gradients are right, and edge cases have scores."""

import math
import re
import zlib
from itertools import groupby

import numpy as np
from pyspark.sql import functions as F

from linkwright.llm import quality

CLEAN = "The quick brown fox jumps over a lazy dog, and then it rests for a while near the old mill number {}. "
JUNK = "BUY!!! NOW### $$$ BUY!!! NOW### {} $$$ "


def corpus(n=240):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        clean = [CLEAN.format(rng.integers(1000)) * 3 for _ in range(rng.integers(2, 6))]
        if i % 3 == 0:
            clean[rng.integers(len(clean))] = JUNK.format(rng.integers(1000)) * 12
        rows.append((i, "".join(clean), int(i % 3 != 0)))
    return rows


def test_learns_and_holds_out(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 9.0, "y") for i, t, _ in rows] + [(i, x, 9.0, "y") for i, x in ((1000, None), (1001, ""), (1002, " \n "), (1003, "w " * 60_000), (None, "x"), (0, rows[0][1]))], "doc_id long, text string, score double, y string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (1, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).withColumn("h", quality.held_out("doc_id")).collect()
    assert len(got) == len(rows) + 6 and all(0 <= r.score <= 1 for r in got)
    label = {i: q for i, _, q in rows}
    test = [(r.score >= 0.3) == label[r.doc_id] for r in got if r.h and r.doc_id in label]
    assert len(test) > 20 and np.mean(test) > 0.95
    for r in got:
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    zero = [r.score for r in got if r.doc_id == 0]
    assert zero[0] == zero[1]
    again = quality.fit(docs.repartition(5), labels)
    assert all(np.array_equal(model.p[k], again.p[k]) for k in model.p)
    assert quality.score(docs.limit(0), model).count() == 0
    assert quality.fit(docs, labels.limit(0)) is None
    assert quality.score(docs, None).agg(F.max("score"), F.min("score")).first() == (0.5, 0.5)


def test_trains_on_whole_documents(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(quality, "train", lambda f, owner, y, **_: taken.append(np.bincount(owner).tolist()))
    rows = [(i, "word " * (64 * n)) for i, n in enumerate((300, 2, 5, 250, 1, 4, 3, 2))]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    quality.fit(docs, labels)
    kept = labels.where(~quality.held_out("doc_id")).orderBy(F.xxhash64("doc_id", F.lit(0))).select("doc_id").collect()
    size = [len(rows[r.doc_id][1].split()) // 64 for r in kept]
    assert sorted(taken[0]) == sorted(size) and max(size) > 200
    for most in (sum(size) - 1, 1):
        quality.fit(docs, labels, most_passages=most)
        n = max(1, int((np.cumsum(size) <= most).sum()))
        assert sorted(taken[-1]) == sorted(size[:n])


def finish(h):
    h = ((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9) % 2**64
    return h ^ (h >> 32)


def plain_passages(text):
    """The passages' counts by loops over words and bytes."""
    words = [w for w in re.split(rb"[ \t-\r]+", (text or "").encode()) if w]
    salt = [int(x) for x in quality._RANDOM]
    kind = lambda b: 97 if b >= 128 or 97 <= b < 123 else 65 if 65 <= b < 91 else 48 if 48 <= b < 58 else b
    total = lambda v: finish(sum(salt[b] * (2 * k + 1) for k, b in enumerate(v)) % 2**64)
    out = []
    for at in range(0, max(1, len(words)), 64):
        row, own = np.zeros(quality.DIMS, int), words[at : at + 64]
        lower = [w.lower() for w in own]
        word = [total(w) for w in lower]
        shape = []
        for i, w in enumerate(own):
            same = lower[i] in lower[max(0, i - 2) : i]
            shape.append((total([k for k, _ in groupby(map(kind, w))]) + same * quality.REPEAT) % 2**64)
        for each, most, dims, low in ((shape, 3, quality.SHAPE_DIMS, 0), (word, 2, quality.WORD_DIMS, quality.SHAPE_DIMS)):
            for n in range(1, most + 1):
                for i in range(len(each) - n + 1):
                    h = sum(x * p for x, p in zip(each[i : i + n], quality.PLACES, strict=False)) % 2**64
                    row[low + finish(h) % dims] += 1
        for w in lower:
            for x, y, z in zip(b"\0" + w, w, w[1:] + b"\0", strict=False):
                h = ((x * 0x9E3779B1 ^ y * 0x85EBCA77 ^ z * 0xC2B2AE3D) % 2**32 * 0x27D4EB2F) % 2**32
                row[quality.SHAPE_DIMS + quality.WORD_DIMS + (h >> 16) % quality.PIECE_DIMS] += 1
        out.append(np.minimum(row, 255))
    return np.array(out)


def plain_score(model, text):
    p, hidden, energy = model.p, [], []
    for row in plain_passages(text):
        x, low = [], 0
        for dims in (quality.SHAPE_DIMS, quality.WORD_DIMS, quality.PIECE_DIMS):
            part = row[low : low + dims]
            x += [math.sqrt(c / max(1, part.sum())) for c in part]
            low += dims
        h = [math.tanh(sum(a * w for a, w in zip(x, column, strict=True)) + b) for column, b in zip(p["W"].T, p["b"], strict=True)]
        gate = [math.tanh(np.dot(h, v)) / (1 + math.exp(-np.dot(h, u))) for v, u in zip(p["V"].T, p["U"].T, strict=True)]
        hidden.append(h)
        energy.append(math.exp(np.dot(gate, p["w"])))
    mean = sum(np.array(h) * e for h, e in zip(hidden, energy, strict=True)) / sum(energy)
    return 1 / (1 + math.exp(-(np.dot(mean, p["c"]) + float(p["d"]))))


TEXTS = ["", None, " \n", "a b a " * 50, "One, TWO!! $x\n" * 30, "é É ü", "x" * 3000, "Rewh.### And&&& and&&& A1b2 \t\x0bw\r"]


def test_passages_against_brute_force():
    f, owner = quality.encode_passages(TEXTS)
    want = [plain_passages(x) for x in TEXTS]
    assert owner.tolist() == [i for i, w in enumerate(want) for _ in w]
    assert np.array_equal(f, np.concatenate(want))
    assert f.max() == 255  # one long word


def test_scores_against_brute_force(spark):
    rows = corpus(60)
    model = quality.fit(spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"), spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int"), epochs=3)
    texts = TEXTS + [t for _, t, _ in rows[:10]]
    got = quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in got:
        assert abs(r.score - plain_score(model, texts[r.doc_id])) < 1e-8


def test_attention_finds_the_passage():
    """Of a document of clean passages and one of junk, the junk gets the attention that decides."""
    rows = corpus()
    f, owner = quality.encode_passages([t for _, t, _ in rows])
    labels = np.array([q for _, _, q in rows], float)
    model = quality.train(f, owner, labels)
    starts = np.searchsorted(owner, np.arange(len(rows)))
    s = quality._forward(model.p, quality._roots(f).astype(float), starts, np.diff(np.append(starts, len(f))))
    assert np.allclose(np.bincount(owner, s["a"]), 1)
    junk = np.zeros(len(f), bool)
    junk[[k for k in range(len(f)) if f[k, : quality.SHAPE_DIMS].argmax() != f[starts[1], : quality.SHAPE_DIMS].argmax()]] = True
    mixed = [i for i in range(len(rows)) if not labels[i] and 0 < junk[owner == i].sum() < (owner == i).sum()]
    assert len(mixed) > 20
    more = [s["a"][(owner == i) & junk].mean() > s["a"][(owner == i) & ~junk].mean() for i in mixed]
    assert np.mean(more) > 0.9


def test_training_lowers_the_loss():
    rng = np.random.default_rng(0)
    f = rng.integers(0, 3, (40, quality.DIMS)).astype(np.uint8)
    owner = np.sort(np.append(np.arange(10), rng.integers(0, 10, 30)))
    labels = (np.arange(10) % 2).astype(float)
    starts = np.searchsorted(owner, np.arange(10))
    counts = np.diff(np.append(starts, len(f)))

    def loss(p):
        y = quality._forward(p, quality._roots(f).astype(float), starts, counts)["y"]
        return -np.mean(labels * np.log(y) + (1 - labels) * np.log(1 - y))

    before = quality.train(f, owner, labels, epochs=4).p
    after = quality.train(f, owner, labels, epochs=40).p
    assert loss(after) < 0.5 * loss(before)
