"""The pipeline's stages keep the contract of their inputs, and do what brute force does."""

import re
from collections import Counter, defaultdict
from itertools import combinations

import corpus_pipeline as P
from linkwright.llm.shared import materialize

LONG = " ".join(f"word{k}" for k in range(60))


def test_stages(spark, tmp_path):
    text = lambda i: " ".join(f"Clean{(i * 7 + k * k) % 97} words{k % 13} follow" for k in range(20))
    rows = [(i, f"{text(i)}.\nThe same last line", "en de fr es".split()[i % 4], "s", 1) for i in range(60)]
    rows += [(100, LONG, "en", "s", 1), (101, LONG + " more", "en", "s", 1), (102, LONG, "de", "s", 1), (103, None, "en", "s", 1), (104, "", None, None, None), (105, "x" * 50_000, "fr", "s", 1)]
    rows += [(200 + i, "$$$ BUY### !!! " * 30, "en", "s", 1) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i in [*range(60), 100, 101, *range(200, 230)]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    outs = []
    for name, stage in P.STAGES:
        docs = materialize(stage(spark, docs, str(tmp_path)), "t")
        outs.append(docs.collect())
        assert name == "packing" or tuple(docs.columns) == P.COLUMNS
    good, lines, single, mixed, packed = outs
    ids = {r.doc_id for r in good}
    assert ids >= set(range(60)) and not ids & set(range(200, 230))
    seen = defaultdict(set)
    for r in good:
        for x in (r.text or "").split("\n"):
            seen[x.strip().lower()].add(r.doc_id)
    want = {r.doc_id: "\n".join(x for x in (r.text or "").split("\n") if not x.strip() or len(seen[x.strip().lower()]) < 10) for r in good}
    assert {r.doc_id: r.text for r in lines} == want and all(r.n_chars == len(r.text) for r in lines)
    sets = {r.doc_id: {tuple(w[k : k + 5]) for w in [re.findall(r"\S+", r.text.lower())] for k in range(max(1, len(w) - 4)) if w} for r in lines}
    comp = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            lo, hi = sorted((comp[a], comp[b]))
            comp = {i: lo if c == hi else c for i, c in comp.items()}
    assert {r.doc_id for r in single} == {i for i, c in comp.items() if i == c} and 101 not in {r.doc_id for r in single}
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in single}
    tokens = Counter()
    for r in packed:
        tokens[r.doc_id] += r.length
    assert all(tokens[r.doc_id] == r.doc_tokens for r in packed) and set(tokens) == {r.doc_id for r in mixed}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
