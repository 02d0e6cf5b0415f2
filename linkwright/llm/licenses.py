"""License scans: a trained paragraph classifier with a calibrated unknown class, confirmed against templates."""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwright.llm.shared import by_bytes, tidy
from linkwright.llm.words import hash_words

#: Words of a window; longer lines and paragraphs are read as windows that overlap by half.
PARAGRAPH, STRIDE = 48, 24
#: Licence families and the sentences that give notice of them.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or at your option any later version.",
    ),
    "gpl-2.0": (
        "This program is licensed under the GNU General Public License, version 2.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "mpl-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc0-1.0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has dedicated all copyright and related rights to this work to the public domain.",
    ),
}
#: Sentences with the words of notices that give no notice, as training examples of the unknown class.
DECOYS = (
    "The driver was licensed under the old rules of the county.", "A license is needed to work under general supervision.",
    "The public release of this version was permitted by law.", "Copies of the notice were distributed free of charge to any person.",
    "This work was released in the spring and the terms of use changed.", "You may obtain a copy of the map at the station.",
)
FAMILIES = (*TEMPLATES, "unknown")


def _ngrams(words: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 1- to 3-grams that begin at each word (shape 3 x words) and whether each is whole within its line (or
    whatever parts the words)."""
    n = len(words)
    grams, whole = np.zeros((3, n), np.uint64), np.zeros((3, n), bool)
    total = np.zeros(n, np.uint64)
    for k in range(3):
        m = max(0, n - k)
        total[:m] += np.roll(words, -k)[:m] * np.uint64(2 * k + 3) + np.uint64(k)
        grams[k] = (total ^ (total >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        whole[k, :m] = np.roll(line, -k)[:m] == line[:m]
    return grams, whole


@dataclass(frozen=True)
class Scanner:
    """vocabulary: sorted n-gram hashes; weights (n-grams and a constant x families); temperature; templates: for each
    family the positions of its sentences' 3-grams in the vocabulary; least: score and likeness that a finding needs."""

    vocabulary: np.ndarray
    weights: np.ndarray
    temperature: float
    templates: tuple[tuple[np.ndarray, ...], ...]
    least_score: float = 0.5
    least_likeness: float = 0.6

    def features(self, words: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each known n-gram: its first word, and its number in the vocabulary."""
        grams, whole = _ngrams(words, line)
        at = np.searchsorted(self.vocabulary, grams)
        at[at == len(self.vocabulary)] = 0
        known = (self.vocabulary[at] == grams) & whole
        size, word = np.nonzero(known)
        return word, at[size, word]

    def probabilities(self, present: np.ndarray) -> np.ndarray:
        z = (present @ self.weights[:-1] + self.weights[-1]) / self.temperature
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def likeness(self, family: int, present: np.ndarray) -> float:
        """The largest share of a template sentence's 3-grams that are there."""
        return max(float(present[t].mean()) for t in self.templates[family])


def train(background: Mapping[str, int], *, copies: int = 40, steps: int = 300, seed: int = 0) -> Scanner:
    """Fit on templates with words dropped and set among background words (given with their counts, which are the odds
    of a draw); decoys and the background itself are the unknown class. The temperature is fit on examples kept apart.
    Deterministic, and sparse: an example is its known n-grams; only those of templates and decoys are features."""
    rng = np.random.default_rng(seed)
    words = sorted(background) or ["and"]
    upto = np.cumsum([background.get(w, 1) for w in words])
    examples: list[tuple[str, int]] = []

    def drawn(k: int) -> list[str]:
        return [words[i] for i in np.searchsorted(upto, rng.integers(0, upto[-1], k), "right")]

    def around(text: str) -> str:
        k = int(rng.integers(0, 30))
        parts = drawn(k)
        cut = int(rng.integers(0, k + 1))
        return " ".join([*parts[:cut], text, *parts[cut:]])

    for f, name in enumerate(TEMPLATES):
        for sentence in TEMPLATES[name]:
            for c in range(copies):
                left = [w for w in sentence.split() if c == 0 or rng.random() > 0.06]
                examples.append((around(" ".join(left)) if c else sentence, f))
    none = len(TEMPLATES)
    notice = np.array([w for s in TEMPLATES.values() for x in s for w in x.split()])
    examples += [(around(d), none) for d in DECOYS for _ in range(copies)]
    examples += [(" ".join(drawn(int(rng.integers(3, PARAGRAPH)))), none) for _ in range(copies * 10)]
    examples += [(around(" ".join(rng.choice(notice, int(rng.integers(1, 8))))), none) for _ in range(copies * 10)]
    shown = [s.encode() for name in TEMPLATES for s in TEMPLATES[name]] + [d.encode() for d in DECOYS]
    hashes, line, _ = hash_words(shown)
    grams, whole = _ngrams(hashes, line)
    scanner = Scanner(np.unique(grams[whole]), np.zeros((0, 0)), 1.0, ())
    hashes, line, begin = hash_words([e.encode() for e, _ in examples])
    at, gram = scanner.features(hashes, line)
    size = len(scanner.vocabulary)
    pairs = np.unique((np.searchsorted(begin, at, "right") - 1) * (size + 1) + gram)
    pairs = np.union1d(pairs, np.arange(len(examples)) * (size + 1) + size)  # the constant
    row, column = pairs // (size + 1), pairs % (size + 1)
    y = np.eye(len(FAMILIES))[[f for _, f in examples]]
    kept = rng.random(len(examples)) < 0.8
    begins = np.searchsorted(row, np.arange(len(examples)))
    by_gram = np.argsort(column, kind="stable")
    runs = np.searchsorted(column[by_gram], np.arange(size + 1))
    seen = np.bincount(column, minlength=size + 1)[:, None] > 0

    def scores(w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(w[column], begins)

    w, v = np.zeros((size + 1, len(FAMILIES))), 0.0
    for _ in range(steps):
        z = scores(w)
        e = np.exp(z - z.max(1, keepdims=True))
        off = (e / e.sum(1, keepdims=True) - y) * kept[:, None] / kept.sum()
        v = 0.9 * v - 0.1 * (np.add.reduceat(off[row[by_gram]], np.minimum(runs, len(row) - 1)) * seen + 1e-5 * w)
        w = w + v
    z = scores(w)[~kept]
    loss = lambda t: float((np.log(np.exp((z - z.max(1, keepdims=True)) / t).sum(1)) - ((z - z.max(1, keepdims=True)) * y[~kept]).sum(1) / t).mean())
    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    templates = []
    for name in TEMPLATES:
        own = []
        for s in TEMPLATES[name]:
            hashes, line, _ = hash_words([s.encode()])
            grams, whole = _ngrams(hashes, line)
            own.append(np.searchsorted(scanner.vocabulary, np.unique(grams[2][whole[2]])))
        templates.append(tuple(own))
    return Scanner(scanner.vocabulary, w, temperature, tuple(templates))


def fit(docs: DataFrame, *, text_col: str = "text", sample: int = 400, words: int = 20_000) -> Scanner:
    """A scanner whose background is a bounded sample of docs: the whole texts with the `sample` smallest hashes, of whose
    words the `words` most frequent come to the driver with their counts. (Scanning reads all texts.)"""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    picked = docs.select(F.xxhash64(text).alias("h")).distinct().orderBy("h").limit(sample)  # no texts go to the driver here
    each = docs.select(F.xxhash64(text).alias("h"), text.alias("t")).join(F.broadcast(picked), "h", "left_semi").distinct()
    counts = each.select(F.explode(F.split("t", r"\s+")).alias("w")).where("w <> ''").groupBy("w").agg(F.count("*").alias("n"))
    return train({r.w: r.n for r in counts.orderBy(F.desc("n"), "w").limit(words).collect()})


def paragraphs(line: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The paragraph of each word: consecutive lines of a text that have words."""
    new = np.zeros(len(line), bool)
    new[1:] = np.diff(line) > 1
    new[begin[:-1][begin[:-1] < len(line)]] = True
    return np.cumsum(new)


FINDING = "array<struct<line:int,word:int,family:string,score:double,likeness:double>>"


def scan(docs: DataFrame, scanner: Scanner, *, text_col: str = "text", out_col: str = "licenses") -> DataFrame:
    """Docs with out_col: an array of findings (line, first word within the text, family, score, likeness).

    Texts are read in paragraphs (consecutive lines with words), so a wrapped notice is whole. A finding is a place in a
    paragraph that holds scanner.least_likeness of the 3-grams of one of a family's template sentences and whose likeliest
    class is that family with a score of scanner.least_score; notices side by side are found each. Where a sentence's
    words lie too far apart for a place, its window counts. A finding stands at its first line, which gives a family once.
    A null or empty text has no findings; equal texts have equal ones; an input column named out_col is replaced. One
    narrow pass over whole texts.
    """
    keep = [f for f in docs.schema.fields if f.name != out_col]
    kind = T._parse_datatype_string(FINDING)
    schema = T.StructType([*keep, T.StructField(out_col, kind)])
    arrow = pa.list_(pa.struct([("line", pa.int32()), ("word", pa.int32()), ("family", pa.string()), ("score", pa.float64()), ("likeness", pa.float64())]))

    owner = [f for f, own in enumerate(scanner.templates) for _ in own]
    grams = [t for own in scanner.templates for t in own]
    sentences = np.zeros((len(scanner.vocabulary), len(grams)))
    for k, t in enumerate(grams):
        sentences[t, k] = 1 / len(t)
    in_template = sentences.any(1)

    def spans(at: np.ndarray, gram: np.ndarray, sentence: int) -> list[tuple[int, int]]:
        """First words and ends of the places, little longer than the sentence, that hold enough of its 3-grams, best first."""
        own = sentences[gram, sentence] > 0
        place, gram = at[own], gram[own]
        out, long = [], len(grams[sentence]) + 8
        while len(place):
            best = (0, 0, 0, 0)
            for k, e in enumerate(np.searchsorted(place, place + long).tolist()):
                new = np.unique(gram[k:e], return_index=True)[1]
                last = k + int(new.max())
                best = max(best, (len(new), int(place[k] - place[last]), k, last))  # most, then shortest
            number, _, k, last = best
            if number < (scanner.least_likeness - 1e-9) * len(grams[sentence]):
                break
            out.append((int(place[k]), int(place[last]) + 3))
            place, gram = np.delete(place, slice(k, last + 1)), np.delete(gram, slice(k, last + 1))
        return out

    def found(texts: list[str | None]) -> list[list[dict]]:
        raw = [(x or "").encode("utf-8", "replace") for x in texts]
        words, line, begin = hash_words(raw)
        out: list[dict] = [{} for _ in texts]
        if not len(words):
            return [[] for _ in texts]
        before = np.cumsum([0] + [x.count(b"\n") + 1 for x in raw])
        block = paragraphs(line, begin)
        at, gram = scanner.features(words, block)
        order = np.argsort(at, kind="stable")
        at, gram = at[order], gram[order]
        hits = np.concatenate([[0], np.cumsum(in_template[gram])])
        first = np.searchsorted(block, np.unique(block[at]))
        last = np.searchsorted(block, np.unique(block[at]), "right")
        rows = [(p, min(n, p + PARAGRAPH), m, n) for m, n in zip(first.tolist(), last.tolist(), strict=True) for p in range(m, max(m + 1, n - STRIDE), STRIDE)]
        lo, hi = np.searchsorted(at, [r[0] for r in rows]), np.searchsorted(at, [r[1] for r in rows])
        busy = [(*r, a, b) for r, a, b in zip(rows, lo.tolist(), hi.tolist(), strict=True) if hits[b] - hits[a] >= 2]  # 0.6 of any sentence
        seen: dict[tuple[int, int, int], tuple[float, float]] = {}
        for k in range(0, len(busy), 512):
            part = busy[k : k + 512]
            present = np.zeros((len(part), len(scanner.vocabulary)), np.float64)
            for i, (*_, a, b) in enumerate(part):
                present[i, gram[a:b]] = 1
            p = scanner.probabilities(present)
            for i, t in zip(*(x.tolist() for x in np.nonzero(present @ sentences >= scanner.least_likeness - 1e-9)), strict=True):
                (begins, ends, m, n, a, b), family = part[i], owner[t]
                c, d = np.searchsorted(at, [max(m, begins - PARAGRAPH), min(n, ends + PARAGRAPH)])
                around = spans(at[c:d], gram[c:d], t)
                for x, y in around:
                    if (x, y, family) not in seen:
                        here = np.zeros((1, len(scanner.vocabulary)))
                        here[0, gram[slice(*np.searchsorted(at, [x, y]))]] = 1
                        q = scanner.probabilities(here)[0]
                        seen[x, y, family] = (float(q[family]) if q.argmax() == family else 0.0, scanner.likeness(family, here[0]))
                if not around and p[i].argmax() == family:  # its words lie too far apart for one place
                    seen[begins, ends, family] = (float(p[i, family]), scanner.likeness(family, present[i]))
        taken: dict[int, list[tuple[int, int]]] = {}
        for (x, y, family), (score, likeness) in sorted(seen.items(), key=lambda z: (-z[1][0], -z[1][1], z[0])):
            others = taken.setdefault(family, [])
            k = bisect(others, (x, y))
            free = (k == 0 or others[k - 1][1] <= x) and (k == len(others) or others[k][0] >= y)
            if score >= scanner.least_score and likeness >= scanner.least_likeness and free:
                others.insert(k, (x, y))
                doc = int(np.searchsorted(begin, x, "right") - 1)
                out[doc].setdefault((int(line[x] - before[doc]), family), (round(score, 6), x - int(begin[doc]), round(likeness, 6)))
        return [[{"line": n, "word": w, "family": FAMILIES[f], "score": s, "likeness": like} for (n, f), (s, w, like) in sorted(own.items())] for own in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for part in by_bytes(batch, at, 1_000_000):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found(part.column(at).to_pylist()), arrow)], names=schema.names)

    return docs.select(*[F.col(f"`{f.name}`") for f in keep]).mapInArrow(tidy(run), schema)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, fit(docs))
    each = F.transform("licenses", lambda x: F.concat_ws(":", x["line"].cast("string"), x["family"], F.format_string("%.3f", x["score"]), F.format_string("%.3f", x["likeness"])))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_found"), F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["family"]))), ",").alias("families"), F.array_join(each, ",").alias("findings"))
