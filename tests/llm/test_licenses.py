"""License scans: held-out accuracy on notices in noise, template confirmation, decoys, edge cases."""

import re
from collections import Counter

import numpy as np
import pytest

from linkwright.llm import licenses


@pytest.fixture(scope="module")
def scanner():
    return licenses.train(Counter("the river went by an old mill and then under some trees near the hill".split()))


def test_finds_notices_and_leaves_text_alone(spark, scanner):
    rng = np.random.default_rng(5)
    noise = lambda n: " ".join("".join(rng.choice(list("aeioust"), 5)) for _ in range(n))
    rows, want = [], {}
    for name, sentences in licenses.TEMPLATES.items():
        for k, s in enumerate(sentences):
            i = len(rows)
            rows.append((i, f"{noise(20)}\n{s.upper() if k else s}\n{noise(5)}" if i % 2 else f"{noise(400)} {s} {noise(300)}", "L"))
            want[i] = name
    clean = [None, "", "\n\n", noise(3000), *licenses.DECOYS, "the license " * 3000, "public version general under the"]
    rows += [(1000 + k, t, "L") for k, t in enumerate(clean)] + [(None, "Released under the MIT License.", "L")] * 2
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, licenses string").repartition(3), scanner).collect()
    assert len(got) == len(rows)
    right = 0
    for r in got:
        if r.doc_id in want:
            right += want[r.doc_id] in {f.family for f in r.licenses}
            assert all(f.likeness >= 0.6 and f.score >= 0.5 for f in r.licenses)
        elif r.doc_id is None:
            assert [f.family for f in r.licenses] == ["mit"]
        else:
            assert r.licenses == []
    assert right == len(want)
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string"), scanner).count() == 0


def test_wrapped_and_dual_notices(spark, scanner):
    import textwrap

    rows, want = [], {}
    for name, own in licenses.TEMPLATES.items():
        for s in own:
            for wide, mark in ((100, ""), (72, ""), (40, "# "), (32, " * ")):
                text = "\n".join(mark + x for x in ["Copyright of somebody", *textwrap.wrap(s, wide, break_on_hyphens=False), "the river went by an old mill"])
                rows.append((len(rows), f"old trees\n\n{text}\n"))
                want[len(rows) - 1] = [name]
    for text, names in (
        ("Released under the MIT License. Licensed under CC BY 4.0.", ["cc-by-4.0", "mit"]),
        ("Released under the MIT License.\nLicensed under the Apache License, Version 2.0.", ["apache-2.0", "mit"]),
        ("Licensed under the BSD 3-Clause License. This work is licensed under the GNU General Public License, version 3.", ["bsd", "gpl-3.0"]),
        ("This work is licensed under a Creative\nCommons Attribution-ShareAlike 4.0\nInternational License.", ["cc-by-sa-4.0"]),
        ("Licensed under CC BY 4.0.\n" * 3, ["cc-by-4.0"] * 3),
        ("Released under\n\nthe MIT License.", []),
    ):
        rows.append((len(rows), text))
        want[len(rows) - 1] = names
    got = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), scanner).collect()}
    assert {i: sorted(f.family for f in x) for i, x in got.items()} == want
    assert all(rows[i][1].split("\n")[f.line].strip("#* ") for i, x in got.items() for f in x)


def test_unknown_is_calibrated(scanner):
    from linkwright.llm.words import hash_words

    rng = np.random.default_rng(9)
    notice = [w for s in licenses.TEMPLATES.values() for x in s for w in x.split()]
    texts = [" ".join(rng.choice(notice, 12)).encode() for _ in range(300)]
    words, line, begin = hash_words(texts)
    at, gram = scanner.features(words, line)
    present = np.zeros((300, len(scanner.vocabulary)))
    present[np.searchsorted(begin, at, "right") - 1, gram] = 1
    p = scanner.probabilities(present)
    assert abs(p[:, -1].mean() - (p.argmax(1) == len(licenses.TEMPLATES)).mean()) < 0.2
    assert sum(scanner.likeness(int(x.argmax()), q) >= 0.6 for x, q in zip(p, present, strict=True) if x.argmax() < len(licenses.TEMPLATES)) == 0


def test_against_plain_ngrams(spark, scanner):
    """Mutated, wrapped notices, one a document: found where, and only where, plain loops over word n-grams say so."""
    from linkwright.llm.words import hash_words

    def number(gram):
        """Place of an n-gram in the vocabulary, or None."""
        h = licenses._ngrams(hash_words([" ".join(gram).encode()])[0], np.zeros(len(gram), int))[0][len(gram) - 1, 0]
        k = int(np.searchsorted(scanner.vocabulary, h))
        return k if k < len(scanner.vocabulary) and scanner.vocabulary[k] == h else None

    def plain(text):
        words = [w[:-1] if len(w) > 1 and w.endswith(".") else w for w in re.findall(r"[0-9a-z+.\-\u0080-\U0010ffff]+", text.lower())]
        families = set()
        for name, sentences in licenses.TEMPLATES.items():
            for s in sentences:
                own = [w[:-1] if len(w) > 1 and w.endswith(".") else w for w in re.findall(r"[0-9a-z+.\-]+", s.lower())]
                grams = {tuple(own[i : i + 3]) for i in range(len(own) - 2)}
                best = (0, 0, 0, 0)
                for a in range(len(words)):
                    seen, last = set(), a
                    for i in range(a, min(len(words) - 2, a + len(grams) + 8)):
                        if tuple(words[i : i + 3]) in grams - seen:
                            seen.add(tuple(words[i : i + 3]))
                            last = i
                    best = max(best, (len(seen), a - last, a, last + 3))
                if best[0] < (0.6 - 1e-9) * len(grams):
                    continue
                known = {number(words[i : i + n]) for n in (1, 2, 3) for i in range(best[2], best[3]) if i + n <= len(words)} - {None}
                z = (sum(scanner.weights[k] for k in known) + scanner.weights[-1]) / scanner.temperature
                p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
                if licenses.FAMILIES[p.argmax()] == name and p.max() >= 0.5:
                    families.add(name)
        return families

    rng = np.random.default_rng(8)
    texts = []
    for sentences in licenses.TEMPLATES.values():
        for s in sentences:
            for drop in (0.0, 0.05, 0.1, 0.2, 0.35):
                words = [w for w in s.split() if rng.random() >= drop]
                around = rng.choice(["river", "mill", "trees", "hill"], 12).tolist()
                joined = around[:6] + words + around[6:]
                texts.append("".join(w + ("\n" if rng.random() < 0.15 else " ") for w in joined))
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), scanner).collect()
    want = [plain(t) for t in texts]
    assert [set(f.family for f in r.licenses) for r in sorted(got, key=lambda r: r.doc_id)] == want
    assert 0.5 * len(want) < sum(map(bool, want)) < len(want)
