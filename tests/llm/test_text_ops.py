"""Packing, personal data and line dedup against brute force, and their edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from linkwright.llm import line_dedup, packing, pii

DOCS = "doc_id long, text string, kind string, n_lines string, r string, id string, start string, pii string"


def docs(spark, texts):
    return spark.createDataFrame([(i, x, "k", "l", "r", "i", "s", "p") for i, x in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def tokenizer():
    from public_tokenizers import path

    return open(path("word_bpe_49k.json"), "rb").read()


TEXTS = ["", None, "One two three.", "ÀÉ ıİ don't IT'S ﬁ é\n\t\x1c\x85x 12345 <|endoftext|> <|ENDOFTEXT|>", "word " * 9000, "One two three."] + [f"text {i} " * (i % 90 + 1) for i in range(300)]


def test_pack_round_trip(spark, tokenizer):
    from tokenizers import Tokenizer

    t = Tokenizer.from_buffer(tokenizer)
    rows = packing.pack(docs(spark, TEXTS).repartition(3), tokenizer, block_tokens=20_000, step_tokens=8192).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, x in enumerate(TEXTS):
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            part = ids[at : at + r.length]
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(b"".join(v.to_bytes(4, "little") for v in part))
            at += r.length
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.step_group == own[0].step_group
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0  # nothing is padded


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab'sS tT.,!9½²ªß\u0301\u212b\x1c\x85\xa0\u2003İΣςñ_\n\t<|"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=8))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_whole_text(tokenizer, texts):
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_buffer(tokenizer), packing.encoder_of(tokenizer)
    texts = [*texts, "".join(texts), "it's don't 'S we'LL <|endoftext|>'s 1'2' '" + "'".join(texts)]
    ids, at = e.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


@given(st.lists(st.integers(1, 9000), max_size=40))
@settings(max_examples=60, deadline=None)
def test_pack_block_holds_each_token_once(lengths):
    seen = Counter()
    for _, pieces in packing.pack_block(lengths):
        total = sum(n for _, _, n in pieces)
        assert total <= 4096 and total & (total - 1) == 0
        for doc, start, n in pieces:
            seen.update((doc, i) for i in range(start, start + n))
    assert seen == Counter((d, i) for d, n in enumerate(lengths) for i in range(n))


def test_balance():
    groups = packing.balance([4096] * 30 + [256] * 32, 16384)
    load = Counter()
    for g, n in zip(groups, [4096] * 30 + [256] * 32, strict=True):
        load[g] += n
    assert max(load.values()) - min(load.values()) <= 4096


def test_pack_empty(spark, tokenizer):
    assert packing.pack(docs(spark, ["x"]).limit(0), tokenizer).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    d = [int(c) for c in reversed(re.sub("[^0-9]", "", s))]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def good(kind, s):
    n = len(re.sub("[^0-9]", "", s))
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".") if kind == "ip"), "card": 14 <= n <= 19 and luhn(s), "phone": 10 <= n <= 15}[kind]


def brute(text):
    found = [(m.start(), i, k, m.end()) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if good(k, m[0])]
    return [(k, s, e) for s, _, k, e in sorted(found)]


PII = [
    None, "", "a@b.co_x@y.com,z@q", "mail ü.a@b-c.d.e.f é 10.0.0.256 1.2.3.4.5.6.7.8 001.02.3.0004 999.1.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 +1 (578) 555-6437 4918187128635271 +12 +1.2.3.4.5.6.7.8.9.0",
    "1" * 6000, "7 " * 7000, "1." * 5000, "@" * 3000, "a" * 20000, "x@y.z" * 2000, "+1" * 3000, "😀 " * 50 + "call +44 20 7946 0958 now",
    "IBAN GB82 WEST 1234 5698 7654 32 bank, GB82WEST12345698765433; ssn 123-45-6789 and 123-45-6789x",
]


def test_pii_base_spans(spark):
    rows = pii.find_pii(docs(spark, PII)).collect()
    assert len(rows) == len(PII)
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.pii if s.kind in BASE] == brute(r.text), r.text and r.text[:60]
    last = {(s.kind, s.start): s.score for s in rows[-1].pii}
    assert ("iban", 5) in last and last["iban", 5] == 1.0 and sum(k == "iban" for k, _ in last) == 1


@given(st.text(alphabet="01234 5678.9-+()@aZ_\né😀", max_size=120))
@settings(max_examples=12, deadline=None)
def test_pii_random(spark, text):
    row = pii.find_pii(spark.createDataFrame([Row(doc_id=1, text=text)])).first()
    assert [(s.kind, s.start, s.end) for s in row.pii if s.kind in BASE] == brute(text)


def test_pii_uses_no_python(spark):
    plan = pii.find_pii(docs(spark, ["x"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan.split("== Physical Plan ==")[1]


def test_lines(spark):
    texts = [None, "", "A line \nkeep %d", "\n\n", "a LINE\x0b\nonly", "É\né"]
    rows = spark.createDataFrame([(i, (texts[i % 6] or "") % i if i % 6 == 2 else texts[i % 6], "k", "l", "r", "i", "s", "p") for i in range(30)] + [(None, "A line\nnull id", "k", "l", "r", "i", "s", "p")] * 2, DOCS)
    got = line_dedup.drop_repeated_lines(rows, min_docs=10).collect()
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(line_dedup.UPPER, line_dedup.LOWER))
    count = defaultdict(set)
    for r in rows.collect():
        for x in (r.text or "").split("\n"):
            count[key(x)].add(r.doc_id)
    want = Counter()
    for r in rows.collect():
        own = (r.text or "").split("\n")
        kept = [x for x in own if not key(x) or len(count[key(x)]) < 10]
        want[r.doc_id, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in got) == want
    assert got[0].kind == "k" and line_dedup.drop_repeated_lines(rows.limit(0)).count() == 0
