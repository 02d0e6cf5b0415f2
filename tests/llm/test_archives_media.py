"""Archives and media columns: exact round trips, both byte orders, every codec, and edge cases."""

import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkwright.llm import tiff, warc
from linkwright.llm.shared import new_path

PAGES = "page_id long, url string, html string, id string, digest string, original string"


def run(spark, rows):
    path = new_path(spark, "t")
    df = spark.createDataFrame([(*r, "i", "d", "o") for r in rows], PAGES)
    warc.write_archives(df, path, records_per_file=3)
    return warc.resolve_records(warc.read_archives(spark, path)).collect()


def test_revisits(spark):
    big, tricky = "é" * 60, "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "y" * 100
    rows = [(5, "u5", big), (3, "u3\r\nEvil: 1", big), (9, None, big), (1, "u", "short"), (2, "u", "short"), (7, "u", None), (8, "u", ""), (10, "u", tricky), (11, "u", tricky), (None, "n", big), (3, "u3", big), (12, "u", "z" * 300_000)]
    got = sorted(((int(r.page_id) if r.page_id else -1, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in run(spark, rows)), key=str)
    want = []
    for p, _, h in rows:
        h = (h or "").encode()
        same = [q for q, _, x in rows if (x or "").encode() == h and q is not None]
        again = len(h) >= 100 and p is not None and min(same) < p
        want.append((-1 if p is None else p, "revisit" if again else "response", str(min(same)) if again else None, len(h), hashlib.sha256(h).hexdigest()))
    assert got == sorted(want, key=str)


def test_no_pages(spark):
    path = new_path(spark, "t")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.resolve_records(warc.read_archives(spark, path)).count() == 0


def test_damaged_archive():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))


@given(st.binary(max_size=700).map(lambda b: b + b[:50] * 5))
@settings(max_examples=60, deadline=None)
def test_codecs(data):
    assert tiff.unpackbits(tiff.packbits(data)) == data
    assert tiff.unlzw(tiff.lzw(data)) == data


def test_lzw_clears_its_full_table():
    data = np.random.default_rng(1).integers(0, 256, 30_000).astype(np.uint8).tobytes()
    assert tiff.unlzw(tiff.lzw(data)) == data


@pytest.mark.parametrize("codec", tiff.ENCODE)
@pytest.mark.parametrize("predictor", (1, 2))
@pytest.mark.parametrize("tile", (0, 48))
def test_tiff_round_trip(codec, predictor, tile):
    payload = (b"some text, " * 400)[: 64 * 50]
    layout = tiff.Layout(page_rows=20, strip_rows=16, tile_width=tile, codec=codec, predictor=predictor)
    found = list(tiff.read_tiff(tiff.write_tiff(payload, layout, "bytes=7")))
    assert [p.height for p in found] == [20, 20, 10] and found[0].note == "bytes=7" and found[0].tiled == bool(tile)
    assert b"".join(p.samples.tobytes() for p in found) == payload


def test_big_endian_rgb():
    pixels = bytes(range(24))  # 4 x 2 pixels of three samples
    entries = [(256, 3, 4), (257, 3, 2), (258, 3, 8), (259, 3, 1), (273, 4, 8), (277, 3, 3), (278, 3, 2), (279, 4, 24)]
    head = b"MM\0*" + struct.pack(">I", 8 + len(pixels))
    ifd = struct.pack(">H", len(entries)) + b"".join(struct.pack(">HHI", t, k, 1) + (struct.pack(">HH", v, 0) if k == 3 else struct.pack(">I", v)) for t, k, v in entries)
    (page,) = tiff.read_tiff(head + pixels + ifd + b"\0\0\0\0")
    assert page.samples.shape == (2, 4, 3) and page.samples.tobytes() == pixels


def test_pages_of_texts(spark):
    texts = ["", None, "a", "é" * 32, "x" * 64, "long " * 40_000, "a"]
    docs = spark.createDataFrame([(i, x, "m", "p", 1.0) for i, x in enumerate(texts)] + [(None, "null id", "m", "p", 1.0)], "doc_id long, text string, media string, page string, mean double")
    rows = tiff.pages(tiff.store(docs), samples=True).collect()
    for i, x in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.page)
        raw = (x or "").encode()
        padded = raw.ljust(max(1, -(-len(raw) // 64)) * 64, b"\0")
        assert b"".join(bytes(r.samples) for r in own) == padded and len(own) == own[0].pages
        last = own[-1]
        assert (last.payload_bytes, last.payload_sha256, last.tail_crc32, last.note) == (len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]), f"bytes={len(raw)}")
    assert tiff.pages(tiff.store(docs.limit(0))).count() == 0


def test_unreadable_files(spark):
    whole = tiff.write_tiff(b"q" * 640)
    media = spark.createDataFrame([(1, None), (2, b"GIF89a"), (3, whole[:40]), (4, whole)], "doc_id int, media binary")
    got = {r.doc_id: r.error for r in tiff.pages(media).collect()}
    assert got[1] == "null" and got[2] and got[3] and got[4] is None
