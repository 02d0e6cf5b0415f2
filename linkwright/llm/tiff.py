"""Media columns: TIFF files of 8-bit samples, written from payloads and read back page by page."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwright.llm.shared import by_bytes, materialize, tidy

#: The format's tags, compression codes and field types (size and letter).
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, DESCRIPTION = 256, 257, 258, 259, 262, 270
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR, PREDICTOR = 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES = 322, 323, 324, 325
CODES = {"none": 1, "lzw": 5, "deflate": 8, "packbits": 32773}
OLD_DEFLATE = 32946
FIELDS = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i")}


def packbits(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        run = 1
        while i + run < n and run < 128 and data[i + run] == data[i]:
            run += 1
        if run > 1:
            out += bytes((257 - run, data[i]))
            i += run
            continue
        start = i
        while i < n and i - start < 128 and not (i + 1 < n and data[i] == data[i + 1]):
            i += 1
        out += bytes((i - start - 1,)) + data[start:i]
    return bytes(out)


def unpackbits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        elif n > 128:
            out += data[i + 1 : i + 2] * (257 - n)
            i += 2
        else:
            i += 1
    return bytes(out)


CLEAR, END, FIRST, LAST = 256, 257, 258, 4094


def lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first; the width grows one code early, as the format has it."""
    buffer = bits = 0
    out, table, width = bytearray(), {bytes((i,)): i for i in range(256)}, 9

    def put(code: int) -> None:
        nonlocal buffer, bits
        buffer, bits = buffer << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(buffer >> bits & 255)
        buffer &= (1 << bits) - 1

    put(CLEAR)
    following, held = FIRST, b""
    for i in range(len(data)):
        longer = held + data[i : i + 1]
        if longer in table:
            held = longer
            continue
        put(table[held])
        table[longer] = following
        following += 1
        if following > LAST:
            put(CLEAR)
            table, width, following = {bytes((j,)): j for j in range(256)}, 9, FIRST
        else:
            width = max(9, following.bit_length())
        held = data[i : i + 1]
    if held:
        put(table[held])
        following += 1
        width = min(12, max(9, following.bit_length()))
    put(END)
    if bits:
        out.append(buffer << (8 - bits) & 255)
    return bytes(out)


def unlzw(data: bytes) -> bytes:
    base = [bytes((i,)) for i in range(256)] + [b"", b""]
    out, table, width, buffer, bits, before = [], list(base), 9, 0, 0, b""
    for byte in data:
        buffer, bits = buffer << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = buffer >> bits
        buffer &= (1 << bits) - 1
        if code == END:
            break
        if code == CLEAR:
            table, width, before = list(base), 9, b""
            continue
        if code > len(table) or (code == len(table) and not before):
            raise ValueError("a code that no entry has")
        entry = table[code] if code < len(table) else before + before[:1]
        out.append(entry)
        if before:
            table.append(before + entry[:1])
        before = entry
        width = min(12, max(9, (len(table) + 1).bit_length()))
    return b"".join(out)


ENCODE = {"none": bytes, "packbits": packbits, "lzw": lzw, "deflate": lambda b: zlib.compress(b, 6)}
DECODE = {1: bytes, 5: unlzw, 8: zlib.decompress, OLD_DEFLATE: zlib.decompress, 32773: unpackbits}


@dataclass(frozen=True)
class Layout:
    """How payloads are stored: row width, rows to a page, rows to a strip (or tile height), tile width (0: strips)."""

    width: int = 64
    page_rows: int = 1024
    strip_rows: int = 256
    tile_width: int = 0
    codec: str = "deflate"
    predictor: int = 1


def write_tiff(payload: bytes, layout: Layout = Layout(), note: str = "") -> bytes:
    """A little-endian file of 8-bit grey pages that hold payload, whose length is a positive multiple of layout.width."""
    if not payload or len(payload) % layout.width:
        raise ValueError("the payload must be a positive multiple of the row width")
    rows = np.frombuffer(payload, np.uint8).reshape(-1, layout.width)
    out, link = bytearray(b"II*\0\0\0\0\0"), 4
    for at in range(0, len(rows), layout.page_rows):
        page = rows[at : at + layout.page_rows]
        across, down = layout.tile_width or layout.width, layout.strip_rows
        offsets, sizes = [], []
        for y in range(0, len(page), down):
            for x in range(0, layout.width, across):
                part = page[y : y + down, x : x + across]
                if layout.tile_width:
                    part = np.pad(part, ((0, down - part.shape[0]), (0, across - part.shape[1])))
                if layout.predictor == 2:
                    part = np.diff(part, axis=1, prepend=np.uint8(0))
                data = ENCODE[layout.codec](np.ascontiguousarray(part).tobytes())
                offsets.append(len(out))
                sizes.append(len(data))
                out += data
        tags = {WIDTH: (4, [layout.width]), HEIGHT: (4, [len(page)]), BITS: (3, [8]), COMPRESSION: (3, [CODES[layout.codec]]), PHOTOMETRIC: (3, [1]), SAMPLES: (3, [1]), PREDICTOR: (3, [layout.predictor])}
        if layout.tile_width:
            tags |= {TILE_WIDTH: (4, [across]), TILE_HEIGHT: (4, [down]), TILE_OFFSETS: (4, offsets), TILE_BYTES: (4, sizes)}
        else:
            tags |= {STRIP_OFFSETS: (4, offsets), ROWS_PER_STRIP: (4, [down]), STRIP_BYTES: (4, sizes)}
        if note and not at:
            tags[DESCRIPTION] = (2, note.encode() + b"\0")
        entries = []
        for tag, (kind, values) in sorted(tags.items()):
            raw = bytes(values) if kind == 2 else struct.pack(f"<{len(values)}{FIELDS[kind][1]}", *values)
            if len(raw) > 4:
                out += b"\0" * (len(out) % 2)
                place = struct.pack("<I", len(out))
                out += raw
            else:
                place = raw.ljust(4, b"\0")
            entries.append(struct.pack("<HHI", tag, kind, len(values)) + place)
        out += b"\0" * (len(out) % 2)
        out[link : link + 4] = struct.pack("<I", len(out))
        out += struct.pack("<H", len(entries)) + b"".join(entries)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


@dataclass
class Page:
    number: int
    width: int
    height: int
    compression: int
    predictor: int
    tiled: bool
    note: str
    samples: np.ndarray


def read_tiff(data: bytes) -> Iterator[Page]:
    """The pages of a file in either byte order, by its chain of image directories: 8-bit samples in strips or tiles."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if not order or struct.unpack_from(f"{order}H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at, seen, number = struct.unpack_from(f"{order}I", data, 4)[0], set(), 0
    while at:
        if at in seen:
            raise ValueError("the image directories form a ring")
        seen.add(at)
        count, tags = struct.unpack_from(f"{order}H", data, at)[0], {}
        for i in range(count):
            tag, kind, n = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * i)
            if kind not in FIELDS:
                continue
            size, letter = FIELDS[kind]
            place = at + 10 + 12 * i
            if size * n > 4:
                place = struct.unpack_from(f"{order}I", data, place)[0]
            tags[tag] = data[place : place + n].rstrip(b"\0") if kind == 2 else struct.unpack_from(f"{order}{n}{letter}", data, place)
        at = struct.unpack_from(f"{order}I", data, at + 2 + 12 * count)[0]
        one = lambda tag, other: tags.get(tag, (other,))[0]  # noqa: B023, E731
        width, height, spp, codec, predictor = one(WIDTH, 0), one(HEIGHT, 0), one(SAMPLES, 1), one(COMPRESSION, 1), one(PREDICTOR, 1)
        if set(tags.get(BITS, (1,))) != {8} or one(PLANAR, 1) != 1 or codec not in DECODE or predictor not in (1, 2):
            raise ValueError("only 8-bit interleaved samples, known codecs and the horizontal predictor are read")
        tiled = TILE_OFFSETS in tags
        across, down = (one(TILE_WIDTH, 0), one(TILE_HEIGHT, 0)) if tiled else (width, min(one(ROWS_PER_STRIP, height), height))
        image = np.empty((height, width, spp), np.uint8)
        boxes = [(y, x) for y in range(0, height, down) for x in range(0, width, across)]
        for (y, x), offset, n in zip(boxes, tags[TILE_OFFSETS if tiled else STRIP_OFFSETS], tags[TILE_BYTES if tiled else STRIP_BYTES], strict=True):
            rows = down if tiled else min(down, height - y)
            part = np.frombuffer(DECODE[codec](data[offset : offset + n]), np.uint8)[: rows * across * spp].reshape(rows, across, spp)
            if predictor == 2:
                part = np.cumsum(part, axis=1, dtype=np.uint8)
            image[y : y + rows, x : x + across] = part[: height - y, : width - x]
        yield Page(number, width, height, codec, predictor, tiled, bytes(tags.get(DESCRIPTION, b"")).decode(), image)
        number += 1


PAGE = "page int, pages int, width int, height int, compression int, predictor int, tiled boolean, note string, media_bytes long, media_sha256 string, payload_bytes long, payload_sha256 string, tail_crc32 long, mean double, entropy double, error string"


def store(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", layout: Layout = Layout()) -> DataFrame:
    """id_col and `media`: each text (null: empty) as UTF-8, padded with bytes 0 to a positive multiple of the row width, as a TIFF file."""
    schema = T.StructType([docs.schema[id_col], T.StructField("media", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, 1, 4_000_000):
                media = []
                for x in part.column(1).cast(pa.large_binary()).to_pylist():
                    x = x or b""
                    padded = max(1, -(-len(x) // layout.width)) * layout.width
                    media.append(write_tiff(x.ljust(padded, b"\0"), layout, f"bytes={len(x)}"))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(media, pa.binary())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(tidy(run), schema)


def pages(media: DataFrame, *, id_col: str = "doc_id", media_col: str = "media", samples: bool = False) -> DataFrame:
    """One row per page of every file: id_col and the columns of PAGE, with samples=True also `samples` (binary).

    note is the file's description. payload_bytes, payload_sha256, mean and entropy (bits) run over the file's samples up to and with the page, and
    tail_crc32 is of the last 64 of them, so a file's last page (page = pages - 1) tells of the whole file. A null or
    unreadable file is one row with `error` and no page. Equal files give equal rows. Files are read one at a time, in
    one narrow pass.
    """
    schema = T.StructType([media.schema[id_col], *T._parse_datatype_string(PAGE).fields, *[T.StructField("samples", T.BinaryType())] * samples])

    def file_rows(data: bytes | None) -> Iterator[tuple]:
        if data is None:
            yield (*[None] * 15, "null", *[None] * samples)
            return
        try:
            found = list(read_tiff(data))
        except (ValueError, KeyError, IndexError, struct.error, zlib.error) as e:
            yield (*[None] * 15, f"{type(e).__name__}: {e}"[:200], *[None] * samples)
            return
        digest, sha, size, tail, counts = hashlib.sha256(), hashlib.sha256(data).hexdigest(), 0, b"", np.zeros(256, np.int64)
        for p in found:
            raw = p.samples.tobytes()
            digest.update(raw)
            size, tail = size + len(raw), (tail + raw)[-64:]
            counts += np.bincount(p.samples.ravel(), minlength=256)
            share = counts[counts > 0] / size
            yield (p.number, len(found), p.width, p.height, p.compression, p.predictor, p.tiled, found[0].note, len(data), sha, size, digest.copy().hexdigest(), zlib.crc32(tail), float(counts @ np.arange(256) / size), float(-(share * np.log2(share)).sum()) + 0.0, None, *[raw] * samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0)
            kinds = [pa.int32()] * 6 + [pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.string()] + [pa.binary()] * samples
            for at in range(0, batch.num_rows, 200):
                rows, index = [], []
                for i, data in enumerate(batch.column(1).slice(at, 200).to_pylist(), at):
                    for row in file_rows(data):
                        rows.append(row)
                        index.append(i)
                yield pa.RecordBatch.from_arrays([own.take(pa.array(index, pa.int64())), *[pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]], names=schema.names)

    return media.select(id_col, media_col).mapInArrow(tidy(run), schema)


def op5_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = pages(materialize(store(docs), "media")).where("page = pages - 1")
    feature = F.format_string("pages=%d;width=%d;rows=%d;mean=%.4f;entropy=%.4f", "pages", "width", (F.col("payload_bytes") / F.col("width")).cast("long"), "mean", "entropy")
    n = F.regexp_extract("note", "bytes=([0-9]+)", 1).cast("long").alias("n_bytes")
    return last.select("doc_id", n, "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))
