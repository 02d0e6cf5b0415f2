"""Hierarchical multi-length packing of tokenized documents."""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from linkwright.llm.shared import by_bytes, tidy

TIERS = (256, 512, 1024, 2048, 4096)
#: Tokens that one task holds and packs at a time, tokens of one optimizer step, chunks of text whose ids a worker remembers.
BLOCK_TOKENS, STEP_TOKENS, MEMO = 1_000_000, 65_536, 250_000


#: Texts with a sign from here on, with an apostrophe, a special token's brackets or an odd blank are split at blanks only.
#: In all others nothing composes, each letter has one lower-case letter, and pre-tokens end where other signs begin and end.
ODD = r"[^\x00-\x{2FF}]|[\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{130}']|<\|"
SIGNS = r"([^\pL\pN\s]+)"


class Memo:
    """The last `most` to twice as many entries that were read: what a full generation holds goes only if unread in the next."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get_all(self, keys: list[str], make: Callable[[list[str]], Iterable[bytes]]) -> list[bytes]:
        """The keys' values; make() gives those of keys that aren't held."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        values = list(map(young.get, keys))
        gone = [i for i, v in enumerate(values) if v is None]
        for i in gone:
            values[i] = old.get(keys[i])
        new = [i for i in gone if values[i] is None]
        for i, v in zip(new, make([keys[i] for i in new]), strict=True):
            values[i] = v
        for i in gone:
            young[keys[i]] = values[i]
        return values


class WordEncoder:
    """ids of whole texts from a tokenizer that lower-cases and splits texts at blanks and where signs that are neither
    letters nor digits begin and end, so that a text's ids are its chunks' ids in a row. Each chunk is encoded once and
    remembered (up to twice MEMO of them); encode() equals the tokenizer on the whole texts."""

    def __init__(self, definition: bytes, memo: int = MEMO):
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_buffer(definition), Memo(memo)
        self.as_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def _ids(self, chunks: list[str]) -> list[bytes]:
        as_bytes = self.as_bytes
        return [b"".join([as_bytes[i] for i in e.ids]) for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty) in a row, and where each text's begin and the last one's end."""
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, ODD)
        plain = pc.replace_substring_regex(pc.utf8_lower(pc.if_else(odd, "", texts)), SIGNS, r" \1 ")
        lists = pc.split_pattern(pc.replace_substring_regex(pc.if_else(odd, texts, plain), r"[\n\t\r]", " "), " ")
        coded = lists.values.dictionary_encode()
        each = self.known.get_all(coded.dictionary.to_pylist(), self._ids)
        size = np.fromiter(map(len, each), np.int32, len(each)) // 4
        begin, word = np.cumsum(size, dtype=np.int32) - size, coded.indices.to_numpy()
        n = size[word]
        ends = np.cumsum(n, dtype=np.int32)
        at = np.repeat(begin[word] - (ends - n), n)
        at += np.arange(len(at), dtype=np.int32)
        ids = np.frombuffer(b"".join(each), "<u4")[at]
        return ids, np.append(0, ends)[lists.offsets.to_numpy()]


@lru_cache(1)
def encoder_of(definition: bytes, memo: int = MEMO) -> WordEncoder:
    """A Python worker's encoder, which its later tasks find warm: to drop and load one anew leaves some 20 MB each time."""
    return WordEncoder(definition, memo)


def pack_block(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences (tier, pieces (document, start, length)) that hold every token of the block once.

    Whole windows of the longest tier are cut off first. Then the longest fragment left opens a window of the shortest
    tier that holds it, and its gap is filled from shorter tiers: the longest fragment that fits, again and again, and
    at last the head of a longer one, whose rest goes back to the tier of its new length. Only the block's very last
    window can stay open; it is split at powers of two, so no sequence needs padding.
    """
    top, out, pool = tiers[-1], [], []
    for doc, n in enumerate(lengths):
        whole = n - n % top
        out += [(top, [(doc, at, top)]) for at in range(0, whole, top)]
        if n > whole:
            pool.append((n - whole, doc, whole))
    pool.sort()
    while pool:
        n, doc, start = pool.pop()
        window = next(t for t in tiers if t >= n)
        pieces, gap = [(doc, start, n)], window - n
        while gap and pool:
            at = bisect_right(pool, (gap, float("inf"), 0)) - 1
            if at >= 0:
                n, doc, start = pool.pop(at)
            else:
                rest, doc, start = pool.pop(0)
                n = gap
                insort(pool, (rest - n, doc, start + n))
            pieces.append((doc, start, n))
            gap -= n
        out += [(window, pieces)] if not gap else split_tail(pieces)
    return out


def split_tail(pieces: list[tuple[int, int, int]]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """An open window's pieces as sequences whose lengths are falling powers of two."""
    total, out, queue = sum(n for _, _, n in pieces), [], list(reversed(pieces))
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            room, own = 1 << bit, []
            while room:
                doc, start, n = queue.pop()
                own.append((doc, start, min(n, room)))
                if n > room:
                    queue.append((doc, start + room, n - room))
                room -= own[-1][2]
            out.append((1 << bit, own))
    return out


def balance(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group for each sequence: the longest first, each to the group with the fewest tokens so far."""
    heap = [(0, g) for g in range(max(1, round(sum(sizes) / step_tokens)))]
    group = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, g = heap[0]
        heapq.heapreplace(heap, (load + sizes[i], g))
        group[i] = g
    return group


def pack(docs: DataFrame, tokenizer: bytes, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, tiers: tuple[int, ...] = TIERS, block_tokens: int = BLOCK_TOKENS, step_tokens: int = STEP_TOKENS, slice_bytes: int = 6_000_000, memo: int = MEMO) -> DataFrame:
    """Pieces of all docs, packed into sequences of at most max(tiers) tokens.

    tokenizer: the bytes of a tokenizers file (sent once to each executor; a few MB whatever the corpus). A null or
    empty text is the end id alone. Rows that repeat an id are packed each on its own. Only id_col and text_col are
    read, so other columns can't clash. An empty table gives no pieces.

    Each task tokenizes and packs its own rows in blocks of block_tokens and emits as it goes: no shuffle, and memory
    that doesn't depend on the input (slice_bytes of text at a time, and up to twice memo remembered chunks, which
    workers keep for later tasks). A retried task over the same input split gives the same pieces and ids.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(tokenizer)
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)] + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")])
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = encoder_of(sent.value, memo), TaskContext.get().partitionId() << 32
        ids: list = []
        held: list[bytes] = []
        size = sequences = groups = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequences, groups
            lengths = [len(x) // 4 for x in held]
            packed = pack_block(lengths, tiers)
            steps = balance([sum(p[2] for p in pieces) for _, pieces in packed], step_tokens)
            rows: list[tuple] = []
            for (tier, pieces), step in zip(packed, steps, strict=True):
                offset = 0
                for doc, start, n in pieces:
                    crc = zlib.crc32(memoryview(held[doc])[4 * start : 4 * (start + n)])
                    rows.append((ids[doc], start, n, crc, lengths[doc], task + sequences, offset, tier, task + groups + step))
                    offset += n
                sequences += 1
            groups += max(steps, default=-1) + 1
            ids.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), [id_type] + [pa.int64()] * 8, strict=True)], names=schema.names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for part in by_bytes(batch, 1, slice_bytes):
                flat, begin = encoder.encode(part.column(1))
                for k, i in enumerate(part.column(0).to_pylist()):
                    ids.append(i)
                    held.append(flat[begin[k] : begin[k + 1]].tobytes() + end)
                    size += len(held[-1]) // 4
                    if size >= block_tokens:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    return docs.select(id_col, text_col).mapInArrow(tidy(run), schema)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    with open(path("word_bpe_49k.json"), "rb") as f:
        definition = f.read()
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), definition)
