"""Quality classifier: attention-based multiple-instance learning over the passages of a document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwright.llm.shared import by_bytes, forget, materialize, tidy

PASSAGE_WORDS = 64
#: Bytes of text that a task encodes at a time.
SLICE = 250_000
#: Dimensions to which the n-grams of each kind are hashed: shapes of words (n up to 3), lower-cased words (n up to 2), and
#: three bytes in a row of a word between its borders.
SHAPE_DIMS, WORD_DIMS, PIECE_DIMS = 192, 192, 128
DIMS = SHAPE_DIMS + WORD_DIMS + PIECE_DIMS
SPACE = b" \t\n\x0b\x0c\r"
#: What n-gram hashes are multiplied by, for the first, second and third word, and what marks a word that one of the two
#: before it equals.
PLACES, REPEAT = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), 0x5851F42D4C957F2D

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE)] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: The class of a byte in a word's shape: lower-case letters and all beyond ASCII, upper-case letters, digits, signs each.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123], _CLASS[128:], _CLASS[65:91], _CLASS[48:58] = 97, 97, 65, 48
_RANDOM = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def encode_passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts (255 at most) of the hashed n-grams of every passage (PASSAGE_WORDS words in a row) of every whole text, and
    the text's index of each; a text without words is one passage of zeros. An n-gram lies within its passage. A shape is
    the word's byte classes, runs of one class as one, and whether the word is that before it or the one before that.
    Nothing about the document as a whole is in a passage. Vectorized over the bytes of all texts together."""
    raw = [(x or "").encode("utf-8", "replace") for x in texts]
    a = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) + 1 for x in raw])])
    solid = ~_IS_SPACE[a]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid])))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros((len(texts), DIMS), np.uint8), np.arange(len(texts))
    doc = np.searchsorted(offsets, starts, "right") - 1
    nth = np.arange(len(starts)) - np.searchsorted(doc, np.arange(len(texts)))[doc]
    new = nth % PASSAGE_WORDS == 0
    passage = np.cumsum(new) - 1
    owner, count = doc[new], int(passage[-1]) + 1
    word_of = np.cumsum(np.bincount(starts, minlength=len(a))) - 1  # of each byte; only those of words are used

    def hashed(values: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The sum of each word's values, each times an odd number of its place; blanks' values are 0."""
        c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * (2 * place.astype(np.uint64) + np.uint64(1)), dtype=np.uint64)])
        return _finish(c[ends] - c[starts])

    folded, kind = _FOLD[a], _CLASS[a]
    word = hashed(_RANDOM[folded] * solid, np.arange(len(a)) - starts[word_of])
    turn = solid.copy()
    turn[1:] &= (kind[1:] != kind[:-1]) | ~solid[:-1]
    turns = np.cumsum(turn)
    shape = hashed(_RANDOM[kind] * turn, turns - turns[starts][word_of])
    again = np.zeros(len(word), bool)
    for d in (1, 2):
        again[d:] |= (word[d:] == word[:-d]) & (passage[d:] == passage[:-d])
    shape = shape + again * np.uint64(REPEAT)
    bins = []

    def grams(each: np.ndarray, most: int, dims: int, low: int) -> None:
        total = np.zeros(len(each), np.uint64)
        for k in range(min(most, len(each))):
            m = len(each) - k
            total = total[:m] + each[k:] * np.uint64(PLACES[k])
            whole = passage[k:] == passage[:m]
            bins.append(passage[:m][whole] * DIMS + low + (_finish(total[whole]) % np.uint64(dims)).astype(np.int64))

    grams(shape, 3, SHAPE_DIMS, 0)
    grams(word, 2, WORD_DIMS, SHAPE_DIMS)
    at = np.flatnonzero(solid)
    code = np.where(solid, folded, 0).astype(np.uint32)
    before, after = np.where(at > 0, code[at - 1], 0), code[at + 1]  # the last byte is a line feed
    piece = (before * np.uint32(0x9E3779B1) ^ code[at] * np.uint32(0x85EBCA77) ^ after * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    bins.append(passage[word_of[at]] * DIMS + SHAPE_DIMS + WORD_DIMS + (piece >> np.uint32(16)).astype(np.int64) % PIECE_DIMS)
    out = np.minimum(np.bincount(np.concatenate(bins), minlength=count * DIMS), 255).astype(np.uint8).reshape(count, DIMS)
    if bare := sorted(set(range(len(texts))) - set(owner.tolist())):
        out, owner = np.concatenate([out, np.zeros((len(bare), DIMS), np.uint8)]), np.concatenate([owner, bare])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, owner


def _roots(counts: np.ndarray) -> np.ndarray:
    """Square roots of each kind's shares: what the encoder's first layer reads."""
    x = counts.astype(np.float32)
    low = 0
    for dims in (SHAPE_DIMS, WORD_DIMS, PIECE_DIMS):
        part = x[:, low : low + dims]
        part /= np.maximum(part.sum(1, keepdims=True), 1)
        low += dims
    return np.sqrt(x)


@dataclass
class Model:
    """h = tanh(x W + b), x the roots of a passage's n-gram shares; attention a = softmax over a document's passages of
    w (tanh(h V) * sigmoid(h U)); score = sigmoid(c (sum a h) + d)."""

    p: dict[str, np.ndarray]

    def score(self, f: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
        starts = np.searchsorted(owner, np.arange(docs))
        y = _forward(self.p, _roots(f).astype(np.float64), starts, np.diff(np.append(starts, len(f))))["y"]
        return np.round(y, 9)  # beyond that a sum's order shows, which depends on the slice


def _forward(p: dict, x: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> dict:
    s = {"h": np.tanh(x @ p["W"] + p["b"])}
    s["t"], s["g"] = np.tanh(s["h"] @ p["V"]), 1 / (1 + np.exp(-(s["h"] @ p["U"])))
    e = (s["t"] * s["g"]) @ p["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
    s["a"] = e / np.repeat(np.add.reduceat(e, starts), counts)
    s["z"] = np.add.reduceat(s["a"][:, None] * s["h"], starts)
    s["y"] = 1 / (1 + np.exp(-np.clip(s["z"] @ p["c"] + p["d"], -30, 30)))
    return s


def train(f: np.ndarray, owner: np.ndarray, labels: np.ndarray, *, hidden: int = 24, gate: int = 12, epochs: int = 20, batch: int = 128, rate: float = 0.01, decay: float = 1e-4, seed: int = 0) -> Model:
    """Fit encoder, gated attention and output together by Adam on the documents' labels. Deterministic."""
    rng = np.random.default_rng(seed)
    starts = np.searchsorted(owner, np.arange(len(labels)))
    counts = np.diff(np.append(starts, len(f)))
    k = f.shape[1]
    p = {"W": rng.normal(0, 1, (k, hidden)), "b": np.zeros(hidden), "V": rng.normal(0, hidden**-0.5, (hidden, gate)), "U": rng.normal(0, hidden**-0.5, (hidden, gate)), "w": rng.normal(0, gate**-0.5, gate), "c": rng.normal(0, hidden**-0.5, hidden), "d": np.zeros(())}
    m, v, step = {n: np.zeros_like(q) for n, q in p.items()}, {n: np.zeros_like(q) for n, q in p.items()}, 0
    average = {n: np.zeros_like(q) for n, q in p.items()}
    tail = 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            docs = order[at : at + batch]
            n = counts[docs]
            begin = np.concatenate([[0], np.cumsum(n)[:-1]])
            rows = np.repeat(starts[docs] - begin, n) + np.arange(n.sum())
            own = _roots(f[rows]).astype(np.float64)
            s = _forward(p, own, begin, n)
            dy = (s["y"] - labels[docs]) / len(docs)
            dz = np.repeat(dy[:, None] * p["c"], n, 0)
            da = (dz * s["h"]).sum(1)
            de = s["a"] * (da - np.repeat(np.add.reduceat(s["a"] * da, begin), n))
            dq = de[:, None] * p["w"]
            dt, dg = dq * s["g"] * (1 - s["t"] ** 2), dq * s["t"] * s["g"] * (1 - s["g"])
            dh = (s["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - s["h"] ** 2)
            grads = {"W": own.T @ dh, "b": dh.sum(0), "V": s["h"].T @ dt, "U": s["h"].T @ dg, "w": (s["t"] * s["g"]).T @ de, "c": s["z"].T @ dy, "d": dy.sum()}
            step += 1
            now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for name, g in grads.items():
                g = g + decay * p[name]
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.999 * v[name] + 0.001 * g * g
                p[name] = p[name] - now * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
            if epoch >= epochs * 3 // 4:
                tail += 1
                for name in p:
                    average[name] += (p[name] - average[name]) / tail
    return Model(average)


def held_out(id_col: str) -> Column:
    """Whether a row is kept from training: crc32 of its id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 6000, most_passages: int = 200_000, seed: int = 0, **training) -> Model | None:
    """A model from at most `sample` labelled documents that are not held out (a documented bound: those with the
    smallest hash of their id), or None if no labelled document is there. Null labels and ids are left out, and ids whose labels contradict each other;
    an id that the labels repeat counts once.
    A document trains with all of its passages or, where those of the documents before it (in the same order) and its own
    are more than most_passages, not at all; the first always does. Encoding runs on the executors; the driver gets
    passages' counts only (DIMS bytes each)."""
    rated = labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(F.col(id_col).alias("lid")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("last")).where("y = last")
    picked = rated.orderBy(F.xxhash64("lid", F.lit(seed)), "lid").limit(sample)
    rows = docs.select(F.col(f"`{id_col}`").alias("lid"), F.col(f"`{text_col}`").alias("t")).join(F.broadcast(picked), "lid").select("lid", "t", F.col("y").cast("double").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, 1, SLICE):
                f, owner = encode_passages(part.column(1).to_pylist())
                own = [x.tobytes() for x in np.split(f, np.searchsorted(owner, np.arange(1, part.num_rows)))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.binary()), part.column(2)], names=["lid", "f", "y"])

    encoded = rows.mapInArrow(tidy(run), T.StructType([T.StructField("lid", rows.schema["lid"].dataType), T.StructField("f", T.BinaryType()), T.StructField("y", T.DoubleType())]))
    encoded = materialize(encoded.withColumn("h", F.xxhash64("lid", F.lit(seed))), "encoded")
    sizes = sorted(encoded.select("h", F.length("f").alias("n")).collect())
    if not sizes:
        return None
    total = np.cumsum([r.n for r in sizes]) // DIMS
    beyond = [r.h for r, n in zip(sizes[1:], total[1:], strict=True) if n > most_passages]
    got = (encoded.where((F.col("h") < beyond[0]) | (F.col("h") == sizes[0].h)) if beyond else encoded).collect()
    forget(encoded)
    got.sort(key=lambda r: (str(r.lid), bytes(r.f)))
    each = [np.frombuffer(r.f, np.uint8).reshape(-1, DIMS) for r in got]
    return train(np.concatenate(each), np.repeat(np.arange(len(got)), [len(e) for e in each]), np.array([r.y for r in got]), seed=seed, **training)


def score(docs: DataFrame, model: Model | None, *, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """Docs with out_col, a double from 0 to 1: higher, likelier of label 1. Every passage of the whole text counts.

    Equal texts get equal scores; a null or empty text is one passage of zeros. Without a model every score is 0.5. An
    input column named out_col is replaced. One narrow pass; the model (some 100 KB) goes with the task.
    """
    schema = T.StructType([f for f in docs.schema.fields if f.name != out_col] + [T.StructField(out_col, T.DoubleType())])
    keep = [c for c in docs.columns if c != out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for part in by_bytes(batch, at, SLICE):
                if model is None:
                    y = np.full(part.num_rows, 0.5)
                else:
                    f, owner = encode_passages(part.column(at).to_pylist())
                    y = model.score(f, owner, part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(y, pa.float64())], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(tidy(run), schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
