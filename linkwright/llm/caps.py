"""Embedding near-dedup by spherical-cap filters: structured random product codes, list decoding, join on filters, verify."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.components import components
from linkwright.llm.shared import materialize

#: Vectors of a bucket that are compared at once; a larger bucket is dealt out as pairs of such blocks.
BLOCK = 2048


@dataclass(frozen=True)
class Code:
    """Filters are sums of one code word per half of the rotated space: words ** 2 directions, of which a vector is
    expected to exceed `hits` and gets `least` at any rate."""

    words: int
    hits: int = 20
    least: int = 10
    seed: int = 5

    @staticmethod
    def sized(vectors: int, dims: int, cosine: float, recall: float = 0.98, bucket: int = 256) -> Code:
        """As many filters as keep the mean bucket's size, of which a vector gets as many as a pair at `cosine` needs to
        share one with a probability of `recall`. Up to BLOCK vectors, or where no such number is found, one filter holds
        all: exact, in blocks."""
        if vectors <= BLOCK:
            return Code(words=1)
        for hits in HITS:
            code = Code(words=int(np.ceil(np.sqrt(max(256, vectors * hits / bucket)))), hits=hits, least=hits)
            found, error = shared(code, dims, cosine)
            if found - 2 * error >= recall:
                return code
        return Code(words=1)


@lru_cache(8)
def _code(code: Code, dims: int) -> tuple[np.ndarray, list[np.ndarray], float]:
    rng = np.random.default_rng(code.seed + dims)
    rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    halves = []
    for n in (dims - dims // 2, dims // 2):
        w = rng.normal(size=(code.words, n))
        halves.append(w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12) * np.sqrt(0.5))
    cut = NormalDist().inv_cdf(1 - min(0.5, code.hits / code.words**2)) / np.sqrt(dims)
    return rotation, halves, cut


def decode(unit: np.ndarray, code: Code) -> list[np.ndarray]:
    """For each unit vector (row) the sorted numbers of the filters that it exceeds: the better half's words are walked
    from the top, and of the other half's sorted words only those that still exceed the threshold are listed."""
    rotation, halves, cut = _code(code, unit.shape[1])
    turned = unit @ rotation
    first, second = turned[:, : halves[0].shape[1]] @ halves[0].T, turned[:, halves[0].shape[1] :] @ halves[1].T
    order = np.argsort(-second, axis=1)
    falling = -np.take_along_axis(second, order, 1)
    out = []
    for i in range(len(unit)):
        n = np.searchsorted(falling[i], first[i] - cut, "right")
        rows = np.repeat(np.arange(code.words), n)
        columns = order[i][np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        found = rows * code.words + columns
        if len(found) < code.least:
            k = min(code.least, code.words**2)
            a, b = np.argsort(-first[i])[:k], order[i][:k]
            sums = first[i][a][:, None] + second[i][b][None, :]
            best = np.argsort(-sums, axis=None)[:k]
            found = a[best // len(b)] * code.words + b[best % len(b)]
        out.append(np.sort(found))
    return out


#: Filters per vector that Code.sized tries.
HITS = (20, 28, 40, 56, 80, 112, 160, 224, 320)


@lru_cache(64)
def shared(code: Code, dims: int, cosine: float, pairs: int = 2000) -> tuple[float, float]:
    """The share of random pairs at exactly `cosine` with a common filter (the code's recall there; it is higher for nearer
    pairs), and its standard error. The rotation and the words are random, so it holds for any pair."""
    rng = np.random.default_rng(code.seed + 1)
    hit = 0
    for at in range(0, pairs, 250):
        n = min(250, pairs - at)
        a, b = rng.normal(size=(2, n, dims))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(1, keepdims=True) * a
        b = cosine * a + np.sqrt(max(0.0, 1 - cosine**2)) * b / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
        b /= np.linalg.norm(b, axis=1, keepdims=True)
        hit += sum(len(np.intersect1d(x, y, assume_unique=True)) > 0 for x, y in zip(decode(a, code), decode(b, code), strict=True))
    p = hit / pairs
    return p, float(np.sqrt(max(p * (1 - p), 1 / pairs) / pairs))


def _packed(x: np.ndarray) -> bytes:
    """The components in single precision where that loses nothing, else in double precision."""
    short = x.astype(np.float32)
    return (short if (short == x).all() else x).tobytes()


def _unpacked(packed: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(packed, np.float32 if len(packed) == 4 * dims else np.float64).astype(np.float64)


def _decoded(classes: DataFrame, codes: dict[int, Code]) -> DataFrame:
    wide = any(c.words**2 >= 2**31 for c in codes.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                vectors = [np.array(v, np.float64) for v in part.column(2).to_pylist()]
                filters: list = [None] * len(vectors)
                for dims in {len(v) for v in vectors}:
                    own = [i for i, v in enumerate(vectors) if len(v) == dims]
                    x = np.stack([vectors[i] / np.linalg.norm(vectors[i]) for i in own])
                    for i, f in zip(own, decode(x, codes[dims]), strict=True):
                        filters[i] = f
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(v) for v in vectors], pa.int32()), pa.array([_packed(v) for v in vectors], pa.binary()), pa.array(filters, pa.list_(pa.int64() if wide else pa.int32()))], names=["rep", "size", "dims", "vec", "filters"])

    return classes.mapInArrow(run, f"rep long, size long, dims int, vec binary, filters array<{'long' if wide else 'int'}>")


LINKS = "rep long, links long, root long"


def _compare(least: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Links within a block, or between two blocks, of a bucket: for each vector the linked vectors that no smaller
        common filter counts, and the smallest vector linked in here."""
        dims, i, j = key[1], key[2], key[3]
        left = rows[rows.block == i].sort_values("rep")
        right = left if i == j else rows[rows.block == j].sort_values("rep")
        if not len(left) or not len(right):
            return pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
        parent = {r: r for r in {*left.rep, *right.rep}}

        def find(r: int) -> int:
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r

        def units(part: pd.DataFrame) -> np.ndarray:
            x = np.stack([_unpacked(v, dims) for v in part.vec])
            return x / np.linalg.norm(x, axis=1, keepdims=True)

        a, b, ea, eb = units(left), units(right), list(left.earlier), list(right.earlier)
        known = np.intersect1d(np.concatenate(ea), np.concatenate(eb))

        def held(lists: list[np.ndarray]) -> np.ndarray:
            m = np.zeros((len(lists), len(known) or 1), np.float32)
            for k, f in enumerate(lists):
                at = np.searchsorted(known, f)
                good = at < len(known)
                good[good] = known[at[good]] == np.asarray(f)[good]
                m[k, at[good]] = 1
            return m

        linked = a @ b.T >= least
        if i == j:
            np.fill_diagonal(linked, False)
        fresh = linked & ~(held(ea) @ held(eb).T > 0.5) if linked.any() else linked
        la, lb = left.rep.to_numpy(), right.rep.to_numpy()
        for k in np.flatnonzero(linked.any(1)):
            to = lb[linked[k]]
            roots = {find(r) for r in {int(la[k]), *to.tolist()}}
            top = min(roots)
            for r in roots:
                parent[r] = top
        count = dict.fromkeys(parent, 0)
        for r, n in zip(la.tolist(), (fresh @ right["size"].to_numpy()).tolist(), strict=True):
            count[r] += n
        if i != j:
            for r, n in zip(lb.tolist(), (left["size"].to_numpy() @ fresh).tolist(), strict=True):
                count[r] += n
        out = [(r, count[r], find(r)) for r in parent]
        out = [x for x in out if x[1] or x[0] != x[2]]
        return pd.DataFrame(out, columns=["rep", "links", "root"]).astype("int64")

    return run


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, recall: float = 0.98, code: Code | None = None, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links (other vectors with a cosine of `least` or more), component_id (smallest id reachable), kept.

    Vectors that are null or empty, zero, or hold null or non-finite components link with nothing, and neither do vectors
    of different lengths. Rows that repeat an id and its vector are one vector, returned once; a null id links with
    nothing. An empty table gives no rows. Other columns aren't read.

    Equal vectors are one class from the start. A class goes to the filters that it exceeds; within a filter's bucket all
    pairs are verified in double precision as blocks of a matrix, a large bucket as pairs of blocks, so no task holds more
    than two blocks. A row in a bucket has the vector, in single precision where that is lossless, and the smaller ones of
    its filters. A bucket emits a count and a root per linked vector, never pairs; a pair is counted in the smallest
    filter that both exceed. A pair at exactly `least` is found with a probability of `recall`, a nearer one with a higher
    one, whatever the number of vectors (Code.sized); `code` takes its place.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
    bad = F.lit("NaN").cast("double"), F.lit("Infinity").cast("double"), F.lit("-Infinity").cast("double")
    sound = F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda c: F.coalesce(~c.isin(*bad), F.lit(False))) & F.exists("x", lambda c: c != 0)
    v = v.withColumn("x", F.when(sound, F.col("x"))).distinct()
    grouped = materialize(v.where("x IS NOT NULL").groupBy("x").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("size")), "classes")
    held = grouped.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("n")).collect()
    codes = {r.dims: code or Code.sized(r.n, r.dims, least, recall) for r in held}
    rows = materialize(_decoded(grouped.select("rep", "size", "x"), codes), "filters")
    spread = rows.select("rep", "size", "dims", "vec", "filters", F.posexplode("filters").alias("at", "f")).select("rep", "size", "dims", "vec", F.slice("filters", F.lit(1), F.col("at")).alias("earlier"), "f")
    counts = rows.select("dims", F.explode("filters").alias("f")).groupBy("dims", "f").agg(F.count("*").alias("n")).where("n > 1")
    dealt = spread.join(counts, ["dims", "f"]).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("*", other).select("rep", "size", "dims", "vec", "earlier", "f", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    links = materialize(dealt.groupBy("f", "dims", "i", "j").applyInPandas(_compare(least), LINKS), "links")
    found = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    by_rep = links.groupBy("rep").agg(F.sum("links").alias("links")).join(found, F.col("rep") == F.col("node"), "full").select(F.coalesce("rep", "node").alias("rep"), "links", "component")
    classes = grouped.join(by_rep, "rep", "left").select("x", F.col("size"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = v.join(classes, "x", "left").select("vec_id", F.coalesce(F.col("links") + F.col("size") - 1, F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (SELECT vec_id, x, sqrt(list_sum(list_transform(x, lambda c: c * c))) AS n FROM v),
g AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND a.n > 0 AND b.n > 0 AND list_inner_product(a.x, b.x) / (a.n * b.n) >= 0.9),
r(node, c) AS (SELECT a, a FROM g UNION SELECT g.b, r.c FROM r JOIN g ON g.a = r.node),
m AS (SELECT node, min(c) AS c FROM r GROUP BY 1),
k AS (SELECT a, count(*) AS n FROM g GROUP BY 1)
SELECT u.vec_id, coalesce(k.n, 0) AS n_links, coalesce(m.c, u.vec_id) AS component_id, coalesce(m.c, u.vec_id) = u.vec_id AS kept
FROM u LEFT JOIN k ON k.a = u.vec_id LEFT JOIN m ON m.node = u.vec_id
"""
