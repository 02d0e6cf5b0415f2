"""Soft-membership mixing: a classifier gives domain posteriors, projected gradients fit document rates to token targets."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwright.llm.shared import by_bytes, materialize, tidy

#: Dimensions that byte trigrams are hashed to; fixed-point scale of the token sums, which makes them independent of order.
DIMS, FIXED = 2048, 1 << 16
#: Bytes of text that a task makes features of at a time.
SLICE = 250_000


def trigram_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per whole text the square roots of its hashed byte trigrams' shares (unit length; zeros for an empty text), and its words."""
    raw = [(x or "").encode("utf-8", "replace") for x in texts]
    out, words = np.zeros((len(texts), DIMS), np.float32), np.array([len(x.split()) for x in raw], np.int64)
    for i, x in enumerate(raw):
        a = np.frombuffer(x, np.uint8).astype(np.uint32)
        if len(a) >= 3:
            h = (a[:-2] * 0x9E3779B1 ^ a[1:-1] * 0x85EBCA77 ^ a[2:] * 0xC2B2AE3D).astype(np.uint32)
            out[i] = np.sqrt(np.bincount((h * np.uint32(0x27D4EB2F)) >> 21, minlength=DIMS) / len(h))
    return out, words


@dataclass(frozen=True)
class Classifier:
    """Softmax regression over trigram_features; without labelled rows all domains are equally likely. absent: domains
    that no labelled row has."""

    domains: tuple[str, ...]
    weights: np.ndarray | None
    absent: frozenset[str] = frozenset()

    def posteriors(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full((len(features), len(self.domains)), 1 / len(self.domains))
        z = features.astype(np.float64) @ self.weights[:-1] + self.weights[-1]
        e = np.exp(z - z.max(1, keepdims=True))
        return np.round(e / e.sum(1, keepdims=True), 6)


def fit_classifier(labelled: DataFrame, domains: tuple[str, ...], *, text_col: str = "text", domain_col: str = "domain", id_col: str = "doc_id", sample: int = 2000, steps: int = 200, decay: float = 1e-3) -> Classifier:
    """Fit on at most `sample` rows of a labelled table (a documented bound: those whose ids have the smallest hashes).
    Rows with a null or unknown domain are left out. Each row's features are made on the executors: 8 KB a row go to the driver."""
    rows = labelled.where(F.col(domain_col).isin(*domains)).select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{domain_col}`").alias("domain"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    picked = rows.select("id", "domain", "h").distinct().orderBy(F.xxhash64("id"), "id", "domain", "h").limit(sample)
    rows = rows.join(F.broadcast(picked), ["id", "domain", "h"], "left_semi")  # texts are read where they lie

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = trigram_features(batch.column("text").to_pylist())[0]
            yield pa.RecordBatch.from_arrays([batch.column("domain"), pa.array([x.tobytes() for x in f], pa.binary())], names=["domain", "f"])

    got = sorted(rows.select("domain", "text").mapInArrow(tidy(run), "domain string, f binary").collect(), key=lambda r: (r.domain, bytes(r.f)))
    if not got:
        return Classifier(domains, None)
    x = np.stack([np.frombuffer(r.f, np.float32) for r in got]).astype(np.float64)
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    y = np.eye(len(domains))[[domains.index(r.domain) for r in got]]
    w, v, rate = np.zeros((x.shape[1], len(domains))), np.zeros((x.shape[1], len(domains))), 40.0 / max(1, np.linalg.norm(x, axis=1).max() ** 2)
    for _ in range(steps):
        z = x @ (w + 0.9 * v)
        e = np.exp(z - z.max(1, keepdims=True))
        g = x.T @ (e / e.sum(1, keepdims=True) - y) / len(x) + decay / len(x) * w
        v = 0.9 * v - rate * 0.1 * g
        w = w + v
    return Classifier(domains, w, frozenset(domains) - {r.domain for r in got})


@dataclass(frozen=True)
class Rates:
    """A document's rate as a function of its posteriors: start, then one projected step for each gradient."""

    start: float
    most: float
    steps: list[np.ndarray] = field(default_factory=list)
    expected: np.ndarray | None = None
    targets: np.ndarray | None = None

    def of(self, p: np.ndarray) -> np.ndarray:
        r = np.full(len(p), min(self.start, self.most))
        for v in self.steps:
            r = np.clip(r - p @ v, 0, self.most)
        return r


def membership(docs: DataFrame, classifier: Classifier, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, tokens (blank-separated words) and posteriors of each row."""
    schema = T.StructType([docs.schema[id_col], T.StructField("tokens", T.LongType()), T.StructField("posteriors", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, 1, SLICE):
                f, words = trigram_features(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words), pa.array(list(classifier.posteriors(f)), pa.list_(pa.float64()))], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(tidy(run), schema)


def fit_rates(members: DataFrame, targets: np.ndarray, *, most: float = float("inf"), rounds: int = 40, tolerance: float = 1e-4) -> Rates:
    """Rates in [0, most] with the least weighted squared distance of the domains' expected token totals from targets, and
    in `expected` and `targets` what they reach. Targets that no rates reach within tolerance after `rounds` are warned of.

    Each round is one pass over members that sums tokens * rate * posterior; a task sends one row. The projection is each
    document's own clipping. A step is the gradient in the metric of the Gram matrix of the documents that can still move;
    where such a step leads away from the targets, the next goes back to the Gram matrix of all, whose steps never do.
    """
    d = len(targets)

    def passed(rates: Rates) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [0] * (d + d * d)
            for batch in batches:
                if not batch.num_rows:
                    continue
                t = batch.column(0).to_numpy().astype(np.float64)
                p = batch.column(1).values.to_numpy().reshape(-1, d)
                r = rates.of(p)
                free = t * ((r > 0) & (r < rates.most))
                each = np.concatenate([(t * r)[:, None] * p, (free[:, None, None] * p[:, :, None] * p[:, None, :]).reshape(-1, d * d)], 1)
                sums = [a + int(b) for a, b in zip(sums, np.rint(each * FIXED).astype(np.int64).sum(0), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([str(x)]) for x in sums], names=[f"s{i}" for i in range(len(sums))])

        shape = ", ".join(f"s{i} string" for i in range(d + d * d))
        got = members.select("tokens", "posteriors").mapInArrow(tidy(run), shape).agg(*[F.sum(F.col(f"s{i}").cast("decimal(38,0)")) for i in range(d + d * d)]).first()
        sums = np.array([float(x or 0) / FIXED for x in got])
        return sums[:d], sums[d:].reshape(d, d)

    inverse = lambda gram: np.linalg.pinv(gram + np.eye(d) * max(np.trace(gram), 1.0) * 1e-9)
    now, gram = passed(Rates(1.0, float("inf")))
    whole, rates, best, last = inverse(gram), Rates(float(targets.sum() / max(now.sum(), 1)), most), None, np.inf
    for _ in range(rounds):
        now, gram = passed(rates)
        miss = float(np.abs(now - targets).max())
        if best is None or miss < best[0]:
            best = (miss, replace(rates, expected=now, targets=targets))
        if miss <= tolerance * max(targets.sum(), 1):
            break
        weight, last = (inverse(gram) if miss < last and np.trace(gram) > 0 else whole), miss
        rates = Rates(rates.start, most, [*rates.steps, weight @ (now - targets)])
    if best[0] > tolerance * max(targets.sum(), 1):
        off = "; ".join(f"{n:.0f} of {t:.0f} tokens" for n, t in zip(best[1].expected, targets, strict=True))
        warnings.warn(f"targets out of reach, by domain: {off}", stacklevel=2)
    return best[1]


def with_rates(members: DataFrame, rates: Rates) -> DataFrame:
    """members with `rate`, a nonnegative double."""
    schema = T.StructType([*members.schema.fields, T.StructField("rate", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column("posteriors").values.to_numpy()
            r = rates.of(p.reshape(batch.num_rows, -1)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.round(r, 6))], names=schema.names)

    return members.mapInArrow(tidy(run), schema)


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], *, tokens: float | None = None, most: float = float("inf"), id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain") -> DataFrame:
    """doc_id, tokens, posteriors (in the order of weights) and rate of every row of docs.

    weights: each domain's share of `tokens` (default: as many as docs has). most: upper bound of a rate. A null or empty
    text has no tokens and the prior's posteriors; rows that repeat an id get a rate each, equal for equal texts. An empty
    table gives no rows. A domain that no labelled row has can't be reached; the rest come as near as they can.
    """
    classifier = fit_classifier(labelled, tuple(weights), text_col=text_col, domain_col=domain_col, id_col=id_col)
    members = materialize(membership(docs, classifier, id_col=id_col, text_col=text_col), "members")
    total = tokens if tokens is not None else float(members.agg(F.sum("tokens")).first()[0] or 0)
    share = np.array(list(weights.values()), float)
    return with_rates(members, fit_rates(members, share / share.sum() * total, most=most))


def resample(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], *, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", seed: int = 0) -> DataFrame:
    """The rows of docs that stay when each is kept with its rate. A domain's target is its share of all tokens of docs, or
    all that it has where that is less, as no document is repeated: a scarce domain stays whole and takes nothing from the
    others. The share of a domain that no labelled row has goes to the others. A hash of id and text decides, so the same documents stay in every run. Columns as
    in docs. Rates are a function of the text, so nothing is joined or shuffled."""
    classifier = fit_classifier(labelled, tuple(weights), text_col=text_col, domain_col=domain_col, id_col=id_col)
    members = materialize(membership(docs, classifier, id_col=id_col, text_col=text_col), "members")
    absent = np.array([d in classifier.absent for d in weights])
    share = np.where(absent, 0.0, list(weights.values()))
    share /= share.sum() or 1
    have = members.select("tokens", F.posexplode("posteriors").alias("d", "p")).groupBy("d").agg(F.sum(F.col("tokens") * F.col("p")).alias("s")).collect()
    held = np.zeros(len(share))
    for r in have:
        held[r.d] = r.s
    rates = fit_rates(members, np.where(absent, held, np.minimum(share * held.sum(), held)), most=1.0)
    rate = "__rate"
    while rate.lower() in (c.lower() for c in docs.columns):
        rate += "_"
    schema = T.StructType([*docs.schema.fields, T.StructField(rate, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for part in by_bytes(batch, at, SLICE):
                p = classifier.posteriors(trigram_features(part.column(at).to_pylist())[0])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rates.of(p))], names=schema.names)

    rated = docs.mapInArrow(tidy(run), schema)
    draw = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return rated.where(draw < F.col(rate)).drop(rate)


#: The production mix: shares of the languages.
WEIGHTS = {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11}


def labelled_languages(docs: DataFrame, labels: DataFrame, sample: int = 3000) -> DataFrame:
    """The labelled table: documents that `labels` covers (at most `sample` ids, a documented bound), with their language as domain."""
    ids = labels.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", "text", F.col("lang").alias("domain")).join(F.broadcast(ids), "doc_id", "left_semi")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = mix(docs, labelled_languages(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), WEIGHTS)
    return out.select("doc_id", "tokens", *[F.col("posteriors")[i].alias(f"p_{d}") for i, d in enumerate(WEIGHTS)], "rate")
