"""N-gram Jaccard join: prefixes of globally ordered shingle sets deal them out, tries of the whole sets find the links."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.components import components
from linkwright.llm.shared import by_bytes, forget, materialize, tidy

#: Sets of a bucket that one trie holds, and rows of it that are compared by their histograms at once.
TRIE_BLOCK, PAIR_BLOCK = 1024, 2048
#: Slots of the fixed-size table by which the second pass skips documents without a possible partner; bins of a histogram.
SLOTS, BINS, FINE_BINS = 1 << 20, 64, 128
#: Most frequent tokens that go to the end of the global order, and how often a task must meet one in a slice to report it.
COMMON, REPORTED = 400_000, 2
#: Rows up to which a table of ids is broadcast (about 8 MB).
BROADCAST = 200_000
ROUNDS = 1
#: Bytes of texts whose shingles are made at once.
PART = 500_000
#: Pairs a row that a bucket may send before it sends its rows instead; first tokens of a row by which a pair knows its bucket.
ROOM, FIRST = 4, 8

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(11)
_BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(int(_RANDOM.integers(1, 2**62)) * 2 + 1)
_PLACES = _RANDOM.integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Measure:
    """Sets of `words`-word shingles link when 100 * intersection >= percent * union."""

    words: int = 4
    percent: int = 85

    def prefix(self, n: int) -> int:
        """Tokens from the front of which linked sets share one at least."""
        return n - -(-self.percent * n // 100) + 1

    def need(self, a, b):
        """The smallest intersection with which sets of a and b tokens link."""
        return -(-self.percent * (a + b) // (100 + self.percent))


def shingle_sets(texts: list[str | None], words: int = 4) -> list[np.ndarray]:
    """For each whole text its distinct shingles as sorted 63-bit tokens: the bytes of its words, more first, in the
    upper 7 bits, 56 bits of hash below. So they are in an order in which long, and so mostly rare, shingles lead. Texts of fewer words are one shingle, texts of none the empty set."""
    raw = [(x or "").encode("utf-8", "replace") for x in texts]
    part = np.cumsum([len(x) for x in raw]) // PART
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(raw)]
    return [s for a, b in zip(cuts, cuts[1:], strict=False) if b > a for s in _shingle_sets(raw[a:b], words)]


def _shingle_sets(raw: list[bytes], words: int) -> list[np.ndarray]:
    """Some 30 bytes of arrays for each byte of all texts, so they are few at a time."""
    a = _FOLD[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    offsets = np.cumsum([0] + [len(x) + 1 for x in raw])
    edge = np.flatnonzero(np.diff(np.concatenate([[False], ~_IS_SPACE[a]])))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in raw]
    length = ends - starts
    power = np.ones(int(length.max()), np.uint64)
    power[1:] = _BASE
    power = np.cumprod(power, dtype=np.uint64)
    begin = np.cumsum(length) - length
    inside = np.arange(int(length.sum())) - np.repeat(begin, length)
    letters = a[np.repeat(starts, length) + inside]
    word = _mix(np.add.reduceat(_BYTES[letters] * power[inside], begin))
    first = np.searchsorted(starts, offsets)
    n = len(starts) - words + 1
    if n > 0:
        token = word[:n] * _PLACES[0]
        size = length[:n].copy()
        for k in range(1, words):
            token = token + word[k : k + n] * _PLACES[k]
            size += length[k : k + n]
        token = _order(_mix(token), size)
    out = []
    for i in range(len(raw)):
        lo, hi = first[i], first[i + 1]
        if hi - lo >= words:
            out.append(np.unique(token[lo : hi - words + 1]))
        elif hi > lo:
            short = (word[lo:hi] * _PLACES[: hi - lo]).sum(dtype=np.uint64, keepdims=True) + np.array([hi - lo], np.uint64) * _MULTIPLY
            out.append(_order(_mix(short), np.array([length[lo:hi].sum()])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _order(token: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (np.uint64(127) - np.minimum(size, 127).astype(np.uint64)) << np.uint64(56) | token >> np.uint64(8)


class Trie:
    """Sets of ranks, each a path whose edges hold runs of ranks; a probe's overlap with a shared beginning counts once."""

    __slots__ = ("edge", "children", "leaves", "least", "most", "rest", "sample", "same")

    def __init__(self, edge: np.ndarray, rest: int, size: int, sample: int):
        self.edge, self.children, self.leaves, self.least, self.most, self.rest, self.sample, self.same = edge, {}, [], size, size, rest, sample, True


def trie_links(ids: list[int], sets: list[np.ndarray], measure: Measure, components: list[int] | None = None, inserted: int | None = None) -> list[tuple[int, int]]:
    """Enough links between the sets to join whatever links among them join, with what `components` joins already.

    sets: sorted keys of the global order (ordered_sets). Paths run from its frequent end, so that sets share long
    beginnings. Each set probes the trie of those before it and enters it; with `inserted`, the first so many only enter
    and the others only probe. On its way a probe counts the overlap with every shared piece of path once. A subtree is left
    as soon as the overlap so far and what can remain on either side can't reach the least overlap that its sizes need,
    and also when everything below it is already joined to the probe.
    """
    held, index = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    ranked = [r[::-1] for r in np.split(len(held) - 1 - index, cuts)]
    first: dict[int, int] = {}
    parent = [first.setdefault(c, i) for i, c in enumerate(components)] if components else list(range(len(ids)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links, root = [], Trie(np.zeros(0, np.int64), 0, len(ranked[0]), 0)
    for i, x in enumerate(ranked):
        n = len(x)
        stack = [(root, 0)] if (i if inserted is None else i >= inserted) else []
        while stack:
            node, overlap = stack.pop()
            if 100 * node.most < measure.percent * n or 100 * n < measure.percent * node.least:
                continue
            if not node.same:
                tips = [c.sample for c in node.children.values()] + node.leaves
                node.same = all(c.same for c in node.children.values()) and len({find(t) for t in tips}) == 1
            if node.same and find(node.sample) == find(i):
                continue
            left = n
            if len(node.edge):
                at = np.searchsorted(x, node.edge)
                at[at == n] = 0
                overlap += int((x[at] == node.edge).sum())
                left = n - int(np.searchsorted(x, node.edge[-1], "right"))
            if overlap + min(left, node.rest) < measure.need(n, max(node.least, -(-measure.percent * n // 100))):
                continue
            for j in node.leaves:
                if overlap >= measure.need(n, len(ranked[j])) and find(i) != find(j):
                    parent[find(i)] = find(j)
                    links.append((ids[i], ids[j]))
            stack += [(c, overlap) for c in node.children.values()]
        if inserted is not None and i >= inserted:
            continue
        node, at = root, 0
        while True:
            node.least, node.most, node.rest = min(node.least, n), max(node.most, n), max(node.rest, n - at)
            node.same = node.same and find(node.sample) == find(i)
            child = node.children.get(int(x[at])) if at < n else None
            if child is None:
                if at < n:
                    node.children[int(x[at])] = child = Trie(x[at:], 0, n, i)
                    child.leaves.append(i)
                else:
                    node.leaves.append(i)
                break
            m = min(len(child.edge), n - at)
            differ = np.flatnonzero(child.edge[:m] != x[at : at + m])
            common = int(differ[0]) if len(differ) else m
            if common < len(child.edge):
                upper = Trie(child.edge[:common], child.rest + len(child.edge) - common, child.least, child.sample)
                upper.most, upper.same = child.most, child.same
                child.edge = child.edge[common:]
                upper.children[int(child.edge[0])] = child
                node.children[int(upper.edge[0])] = child = upper
            node, at = child, at + common
    return links


def _by_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("k1"), F.hash(text).alias("k2"), text.alias("text"))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return by_bytes(batch, batch.schema.get_field_index("text"), 4_000_000)


PREFIXES = "doc_id long, k1 long, k2 int, n int, bins binary, token long"
SETS = "doc_id long, k1 long, k2 int, n int, tokens binary, bins binary, sketch binary, least array<long>"


def histogram(tokens: np.ndarray, bins: int = BINS) -> bytes:
    """How many keys fall in each bin, a byte each; all 255 (which bounds nothing) where one doesn't fit."""
    count = np.bincount((tokens & np.uint64(bins - 1)).astype(np.int64), minlength=bins)
    return (count if count.max(initial=0) < 256 else np.full(bins, 255)).astype(np.uint8).tobytes()


def sketch_bins(n: int) -> int:
    """Bins of a histogram as fine as the set is large: four to eight keys a bin, so a byte for some 50 of the set's."""
    return max(BINS, 1 << max(0, (n // 4).bit_length() - 1))


def at_most(x: np.ndarray, y: np.ndarray) -> int:
    """What two sets with these sketches can share at the most."""
    if 255 in (x.max(), y.max()):
        return 1 << 62
    x, y = (x.astype(np.int64), y.astype(np.int64)) if len(x) <= len(y) else (y.astype(np.int64), x.astype(np.int64))
    return int(np.minimum(x, y.reshape(-1, len(x)).sum(0)).sum())


def common_tokens(keyed: DataFrame, measure: Measure, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """The (at most `most`) most frequent tokens, sorted, and the rank of each, the rarest first. Every document is
    counted; a slice reports only tokens that REPORTED of its documents have. This decides the order of the sets and so
    the cost, never the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                tokens, count = np.unique(np.concatenate(shingle_sets(part.column("text").to_pylist(), measure.words)), return_counts=True)
                many = count >= REPORTED
                yield pa.RecordBatch.from_arrays([pa.array(tokens[many].view(np.int64)), pa.array(count[many].astype(np.int64))], names=["token", "n"])

    counted = keyed.mapInArrow(tidy(run), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= 2 * REPORTED)
    got = counted.orderBy(F.desc("n"), "token").limit(most).toArrow()
    tokens = got.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], (len(tokens) - 1 - np.arange(len(tokens), dtype=np.int32))[order]


def ordered_sets(sets: list[np.ndarray], common: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """The sets as sorted 64-bit keys, whose order is the global one: tokens that aren't common as they are, then, with
    the highest bit, the ranks of the common ones, the most frequent last. Different tokens have different keys."""
    tokens, rank = common
    if not len(tokens) or not sets:
        return sets
    flat = np.concatenate(sets)
    at = np.searchsorted(tokens, flat)
    at[at == len(tokens)] = 0
    hit = tokens[at] == flat
    keys = np.where(hit, np.uint64(1 << 63) | rank[at].astype(np.uint64), flat)
    cuts = np.cumsum([0] + [len(s) for s in sets])
    return [np.sort(keys[a:b]) if hit[a:b].any() else keys[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def _prefixes(measure: Measure, common) -> Callable:
    """A row without a token for each document, and a row for each token of its prefix; a text that a task has had already
    has no more prefix rows, so a hot group of copies sends a task's worth of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for part in _slices(batch):
                sets = ordered_sets(shingle_sets(part.column("text").to_pylist(), measure.words), common.value)
                m = len(sets)
                k = np.zeros(m, np.int64)
                for i, key in enumerate(zip(part.column("k1").to_pylist(), part.column("k2").to_pylist(), strict=True)):
                    if len(sets[i]) and key not in seen:
                        seen.add(key)
                        k[i] = measure.prefix(len(sets[i]))
                of = np.concatenate([np.arange(m), np.repeat(np.arange(m), k)])
                tokens = np.concatenate([np.zeros(m, np.uint64), *[s[:j] for s, j in zip(sets, k, strict=True)]]).view(np.int64)
                row = np.arange(len(of)) >= m
                bins = pa.array([histogram(s) for s in sets] + [None] * (len(of) - m), pa.binary())
                n = np.array([len(s) for s in sets], np.int32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(of, mask=row)), part.column("k1").take(pa.array(of)), part.column("k2").take(pa.array(of, mask=row)), pa.array(n[of], mask=row), bins, pa.array(tokens, mask=~row)], names=[c.split()[0] for c in PREFIXES.split(", ")])

    return run


def _sets(measure: Measure, slots: np.ndarray, common, rounds: int) -> Callable:
    salts = np.random.default_rng(12).integers(1, 2**62, rounds, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ids = np.unpackbits(slots, axis=1)
        seen: set = set()
        for batch in batches:
            wanted = (texts[batch.column("k1").to_numpy() % SLOTS] & ids[batch.column("doc_id").fill_null(0).to_numpy() % SLOTS]).astype(bool)
            for i in np.flatnonzero(wanted):  # a row that repeats an id and its text adds nothing
                key = (batch.column("doc_id")[i].as_py(), batch.column("k1")[i].as_py())
                wanted[i] = key not in seen
                seen.add(key)
            for part in _slices(batch.filter(pa.array(wanted))):
                sets = ordered_sets(shingle_sets(part.column("text").to_pylist(), measure.words), common.value)
                if not sets:
                    continue
                least = [[int(_mix(s * salt).min().view(np.int64)) if len(s) else 0 for salt in salts] for s in sets]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([histogram(s, FINE_BINS) for s in sets], pa.binary()), pa.array([histogram(s, sketch_bins(len(s))) for s in sets], pa.binary()), pa.array(least, pa.list_(pa.int64()))], names=[c.split()[0] for c in SETS.split(", ")])

    return run


def _sized(rows: DataFrame, key: str) -> DataFrame:
    """Rows of keys that more than one row has, with that number as size. Counts are aggregated before they move, and the
    join is one that Spark can split where a key has very many rows."""
    return rows.join(rows.groupBy(key).agg(F.count("*").alias("size")).where("size > 1"), key)


def _small(table: DataFrame) -> DataFrame:
    """A table of a few numbers a row, marked to be broadcast if it has at most BROADCAST rows; else Spark shuffles it."""
    return F.broadcast(table) if table.count() <= BROADCAST else table


def _trie_runs(measure: Measure) -> Callable:
    """The links that the tries of (token, i, j) find; in pairs of two blocks, the one's sets probe the other's trie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_runs(batches):
            keys = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("token", "i", "j")], 1)
            edges = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
            links = []
            for a, b in zip(edges, np.append(edges[1:], len(t)), strict=True):
                own = t.slice(a, b - a)
                _, i, j = keys[a]
                column = {c: own.column(c).to_pylist() for c in ("rep", "block", "component", "tokens")}
                order, inserted = list(range(b - a)), None
                if i != j:
                    order.sort(key=lambda k: column["block"][k])  # noqa: B023
                    inserted = column["block"].count(int(i))
                if b - a > 1 and inserted not in (0, b - a) and len(set(column["component"])) > 1:
                    rep, component, tokens = ([column[c][k] for k in order] for c in ("rep", "component", "tokens"))
                    links += trie_links(rep, [np.frombuffer(x, np.uint64) for x in tokens], measure, component, inserted)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([x for _, x in links], pa.int64())], names=["a", "b"])

    return run


def _trie_join(blocks: DataFrame, sets: DataFrame, measure: Measure) -> DataFrame:
    """a, b: what the tries link. blocks: token, pair of blocks (i, j), own block, rep, component."""
    rows = _sorted_runs(sets.select("rep", "n", "tokens").join(_small(blocks), "rep"))
    return rows.select("token", "i", "j", "block", "rep", "component", "tokens").mapInArrow(tidy(_trie_runs(measure)), "a long, b long")


def _fitting(t: pa.Table, measure: Measure, alive: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of rows of the same bucket and pair of blocks whose sizes and histograms allow a link: of all buckets at
    once, rows one apart, two apart and so on. alive: marks to which the caller adds; pairs of marked rows are left out.
    With a column `component`, pairs within one are left out too."""
    column = lambda c: t.column(c).to_numpy()
    keys = np.stack([column(c).astype(np.int64) for c in ("token", "i", "j")], 1)
    run = np.cumsum(np.append(False, (keys[1:] != keys[:-1]).any(1)))
    n, block, across = column("n").astype(np.int64), column("block"), column("i") != column("j")
    component = column("component") if "component" in t.column_names else np.arange(len(run))
    bins = np.frombuffer(b"".join(t.column("bins").to_pylist()), np.uint8).reshape(len(run), -1)
    open_ = bins.min(1) == 255
    left, d = np.arange(len(run)), 1
    while len(left):
        if alive is not None:  # a bucket of marked rows only, as of copies, is done
            left = left[np.bincount(run, ~alive, run[-1] + 1)[run[left]] > 0]
        left = left[left + d < len(run)]
        near = (run[left] == run[left + d]) & (100 * n[left] >= measure.percent * n[left + d])
        left = left[near]  # sizes rise within a bucket: what is too small for this row is for all later ones
        right = left + d
        good = (component[left] != component[right]) & ~(across[left] & (block[left] == block[right]))
        if alive is not None:
            good &= ~(alive[left] & alive[right])
        a, b = left[good], right[good]
        for at in range(0, len(a), 20_000):
            p, q = a[at : at + 20_000], b[at : at + 20_000]
            fits = (np.minimum(bins[p], bins[q]).sum(1, dtype=np.int64) >= measure.need(n[p], n[q])) | open_[p] | open_[q]
            yield p[fits], q[fits]
        d += 1


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows as tables that cut no run of (token, i, j)."""
    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
        if not len(t):
            continue
        keys = [t.column(c).to_numpy() for c in ("token", "i", "j")]
        differs = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in keys]))
        cut = int(differs[-1]) + 1 if len(differs) else 0
        held = t.slice(cut).combine_chunks()
        if cut:
            yield t.slice(0, cut).combine_chunks()
    if held is not None and len(held):
        yield held


def _alive(measure: Measure) -> Callable:
    """The classes that have a fitting partner in some bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_runs(batches):
            alive = np.zeros(len(t), bool)
            for p, q in _fitting(t, measure, alive):
                alive[p] = alive[q] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(t.column("rep").to_numpy()[alive]))], names=["rep"])

    return run


def _firsts(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of each row, FIRST columns, and which of them are there."""
    lists = t.column("first").combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    there = np.arange(FIRST) < size[:, None]
    out = np.zeros(there.shape, np.int64)
    out[there] = lists.flatten().to_numpy()
    return out, there


def _is_first(first: tuple[np.ndarray, np.ndarray], token: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether no smaller token is among the first ones of both rows of a pair. Both rows are in that token's bucket too and
    fit there as well, so such a pair is left to it; a pair without a common one is kept by each of its buckets."""
    x, there = first
    common = ((x[p][:, :, None] == x[q][:, None, :]) & there[q][:, None, :]).any(2) & there[p]
    return ~(common & (x[p] < token[p][:, None])).any(1)


def _jobs_of_runs(measure: Measure) -> Callable:
    """What a bucket's trie must still decide: fitting pairs of different components, or where a run has more than
    ROOM of them a row, the rows that are in one (b is null). So what is sent grows with the rows. Copies share most of
    their buckets, and all but one of them leave a pair out (_is_first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_runs(batches):
            keys = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("token", "i", "j")], 1)
            of = np.cumsum(np.append(False, (keys[1:] != keys[:-1]).any(1)))
            room = ROOM * np.bincount(of)
            number, within, some = np.zeros(len(room), np.int64), np.zeros(len(t), bool), [np.zeros((2, 0), np.int64)]
            first = _firsts(t)
            for p, q in _fitting(t, measure, None):
                mine = _is_first(first, keys[:, 0], p, q)
                p, q = p[mine], q[mine]
                within[p] = within[q] = True
                number += np.bincount(of[p], minlength=len(room))
                few = number[of[p]] <= room[of[p]]
                some.append(np.stack([p[few], q[few]]))
            p, q = np.concatenate(some, 1)
            few = number[of[p]] <= room[of[p]]
            p, q, rest = p[few], q[few], np.flatnonzero(within & (number > room)[of])
            rep, component = t.column("rep").to_numpy(), t.column("component").to_numpy()
            swap = rep[p] > rep[q]
            p, q = np.where(swap, q, p), np.where(swap, p, q)
            a, b = np.append(p, rest), np.append(q, rest)
            none = np.arange(len(a)) >= len(p)
            yield pa.RecordBatch.from_arrays([pa.array(keys[a, 0]), pa.array(rep[a]), pa.array(component[a]), pa.array(rep[b], mask=none), pa.array(component[b], mask=none)], names=["token", "a", "ca", "b", "cb"])

    return run


def _sketched(measure: Measure) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = batch.column("na").to_pylist(), batch.column("nb").to_pylist()
            fits = [at_most(np.frombuffer(x.as_py(), np.uint8), np.frombuffer(y.as_py(), np.uint8)) >= measure.need(m[i], n[i]) for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"), strict=True))]
            yield batch.select(["a", "ca", "b", "cb", "token"]).filter(pa.array(fits, pa.bool_()))

    return run


def _in_runs(rows: DataFrame, most: int, columns: list[str]) -> DataFrame:
    """Rows (token, size of its bucket, rep) dealt out as pairs of blocks of about `most`."""
    dealt = rows.withColumn("blocks", F.ceil(F.col("size") / most).cast("int")).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select("*", other).select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", *columns)


def _sorted_runs(rows: DataFrame) -> DataFrame:
    return rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "rep")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", measure: Measure = Measure(), trie_block: int = TRIE_BLOCK, pair_block: int = PAIR_BLOCK, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) for every row of docs.

    Exact, up to equal 63-bit tokens of different shingles. A null or empty text has no shingles and no links, and its
    component is its own id. Rows that repeat an id are one document in the links; a null id has neither links nor a
    component. Ids are integers. An empty table gives no rows. Only id_col and text_col are read.

    0. One pass counts tokens; the most frequent (a fixed number of them, so they can be broadcast) end the global order.
    1. One pass writes each document's size, histogram and the prefix of its ordered set. Equal texts are one class. A
       token whose prefix holders are one class can't link anything; what remains are buckets. Classes whose sizes and
       histograms, which bound the overlap from above, allow no partner in any bucket are done.
    2. A second pass makes the ordered sets of the others, and only of those.
    3. A few rounds contract groups of copies: classes with an equal min-hash meet in tries, then only one class of each
       component goes on. (They lower the cost of the last step and may be 0.)
    4. In each bucket that still holds different components, sizes and histograms say which classes must meet; a pair that
       shares buckets meets in the first (and most buckets know that of their pairs), unless finer histograms rule it out. Their sets are stored in the bucket's tries, whose traversal gives the links.
    All links between different texts come from tries. Groups of copies emit at most one edge per member and round; no
    bucket is held whole by a task.
    """
    spark = docs.sparkSession
    if docs.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col} must hold integers")
    keyed = _by_texts(docs, id_col, text_col)
    common = spark.sparkContext.broadcast(common_tokens(keyed, measure))
    rows = materialize(keyed.mapInArrow(tidy(_prefixes(measure, common)), PREFIXES), "prefixes")
    table = materialize(rows.where("token IS NULL").select("doc_id", "k1", "k2", "n", "bins"), "table")
    prefixes = rows.where("token IS NOT NULL").select("token", "k1")
    shared = prefixes.groupBy("token").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low <> high").select("token")
    buckets = materialize(prefixes.join(shared, "token", "left_semi").distinct(), "buckets")
    forget(rows)
    reps = table.where("n > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bins").alias("bins"))
    reps = materialize(reps, "reps")
    met = _sorted_runs(_in_runs(_sized(buckets, "token").join(reps.drop("k2"), "k1"), pair_block, ["n", "bins"]))
    fitting = materialize(met.mapInArrow(tidy(_alive(measure)), "rep long").distinct(), "fitting")
    live = materialize(reps.join(fitting, "rep", "left_semi").select("rep", "n", "k1", "k2"), "live")
    forget(fitting)
    named = materialize(buckets.join(live.select("k1", "rep", "n"), "k1").select("token", "rep", "n"), "named")
    forget(buckets)
    slots = np.zeros((2, SLOTS), bool)
    for i, c in enumerate(("k1", "rep")):
        slots[i, [r.s for r in live.select(F.pmod(c, F.lit(SLOTS)).cast("int").alias("s")).distinct().collect()]] = True
    mine = live.select("rep", F.col("k1").alias("l1"), F.col("k2").alias("l2"))
    sets = keyed.mapInArrow(tidy(_sets(measure, np.packbits(slots, axis=1), common, rounds)), SETS).join(_small(mine), F.col("doc_id") == F.col("rep")).where("k1 = l1 AND k2 = l2").drop("doc_id", "k2", "l1", "l2")
    sets = materialize(sets, "sets")

    twice = table.where("n > 0").join(reps.select("k1", "k2", "rep"), ["k1", "k2"]).groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).where("a <> b").select("a", "b")
    edges = materialize(twice, "links")
    found = components(edges)

    def link(jobs: DataFrame) -> None:
        """Add what the tries of each token's sets link, a large token's dealt out as pairs of blocks."""
        nonlocal edges, found
        blocks = materialize(_in_runs(_sized(jobs, "token"), trie_block, ["component"]), "blocks")
        before, edges = edges, materialize(edges.unionByName(_trie_join(blocks, sets, measure)), "links")
        forget(before)
        forget(blocks)
        found = components(edges)

    for k in range(rounds):
        rest = sets.select("rep", F.col("least")[k].alias("token")).join(found.where("node <> component"), F.col("rep") == F.col("node"), "left_anti")
        link(rest.select("token", "rep", F.col("rep").alias("component")))
    by_component = named.join(_small(found), F.col("rep") == F.col("node"), "left").select("token", "rep", "n", F.coalesce("component", "rep").alias("component"))
    mixed = by_component.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size")).where("low <> high")
    mixed = materialize(by_component.join(mixed.select("token", "size"), "token"), "mixed")
    first = mixed.groupBy("rep").agg(F.slice(F.array_sort(F.collect_set("token")), 1, FIRST).alias("first"))
    met = mixed.join(first.join(sets.select("rep", "bins"), "rep"), "rep")
    met = _sorted_runs(_in_runs(met, pair_block, ["component", "n", "bins", "first"]))
    open_ = materialize(met.mapInArrow(tidy(_jobs_of_runs(measure)), "token long, a long, ca long, b long, cb long"), "open")
    pairs = open_.where("b IS NOT NULL").groupBy("a", "b").agg(F.min(F.struct("token", "ca", "cb")).alias("x")).select("a", "x.ca", "b", "x.cb", "x.token")
    for c in "ab":
        pairs = pairs.join(sets.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")), c)
    pairs = pairs.mapInArrow(tidy(_sketched(measure)), "a long, ca long, b long, cb long, token long")
    ends = F.explode(F.array(F.struct(F.col("a").alias("rep"), F.col("ca").alias("component")), F.struct(F.col("b").alias("rep"), F.col("cb").alias("component")))).alias("e")
    jobs = pairs.select("token", ends).select("token", "e.rep", "e.component").unionByName(open_.where("b IS NULL").select("token", F.col("a").alias("rep"), F.col("ca").alias("component"))).distinct()
    link(jobs)
    for x in (sets, open_, live, named, mixed):
        forget(x)
    out = table.join(reps.select("k1", "k2", "rep"), ["k1", "k2"], "left").join(found, F.col("rep") == F.col("node"), "left")
    own = F.when(F.col("n") > 0, F.coalesce("component", "rep"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce(own, "doc_id")).alias("component_id"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")  # what 10,000 texts need depends on their lengths
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: Feasible on small tables only: every pair of documents that share a shingle is counted.
ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, CAST(len(w) - 2 AS BIGINT)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS s FROM w),
e AS (SELECT doc_id, hash(unnest(s)) AS t, len(s) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n + b.n) AS n, count(*) AS k FROM e a JOIN e b ON a.t = b.t AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * k >= 85 * (n - k)),
g AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(node, c) AS (SELECT a, a FROM g UNION SELECT g.b, r.c FROM r JOIN g ON g.a = r.node),
m AS (SELECT node, min(c) AS c FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(m.c, s.doc_id) AS component_id FROM s LEFT JOIN m ON m.node = s.doc_id
"""
