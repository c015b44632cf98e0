"""Approximate nearest neighbours over learned partitions.

Fitting, on bounded samples: the exact neighbour graph of a sample is cut into balanced parts, and a small network
learns to tell a vector's part, with the parts of its neighbours as soft labels. Where a part would hold many more
vectors than wanted, a sample of it is cut again in the same way, by the executors, with a network of its own. So the
number of leaves grows with the vectors. Indexing, over every row: each vector goes to its most probable leaf.
Searching: the networks route each query to its most probable leaves, whose vectors are ranked by the exact inner
product in double precision. A query probes leaves until these have a share of the probability that found the wanted
recall for held-out vectors, whose true neighbours come from a scan of all rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.llm._scratch import Scratch, hot_join, small

#: Vectors that a network is fitted on (the first; those of its parts), and held-out ones that settle how much is probed.
#: Of each length only the first and the last of these reach the driver.
SAMPLE, PART_SAMPLE, HELD_OUT = 8192, 4096, 256
#: Vectors wanted in a leaf, and the most parts that a network tells apart.
LEAF, PARTS = 512, 128
#: Lengths of vectors that get a network, the most frequent ones; vectors of another length are one leaf for each length.
LENGTHS = 8
#: Lengths beyond this many times the average are all the same to a network; entries beyond ``LARGEST`` are refused, as
#: inner products of such vectors overflow.
LONGEST, LARGEST = 1e3, 1e150
#: Vectors, and their bytes, that a task holds at a time; a larger leaf is split into blocks.
BLOCK, BLOCK_BYTES = 16_384, 1 << 26
_QUERIES = 256


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of each vector's k nearest others by inner product, in blocks."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), dtype=np.int64)
    for a in range(0, len(x), 1024):
        s = x[a : a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_cut(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 0.05, seed: int = 1) -> np.ndarray:
    """A part for each vector: halves by principal directions at first, then moves to the part of most neighbours.

    Neighbours count in both directions. A move needs room: no part grows beyond its share plus ``slack``.
    """
    rng = np.random.default_rng(seed)
    labels = np.zeros(len(x), dtype=np.int64)
    work = [(np.arange(len(x)), 0, parts)]
    while work:
        rows, first, n = work.pop()
        if n == 1:
            labels[rows] = first
            continue
        part = x[rows] - x[rows].mean(axis=0)
        v = rng.standard_normal(part.shape[1])
        for _ in range(10):
            v = part.T @ (part @ v)
            v /= np.linalg.norm(v) + 1e-12
        order = rows[np.argsort(part @ v, kind="stable")]
        at = len(rows) * (n // 2) // n
        work += [(order[:at], first, n // 2), (order[at:], first + n // 2, n - n // 2)]
    n = len(x)
    room = int(np.ceil((1 + slack) * n / parts))
    src, dst = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (src, labels[dst]), 1)
        np.add.at(votes, (dst, labels[src]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), labels]
        sizes, moved = np.bincount(labels, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < room:
                sizes[best[i]] += 1
                sizes[labels[i]] -= 1
                labels[i] = best[i]
                moved += 1
        if moved < n // 200:
            break
    return labels


def _norms(x: np.ndarray) -> np.ndarray:
    """The length of each vector, whatever its size: squares of entries neither overflow nor vanish."""
    most = np.abs(x).max(axis=1, initial=np.finfo(float).tiny)
    return most * np.linalg.norm(x / most[:, None], axis=1)


@dataclass
class Router:
    """A network with one hidden layer; its size depends on the dimension and the number of parts only.

    It takes vectors times ``scale``, which brings those that it is fitted on to length 1 on average; what is longer
    than ``LONGEST`` times that is shortened. Weights are single precision, as they travel to every task.
    """

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    scale: float = 1.0

    def logits(self, x: np.ndarray, unit: bool = False) -> np.ndarray:
        """Of each vector; with ``unit`` as if its length were 1 on the network's scale."""
        x = x / _norms(x)[:, None] if unit else x * self.scale
        x = (x / np.maximum(1, _norms(x) / LONGEST)[:, None]).astype(np.float32)
        return (np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2).astype(np.float64)

    @staticmethod
    def fit(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 30, seed: int = 1) -> Router:
        """Cross-entropy with soft targets, by Adam."""
        rng = np.random.default_rng(seed)
        d, m = x.shape[1], target.shape[1]
        ps = [rng.standard_normal((d, hidden)) * np.sqrt(2 / d), np.zeros(hidden), rng.standard_normal((hidden, m)) * np.sqrt(1 / hidden), np.zeros(m)]
        one, two, t = [np.zeros_like(p) for p in ps], [np.zeros_like(p) for p in ps], 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            rate = 4e-3 * (1 - epoch / epochs)
            for a in range(0, len(x), 256):
                rows = order[a : a + 256]
                xb = x[rows]
                h = np.maximum(xb @ ps[0] + ps[1], 0)
                z = h @ ps[2] + ps[3]
                z = np.exp(z - z.max(axis=1, keepdims=True))
                e = (z / z.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
                eh = (e @ ps[2].T) * (h > 0)
                t += 1
                for i, g in enumerate((xb.T @ eh, eh.sum(axis=0), h.T @ e, e.sum(axis=0))):
                    one[i] = 0.9 * one[i] + 0.1 * g
                    two[i] = 0.999 * two[i] + 0.001 * g * g
                    ps[i] -= rate * (one[i] / (1 - 0.9**t)) / (np.sqrt(two[i] / (1 - 0.999**t)) + 1e-8)
        return Router(*(p.astype(np.float32) for p in ps))


def fit_router(sample: np.ndarray, parts: int) -> Router | None:
    """A network that tells the parts of a balanced cut of the sample's neighbour graph; none for a single part."""
    parts = max(1, min(parts, len(sample) // 64))
    if parts == 1:
        return None
    scale = min(1 / float(_norms(sample).mean()), 1e300)
    unit = sample * scale
    unit /= np.maximum(1, _norms(unit) / LONGEST)[:, None]
    graph = neighbour_graph(unit, 10)
    labels = balanced_cut(unit, graph, parts)
    target = np.zeros((len(unit), parts))
    np.add.at(target, (np.repeat(np.arange(len(unit)), graph.shape[1]), labels[graph].ravel()), 1)
    target[np.arange(len(unit)), labels] += 2
    router = Router.fit(unit, target / target.sum(axis=1, keepdims=True))
    router.scale = scale
    return router


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


@dataclass
class Tree:
    """The networks for vectors of one length: one for parts, and one for the leaves of each part that is cut again.

    Leaves are numbered from ``base``. A query probes its leaves, most probable first, as long as those before have no
    more than ``mass`` of the probability.
    """

    first: Router | None
    base: int = 0
    below: dict[int, Router] = field(default_factory=dict)
    mass: float = 1.0

    def offsets(self) -> np.ndarray:
        parts = 1 if self.first is None else len(self.first.b2)
        return np.concatenate([[0], np.cumsum([len(self.below[p].b2) if p in self.below else 1 for p in range(parts)])])

    def leaves(self) -> int:
        return int(self.offsets()[-1])

    def home(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        if self.first is None:
            return np.full(len(x), self.base, dtype=np.int32)
        part = self.first.logits(x).argmax(axis=1)
        out = self.offsets()[part]
        for p in set(part.tolist()) & self.below.keys():
            rows = np.flatnonzero(part == p)
            out[rows] += self.below[p].logits(x[rows]).argmax(axis=1)
        return (out + self.base).astype(np.int32)

    def _ranked(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query its leaves, most probable first, and the probability of those before each. A query's length
        changes nothing about what is nearest to it, so all are asked at length 1."""
        if self.first is None:
            return np.zeros((len(x), 1), dtype=np.int64), np.zeros((len(x), 1))
        z, at = _log_softmax(self.first.logits(x, True)), self.offsets()
        if self.below:
            z = np.concatenate([z[:, p : p + 1] + (_log_softmax(self.below[p].logits(x, True)) if p in self.below else 0) for p in range(len(at) - 1)], axis=1)
        order = np.argsort(-z, axis=1, kind="stable")
        share = np.exp(np.take_along_axis(z, order, axis=1))
        return order, np.cumsum(share, axis=1) - share

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaves of all vectors, one vector's behind the other's; how many each has)."""
        order, before = self._ranked(x)
        asked = before <= self.mass
        return (order[asked] + self.base).astype(np.int32), asked.sum(axis=1)

    def before(self, x: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """The probability of the leaves that come before ``leaf`` (one for each vector)."""
        order, before = self._ranked(x)
        return np.where(order == (leaf - self.base)[:, None], before, 0).sum(axis=1)


def _rows_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix of vectors) for each length of the vectors in a batch."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    for dim in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == dim)
        yield dim, places, _matrix(column if len(places) == len(column) else column.take(pa.array(places)), dim)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(column), dim)


def _assigner(trees: dict[int, Tree], probe: bool):
    """Adds to (h1, h2, embedding, ...) the leaf of each vector or, with ``probe``, the leaves that a query asks. A length
    without a tree has one leaf, whose number is the length, negative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, flat = np.ones(batch.num_rows, dtype=np.int64), []
            for dim, places, x in _rows_of(batch.column(2)):
                if dim not in trees:
                    leaves = np.full(len(x), -dim, dtype=np.int32)
                elif probe:
                    leaves, counts[places] = trees[dim].probes(x)
                else:
                    leaves = trees[dim].home(x)
                flat.append((places, leaves))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            out = np.empty(offsets[-1], dtype=np.int32)
            for places, leaves in flat:
                n = counts[places]
                out[np.repeat(offsets[places] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = leaves
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(out))], [*batch.schema.names, "leaves"])

    return run


def _part_fitter(share: float, leaf: int):
    """Rows (part, embedding) come by part, a sample of ``share`` of its vectors. Yields the network of each part that
    has to be cut again; only the first 2 * PART_SAMPLE vectors are held."""

    def fitted(part: int, held: list[np.ndarray], n: int) -> bytes | None:
        router = fit_router(np.concatenate(held)[: 2 * PART_SAMPLE], min(PARTS, round(n / share / leaf)))
        return router and pickle.dumps(router)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, n, out = None, [], 0, []
        for batch in batches:
            parts = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if parts[a] != at:
                    if held:
                        out.append((at, fitted(at, held, n)))
                    at, held, n = int(parts[a]), [], 0
                if n < 2 * PART_SAMPLE:
                    column = batch.column(1).slice(a, b - a)
                    held.append(_matrix(column, len(column.flatten()) // len(column)))
                n += b - a
        if held:
            out.append((at, fitted(at, held, n)))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()), pa.array([r for _, r in out], pa.binary())], ["part", "router"])

    return run


def _scanner(held: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Rows are the index; yields each held-out vector's k nearest of the task, and their leaves. ``held`` has by length
    (keys, vectors)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: (np.full((len(x), k), -np.inf), np.zeros((len(x), k), dtype=np.int32)) for dim, (_, x) in held.items()}
        for batch in batches:
            h1, leaf = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for dim, places, x in _rows_of(batch.column(1)):
                if dim not in held:
                    continue
                keys, asked = held[dim]
                scores = np.where(keys[:, None] == h1[places][None, :], -np.inf, asked @ x.T)
                both = np.concatenate([best[dim][0], scores], axis=1)
                leaves = np.concatenate([best[dim][1], np.broadcast_to(leaf[places], scores.shape)], axis=1)
                top = np.argpartition(-both, k - 1, axis=1)[:, :k]
                best[dim] = np.take_along_axis(both, top, axis=1), np.take_along_axis(leaves, top, axis=1)
        for dim, (scores, leaves) in best.items():
            query, col = np.nonzero(scores > -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(query), dim, dtype=np.int32)), pa.array(query.astype(np.int32)), pa.array(scores[query, col]), pa.array(leaves[query, col])], ["dim", "query", "score", "leaf"])

    return run


class _Nearest:
    """The k best rows of each query among those of a task, in arrays; at most about ``most`` rows are held."""

    names = ["h1", "h2", "vec_id", "score", "own"]

    def __init__(self, k: int, most: int = 400_000):
        self.k, self.most, self.held, self.size = k, most, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(columns)
        self.size += len(columns[0])
        if self.size > self.most:
            self._cut()
            if 2 * self.size > self.most:  # so many queries: their best of all tasks are found later
                yield from self.rest()

    def _cut(self) -> None:
        h1, h2, ids, scores, own = (np.concatenate(c) for c in zip(*self.held))
        order = np.lexsort((ids, -scores, h2, h1))
        h1, h2 = h1[order], h2[order]
        first = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        starts = np.flatnonzero(first)
        rank = np.arange(len(h1)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(h1)]])))
        kept = rank < self.k
        self.held = [(h1[kept], h2[kept], *(c[order][kept] for c in (ids, scores, own)))]
        self.size = int(kept.sum())

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self._cut()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in self.held[0]], self.names)
        self.held, self.size = [], 0


def _searcher(k: int):
    """Rows come by (leaf, block), its vectors before the queries. Yields each query's k nearest rows of what the task has,
    ties to the smaller id. Scores are summed in an order that depends on the two vectors alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, stored, best = None, [], None, _Nearest(k)
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                leaf, block, is_query = keys[a]
                if (leaf, block) != at:
                    at, held, stored = (leaf, block), [], None
                h1, h2 = (batch.column(i).slice(a, b - a).to_numpy() for i in (3, 4))
                column = batch.column(6).slice(a, b - a)
                vectors = _matrix(column, len(column.flatten()) // len(column))
                if not is_query:
                    held.append((h1, h2, vectors, batch.column(5).slice(a, b - a)))
                    continue
                if not held:
                    continue
                if stored is None:
                    ids = pa.concat_arrays([part[3] for part in held])
                    stored = *(np.concatenate([part[i] for part in held]) for i in (0, 1, 2)), ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())])
                s1, s2, matrix, ids, starts = stored
                for c in range(0, len(h1), _QUERIES):
                    asked = vectors[c : c + _QUERIES]
                    scores = asked @ matrix.T
                    edge = np.partition(scores, max(0, scores.shape[1] - k), axis=1)[:, max(0, scores.shape[1] - k)]
                    slack = 1e-12 * np.linalg.norm(asked, axis=1) * np.linalg.norm(matrix, axis=1).max()
                    for i in range(len(asked)):
                        near = np.flatnonzero(scores[i] >= edge[i] - slack[i])
                        exact = (matrix[near] * asked[i]).sum(axis=1)
                        # a class further back has k smaller ids of the same score or better before it
                        near, exact = (x[np.lexsort((ids[starts[near]], -exact))[:k]] for x in (near, exact))
                        sizes = starts[near + 1] - starts[near]
                        places = np.repeat(starts[near] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                        near, exact = np.repeat(near, sizes), np.repeat(exact, sizes)
                        own = (s1[near] == h1[c + i]) & (s2[near] == h2[c + i])
                        yield from best.add(np.full(len(near), h1[c + i]), np.full(len(near), h2[c + i]), ids[places], exact, own)
        yield from best.rest()

    return run


def valid(column: str) -> Column:
    """Not null, not empty, every component finite, and not all of them zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.col(column).isNotNull() & (F.size(column) > 0) & finite & F.exists(column, lambda x: x != 0)


def _first_trees(entries: DataFrame, lengths: list, sample: int, leaf: int) -> tuple[dict[int, Tree], dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The first network for each of the lengths, and its held-out vectors: (keys, vectors)."""
    trees, held = {}, {}
    for row in lengths:
        some = entries.where(F.size("embedding") == row.dim).select("h1", "embedding").orderBy(F.xxhash64("h1"), "h1").limit(sample + HELD_OUT).collect()
        x = np.array([r.embedding for r in some], dtype=np.float64).reshape(len(some), row.dim)
        cut = len(x) - min(HELD_OUT, len(x) // 5)
        trees[row.dim] = Tree(fit_router(x[:cut], min(PARTS, -(-row.n // leaf))))
        if trees[row.dim].first is not None:
            held[row.dim] = np.array([r.h1 for r in some[cut:]], dtype=np.int64), x[cut:]
    return trees, held


def _cut_again(entries: DataFrame, trees: dict[int, Tree], lengths: list, leaf: int) -> None:
    """Adds the networks below, fitted by the executors, where parts are more than twice a leaf; numbers the leaves."""
    for row in lengths:
        tree = trees[row.dim]
        parts = 1 if tree.first is None else tree.leaves()
        if tree.first is not None and row.n > 2 * leaf * parts:
            share = min(1.0, PART_SAMPLE * parts / row.n)
            drawn = entries.where((F.size("embedding") == row.dim) & (F.pmod(F.xxhash64("h2"), F.lit(1 << 30)) < int(share * (1 << 30)))).select("h1", "h2", "embedding")
            sent = drawn.mapInArrow(_assigner({row.dim: tree}, False), "h1 long, h2 long, embedding array<double>, leaves array<int>").select(F.col("leaves")[0].alias("part"), "embedding")
            dealt = sent.repartition(parts, "part").sortWithinPartitions("part")
            for r in dealt.mapInArrow(_part_fitter(share, leaf), "part int, router binary").collect():
                if r.router is not None:
                    tree.below[r.part] = pickle.loads(bytes(r.router))
    base = 0
    for tree in trees.values():
        tree.base = base
        base += tree.leaves()


def _settle(index: DataFrame, trees: dict[int, Tree], held: dict[int, tuple[np.ndarray, np.ndarray]], k: int, recall: float) -> None:
    """Sets what the queries of each length probe, from the true neighbours of the held-out vectors among all rows."""
    if not held:
        return
    near = index.select("h1", "embedding", "leaf").mapInArrow(_scanner(held, k), "dim int, query int, score double, leaf int")
    best = Window.partitionBy("dim", "query").orderBy(F.desc("score"))
    near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("dim", "query", "leaf").collect()
    for dim, (_, x) in held.items():
        found = [(r["query"], r.leaf) for r in near if r.dim == dim]
        if found:
            query, leaf = np.array(found).T
            before = np.sort(trees[dim].before(x[query], leaf))
            trees[dim].mass = float(before[min(len(before), int(np.ceil(recall * len(before)))) - 1])


def build(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.93, sample: int = SAMPLE, leaf: int = LEAF, block: int = BLOCK) -> tuple[Scratch, DataFrame, DataFrame, DataFrame, dict[int, Tree]]:
    """(scratch, members, index, blocks, trees): the fitted index of ``nearest``."""
    scratch = Scratch(vectors.sparkSession, "ann")
    rows = vectors.where(valid("embedding") & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(F.col("embedding").cast("array<double>"), lambda x: F.when(F.abs(x) <= LARGEST, x + 0.0).otherwise(F.raise_error(f"an entry is beyond {LARGEST}").cast("double"))).alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(3), "embedding")})
    members = scratch.write(rows.groupBy("h1", "h2", "vec_id").agg(F.max("is_query").alias("is_query")), "members")
    nth = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    ids = members.select("h1", "h2", "vec_id", nth.alias("n")).where(F.col("n") <= k + 1).groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = members.groupBy("h1", "h2").agg(F.count_if("is_query").alias("asked"))
    entries = rows.groupBy("h1", "h2").agg(F.first("embedding").alias("embedding")).join(ids, ["h1", "h2"]).join(asked, ["h1", "h2"])
    entries = scratch.write(entries.select("h1", "h2", "embedding", "ids", "asked"), "entries")

    lengths = entries.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(LENGTHS).collect()
    trees, held = _first_trees(entries, lengths, sample, leaf)
    _cut_again(entries, trees, lengths, leaf)
    homes = entries.mapInArrow(_assigner(trees, False), "h1 long, h2 long, embedding array<double>, ids array<long>, asked long, leaves array<int>")
    index = scratch.write(homes.select(F.col("leaves")[0].alias("leaf"), "h1", "h2", "embedding", "ids", "asked"), "index")
    scratch.drop(entries)
    _settle(index, trees, held, k, recall)
    size = F.least(F.lit(block), F.greatest(F.lit(1), F.lit(BLOCK_BYTES // 8) / F.max(F.size("embedding"))))
    blocks = scratch.write(index.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("blocks")), "blocks")
    return scratch, members, index, blocks, trees


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.93, sample: int = SAMPLE, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score, query_class): for each row of ``vectors`` (vec_id, embedding) where ``is_query``
    holds, its ``k`` nearest other rows found, nearest first by inner product, ties to the smaller id.

    Every row is indexed. ``sample`` bounds what a network is fitted on; ``recall`` is the share of held-out vectors'
    true neighbours that the probed leaves must have; a leaf has about ``leaf`` vectors up to some PARTS * PARTS * leaf
    of them, and more beyond. Equal vectors are one entry of the index that keeps its k + 1 smallest ids (a larger id
    of an equal vector can never be among the k nearest), so a vector that a third of the rows share costs as much as
    any other. Large leaves are split into blocks; a query meets each block once.

    A row is an id and a vector; rows that repeat both count once. An id that stands on several vectors is as many
    rows: each is a query and a candidate of its own, also for the other, and ``query_class`` (a hash of the query's
    vector) tells their lists apart. Vectors are compared with those of the same length (number of entries). Norms may be
    of any size: networks work on scaled vectors, scores are on the original ones; entries beyond ``LARGEST`` raise an
    error, as their products overflow, and products that vanish are equal scores of 0. Vectors null, empty, zero, or
    with a null or non-finite component take no part, nor do rows without an id. Other columns are ignored. An empty
    table gives an empty result.
    """
    scratch, members, index, blocks, trees = build(vectors, is_query, k, recall, sample, leaf, block)
    sizes = small(blocks, 1_000_000)  # a row a leaf
    routed = index.where("asked > 0").select("h1", "h2", "embedding").mapInArrow(_assigner(trees, True), "h1 long, h2 long, embedding array<double>, leaves array<int>").select("h1", "h2", "embedding", F.explode("leaves").alias("leaf"))
    columns = ["leaf", "block", "is_query", "h1", "h2", "ids", "embedding"]
    queries = routed.join(sizes, "leaf").withColumns({"block": F.explode(F.expr("sequence(0, blocks - 1)")), "is_query": F.lit(1), "ids": F.lit(None).cast("array<long>")})
    stored = index.join(sizes, "leaf").withColumns({"block": F.expr("cast(pmod(xxhash64(h2), blocks) as int)"), "is_query": F.lit(0)})
    dealt = stored.select(*columns).unionByName(queries.select(*columns)).repartition("leaf", "block").sortWithinPartitions("leaf", "block", "is_query")
    found = dealt.mapInArrow(_searcher(k + 1), "h1 long, h2 long, vec_id long, score double, own boolean")
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    lists = found.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score", "own"))).alias("near"))
    lists = scratch.write(lists.join(index.where("asked > 0").select("h1", "h2", "asked"), ["h1", "h2"]), "lists")
    scratch.drop(index, blocks)
    # a vector may be that of very many queries
    asking = members.where("is_query").select("h1", "h2", F.col("vec_id").alias("query_id"))
    listed = hot_join(asking, lists, ["h1", "h2"], "asked")
    own = listed.select("query_id", F.col("h1").alias("query_class"), F.slice(F.filter("near", lambda e: ~(e["own"] & (e["vec_id"] == F.col("query_id")))), 1, k).alias("near"))
    return own.select("query_id", "query_class", F.posexplode("near").alias("i", "e")).select("query_id", (F.col("i") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score"), "query_class")
