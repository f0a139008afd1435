"""Tree ensembles grown from histograms of binned features.

A forest, boosted trees grown level by level with second-order gains, and boosted trees
grown best-first up to a number of leaves share one learner:

* **Cut points** of all features come from one aggregate of mergeable quantile summaries
  (``percentile_approx``; a cut's rank is off by 1 / ACCURACY of the rows at most). A value
  goes left of a cut if it is not above it.
* **Blocks** hold some thousand binned rows each (a byte a value) and are written to the
  shared folder once; every pass reads them.
* **Split search** needs the sums of residuals r and weights w a (tree, node, feature, bin).
  A split's gain is GL^2/(HL + l2) + GR^2/(HR + l2) - G^2/(H + l2), a node's value
  G/(H + l2). Of two siblings only the one with fewer rows is summed, the other is the
  parent's sums less these.
* **Best-first growth** takes the open node of the highest gain until the bound on leaves is
  met. Gains do not depend on the order, so a level's candidates can be opened together: the
  queue is simulated on the nodes known so far, what it takes is opened, and the simulation
  is repeated until it takes only known nodes. Other nodes are dropped.
* **Samples**: rows by a hash of their values, tree and seed (a forest draws Poisson(1) copies),
  columns once a tree. Equal rows are drawn together; a lost task repeats its draw.

Where the rows are dealt to many blocks, one job grows a level of all trees at hand: tasks sum
their blocks, partial sums are added by (tree, node), and the driver sees one best split a
node. Where all blocks together are below LOCAL_BYTES (checked before), they are broadcast and
the trees are dealt to tasks instead: the boosted trees of a model to one, a forest's in
groups. Both ways use the same functions and give the same trees, but for rounding.
"""
from __future__ import annotations

import heapq
import json
import math
import os
import uuid
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir, ship_package

BINS, ACCURACY = 64, 10_000
BLOCK_ROWS, LOCAL_BYTES = 1 << 14, 16 << 20
#: Trees of a forest that one task grows; nodes whose sums are held at once.
GROUP, NODES = 20, 128
#: Rounds of boosting after which the blocks take up their fitted values.
ROUNDS_KEPT = 8
#: Bytes of trees that are sent to the rows at once.
SENT_BYTES = 32 << 20


@dataclass(frozen=True)
class Spec:
    """What to grow. ``leaves`` 0: no bound. ``rows`` 0: Poisson(1) copies of each row, else
    the share of rows a tree sees. ``least``, ``split``: weight a child, a split node needs."""
    forest: bool
    trees: int
    depth: int
    leaves: int = 0
    rate: float = 1.0
    rows: float = 1.0
    cols: float = 1.0
    least: float = 1.0
    split: float = 2.0
    l2: float = 0.0
    seed: int = 0


# ------------------------------------------------------------------- bins
def cut_points(df: DataFrame, cols: list[str], bins: int = BINS, accuracy: int = ACCURACY) -> list[np.ndarray]:
    """At most ``bins`` - 1 ascending cuts of each column, all of them values that occur."""
    at = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), at, accuracy).alias(str(i))
                   for i, c in enumerate(cols)]).first()
    return [np.unique(np.array(v if v is not None else [], float)) for v in row]


class Layout:
    """Where the bins of each feature lie in a row of sums."""

    def __init__(self, cuts: list[np.ndarray]):
        self.cuts = cuts
        sizes = np.array([len(c) + 1 for c in cuts])
        self.start = np.cumsum(sizes) - sizes
        self.size = int(sizes.sum())
        self.feature = np.repeat(np.arange(len(cuts)), sizes)
        self.last = np.zeros(self.size, bool)
        self.last[self.start + sizes - 1] = True

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for j, cuts in enumerate(self.cuts):
            out[:, j] = np.searchsorted(cuts, x[:, j], "left")
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def row_keys(bins: np.ndarray, y: np.ndarray) -> np.ndarray:
    key = _mix(y.astype(np.float64).view(np.uint64))
    for j in range(bins.shape[1]):
        key = _mix(key + bins[:, j].astype(np.uint64) + np.uint64(j + 1))
    return key


BLOCKS = "n long, bins binary, y binary, fitted binary"


def blocks_of(df: DataFrame, cols: list[str], label: str, layout: Layout, rows: int = BLOCK_ROWS) -> DataFrame:
    """Binned rows in blocks, written to the shared folder."""
    def run(batches):
        for batch in batches:
            x = np.asarray(batch.column("x").flatten(), float).reshape(-1, len(cols))
            y = np.asarray(batch.column("y"), float)
            for at in range(0, len(y), rows):
                part = layout.bins(x[at:at + rows])
                yield pa.RecordBatch.from_pydict({"n": [len(part)], "bins": [part.tobytes()], "y": [y[at:at + rows].tobytes()], "fitted": [b""]})
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    return _stored(df.select(x.alias("x"), F.col(label).cast("double").alias("y")).filter("y is not null").mapInArrow(run, BLOCKS), "blocks")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = os.path.join(checkpoint_dir(df.sparkSession), f"trees-{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rows(row, width: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(row["bins"], np.uint8).reshape(-1, width), np.frombuffer(row["y"], np.float64))


# ----------------------------------------------------------------- samples
def drawn(spec: Spec, tree: int, keys: np.ndarray) -> np.ndarray:
    """Weights of rows in a tree's sample."""
    if spec.rows == 1.0:
        return np.ones(len(keys))
    with np.errstate(over="ignore"):
        salt = _mix(np.array([spec.seed * 1_000_003 + tree + 1], np.uint64))
        u = (_mix(keys + salt) >> np.uint64(11)) / 2.0**53
    if spec.rows > 0:
        return (u < spec.rows).astype(float)
    poisson = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
    return np.searchsorted(poisson, u, "right").astype(float)


def columns_of(spec: Spec, tree: int, width: int) -> np.ndarray:
    """Whether a tree may split on each feature."""
    take = max(1, int(spec.cols * width))
    out = np.zeros(width, bool)
    out[np.random.default_rng([spec.seed, tree]).permutation(width)[:take]] = True
    return out


# ------------------------------------------------------------------- splits
def sums(code: np.ndarray, node: np.ndarray, r: np.ndarray, w: np.ndarray, k: int, size: int) -> np.ndarray:
    """(2, k, size): residuals and weights by (node, feature, bin). ``code`` has the places of the bins."""
    at = (node[:, None] * size + code).ravel()
    width = code.shape[1]
    return np.stack([np.bincount(at, np.repeat(r * w, width), k * size),
                     np.bincount(at, np.repeat(w, width), k * size)]).reshape(2, k, size)


def best_splits(total: np.ndarray, layout: Layout, allowed: np.ndarray, spec: Spec) -> np.ndarray:
    """(k, 7): gain, feature, bin, residuals and weight on the left, of the node. Gain 0 where
    no split is any good; equal gains: the first feature and bin."""
    run = np.cumsum(total, axis=2)
    before = np.where(layout.start > 0, run[:, :, layout.start - 1], 0.0)
    left = run - before[:, :, layout.feature]
    whole = run[:, :, np.flatnonzero(layout.last)[0]]  # any feature's bins hold all rows
    right = whole[:, :, None] - left
    (gl, hl), (gr, hr), (g, h) = left, right, whole
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = gl * gl / (hl + spec.l2) + gr * gr / (hr + spec.l2)
        good = (hl >= spec.least) & (hr >= spec.least) & (hl > 0) & (hr > 0) & ~layout.last & allowed[layout.feature]
        parts = np.where(good, parts, -np.inf)
        best = parts.argmax(axis=1)
        rows = np.arange(len(best))
        top = parts[rows, best]
        gain = top - g * g / (h + spec.l2)
        gain = np.where((h >= spec.split) & (gain > 1e-10 * np.abs(top)), gain, 0.0)
    gain[~np.isfinite(gain)] = 0.0
    f = layout.feature[best]
    return np.stack([gain, f, best - layout.start[f], gl[rows, best], hl[rows, best], g, h], 1)


class Grower:
    """The nodes of a tree and which of them to open next."""

    def __init__(self, spec: Spec, root: np.ndarray):
        self.spec = spec
        self.best, self.depth, self.path, self.left = [root], [0], [1], [-1]

    def open(self, i: int) -> bool:
        return self.best[i][0] > 0 and self.depth[i] < self.spec.depth

    def taken(self) -> list[int]:
        """Nodes that are split, as far as nodes are known."""
        if not self.spec.leaves:
            return [i for i in range(len(self.best)) if self.open(i)]
        queue, out = [(-self.best[0][0], 1, 0)], []
        while queue and len(out) < self.spec.leaves - 1:
            _, _, i = heapq.heappop(queue)
            if not self.open(i):
                continue
            out.append(i)
            if self.left[i] >= 0:
                for c in (self.left[i], self.left[i] + 1):
                    heapq.heappush(queue, (-self.best[c][0], self.path[c], c))
        return out

    def wanted(self) -> list[int]:
        return [i for i in self.taken() if self.left[i] < 0]

    def needs_sums(self, i: int) -> bool:
        """Whether a new node could be split at all."""
        h = self.best[i][6]
        return self.depth[i] < self.spec.depth and h >= max(self.spec.split, 2 * self.spec.least)

    def split(self, i: int) -> int:
        """Two children, whose own best splits are not known yet; the number of the left one."""
        gain, f, b, gl, hl, g, h = self.best[i]
        self.left[i] = n = len(self.best)
        for side, (x, y) in enumerate(((gl, hl), (g - gl, h - hl))):
            self.best.append(np.array([0.0, 0, 0, 0, 0, x, y]))
            self.depth.append(self.depth[i] + 1)
            self.path.append(2 * self.path[i] + side)
            self.left.append(-1)
        return n

    def tree(self, layout: Layout) -> tuple[dict, np.ndarray]:
        """Columns of the tree's nodes, and the new number of each node (-1: dropped)."""
        split = set(self.taken())
        keep, number = [0], {0: 0}
        for i in keep:
            if i in split:
                for c in (self.left[i], self.left[i] + 1):
                    number[c] = len(keep)
                    keep.append(c)
        best = np.array([self.best[i] for i in keep])
        inner = np.array([i in split for i in keep])
        f = np.where(inner, best[:, 1], -1).astype(np.int32)
        out = {"feature": f, "bin": np.where(inner, best[:, 2], 0).astype(np.int32),
               "threshold": np.array([layout.cuts[a][int(b)] if a >= 0 else 0.0 for a, b in zip(f, best[:, 2])]),
               "left": np.array([number[self.left[i]] if s else -1 for i, s in zip(keep, inner)], np.int32),
               "value": best[:, 5] / np.maximum(best[:, 6] + self.spec.l2, 1e-300),
               "gain": np.where(inner, best[:, 0], 0.0), "cover": best[:, 6]}
        return out, np.array([number.get(i, -1) for i in range(len(self.best))])


def leaves_of(tree: dict, bins: np.ndarray, depth: int = 1 << 30, split: float = 0.0) -> np.ndarray:
    """Node that each binned row ends in, also of the tree cut at a depth or a node weight."""
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    for _ in range(depth):
        f = tree["feature"][node[rows]]
        go = (f >= 0) & (tree["cover"][node[rows]] >= split)
        rows, f = rows[go], f[go]
        if not len(rows):
            break
        at = node[rows]
        node[rows] = tree["left"][at] + (bins[rows, f] > tree["bin"][at])
    return node


def grow(spec: Spec, code: np.ndarray, bins: np.ndarray, r: np.ndarray, w: np.ndarray, layout: Layout, allowed: np.ndarray) -> dict:
    """One tree on rows in memory."""
    own = np.flatnonzero(w > 0)
    code, bins, r, w = code[own], bins[own], r[own], w[own]
    node = np.zeros(len(own), np.int64)
    held = {0: sums(code, node, r, w, 1, layout.size)[:, 0]}
    grower = Grower(spec, best_splits(held[0][:, None], layout, allowed, spec)[0])
    rows_of = {0: np.arange(len(own))}
    while todo := grower.wanted():
        for at in range(0, len(todo), NODES):
            part, small, large = todo[at:at + NODES], [], []
            for i in part:
                rows, (_, f, b, *_) = rows_of.pop(i), grower.best[i]
                right = bins[rows, int(f)] > b
                n = grower.split(i)
                rows_of[n], rows_of[n + 1] = rows[~right], rows[right]
                if grower.needs_sums(n) or grower.needs_sums(n + 1):
                    few = n if len(rows_of[n]) <= len(rows_of[n + 1]) else n + 1
                    small.append(few)
                    large.append((i, 2 * n + 1 - few))
                else:
                    held.pop(i)
            if not small:
                continue
            rows = np.concatenate([rows_of[i] for i in small])
            group = np.repeat(np.arange(len(small)), [len(rows_of[i]) for i in small])
            total = sums(code[rows], group, r[rows], w[rows], len(small), layout.size)
            rest = np.stack([held.pop(i) for i, _ in large], 1) - total
            for nodes, t in ((small, total), ([i for _, i in large], rest)):
                for i, split in zip(nodes, best_splits(t, layout, allowed, spec)):
                    if grower.needs_sums(i):
                        grower.best[i][:5] = split[:5]  # the node's own sums stay those of the split above
                for j, i in enumerate(nodes):
                    if grower.open(i):
                        held[i] = t[:, j]
    return grower.tree(layout)[0]


# ------------------------------------------------------- trees dealt to tasks
class Rows:
    """All binned rows in memory, in an order that does not depend on their blocks."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], width: int, layout: Layout):
        bins = np.concatenate([b for b, _ in parts]) if parts else np.zeros((0, width), np.uint8)
        y = np.concatenate([y for _, y in parts]) if parts else np.zeros(0)
        keys = row_keys(bins, y)
        order = np.lexsort((y, keys))
        self.bins, self.y, self.keys = bins[order], y[order], keys[order]
        self.code = self.bins.astype(np.int32) + layout.start.astype(np.int32)


def trees_in_memory(spec: Spec, rows: Rows, layout: Layout, base: float, first: int, last: int):
    """Trees ``first`` to ``last`` of a model (of boosted ones: all)."""
    fitted = np.zeros(len(rows.y))
    for tree in range(first, last):
        r = rows.y - base - fitted
        grown = grow(spec, rows.code, rows.bins, r, drawn(spec, tree, rows.keys), layout, columns_of(spec, tree, len(layout.cuts)))
        yield tree, grown
        if not spec.forest:
            fitted = fitted + spec.rate * grown["value"][leaves_of(grown, rows.bins)]


NODE_ARRAYS = {"feature": "int", "bin": "int", "threshold": "double", "left": "int", "value": "double", "gain": "double", "cover": "double"}
TREES = "model int, tree int, " + ", ".join(f"{n} array<{t}>" for n, t in NODE_ARRAYS.items())
_ARROW = {"int": pa.int32(), "double": pa.float64()}


def _tree_batch(rows: list[tuple[int, int, dict]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "model": pa.array([m for m, _, _ in rows], pa.int32()), "tree": pa.array([t for _, t, _ in rows], pa.int32()),
        **{n: pa.array([g[n] for _, _, g in rows], pa.list_(_ARROW[t])) for n, t in NODE_ARRAYS.items()}})


def _units(specs: list[Spec]) -> list[tuple[int, int, int]]:
    """(model, first tree, last tree) of each task."""
    return [(i, a, min(a + GROUP, s.trees) if s.forest else s.trees)
            for i, s in enumerate(specs) for a in (range(0, s.trees, GROUP) if s.forest else [0])]


def _dealt(spark: SparkSession, units: list[tuple[int, int, int]]) -> DataFrame:
    """(id): a partition a unit."""
    return spark.range(0, len(units), 1, max(1, len(units)))


def _in_memory(blocks: DataFrame, width: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """The blocks, if they are few enough to be sent to every task."""
    size = blocks.agg(F.sum(F.octet_length("bins") + F.octet_length("y"))).first()[0] or 0
    return [_rows(r, width) for r in blocks.collect()] if size <= LOCAL_BYTES else None


# ------------------------------------------------------------- rows dealt to tasks
def _fitted(row: dict, bins: np.ndarray, specs: list[Spec], past: list[list[dict]]) -> np.ndarray:
    """(models, rows): what the boosted trees so far add up to; ``past`` has those that are not
    in the block yet."""
    old = np.frombuffer(row["fitted"], np.float64)
    out = old.reshape(len(specs), -1).copy() if len(old) else np.zeros((len(specs), len(bins)))
    for m, spec in enumerate(specs):
        for tree in past[m]:
            out[m] += spec.rate * tree["value"][leaves_of(tree, bins)]
    return out


def _advanced(blocks: DataFrame, layout: Layout, specs: list[Spec], past: list[list[dict]]) -> DataFrame:
    """The blocks with the trees of ``past`` in their fitted values."""
    width = len(layout.cuts)
    sent = blocks.sparkSession.sparkContext.broadcast((specs, past))

    def run(batches):
        for batch in batches:
            new = [_fitted(r, _rows(r, width)[0], *sent.value).tobytes() for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(new, pa.binary())], batch.schema.names)
    return _stored(blocks.mapInArrow(run, BLOCKS), "blocks")


def _level(blocks: DataFrame, layout: Layout, specs: list[Spec], jobs: list[tuple[int, int, dict, list]], past: list[list[dict]],
           base: float) -> DataFrame:
    """(job, node, total binary): sums of the nodes that each job asks for. A job is (model,
    tree, nodes so far, asked nodes); residuals follow from the fitted values."""
    width = len(layout.cuts)
    sent = blocks.sparkSession.sparkContext.broadcast((layout, specs, jobs, past, base))

    def run(batches):
        layout, specs, jobs, past, base = sent.value
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                bins, y = _rows(row, width)
                code, keys = bins.astype(np.int64) + layout.start, row_keys(bins, y)
                fitted = _fitted(row, bins, specs, past)
                for j, (m, t, nodes, asked) in enumerate(jobs):
                    spec = specs[m]
                    w = drawn(spec, t, keys)
                    at = leaves_of(nodes, bins)
                    number = np.full(len(nodes["feature"]), -1)
                    number[asked] = np.arange(len(asked))
                    own = np.flatnonzero((number[at] >= 0) & (w > 0))
                    got = sums(code[own], number[at[own]], y[own] - base - fitted[m][own], w[own], len(asked), layout.size)
                    for k, i in enumerate(asked):
                        held[j, i] = held[j, i] + got[:, k] if (j, i) in held else got[:, k]
        keys = list(held)
        yield pa.RecordBatch.from_pydict({"job": pa.array([j for j, _ in keys], pa.int32()), "node": pa.array([i for _, i in keys], pa.int32()),
                                          "total": pa.array([held[k].tobytes() for k in keys], pa.binary())})

    def add(part: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(b, np.float64) for b in part.column("total").to_pylist()], axis=0)
        return pa.table({"job": part.column("job").slice(0, 1), "node": part.column("node").slice(0, 1), "total": [total.tobytes()]})
    schema = "job int, node int, total binary"
    return blocks.mapInArrow(run, schema).groupBy("job", "node").applyInArrow(add, schema)


def _searched(total: DataFrame, layout: Layout, specs: list[Spec], jobs: list[tuple[int, int, dict, list]], parents: DataFrame | None,
              pairs: dict[tuple[int, int], tuple[int, int]]) -> DataFrame:
    """(job, node, total, split array): the asked nodes with their best splits, and their
    siblings, whose sums are the parents' less theirs."""
    sent = total.sparkSession.sparkContext.broadcast((layout, specs, [(m, t) for m, t, _, _ in jobs], pairs))

    def run(part: pa.Table) -> pa.Table:
        layout, specs, jobs, pairs = sent.value
        job = part.column("job")[0].as_py()
        m, t = jobs[job]
        allowed = columns_of(specs[m], t, len(layout.cuts))
        held = {(r["kind"], r["node"]): np.frombuffer(r["total"], np.float64).reshape(2, -1) for r in part.to_pylist()}
        out = []
        for (kind, i), own in held.items():
            if kind == 0:
                out.append((i, own))
                if (job, i) in pairs:
                    parent, other = pairs[job, i]
                    out.append((other, held[1, parent] - own))
        splits = best_splits(np.stack([x for _, x in out], 1), layout, allowed, specs[m]) if out else []
        return pa.table({"job": pa.array([job] * len(out), pa.int32()), "node": pa.array([i for i, _ in out], pa.int32()),
                         "total": pa.array([x.tobytes() for _, x in out], pa.binary()),
                         "split": pa.array([s.tolist() for s in splits], pa.list_(pa.float64()))})
    # nodes meet their parents' sums by (job, parent)
    family = [(j, i, pairs[j, i][0] if (j, i) in pairs else i) for j, (*_, asked) in enumerate(jobs) for i in asked]
    mapping = total.sparkSession.createDataFrame(family, "job int, node int, parent int")
    rows = total.join(F.broadcast(mapping), ["job", "node"]).withColumn("kind", F.lit(0))
    if parents is not None and pairs:
        rows = rows.unionByName(parents.select("job", "node", "total").withColumn("parent", F.col("node")).withColumn("kind", F.lit(1)))
    return rows.groupBy("job", "parent").applyInArrow(run, "job int, node int, total binary, split array<double>")


def _grow_by_levels(blocks: DataFrame, layout: Layout, specs: list[Spec], wanted: list[tuple[int, int]], past: list[list[dict]],
                    base: float) -> list[dict]:
    """The trees (model, tree), a job a level of all of them."""
    empty = {n: np.zeros(1, np.int32 if t == "int" else float) for n, t in NODE_ARRAYS.items()}
    empty["feature"] = np.full(1, -1, np.int32)
    jobs = [(m, t, empty, [0]) for m, t in wanted]
    growers: list[Grower | None] = [None] * len(jobs)
    state, pairs = None, {}
    while any(asked for *_, asked in jobs):
        found = _searched(_level(blocks, layout, specs, jobs, past, base), layout, specs, jobs, state, pairs)
        found = _stored(found, "sums")
        for r in found.select("job", "node", "split").collect():  # one split a node
            if growers[r["job"]] is None:
                growers[r["job"]] = Grower(specs[jobs[r["job"]][0]], np.array(r["split"]))
            elif growers[r["job"]].needs_sums(r["node"]):
                growers[r["job"]].best[r["node"]][:5] = r["split"][:5]
        state = found if state is None else state.unionByName(found)
        pairs, keep = {}, set()  # sums that the next levels subtract from
        for j, (m, t, _, _) in enumerate(jobs):
            grower, asked = growers[j], []
            for i in grower.wanted() if grower else ():
                n = grower.split(i)
                few = n if grower.best[n][6] <= grower.best[n + 1][6] else n + 1
                if grower.needs_sums(n) or grower.needs_sums(n + 1):
                    asked.append(few)
                    pairs[j, few] = (i, 2 * n + 1 - few)
                    keep.add((j, i))
            keep |= {(j, i) for i in range(len(grower.best)) if grower.left[i] < 0 and grower.open(i)} if grower else set()
            best = np.array(grower.best) if grower else np.zeros((1, 7))
            opened = np.array([x >= 0 for x in grower.left]) if grower else np.zeros(1, bool)
            nodes = {**{n: np.zeros(len(best)) for n in NODE_ARRAYS}, "feature": np.where(opened, best[:, 1], -1).astype(np.int32),
                     "bin": best[:, 2].astype(np.int32), "left": np.array(grower.left if grower else [-1], np.int32), "cover": np.full(len(best), 1.0)}
            jobs[j] = (m, t, nodes, asked)
        if any(asked for *_, asked in jobs):
            held = blocks.sparkSession.createDataFrame(sorted(keep), "job int, node int")
            state = _stored(state.join(F.broadcast(held), ["job", "node"], "left_semi"), "parents")
    # a row sample without rows gives a tree of one leaf
    none = np.zeros(7)
    return [(g or Grower(specs[m], none)).tree(layout)[0] for g, (m, *_) in zip(growers, jobs)]


def _trees_by_levels(blocks: DataFrame, layout: Layout, specs: list[Spec], base: float, at_once: int = 16):
    """All trees: boosted ones round by round (one of each model), a forest's some at a time."""
    done: list[list[dict]] = [[] for _ in specs]
    recent: list[list[dict]] = [[] for _ in specs]
    boosted = [i for i, s in enumerate(specs) if not s.forest]
    for t in range(max([specs[i].trees for i in boosted], default=0)):
        wanted = [(i, t) for i in boosted if t < specs[i].trees]
        for (i, _), tree in zip(wanted, _grow_by_levels(blocks, layout, specs, wanted, recent, base)):
            done[i].append(tree)
            recent[i].append(tree)
        if t % ROUNDS_KEPT == ROUNDS_KEPT - 1:
            blocks, recent = _advanced(blocks, layout, specs, recent), [[] for _ in specs]
    wanted = [(i, t) for i, s in enumerate(specs) if s.forest for t in range(s.trees)]
    for at in range(0, len(wanted), at_once):
        part = wanted[at:at + at_once]
        for (i, _), tree in zip(part, _grow_by_levels(blocks, layout, specs, part, [[] for _ in specs], base)):
            done[i].append(tree)
    return [(i, t, tree) for i, trees in enumerate(done) for t, tree in enumerate(trees)]


# -------------------------------------------------------------------- models
@dataclass
class TreeModel:
    """A fitted ensemble: its nodes as a table, one row a tree."""
    spec: Spec
    features: list[str]
    base: float
    trees: DataFrame

    def transform(self, df: DataFrame, pred: str = "pred") -> DataFrame:
        """``df`` with the predictions. Null features: null prediction. Trees are sent some at a time."""
        spark = df.sparkSession
        ship_package(spark)
        weight = 1.0 / max(1, self.spec.trees) if self.spec.forest else self.spec.rate
        sizes = self.trees.select("tree", (24 * F.size("feature")).alias("b")).collect()  # one row a tree
        groups, room = [], 0
        for r in sorted(sizes):
            if not groups or room + r["b"] > SENT_BYTES:
                groups.append([])
                room = 0
            groups[-1].append(r["tree"])
            room += r["b"]
        x = F.array(*[F.col(f"`{c}`").cast("double") for c in self.features])
        out = df.withColumn("_x", x).withColumn(pred, F.lit(float(self.base)).cast("double"))
        names = out.columns
        for group in groups or [[]]:
            rows = self.trees.filter(F.col("tree").between(group[0], group[-1])).orderBy("tree").collect() if group else []
            sent = spark.sparkContext.broadcast([{n: np.array(r[n], np.int32 if t == "int" else float)
                                                  for n, t in NODE_ARRAYS.items() if n in ("feature", "threshold", "left", "value")} for r in rows])

            def run(batches, sent=sent):
                for batch in batches:
                    x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
                    add = np.zeros(len(x))
                    for tree in sent.value:
                        add += tree["value"][walk(tree, x)]
                    old = batch.column(pred).to_numpy(zero_copy_only=False).astype(float)
                    new = np.where(np.isnan(x).any(axis=1), np.nan, old + weight * add)
                    arrays = [pa.array(new, pa.float64(), from_pandas=True) if n == pred else batch.column(n) for n in names]
                    yield pa.RecordBatch.from_arrays(arrays, names)
            out = out.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema]))
        return out.drop("_x")

    def importances(self) -> np.ndarray:
        """Share of the gain of each feature; best-first trees: of the number of splits."""
        used = self.trees.select(F.explode(F.arrays_zip("feature", "gain")).alias("s")).filter("s.feature >= 0")
        amount = F.count(F.lit(1)) if self.spec.leaves else F.sum("s.gain")
        if not self.spec.leaves and not self.spec.forest:
            amount = F.avg("s.gain")
        out = np.zeros(len(self.features))
        for r in used.groupBy("s.feature").agg(amount.cast("double").alias("a")).collect():
            out[r["feature"]] = r["a"]
        return out / out.sum() if out.sum() else out

    def save(self, path: str) -> None:
        self.trees.write.mode("overwrite").parquet(os.path.join(path, "trees"))
        about = json.dumps({"spec": asdict(self.spec), "features": self.features, "base": self.base})
        spark = self.trees.sparkSession
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(path, "about"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeModel":
        about = json.loads(spark.read.text(os.path.join(path, "about")).first()[0])
        trees = spark.read.schema(TREES).parquet(os.path.join(path, "trees"))
        return TreeModel(Spec(**about["spec"]), about["features"], about["base"], trees)


def walk(tree: dict, x: np.ndarray) -> np.ndarray:
    """Node that each row of values ends in."""
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(rows):
        f = tree["feature"][node[rows]]
        rows, f = rows[f >= 0], f[f >= 0]
        at = node[rows]
        node[rows] = tree["left"][at] + ~(x[rows, f] <= tree["threshold"][at])
    return node


def fit_all(df: DataFrame, cols: list[str], label: str, specs: list[Spec], bins: int = BINS, rows: int = BLOCK_ROWS) -> list[TreeModel]:
    """An ensemble of each of ``specs``, all grown at once; rows with a null label are left out."""
    spark = df.sparkSession
    ship_package(spark)
    df = df.filter(F.col(label).isNotNull())
    layout = Layout(cut_points(df, cols, bins))
    blocks = blocks_of(df, cols, label, layout, rows)
    base = float(df.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0)
    parts = _in_memory(blocks, len(cols))
    if parts is not None:
        sent = spark.sparkContext.broadcast(Rows(parts, len(cols), layout))
        units = sorted(_units(specs), key=lambda u: -(u[2] - u[1]) * specs[u[0]].depth)  # long tasks first

        def run(batches):
            for batch in batches:
                for i in batch.column("id").to_pylist():
                    m, first, last = units[i]
                    yield _tree_batch([(m, t, g) for t, g in trees_in_memory(specs[m], sent.value, layout, base, first, last)])
        trees = _dealt(spark, units).mapInArrow(run, TREES)
    else:
        trees = spark.createDataFrame(pa.Table.from_batches([_tree_batch(_trees_by_levels(blocks, layout, specs, base))]))
    trees = _stored(trees, "model")
    return [TreeModel(s, list(cols), base, trees.filter(F.col("model") == i)) for i, s in enumerate(specs)]


def fit(df: DataFrame, cols: list[str], label: str, spec: Spec, bins: int = BINS, rows: int = BLOCK_ROWS) -> TreeModel:
    """One ensemble."""
    return fit_all(df, cols, label, [spec], bins, rows)[0]


def search(train: DataFrame, tune: DataFrame, cols: list[str], label: str, specs: list[Spec], bins: int = BINS,
           rows: int = BLOCK_ROWS) -> list[float | None]:
    """WMAPE on ``tune`` of every candidate fitted with all its trees on ``train``; all
    candidates at once. Forests that differ in number, depth and node size to split only are
    cut from the same trees: a tree cut at a depth or a weight is the one grown to it."""
    spark = train.sparkSession
    ship_package(spark)
    train, tune = (df.filter(F.col(label).isNotNull()) for df in (train, tune))
    layout = Layout(cut_points(train, cols, bins))
    base = float(train.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0)
    blocks, asked = blocks_of(train, cols, label, layout, rows), blocks_of(tune, cols, label, layout, rows)
    grown, members = [], []  # what to grow, and the candidates cut from each
    for i, s in enumerate(specs):
        like = replace(s, trees=0, depth=0, split=0.0) if s.forest else None
        same = [k for k, g in enumerate(grown) if like is not None and g.forest and replace(g, trees=0, depth=0, split=0.0) == like]
        if same:
            g = grown[same[0]]
            grown[same[0]] = replace(g, trees=max(g.trees, s.trees), depth=max(g.depth, s.depth), split=min(g.split, s.split))
            members[same[0]].append(i)
        else:
            grown.append(s)
            members.append([i])
    width = len(cols)

    def add_predictions(out: dict, m: int, t: int, tree: dict, bins_of: np.ndarray) -> None:
        for i in members[m]:
            s = specs[i]
            if t < s.trees:
                value = tree["value"][leaves_of(tree, bins_of, s.depth if s.forest else 1 << 30, s.split if s.forest else 0.0)]
                out[i] = out.get(i, 0.0) + value * (1.0 / s.trees if s.forest else s.rate)
    parts, own = _in_memory(blocks, width), _in_memory(asked, width)
    if parts is not None and own is not None:
        sent = spark.sparkContext.broadcast((Rows(parts, width, layout), Rows(own, width, layout)))

        def run(batches):
            data, other = sent.value
            for batch in batches:
                for i in batch.column("id").to_pylist():
                    out: dict[int, np.ndarray] = {}
                    m, first, last = units[i]
                    for t, tree in trees_in_memory(grown[m], data, layout, base, first, last):
                        add_predictions(out, m, t, tree, other.bins)
                    yield pa.RecordBatch.from_pydict({"trial": pa.array(list(out), pa.int32()),
                                                      "part": pa.array([p.tobytes() for p in out.values()], pa.binary())})

        def judge(part: pa.Table) -> pa.Table:
            y = sent.value[1].y
            p = base + np.sum([np.frombuffer(b, np.float64) for b in part.column("part").to_pylist()], axis=0)
            return pa.table({"trial": part.column("trial").slice(0, 1), "error": [float(np.abs(y - p).sum())], "actual": [float(y.sum())]})
        units = sorted(_units(grown), key=lambda u: -(u[2] - u[1]) * grown[u[0]].depth)
        scores = (_dealt(spark, units).mapInArrow(run, "trial int, part binary").groupBy("trial")
                  .applyInArrow(judge, "trial int, error double, actual double"))
    else:
        trees = _trees_by_levels(blocks, layout, grown, base)
        sent = spark.sparkContext.broadcast(trees)

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    bins_of, y = _rows(row, width)
                    out: dict[int, np.ndarray] = {}
                    for m, t, tree in sent.value:
                        add_predictions(out, m, t, tree, bins_of)
                    yield pa.RecordBatch.from_pydict({
                        "trial": pa.array(list(out), pa.int32()), "error": [float(np.abs(y - base - p).sum()) for p in out.values()],
                        "actual": [float(y.sum())] * len(out)})
        scores = asked.mapInArrow(run, "trial int, error double, actual double").groupBy("trial").agg(
            F.sum("error").alias("error"), F.sum("actual").alias("actual"))
    got = {r["trial"]: 100 * r["error"] / r["actual"] if r["actual"] else None for r in scores.collect()}
    return [got.get(i) for i in range(len(specs))]
