"""Boosted trees of many models in the same Spark jobs: level by level, from histograms.

A model's training rows are numbers of bins (0 for a missing value, then 1.. by the borders), packed into
blocks of at most ``block_rows`` rows of one model group, a row of ``blocks`` each.  A tree grows one level a
job, whatever the number of models: every task adds the gradients of its blocks by (model, head, node, feature, bin),
the sums of a model meet in one task (one partial sum a task and model, not one a row), which picks the
best split, and only the split and the sums on its two sides, a few numbers a node, reach the driver.  The
driver holds the trees, which parameters bound, and no data.  Scores are kept with the blocks and
written to the shared checkpoint folder every ``refresh`` trees, so a lost executor repeats one job and at most so many trees.
A group of one block has nothing to add up: its task grows ``refresh`` trees a job by the same steps.

Each group is fitted twice in the same jobs: on its training rows, which the validation rows stop after
``patience`` trees without gain, and on both.  A boosted model's first k trees do not depend on the later ones, so the
second fit cut to the best number of the first is the refit.

Two kinds of model:

* ``squared``: one head, the mean; trees are symmetric (one split a level for all nodes).
* ``crps``: two heads, mean and log standard deviation, moved along the natural gradient of the closed-form
  Gaussian CRPS; every node has its own split.  Validation is by mean CRPS.
"""

from __future__ import annotations

import dataclasses
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import cut_lineage

FIT, BOTH = 0, 1          # the two fits of a group: training rows; training and validation rows
TRAIN, VALID = 1, 2       # ``part`` of a row
SQRT_PI = math.sqrt(math.pi)
TIE = 1e-9


@dataclasses.dataclass(frozen=True)
class BoostParams:
    kind: str = "squared"
    trees: int = 1000
    depth: int = 6
    rate: float = 0.1
    patience: int = 50
    l2: float = 3.0            # added to a leaf's row count
    bins: int = 32
    min_rows: int = 1          # on each side of a split
    refresh: int = 25          # trees between two checkpoints of the scores
    block_rows: int = 65_536

    @property
    def heads(self) -> int:
        return 1 if self.kind == "squared" else 2

    @property
    def symmetric(self) -> bool:
        return self.kind == "squared"


@dataclasses.dataclass
class Tree:
    """Splits level by level (feature -1: everything goes left) and the leaves' values."""

    feature: list[np.ndarray] = dataclasses.field(default_factory=list)
    bin: list[np.ndarray] = dataclasses.field(default_factory=list)
    leaf: np.ndarray | None = None

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The node of every row after the levels so far; ``x`` are bins, rows by features."""
        at, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        for f, b in zip(self.feature, self.bin, strict=True):
            right = (f[at] >= 0) & (x[rows, np.maximum(f[at], 0)] > b[at])
            at = 2 * at + right
        return at

    def value(self, x: np.ndarray) -> np.ndarray:
        return self.leaf[self.nodes(x)]

    def split(self, feature, cut) -> None:
        self.feature.append(np.asarray(feature, dtype=np.int64))
        self.bin.append(np.asarray(cut, dtype=np.int64))

    def finish(self, left_s, left_n, right_s, right_n, p: "BoostParams") -> None:
        """Leaf values from the sums and counts on both sides of the last level."""
        s, n = np.stack([left_s, right_s], axis=1).ravel(), np.stack([left_n, right_n], axis=1).ravel()
        self.leaf = p.rate * s / np.maximum(n + p.l2, 1e-12)


def normal_pdf(z: np.ndarray) -> np.ndarray:
    return np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)


def normal_cdf(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _erf(z / math.sqrt(2)))


_erf = np.vectorize(math.erf, otypes=[float])


def crps(y: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """Closed-form CRPS of a normal forecast."""
    z = (y - mean) / sd
    return sd * (z * (2 * normal_cdf(z) - 1) + 2 * normal_pdf(z) - 1 / SQRT_PI)


def gradients(kind: str, y: np.ndarray, score: np.ndarray) -> np.ndarray:
    """What the trees of every head are fitted to (heads by rows)."""
    if kind == "squared":
        return (y - score[0])[None]
    sd = np.exp(score[1])
    z = (y - score[0]) / sd
    # the CRPS's gradient in (mean, log sd) times the inverse of its metric, diag(1 / (sd sqrt(pi)), sd / (2 sqrt(pi)))
    return np.stack([sd * SQRT_PI * (2 * normal_cdf(z) - 1), 2 - 4 * SQRT_PI * normal_pdf(z)])


def loss(kind: str, y: np.ndarray, score: np.ndarray) -> np.ndarray:
    return (y - score[0]) ** 2 if kind == "squared" else crps(y, score[0], np.exp(score[1]))


def best_splits(sums: np.ndarray, counts: np.ndarray, p: BoostParams) -> tuple[np.ndarray, ...]:
    """Per node the feature and bin to split at, and the sums and counts left and right; ``sums`` is features x nodes x bins.

    Ties go to the smallest feature, then the smallest bin; gains this close (``TIE``) differ by the order of summation only.
    A node without a gain sends everything left.
    """
    left_s, left_n = np.cumsum(sums, axis=2), np.cumsum(counts, axis=2)
    all_s, all_n = left_s[:, :, -1:], left_n[:, :, -1:]
    right_s, right_n = all_s - left_s, all_n - left_n
    gain = _gain(left_s, left_n, p) + _gain(right_s, right_n, p) - _gain(all_s, all_n, p)
    open_ = (left_n >= p.min_rows) & (right_n >= p.min_rows)
    gain = np.where(open_, gain, 0.0)
    nodes, bins = gain.shape[1:]
    flat = gain.sum(axis=1).reshape(1, -1) if p.symmetric else gain.transpose(1, 0, 2).reshape(nodes, -1)
    most = flat.max(axis=1)
    at = (flat >= (most * (1 - TIE))[:, None]).argmax(axis=1)
    if p.symmetric:
        at, most = np.repeat(at, nodes), np.repeat(most, nodes)
    feature, cut, useful = at // bins, at % bins, most > 1e-12
    pick = (np.where(useful, feature, 0), np.arange(nodes), np.where(useful, cut, bins - 1))
    return (np.where(useful, feature, -1), np.where(useful, cut, 0), left_s[pick], left_n[pick], right_s[pick], right_n[pick])


def _gain(s: np.ndarray, n: np.ndarray, p: BoostParams) -> np.ndarray:
    return s * s / np.maximum(n + p.l2, 1e-12)


BLOCKS = "grp int, rows int, width int, x binary, y binary, part binary, score binary"
_BLOCK_SCHEMA = pa.schema([("grp", pa.int32()), ("rows", pa.int32()), ("width", pa.int32()), ("x", pa.binary()), ("y", pa.binary()),
                           ("part", pa.binary()), ("score", pa.binary())])


def make_blocks(samples: DataFrame, start: dict[tuple[int, int], tuple[float, ...]], p: BoostParams, salts: int, tasks: int) -> DataFrame:
    """``samples(grp, part, y, x)`` with a label as blocks; scores begin at ``start`` per (group, fit).

    A group is dealt over ``salts`` places by its rows' hash, so that a task holds about a block of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grp, xs, ys, parts = None, [], [], []

        def block():
            n = len(ys)
            score = np.repeat(np.array([start.get((grp, fit), (0.0,) * p.heads) for fit in (FIT, BOTH)], dtype=float)[:, :, None], n, axis=2)
            return _batch([(grp, n, len(xs[0]), b"".join(xs), np.array(ys, dtype=float).tobytes(), bytes(parts), score.tobytes())], _BLOCK_SCHEMA)

        for b in batches:
            for g, part, y, x in zip(*(b.column(c).to_pylist() for c in ("grp", "part", "y", "x")), strict=True):
                if ys and (g != grp or len(ys) >= p.block_rows):
                    yield block()
                    xs, ys, parts = [], [], []
                grp = g
                xs.append(x)
                ys.append(y)
                parts.append(part)
        if ys:
            yield block()

    rows = samples.where(F.col("y").isNotNull() & F.col("part").isin(TRAIN, VALID)).select("grp", "part", "y", "x")
    rows = rows.repartition(tasks, "grp", F.pmod(F.xxhash64("x", "y"), F.lit(salts)))
    return rows.sortWithinPartitions("grp").mapInArrow(run, BLOCKS)


class _Block:
    def __init__(self, row: dict, p: BoostParams):
        n = row["rows"]
        self.grp, self.n = row["grp"], n
        self.x = np.frombuffer(row["x"], dtype=np.uint8).reshape(n, row["width"])
        self.y = np.frombuffer(row["y"])
        self.part = np.frombuffer(row["part"], dtype=np.uint8)
        self.score = np.frombuffer(row["score"]).reshape(2, p.heads, n).copy()

    def add(self, trees: dict) -> None:
        for fit in (FIT, BOTH):
            for grown in trees.get((self.grp, fit), ()):
                for head, tree in enumerate(grown):
                    self.score[fit, head] += tree.value(self.x)

    def cells(self, step: int) -> np.ndarray:
        """Bins of all features side by side, ``step`` numbers apart."""
        return (np.arange(self.x.shape[1]) * step)[None, :] + self.x

    def mask(self, fit: int) -> np.ndarray:
        return self.part == TRAIN if fit == FIT else slice(None)


def _unpack(batches: Iterator[pa.RecordBatch], p: BoostParams, groups: set[int] | None = None) -> Iterator[tuple[dict, _Block]]:
    for b in batches:
        for row in b.to_pylist():
            if groups is None or row["grp"] in groups:
                yield row, _Block(row, p)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_SUMS = "grp int, fit int, head int, width int, sums binary, counts binary"
_SUMS_SCHEMA = pa.schema([("grp", pa.int32()), ("fit", pa.int32()), ("head", pa.int32()), ("width", pa.int32()), ("sums", pa.binary()), ("counts", pa.binary())])
LOSS = -1                      # as head: the validation loss


def _level_sums(k: _Block, fit: int, head: int, g: np.ndarray, tree: Tree, level: int, p: BoostParams) -> tuple[np.ndarray, np.ndarray]:
    """Gradient sums and row counts of a block by (feature, node, bin), flat."""
    nodes, bins, width = 1 << level, p.bins + 1, k.x.shape[1]
    m = k.mask(fit)
    at = k.cells(nodes * bins)[m]
    if level:
        at = at + (tree.nodes(k.x[m]) * bins)[:, None]
    size = width * nodes * bins
    return np.bincount(at.ravel(), weights=np.repeat(g[head][m], width), minlength=size), np.bincount(at.ravel(), minlength=size)


def _valid_loss(k: _Block, p: BoostParams) -> tuple[float, int]:
    v = k.part == VALID
    return float(loss(p.kind, k.y[v], k.score[FIT][:, v]).sum()), int(v.sum())


def _histograms(active: set[int], pending: dict, growing: dict, level: int, p: BoostParams):
    """Per task and model the gradient sums of the level's nodes; at level 0 the validation loss as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        now = None

        def flush():
            rows = [(*k, w, s.tobytes(), n.tobytes()) for k, (w, s, n) in held.items()]
            held.clear()
            return _batch(rows, _SUMS_SCHEMA)

        def put(key, width, s, n):
            if key in held:
                _, s0, n0 = held[key]
                s, n = s0 + s, n0 + n
            held[key] = width, s, n

        for _, k in _unpack(batches, p, active):
            if k.grp != now and held:
                yield flush()
            now = k.grp
            k.add(pending)
            for fit in (FIT, BOTH):
                g = gradients(p.kind, k.y, k.score[fit])
                for head in range(p.heads):
                    put((k.grp, fit, head), k.x.shape[1], *_level_sums(k, fit, head, g, growing[k.grp, fit][head], level, p))
            if level == 0:
                total, n = _valid_loss(k, p)
                put((k.grp, FIT, LOSS), 1, np.array([total]), np.array([n]))
        if held:
            yield flush()

    return run


_SPLITS = "grp int, fit int, head int, feature array<int>, bin array<int>, ls array<double>, ln array<long>, rs array<double>, rn array<long>"


def _pick(level: int, p: BoostParams):
    """The sums of a model, sorted together, to its best splits."""
    nodes, bins = 1 << level, p.bins + 1
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int64()),
             pa.list_(pa.float64()), pa.list_(pa.int64())]
    schema = pa.schema(list(zip([c.split()[0] for c in _SPLITS.split(", ")], kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, width, s, n = [], None, 0, None, None

        def done():
            if now[2] == LOSS:
                out.append((*now, [], [], s.tolist(), n.tolist(), [], []))
            else:
                shape = (width, nodes, bins)
                out.append((*now, *(x.tolist() for x in best_splits(s.reshape(shape), n.reshape(shape), p))))

        for b in batches:
            for row in b.to_pylist():
                key = row["grp"], row["fit"], row["head"]
                s1, n1 = np.frombuffer(row["sums"]), np.frombuffer(row["counts"], dtype=np.int64)
                if key == now:
                    s, n = s + s1, n + n1
                else:
                    if now is not None:
                        done()
                    now, width, s, n = key, row["width"], s1, n1
        if now is not None:
            done()
        if out:
            yield _batch(out, schema)

    return run


_GROWN = "grp int, fit int, losses array<double>, trees binary"


def _grow(active: set[int], pending: dict, count: int, p: BoostParams):
    """The next ``count`` trees of groups that are one block."""
    schema = pa.schema([("grp", pa.int32()), ("fit", pa.int32()), ("losses", pa.list_(pa.float64())), ("trees", pa.binary())])

    def grow(k: _Block, fit: int) -> tuple:
        losses, made = [], []
        for _ in range(count):
            if fit == FIT:
                total, n = _valid_loss(k, p)
                losses.append(total / n if n else math.nan)
            g = gradients(p.kind, k.y, k.score[fit])
            grown = [Tree() for _ in range(p.heads)]
            for head, tree in enumerate(grown):
                for level in range(p.depth):
                    sums, counts = _level_sums(k, fit, head, g, tree, level, p)
                    shape = (k.x.shape[1], 1 << level, p.bins + 1)
                    feature, cut, *sides = best_splits(sums.reshape(shape), counts.reshape(shape), p)
                    tree.split(feature, cut)
                tree.finish(*sides, p)
            for head, tree in enumerate(grown):
                k.score[fit, head] += tree.value(k.x)
            made.append(grown)
        return k.grp, fit, losses, pickle.dumps(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, k in _unpack(batches, p, active):
            k.add(pending)
            yield _batch([grow(k, fit) for fit in (FIT, BOTH)], schema)

    return run


def _add_trees(pending: dict, p: BoostParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, k in _unpack(batches, p):
            k.add(pending)
            row["score"] = k.score.tobytes()
            yield _batch([tuple(row[f.name] for f in _BLOCK_SCHEMA)], _BLOCK_SCHEMA)

    return run


@dataclasses.dataclass
class Fitted:
    """The kept trees of every group's second fit, the start scores, and the validation loss after 0, 1, .. trees."""

    start: dict[int, tuple[float, ...]]
    trees: dict[int, list[list[Tree]]]
    losses: dict[int, list[float]]

    def score(self, grp: int, x: np.ndarray) -> np.ndarray:
        """Heads by rows."""
        out = np.repeat(np.array(self.start[grp], dtype=float)[:, None], len(x), axis=1)
        for grown in self.trees[grp]:
            for head, tree in enumerate(grown):
                out[head] += tree.value(x)
        return out


def fit(samples: DataFrame, p: BoostParams) -> Fitted:
    """Fit every group of ``samples(grp int, part int, y double, x binary)`` at once.

    ``part`` is 1 for training and 2 for validation rows, others and rows without a label are not used; ``x`` is one byte a
    feature, as many in every row of a group.  Groups without training rows are left out.  A group
    without validation rows keeps all its trees.
    """
    labelled = samples.where(F.col("y").isNotNull())
    train = F.col("part") == TRAIN
    both = F.col("part").isin(TRAIN, VALID)
    stats = labelled.groupBy("grp").agg(*(f(F.when(c, F.col("y"))).alias(a + n) for c, n in ((train, "0"), (both, "1"))
                                          for f, a in ((F.avg, "m"), (F.stddev_pop, "s"), (F.count, "n"))),
                                        F.count(F.when(F.col("part") == VALID, F.lit(1))).alias("valid")).collect()  # one row a group
    start, has_valid = {}, {}
    for r in stats:
        if r["n0"]:
            has_valid[r["grp"]] = r["valid"] > 0
            for k in (FIT, BOTH):
                start[r["grp"], k] = (r[f"m{k}"],) if p.heads == 1 else (r[f"m{k}"], math.log(max(r[f"s{k}"], 1e-6)))
    sizes = {r["grp"]: r["n1"] for r in stats if r["grp"] in has_valid}
    run = _Run(p, has_valid)
    for one_block in (True, False):
        groups = {g for g, n in sizes.items() if (n <= p.block_rows) == one_block}
        if groups:
            most = 1 if one_block else max(-(-sizes[g] // p.block_rows) for g in groups)
            tasks = max(1, min(len(groups) * most, int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
            rows = samples.where(F.col("grp").isin(*groups)) if len(groups) < len(sizes) else samples
            state = cut_lineage(make_blocks(rows, start, p, most, tasks))
            (run.by_block if one_block else run.by_level)(state, groups, tasks)
    return Fitted({g: start[g, BOTH] for g in sizes}, {g: run.kept[g][:run.best(g)] for g in sizes}, run.losses)


class _Run:
    """The trees, validation losses and early stopping of all groups, on the driver."""

    def __init__(self, p: BoostParams, has_valid: dict[int, bool]):
        self.p, self.has_valid = p, has_valid
        self.kept: dict[int, list[list[Tree]]] = {g: [] for g in has_valid}
        self.losses: dict[int, list[float]] = {g: [] for g in has_valid}

    def best(self, g: int) -> int:
        """The number of trees (one at least) after which the validation loss was least; all without validation rows."""
        after = self.losses[g][1:self.p.trees + 1]
        if not self.has_valid[g] or not after:
            return self.p.trees
        return 1 + min(range(len(after)), key=lambda i: (after[i], i))

    def stopped(self, g: int) -> bool:
        known = len(self.losses[g]) - 1
        return self.has_valid[g] and known >= 1 and known - self.best(g) >= self.p.patience

    def by_block(self, state: DataFrame, active: set[int], tasks: int) -> None:
        done, pending = 0, {}
        while active and done < self.p.trees:
            count = min(self.p.refresh, self.p.trees - done)
            if pending:
                state = cut_lineage(state.mapInArrow(_add_trees(pending, self.p), BLOCKS))
            pending = {}
            # one tree more than is kept, for the loss after the last one
            rows = state.mapInArrow(_grow(active, {}, count + (done + count == self.p.trees), self.p), _GROWN).collect()
            for r in rows:
                trees = pickle.loads(r["trees"])[:count]
                pending[r["grp"], r["fit"]] = trees
                if r["fit"] == BOTH:
                    self.kept[r["grp"]] += trees
                else:
                    self.losses[r["grp"]] += r["losses"]
            done += count
            active = {g for g in active if not self.stopped(g)}

    def by_level(self, state: DataFrame, active: set[int], tasks: int) -> None:
        p, pending = self.p, {}
        for m in range(p.trees + 1):
            growing = {(g, k): [Tree() for _ in range(p.heads)] for g in active for k in (FIT, BOTH)}
            sides: dict = {}
            for level in range(p.depth):
                sums = state.mapInArrow(_histograms(active, pending, growing, level, p), _SUMS)
                picked = sums.repartition(tasks, "grp", "fit", "head").sortWithinPartitions("grp", "fit", "head").mapInArrow(_pick(level, p), _SPLITS)
                for r in picked.collect():  # one row a model and head, a few numbers a node
                    if r["head"] == LOSS:
                        self.losses[r["grp"]].append(r["ls"][0] / r["ln"][0] if r["ln"][0] else math.nan)
                    else:
                        growing[r["grp"], r["fit"]][r["head"]].split(r["feature"], r["bin"])
                        sides[r["grp"], r["fit"], r["head"]] = [np.array(r[c]) for c in ("ls", "ln", "rs", "rn")]
                if level == 0:
                    active = {g for g in active if m < p.trees and not self.stopped(g)}
                    growing = {k: v for k, v in growing.items() if k[0] in active}
                    if not active:
                        return
            for (g, k), grown in growing.items():
                for head, tree in enumerate(grown):
                    tree.finish(*sides[g, k, head], p)
                pending.setdefault((g, k), []).append(grown)
                if k == BOTH:
                    self.kept[g].append(grown)
            if (m + 1) % p.refresh == 0:
                state = cut_lineage(state.mapInArrow(_add_trees(pending, p), BLOCKS))
                pending = {}
