"""M3: the tabular-network slot filled by an elastic-net linear model, all penalties and cells from one pass.

Data steps as in the reference: only columns without NULLs over train and valid enter (A11), standardised with the mean
and population std of the training rows (A12).  A task reduces its rows to means and centred cross-products per
(cell, split), the parts of a cell are merged in one task, and that task does the rest without the rows: null-free
columns from the null counts, the standardised Gram, coordinate descent for every penalty, the valid error of each
(a quadratic form in the valid moments), and the refit on train + valid with the best.  Test rows
with a NULL in a kept column get the column's mean instead of being dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.models import grid_design
from panelcast.models.design import Cell, cell_record
from panelcast.operators.calendar import add_months

TRAIN, VALID = 1, 2


def warmup_quarters(cell: Cell, windows: tuple[int, ...]) -> int:
    """Quarters at the start of the data in which a cell's columns are NULL by construction of their lags.

    A feature reaches back 12 months, the widest rolling frame less one month and h - 1 quarters; the lagged
    target reaches back 4 + h quarters.
    """
    months = 12 + (max(windows) - 1 if cell.features_type == "rolling" else 0)
    return max(-(-months // 3) + cell.horizon - 1, 4 + cell.horizon)


class Moments:
    """Count, null counts, means and centred cross-products of rows ``[v, y]``; parts merge without cancellation."""

    def __init__(self, n: int, nulls: np.ndarray, mean: np.ndarray, cross: np.ndarray):
        self.n, self.nulls, self.mean, self.cross = n, nulls, mean, cross

    @classmethod
    def of(cls, rows: np.ndarray) -> "Moments":
        missing = np.isnan(rows)
        rows = np.where(missing, 0.0, rows)
        mean = rows.mean(axis=0)
        d = rows - mean
        return cls(len(rows), missing.sum(axis=0), mean, d.T @ d)

    def __add__(self, o: "Moments") -> "Moments":
        n, d = self.n + o.n, o.mean - self.mean
        return Moments(n, self.nulls + o.nulls, self.mean + d * (o.n / n), self.cross + o.cross + np.outer(d, d) * (self.n * o.n / n))


def coordinate_descent(gram: np.ndarray, xy: np.ndarray, absolute: float, square: float, start: np.ndarray | None = None,
                       tolerance: float = 1e-12, sweeps: int = 20_000) -> np.ndarray:
    """argmin of b'Gb/2 - b'c + absolute |b|_1 + square |b|^2 / 2, G and c per row."""
    b = np.zeros(len(xy)) if start is None else start.copy()
    down = np.diag(gram) + square
    rest = xy - gram @ b
    for _ in range(sweeps):
        most = 0.0
        for j in range(len(b)):
            if down[j] <= 0:
                continue
            r = rest[j] + gram[j, j] * b[j]
            new = np.sign(r) * max(abs(r) - absolute, 0.0) / down[j]
            if new != b[j]:
                rest -= gram[:, j] * (new - b[j])
                most = max(most, abs(new - b[j]))
                b[j] = new
        if most < tolerance:
            break
    return b


def path(m: Moments, cols: np.ndarray, penalties: Sequence[float], mix: float) -> list[tuple[float, np.ndarray]]:
    """(intercept, coefficients of ``cols``) for every penalty, on columns standardised with the moments' own statistics.

    As in Spark's ``LinearRegression`` the square part of a penalty is in units of the label's population std.
    """
    sd = np.sqrt(np.diag(m.cross)[cols] / m.n)
    sd = np.where(sd > 0, sd, 1.0)
    gram = m.cross[np.ix_(cols, cols)] / np.outer(sd, sd) / m.n
    xy = m.cross[cols, -1] / sd / m.n
    unit = float(np.sqrt(m.cross[-1, -1] / m.n)) or 1.0
    out, b = {}, None
    for lam in sorted(set(penalties), reverse=True):  # each penalty starts from the next larger one's solution
        b = coordinate_descent(gram, xy, lam * mix, lam * (1 - mix) / unit, b)
        raw = b / sd
        out[lam] = m.mean[-1] - raw @ m.mean[cols], raw
    return [out[lam] for lam in penalties]


def mean_squared_error(m: Moments, cols: np.ndarray, intercept: float, coef: np.ndarray) -> float:
    off = m.mean[-1] - intercept - coef @ m.mean[cols]
    around = m.cross[-1, -1] - 2 * coef @ m.cross[cols, -1] + coef @ m.cross[np.ix_(cols, cols)] @ coef
    return off * off + around / m.n


def solve(train: Moments | None, valid: Moments | None, penalties: Sequence[float], mix: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """(penalty, intercept, coefficients of all columns, what stands in for a NULL) of the fit on train + valid."""
    both = train + valid if train and valid else train or valid
    cols = np.flatnonzero(both.nulls[:-1] == 0)
    best = penalties[0]
    if train and valid:
        errors = [mean_squared_error(valid, cols, *fit) for fit in path(train, cols, penalties, mix)]
        best = penalties[min(range(len(errors)), key=lambda i: (errors[i], i))]
    intercept, coef = path(both, cols, [best], mix)[0]
    full = np.zeros(len(both.mean) - 1)
    full[cols] = coef
    return best, float(intercept), full, both.mean[:-1]


_PARTS = "grp int, part int, n long, nulls binary, mean binary, cross binary"
_COEF = "grp int, penalty double, intercept double, coef array<double>, fill array<double>"


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("grp", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("nulls", pa.binary()), ("mean", pa.binary()), ("cross", pa.binary())])
    held: dict[tuple[int, int], Moments] = {}
    for b in batches:
        if not b.num_rows:
            continue
        grp, part = b.column("grp").to_numpy(), b.column("part").to_numpy()
        y, v = b.column("y").to_numpy(), b.column("v")
        flat, ends = v.flatten().to_numpy(zero_copy_only=False), np.cumsum(v.value_lengths().to_numpy())
        for key in sorted(set(zip(grp.tolist(), part.tolist()))):
            at = np.flatnonzero((grp == key[0]) & (part == key[1]))
            width = len(v[int(at[0])])
            x = flat[(ends[at] - width)[:, None] + np.arange(width)]
            m = Moments.of(np.column_stack([x.astype(float), y[at]]))
            held[key] = held[key] + m if key in held else m
    if held:
        rows = [(*k, m.n, m.nulls.astype(np.int64).tobytes(), m.mean.tobytes(), m.cross.tobytes()) for k, m in held.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _solver(penalties: Sequence[float], mix: float):
    schema = pa.schema([("grp", pa.int32()), ("penalty", pa.float64()), ("intercept", pa.float64()), ("coef", pa.list_(pa.float64())), ("fill", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, {}, []
        for b in batches:
            for r in b.to_pylist():
                if now is not None and r["grp"] != now:
                    out.append((now, *solve(held.get(TRAIN), held.get(VALID), penalties, mix)))
                    held = {}
                now = r["grp"]
                mean = np.frombuffer(r["mean"])
                m = Moments(r["n"], np.frombuffer(r["nulls"], dtype=np.int64), mean, np.frombuffer(r["cross"]).reshape(len(mean), -1))
                held[r["part"]] = held[r["part"]] + m if r["part"] in held else m
        if now is not None:
            out.append((now, *solve(held.get(TRAIN), held.get(VALID), penalties, mix)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def coefficients(samples: DataFrame, penalties: Sequence[float], mix: float) -> DataFrame:
    """``(grp, penalty, intercept, coef, fill)`` per group of ``samples(grp, part, y, v)``; part 1 is train, 2 valid."""
    rows = samples.where(F.col("y").isNotNull() & F.col("part").isin(TRAIN, VALID)).select(
        F.col("grp").cast("int").alias("grp"), F.col("part").cast("int").alias("part"), "y", "v")
    parts = rows.mapInArrow(_partial, _PARTS)
    return parts.repartition("grp").sortWithinPartitions("grp", "part").mapInArrow(_solver(tuple(penalties), mix), _COEF)


def fit_sparse_linear(build, cells: Sequence[Cell] | Cell, run_id: str) -> DataFrame:
    """Forecast records of all ``cells``, with the penalty chosen per cell."""
    cells = [cells] if isinstance(cells, Cell) else list(cells)
    p = build.freeze().params
    first = [(k, add_months(build.first_quarter, 3 * warmup_quarters(c, p.windows))) for k, c in enumerate(cells)]
    grid = build.spark.createDataFrame(first, "grp int, first date")
    rows = grid_design.values(build, cells).join(F.broadcast(grid), "grp").where(F.col("date") >= F.col("first"))  # one row a cell
    rows = rows.withColumn("part", F.when(F.col("split") == "train", TRAIN).when(F.col("split") == "valid", VALID).otherwise(3))
    fitted = coefficients(rows, p.linear_penalties, p.linear_mix)
    out = rows.where(F.col("part") == 3).join(F.broadcast(fitted), "grp").withColumn("prediction", F.expr(
        "aggregate(transform(sequence(0, size(v) - 1), i -> coalesce(v[i], fill[i]) * coef[i]), intercept, (a, x) -> a + x)"))
    return cell_record(out, "sparse_linear", cells, run_id, extra=["penalty"])
