"""M4: factor model over rolling origins, with missing values, direct and dynamic.

For every origin of the rolling back-test (B4) the monthly features are standardised with statistics of the quarters
before the origin and reduced to ``k`` principal components.  Missing values are no zeros: the components are those
of the EM iteration (fill a row's holes from its expected factors under probabilistic PCA, decompose, repeat), which is plain PCA
on complete data.  Columns without variation before the origin are left out, and so are rows with less than half of the columns.  Two forecasts are made from the factors of the origin
quarter (features frozen at the origin, no realised future features):

* direct (``factor_k<k>``): every target regressed on factors and own lag, one regression per horizon (Stock & Watson 2002);
* dynamic (``factor_k<k>_o<order>``): factors follow a VAR of that order, targets load on them; the state is iterated
  to the horizon with its own covariance, which with the loading's residual variance gives a 68% band.

Distribution: the unit is an entity's history, as long as the calendar, not as the panel.  Every step is one
job for all origins, feature sets and k: tasks add cross-products by (set, origin), and decompositions and regressions are
solved where a key's sums meet (:mod:`panelcast.models.keyed`).  The driver gets means, loadings and
coefficients, whose number parameters and features bound.
"""

from __future__ import annotations

import datetime as dt
import pickle
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import to_date
from panelcast.models import grid_design
from panelcast.models.keyed import keyed_sums
from panelcast.operators.calendar import add_months
from panelcast.operators.score import FORECASTS_SCHEMA, Z68
from panelcast.session import cut_lineage

RIDGE = 1e-8


def origin_dates(anchor: dt.date, test_len: int, horizon: int) -> list[dt.date]:
    """The T+H-1 window starts; window i ends at the i-th test quarter (or the anchor)."""
    return [add_months(anchor, -3 * (test_len - 2 + horizon - i)) for i in range(test_len + horizon - 1)]


def quarters_between(a: dt.date, b: dt.date) -> int:
    return ((b.year - a.year) * 12 + b.month - a.month) // 3


def histories(build, sets: Sequence[tuple[str, int, str]], targets: Sequence[str]) -> DataFrame:
    """``(fs, entity, h)``: per feature set and entity its quarters from the start year on, ``h`` = (q, v, y) in order."""
    p = build.params
    f = grid_design.wide(grid_design.long_features(build.feat_q(), sets), "value", "v")
    at = build.aligned_targets().where(F.col("target").isin(*targets)).groupBy("entity", "date") \
        .agg(F.map_from_entries(F.collect_list(F.struct("target", "y"))).alias("m"))
    rows = f.join(at, ["entity", "date"], "left").where(F.col("date").between(to_date(p.start_date), to_date(build.anchor)))
    q = (F.months_between("date", to_date(p.start_date)) / 3).cast("int").alias("q")
    y = F.array(*(F.try_element_at("m", F.lit(t)) for t in targets)).alias("y")
    tasks = int(build.spark.conf.get("spark.sql.shuffle.partitions"))   # many passes follow: as many tasks as the session deals out
    return rows.select("fs", "entity", q, "v", y).repartition(tasks, "fs", "entity").groupBy("fs", "entity").agg(F.sort_array(F.collect_list(F.struct("q", "v", "y"))).alias("h"))


def arrays_of(row: dict, quarters: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, targets) of a history by quarter, NaN where there is nothing."""
    v = np.full((quarters, len(row["h"][0]["v"])), np.nan)
    y = np.full((quarters, len(row["h"][0]["y"])), np.nan)
    for r in row["h"]:
        v[r["q"]] = [np.nan if a is None else a for a in r["v"]]
        y[r["q"]] = [np.nan if a is None else a for a in r["y"]]
    return v, y


def enough(z: np.ndarray, k: int) -> np.ndarray:
    """Rows with at least half of the columns, and one more than there are factors: fewer would fit them to noise."""
    return (~np.isnan(z)).sum(axis=1) >= min(z.shape[1], max(k + 1, -(-z.shape[1] // 2)))


class Loadings(NamedTuple):
    """Of one (set, origin): standardisation, kept columns, orthonormal loadings, the factors' standard deviations over the
    noise, and the noise variance."""

    mean: np.ndarray
    sd: np.ndarray
    cols: np.ndarray
    u: np.ndarray
    s: np.ndarray
    noise: float

    def scaled(self, v: np.ndarray) -> np.ndarray:
        return ((v - self.mean) / self.sd)[:, self.cols]


def filled(z: np.ndarray, load: Loadings) -> np.ndarray:
    """``z`` with a row's holes from its expected factors given its observed columns (probabilistic PCA); NaN rows without enough."""
    out = np.full(z.shape, np.nan)
    use = np.flatnonzero(enough(z, load.u.shape[1]))
    w = load.u * load.s
    masks, which = np.unique(~np.isnan(z[use]), axis=0, return_inverse=True)
    for m, mask in enumerate(masks):
        rows = use[which.ravel() == m]
        out[rows] = z[rows]
        if not mask.all():
            part = w[mask]
            f = np.linalg.solve(part.T @ part + load.noise * np.eye(part.shape[1]), part.T @ z[rows][:, mask].T)
            out[np.ix_(rows, ~mask)] = (w[~mask] @ f).T
    return out


def factors(z: np.ndarray, load: Loadings, k: int) -> np.ndarray:
    """The first ``k`` factors of every row, its holes filled; NaN where there are not enough columns."""
    return filled(z, load) @ load.u[:, :k]


def components(cross: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` eigenvectors, the entry of largest size positive in each, and all eigenvalues, largest first."""
    val, vec = np.linalg.eigh(cross)
    load = vec[:, ::-1][:, :k]
    return load * np.sign(load[np.abs(load).argmax(axis=0), np.arange(load.shape[1])]), np.maximum(val[::-1], 0.0)


class Panel:
    """Histories and the quarters of the origins; each method is one Spark job over all sets and origins."""

    def __init__(self, rows: DataFrame, origins: Sequence[int], quarters: int):
        self.rows, self.origins, self.quarters = rows, list(origins), quarters

    def _sums(self, partial, finish, schema: str, arrow: pa.Schema) -> DataFrame:
        origins, quarters = self.origins, self.quarters

        def of(row: dict) -> Iterator[tuple[str, list[np.ndarray]]]:
            v, y = arrays_of(row, quarters)
            for o in origins:
                for key, sums in partial(f"{row['fs']}|{o}", o, v, y):
                    yield key, sums

        return keyed_sums(self.rows, of, finish, schema, arrow)

    def _by_key(self, partial, finish) -> dict:
        arrow = pa.schema([("key", pa.string()), ("value", pa.binary())])
        done = self._sums(partial, lambda key, s: iter([(key, pickle.dumps(finish(key, s)))]), "key string, value binary", arrow)
        return {r["key"]: pickle.loads(r["value"]) for r in done.collect()}  # a row per set, origin (and k)

    def scale(self) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Per (set, origin) the mean and population std of every column before the origin; std NaN without variation."""
        def first(key, o, v, y):
            yield key, [np.sum(~np.isnan(v[:o]), axis=0), np.nansum(v[:o], axis=0)]

        def mean(key, s):
            return s[0], np.where(s[0] > 0, s[1] / np.maximum(s[0], 1), np.nan)

        known = self._by_key(first, mean)

        def second(key, o, v, y):
            yield key, [np.nansum((v[:o] - known[key][1]) ** 2, axis=0)]

        def std(key, s):
            n, m = known[key]
            sd = np.sqrt(s[0] / np.maximum(n, 1))
            return m, np.where((n > 1) & (sd > 1e-12), sd, np.nan)

        return self._by_key(second, std)

    def loadings(self, scale: dict, k: int, iterations: int, tolerance: float) -> dict[str, Loadings]:
        """The loadings of every (set, origin) on at most ``k`` components.

        A set's iteration ends when what the components explain changes by less than ``tolerance`` of it.
        """
        cols = {key: np.flatnonzero(~np.isnan(sd)) for key, (_, sd) in scale.items()}
        found: dict[str, Loadings] = {}
        explained: dict[str, float] = {}
        open_ = {key for key, c in cols.items() if len(c)}
        for _ in range(iterations):
            if not open_:
                break
            now = {key: found.get(key) for key in open_}

            def partial(key, o, v, y):
                if key not in now:
                    return
                c = cols[key]
                z = ((v[:o] - scale[key][0]) / scale[key][1])[:, c]
                z = z[enough(z, min(k, len(c)))]
                holes = np.isnan(z).sum()
                z = np.nan_to_num(z) if now[key] is None else filled(z, now[key])
                yield key, [z.T @ z, np.array([holes, len(z)])]

            def finish(key, s):
                n = max(int(s[1][1]), 1)
                u, val = components(s[0] / n, min(k, len(s[0])))
                rest = val[u.shape[1]:]
                noise = max(float(rest.mean()) if len(rest) else 0.0, 1e-6)
                return bool(s[1][0]), u, np.sqrt(np.maximum(val[:u.shape[1]] - noise, 0.0)), noise, float(val[:u.shape[1]].sum())

            for key, (holes, u, s, noise, total) in self._by_key(partial, finish).items():
                before = explained.get(key, np.inf)
                found[key], explained[key] = Loadings(*scale[key], cols[key], u, s, noise), total
                if not holes or abs(total - before) <= tolerance * total:
                    open_.discard(key)
            open_ &= set(found)
        return found


def _observed(v: np.ndarray, key: str, k: int, loads: dict[str, Loadings]) -> np.ndarray:
    return factors(loads[key].scaled(v), loads[key], k)


def _gram(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Sums of [x, y]' [x, y] and the count, over rows without a hole."""
    rows = np.column_stack([x, y])
    rows = rows[~np.isnan(rows).any(axis=1)]
    return [rows.T @ rows, np.array([len(rows)])]


def _regress(gram: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(coefficients width x outputs, residual covariance), None with too few rows."""
    if n < width + 1:
        return None
    xx, xy, yy = gram[:width, :width], gram[:width, width:], gram[width:, width:]
    b = np.linalg.solve(xx + RIDGE * np.eye(width), xy)
    rest = (yy - b.T @ xy - xy.T @ b + b.T @ xx @ b) / n
    return b, (rest + rest.T) / 2


def _lagged(f: np.ndarray, order: int) -> np.ndarray:
    """[1, f(t-1), .., f(t-order)] by row, NaN before there are so many."""
    out = [np.ones((len(f), 1))]
    for j in range(1, order + 1):
        out.append(np.vstack([np.full((min(j, len(f)), f.shape[1]), np.nan), f[:-j] if j < len(f) else f[:0]]))
    return np.hstack(out)


def _regressions(panel: Panel, loads: dict, ks: Sequence[int], orders: Sequence[int], horizon: int, n_targets: int) -> dict:
    """Per (set, origin, k): the direct regressions by (target, h), the transitions by order, the targets' loadings."""
    parts = [("direct", t, h) for t in range(n_targets) for h in range(1, horizon + 1)] + \
        [("step", o, 0) for o in orders] + [("load", t, 0) for t in range(n_targets)]

    def partial(key, o, v, y):
        if key not in loads:
            return
        for k in ks:
            if k > loads[key].u.shape[1]:
                continue
            f, out = _observed(v[:o], key, k, loads), []
            one, past = np.ones((o, 1)), np.vstack([np.full((1, y.shape[1]), np.nan), y[:o - 1]]) if o else y[:0]
            for kind, a, h in parts:
                if kind == "direct":
                    label = np.full(o, np.nan)
                    label[:max(o - h + 1, 0)] = y[h - 1:o, a]
                    out += _gram(np.column_stack([one, f, past[:, a]]), label)
                elif kind == "step":
                    out += _gram(_lagged(f, a), f)
                else:
                    out += _gram(np.column_stack([one, f]), y[:o, a])
            yield f"{key}|{k}", out

    def finish(key, sums):
        k = int(key.rsplit("|", 1)[1])
        width = {"direct": lambda a: k + 2, "step": lambda a: 1 + k * a, "load": lambda a: k + 1}
        return {p: _regress(sums[2 * i], int(sums[2 * i + 1][0]), width[p[0]](p[1])) for i, p in enumerate(parts)}

    return panel._by_key(partial, finish)


def dynamic(state: np.ndarray, step: tuple, load: tuple, order: int, horizon: int) -> list[tuple[float, float]]:
    """(mean, sd) of a target 0 .. horizon - 1 quarters after the state ``[f(t), f(t-1), ..]`` (order x k)."""
    (b, q), (beta, s2) = step, load
    k = state.shape[1]
    size = k * order
    move = np.zeros((size, size))
    move[:k] = b[1:].T
    move[k:, :size - k] = np.eye(size - k)
    noise = np.zeros((size, size))
    noise[:k, :k] = q
    x, cov, out = state.ravel(), np.zeros((size, size)), []
    for h in range(horizon):
        if h:
            x = move @ x
            x[:k] += b[0]
            cov = move @ cov @ move.T + noise
        c = beta[1:, 0]
        out.append((float(beta[0, 0] + c @ x[:k]), float(np.sqrt(max(c @ cov[:k, :k] @ c + s2[0, 0], 0.0)))))
    return out


_OUT = "fs int, entity string, k int, ord int, target int, horizon int, q int, pred double, sd double"


def _forecasts(panel: Panel, loads: dict, fits: dict, ks, orders, horizon: int) -> DataFrame:
    arrow = pa.schema([("fs", pa.int32()), ("entity", pa.string()), ("k", pa.int32()), ("ord", pa.int32()), ("target", pa.int32()),
                       ("horizon", pa.int32()), ("q", pa.int32()), ("pred", pa.float64()), ("sd", pa.float64())])
    origins, quarters = panel.origins, panel.quarters
    shared = panel.rows.sparkSession.sparkContext.broadcast((loads, fits))

    def rows(row: dict, loads: dict, fits: dict) -> Iterator[tuple]:
        v, y = arrays_of(row, quarters)
        for o in origins:
            key = f"{row['fs']}|{o}"
            for k in ks:
                fit = fits.get(f"{key}|{k}")
                if fit is None or o >= quarters:
                    continue
                f = _observed(v[:o + 1], key, k, loads)
                for t in range(y.shape[1]):
                    now = np.r_[1.0, f[o], y[o - 1, t] if o else np.nan]
                    for h in range(1, min(horizon, quarters - o) + 1):
                        direct = fit["direct", t, h]
                        if direct is not None and not np.isnan(now).any():
                            yield row["fs"], row["entity"], k, 0, t, h, o, float(now @ direct[0][:, 0]), None
                    for order in orders:
                        step, load = fit["step", order, 0], fit["load", t, 0]
                        state = f[max(o - order + 1, 0):o + 1][::-1]
                        if step is None or load is None or len(state) < order or np.isnan(state).any():
                            continue
                        for h, (m, sd) in enumerate(dynamic(state, step, load, order, min(horizon, quarters - o)), 1):
                            yield row["fs"], row["entity"], k, order, t, h, o, m, sd

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads, fits = shared.value
        for b in batches:
            for row in b.to_pylist():
                out = list(rows(row, loads, fits))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return panel.rows.mapInArrow(run, _OUT)


def fit_factors(build, configs: Sequence[tuple[str, int, str]], run_id: str) -> DataFrame:
    """Forecast records of every (features_type, availability, strategy) of ``configs``, every k and order, in the same jobs.

    The configuration stays readable: columns ``features_strategy``, ``k_factors`` and ``factor_order`` (0: direct) follow the record.
    """
    p = build.freeze().params
    sets = sorted(set(configs))
    targets = sorted(r["target"] for r in build.aligned_targets().select("target").distinct().collect())  # the configured targets
    quarters = quarters_between(p.start_date, build.anchor) + 1
    dates = [o for o in origin_dates(build.anchor, p.test_len, p.horizon) if o > p.start_date]
    panel = Panel(cut_lineage(histories(build, sets, targets)), [quarters_between(p.start_date, o) for o in dates], quarters)
    ks, orders = sorted(p.factor_k_grid), sorted(p.factor_order_grid)
    loads = panel.loadings(panel.scale(), max(ks), p.factor_em_iterations, p.factor_em_tolerance)
    fits = _regressions(panel, loads, ks, orders, p.horizon, len(targets))
    out = _forecasts(panel, loads, fits, ks, orders, p.horizon)
    names = build.spark.createDataFrame([(i, *s) for i, s in enumerate(sets)], "fs int, features_type string, availability int, features_strategy string")
    target = F.element_at(F.array(*(F.lit(t) for t in targets)), F.col("target") + 1)
    month = lambda q: F.expr(f"cast(add_months(DATE'{p.start_date.isoformat()}', 3 * ({q})) as date)")
    model = F.concat(F.lit("factor_k"), F.col("k").cast("string"), F.when(F.col("ord") > 0, F.concat(F.lit("_o"), F.col("ord").cast("string"))).otherwise(""),
                     F.when(F.col("features_strategy") == "all", "_all").otherwise(""))
    return out.join(F.broadcast(names), "fs").select(  # one row a feature set
        F.lit(run_id).alias("run_id"), model.alias("model"), "entity", target.alias("target"), "features_type", "availability",
        "horizon", month("q").alias("origin"), month("q + horizon - 1").alias("date"), "pred",
        (F.col("pred") - Z68 * F.col("sd")).alias("lo"), (F.col("pred") + Z68 * F.col("sd")).alias("hi"),
        "features_strategy", F.col("k").alias("k_factors"), F.col("ord").alias("factor_order"))


def fit_factor(build, features_type: str, availability: int, strategy: str, run_id: str) -> DataFrame:
    """:func:`fit_factors` for one configuration, in the uniform record."""
    return fit_factors(build, [(features_type, availability, strategy)], run_id).select(*(f.name for f in FORECASTS_SCHEMA.fields))
