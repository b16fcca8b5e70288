"""M5: mixed-frequency Minnesota VAR, stacked at quarterly grain, by posterior simulation.

The three monthly values of every indicator enter the quarterly vector as separate components next to the quarterly
targets, so one VAR at quarterly grain carries the monthly information; the reference's three monthly lags are one
stacked quarterly lag.  Coefficients are pooled over the panel and estimated per vintage (rolling origin):

* the unit is an entity's history; a task adds the cross-products of ``[1, lagged vector, vector]`` per *segment*, the
  quarters between two origins, in blocks of ``block`` columns.  A vintage's sums are those of its segment and all earlier ones, so
  no row is copied to a vintage, and what is shuffled does not depend on how many there are but for the small sums;
* a vintage is solved in the task where its sums meet: the Minnesota prior (own lag ``ar1_prior``, tightness lambda1,
  cross-shrinkage lambda2, intercept lambda4) gives posterior mean, precision per equation and residual covariance;
* draws are spread over tasks by (vintage, block of draws): coefficients from each equation's normal posterior, the
  covariance from its inverse Wishart.  A draw's numbers depend on (seed, vintage, draw) alone, and an explosive
  draw is rejected and drawn again;
* forecasts meet the draws of their vintage by a salted, sorted shuffle (no broadcast: draws x components^2 a vintage).  The
  published months of the origin quarter (availability a) condition the first step (ragged edge), later steps
  iterate the VAR with shocks; the record is the draws' median and 68% band.  With ``var_draws`` 0 it is the
  posterior mean's Gaussian forecast.

Neither sums nor coefficients reach the driver.  A ``status`` column tells rows with a complete state (ok) from the others
(incomplete_state, singular, no_fit), which are not to be scored.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.models.factor import arrays_of, histories, origin_dates, quarters_between
from panelcast.models.keyed import keyed_sums
from panelcast.operators.score import Z68
from panelcast.session import cut_lineage

SET = ("d12", 3, "all")     # the features of all three months
TRIES = 25                  # of an explosive draw
DRAW_BLOCK = 50             # draws of a task


def minnesota(G: np.ndarray, K: int, p) -> dict:
    """Posterior from the Gram of [1, x(K lagged), y(K)]: mean (c, A), residual covariance, and what draws need."""
    N = G[0, 0]
    X_X, X_Y, Y_Y = G[: K + 1, : K + 1], G[: K + 1, K + 1:], G[K + 1:, K + 1:]
    mean = G[0, K + 1:] / N
    sd = np.sqrt(np.maximum(np.diag(Y_Y) / N - mean ** 2, 1e-12))
    B, prec = np.zeros((K + 1, K)), np.zeros((K, K + 1))
    for i in range(K):
        prior_sd = np.empty(K + 1)
        prior_sd[0] = p.var_lambda4 * sd[i]
        prior_sd[1:] = p.var_lambda1 * p.var_lambda2 * sd[i] / sd
        prior_sd[1 + i] = p.var_lambda1
        b0 = np.zeros(K + 1)
        b0[1 + i] = p.var_ar1_prior
        prec[i] = 1.0 / prior_sd ** 2
        s2 = sd[i] ** 2
        B[:, i] = np.linalg.solve(X_X / s2 + np.diag(prec[i]), X_Y[:, i] / s2 + prec[i] * b0)
    sigma = (Y_Y - B.T @ X_Y - X_Y.T @ B + B.T @ X_X @ B) / N
    return {"c": B[0], "A": B[1:].T, "sigma": (sigma + sigma.T) / 2, "n": N, "xx": X_X, "s2": sd ** 2, "prec": prec}


def radius(A: np.ndarray) -> float:
    return float(np.abs(np.linalg.eigvals(A)).max())


def draw(fit: dict, roots: list[np.ndarray], half: np.ndarray, seed: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(c, A, covariance) of one draw; None if all tries are explosive.

    ``roots`` are the Cholesky factors of the equations' posterior precisions, ``half`` that of the inverse Wishart's inverse scale.
    """
    rng, K = np.random.default_rng(list(seed)), len(fit["c"])
    mean = np.vstack([fit["c"], fit["A"].T])
    for _ in range(TRIES):
        B = np.column_stack([mean[:, i] + np.linalg.solve(roots[i].T, e) for i, e in enumerate(rng.normal(size=(K, K + 1)))])
        w = np.tril(rng.normal(size=(K, K)), -1) + np.diag(np.sqrt(rng.chisquare(fit["n"] - np.arange(K))))
        if radius(B[1:].T) < 1:
            root = np.linalg.inv(half @ w)   # the Wishart's root is half @ w, its inverse's is root.T
            return B[0], B[1:].T, root.T @ root
    return None


def draw_block(fit: dict, seed: int, vintage: int, first: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stacked (c, A, covariance) of the draws ``first`` .. that are not rejected."""
    K = len(fit["c"])
    roots = [np.linalg.cholesky(fit["xx"] / fit["s2"][i] + np.diag(fit["prec"][i])) for i in range(K)]
    d, corr = _scaled(fit["sigma"] * fit["n"])      # components differ by orders of magnitude
    half = np.linalg.cholesky(np.linalg.inv(corr + 1e-10 * np.eye(K))) / d[:, None]
    got = [d for k in range(first, first + count) if (d := draw(fit, roots, half, (seed, vintage, k))) is not None]
    return tuple(np.array([d[j] for d in got]).reshape(len(got), *s) for j, s in enumerate([(K,), (K, K), (K, K)]))


def _gain(S: np.ndarray, obs: list[int], un: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(un x obs) gain and conditional covariance of the unobserved; leading axes are draws."""
    if not obs:
        return np.zeros((*S.shape[:-2], len(un), 0)), S
    oo, ou, uu = S[..., obs, :][..., obs], S[..., obs, :][..., un], S[..., un, :][..., un]
    gain = np.swapaxes(np.linalg.solve(oo, ou), -1, -2)
    cond = uu - gain @ ou
    return gain, (cond + np.swapaxes(cond, -1, -2)) / 2


def gaussian_path(c, A, S, z, cur, obs: list[int], targets: Sequence[int], horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sd (targets x horizon) of the Gaussian forecast from lagged state ``z`` and the published ``cur[obs]``."""
    K = len(c)
    un = [i for i in range(K) if i not in obs]
    v, P = c + A @ z, np.zeros((K, K))
    gain, cond = _gain(S, obs, un)
    v[un] += gain @ (cur[obs] - v[obs])
    v[obs] = cur[obs]
    P[np.ix_(un, un)] = cond
    mean, sd = np.zeros((len(targets), horizon)), np.zeros((len(targets), horizon))
    for h in range(horizon):
        if h:
            v, P = c + A @ v, A @ P @ A.T + S
        mean[:, h], sd[:, h] = v[targets], np.sqrt(np.maximum(np.diag(P)[targets], 0.0))
    return mean, sd


def _scaled(S: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(standard deviations, correlations) of each covariance."""
    d = np.sqrt(np.maximum(np.diagonal(S, axis1=-2, axis2=-1), 1e-300))
    return d, S / (d[..., :, None] * d[..., None, :])


def _root(S: np.ndarray) -> np.ndarray:
    """A square root of each (positive semi-definite) matrix."""
    d, corr = _scaled(S)
    val, vec = np.linalg.eigh(corr)
    return d[..., :, None] * vec * np.sqrt(np.maximum(val, 0.0))[..., None, :]


class Simulator:
    """Paths of a vintage's draws; gains and roots are kept per set of published components."""

    def __init__(self, c: np.ndarray, A: np.ndarray, S: np.ndarray):
        self.c, self.A, self.S, self.root = c, A, S, _root(S)
        self.known: dict[tuple, tuple] = {}

    def paths(self, z, cur, obs: list[int], targets: Sequence[int], horizon: int, rng: np.random.Generator) -> np.ndarray:
        """draws x targets x horizon."""
        D, K = self.c.shape
        un = [i for i in range(K) if i not in obs]
        if tuple(obs) not in self.known:
            gain, cond = _gain(self.S, obs, un)
            self.known[tuple(obs)] = gain, _root(cond)
        gain, root = self.known[tuple(obs)]
        v = self.c + self.A @ z
        shock = rng.normal(size=(horizon, D, K))
        v[:, un] += np.einsum("duo,do->du", gain, cur[obs] - v[:, obs]) + np.einsum("duk,dk->du", root, shock[0][:, :len(un)])
        v[:, obs] = cur[obs]
        out = np.empty((D, len(targets), horizon))
        for h in range(horizon):
            if h:
                v = self.c + np.einsum("dij,dj->di", self.A, v) + np.einsum("dij,dj->di", self.root, shock[h])
            out[:, :, h] = v[:, targets]
        return out


def _vectors(row: dict, quarters: int) -> np.ndarray:
    v, y = arrays_of(row, quarters)
    return np.hstack([y, v])


def kept_components(rows: DataFrame, quarters: int, n_targets: int, max_nulls: int) -> list[int]:
    """A stacked component stays if it has at most ``max_nulls`` NULL quarters per entity on average; targets always stay."""
    def partial(row):
        x = _vectors(row, quarters)[[r["q"] for r in row["h"]]]
        yield "", [np.isnan(x).sum(axis=0), np.array([1])]

    def finish(key, s):
        return iter([(s[0].tolist(), int(s[1][0]))])

    arrow = pa.schema([("nulls", pa.list_(pa.int64())), ("entities", pa.int64())])
    got = keyed_sums(rows, partial, finish, "nulls array<long>, entities long", arrow).first()  # one number a component
    return [] if got is None else [i for i, n in enumerate(got["nulls"]) if i < n_targets or n / got["entities"] <= max_nulls]


def _segments(rows: DataFrame, origins: list[int], quarters: int, keep: list[int], block: int) -> DataFrame:
    """``(seg, bi, bj, sums)``: cross-products of the quarters up to the seg-th origin, after the one before, by column blocks."""
    n = 2 * len(keep) + 1
    cuts = list(range(0, n, block))

    def partial(row):
        x = _vectors(row, quarters)[:, keep]
        z = np.hstack([np.ones((quarters - 1, 1)), x[:-1], x[1:]])
        seg = np.searchsorted(origins, np.arange(1, quarters), side="right")   # quarter t trains the origins after it
        use = ~np.isnan(z).any(axis=1) & (seg < len(origins))
        for s in np.unique(seg[use]).tolist():
            part = z[use & (seg == s)]
            for i, a in enumerate(cuts):
                for j, b in enumerate(cuts[i:], i):
                    yield f"{s}|{i}|{j}", [part[:, a:a + block].T @ part[:, b:b + block]]

    def finish(key, s):
        return iter([(*map(int, key.split("|")), np.ascontiguousarray(s[0]).tobytes())])

    arrow = pa.schema([("seg", pa.int32()), ("bi", pa.int32()), ("bj", pa.int32()), ("sums", pa.binary())])
    return keyed_sums(rows, partial, finish, "seg int, bi int, bj int, sums binary", arrow)


def coefficients(segments: DataFrame, n_origins: int, K: int, block: int, p) -> DataFrame:
    """``(vintage, fit)``: every vintage solved where its blocks meet, memory (2K+1)^2 numbers."""
    n = 2 * K + 1
    schema = pa.schema([("vintage", pa.int32()), ("fit", pa.binary())])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, G = None, None

        def done():
            if G[0, 0] > K + 1:
                try:
                    fit = pickle.dumps(minnesota(G, K, p))
                except np.linalg.LinAlgError:
                    return
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([fit], pa.binary())], schema=schema)

        for b in batches:
            for r in b.to_pylist():
                if r["vintage"] != now:
                    if now is not None:
                        yield from done()
                    now, G = r["vintage"], np.zeros((n, n))
                i, j = r["bi"] * block, r["bj"] * block
                part = np.frombuffer(r["sums"]).reshape(min(block, n - i), min(block, n - j))
                G[i:i + block, j:j + block] += part
                if i != j:
                    G[j:j + block, i:i + block] += part.T
        if now is not None:
            yield from done()

    later = F.explode(F.sequence("seg", F.lit(n_origins - 1))).alias("vintage")
    rows = segments.select(later, "seg", "bi", "bj", "sums")
    return rows.repartition("vintage").sortWithinPartitions("vintage", "seg", "bi", "bj").mapInArrow(solve, "vintage int, fit binary")


def _draws(fits: DataFrame, p) -> DataFrame:
    """``(vintage, part, draws)``, spread over tasks; without draws the posterior mean itself."""
    schema = pa.schema([("vintage", pa.int32()), ("part", pa.int32()), ("draws", pa.binary())])
    parts = max(1, -(-p.var_draws // DRAW_BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                fit, first = pickle.loads(r["fit"]), r["part"] * DRAW_BLOCK
                if p.var_draws:
                    try:
                        got = draw_block(fit, p.seed, r["vintage"], first, min(DRAW_BLOCK, p.var_draws - first))
                    except np.linalg.LinAlgError:
                        got = None
                else:
                    got = fit["c"][None], fit["A"][None], fit["sigma"][None]
                yield pa.RecordBatch.from_arrays([pa.array([r["vintage"]], pa.int32()), pa.array([r["part"]], pa.int32()),
                                                  pa.array([pickle.dumps(got)], pa.binary())], schema=schema)

    rows = fits.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition("vintage", "part")
    return rows.mapInArrow(run, "vintage int, part int, draws binary")


_OUT = "vintage int, entity string, availability int, target int, horizon int, pred double, lo double, hi double, n_draws int, status string"
_OUT_SCHEMA = pa.schema([("vintage", pa.int32()), ("entity", pa.string()), ("availability", pa.int32()), ("target", pa.int32()), ("horizon", pa.int32()),
                         ("pred", pa.float64()), ("lo", pa.float64()), ("hi", pa.float64()), ("n_draws", pa.int32()), ("status", pa.string())])


def forecasts_of(sim: Simulator | None, simulate: bool, z: np.ndarray, cur: np.ndarray, observable: list[int], targets: list[int],
                 horizon: int, seed: Sequence[int]) -> Iterator[tuple]:
    """(target, horizon, pred, lo, hi, n_draws, status) of one state."""
    none = [(t, h, None, None, None, 0) for t in range(len(targets)) for h in range(1, horizon + 1)]
    if sim is None or not len(sim.c):
        yield from ((*r, "no_fit") for r in none)
        return
    status = "incomplete_state" if np.isnan(z).any() else "ok"
    obs = [i for i in observable if not np.isnan(cur[i])]
    try:
        if simulate:
            paths = sim.paths(np.nan_to_num(z), cur, obs, targets, horizon, np.random.default_rng(list(seed)))
            lo, mid, hi = np.quantile(paths, [0.16, 0.5, 0.84], axis=0)
        else:
            mid, sd = gaussian_path(sim.c[0], sim.A[0], sim.S[0], np.nan_to_num(z), cur, obs, targets, horizon)
            lo, hi = mid - Z68 * sd, mid + Z68 * sd
    except np.linalg.LinAlgError:
        yield from ((*r, "singular") for r in none)
        return
    for t in range(len(targets)):
        for h in range(horizon):
            yield t, h + 1, float(mid[t, h]), float(lo[t, h]), float(hi[t, h]), len(sim.c) if simulate else 0, status


def _forecasts(rows: DataFrame, draws: DataFrame, origins: list[int], quarters: int, keep: list[int], months: list[int], n_targets: int,
               availabilities: Sequence[int], p) -> DataFrame:
    """States meet their vintage's draws: both dealt by (vintage, salt), draws first in every run."""
    state_schema = pa.schema([("vintage", pa.int32()), ("entity", pa.string()), ("payload", pa.binary())])

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                x = _vectors(row, quarters)[:, keep]
                out = [(k, row["entity"], pickle.dumps((x[o - 1], x[o]))) for k, o in enumerate(origins) if 0 < o < quarters]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), state_schema, strict=True)], schema=state_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, sim = None, [], None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if (r["vintage"], r["salt"]) != now:
                    now, parts, sim = (r["vintage"], r["salt"]), [], None
                if r["entity"] is None:
                    got = pickle.loads(r["payload"])
                    if got is not None:
                        parts.append(got)
                    continue
                if sim is None and parts:
                    sim = Simulator(*(np.concatenate(a) for a in zip(*parts, strict=True)))
                z, cur = pickle.loads(r["payload"])
                steps = min(p.horizon, quarters - origins[r["vintage"]])
                for a in availabilities:
                    seen = [i for i, m in enumerate(months) if m and m <= a]
                    for res in forecasts_of(sim, p.var_draws > 0, z, cur, seen, list(range(n_targets)), steps,
                                            (p.seed, r["vintage"], zlib.crc32(r["entity"].encode()))):
                        out.append((r["vintage"], r["entity"], a, *res))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT_SCHEMA, strict=True)], schema=_OUT_SCHEMA)

    salts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // max(1, len(origins)))
    left = draws.select("vintage", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(None).cast("string").alias("entity"),
                        "part", F.col("draws").alias("payload"))
    right = rows.mapInArrow(states, "vintage int, entity string, payload binary").select(
        "vintage", F.pmod(F.xxhash64("entity"), F.lit(salts)).cast("int").alias("salt"), "entity", F.lit(0).alias("part"), "payload")
    both = left.unionByName(right).repartition("vintage", "salt")
    return both.sortWithinPartitions("vintage", "salt", F.col("entity").asc_nulls_first(), "part").mapInArrow(run, _OUT)


def fit_mfvars(build, availabilities: Sequence[int], target_names: Sequence[str], run_id: str) -> DataFrame:
    """Forecast records of every vintage and availability, with the draws kept and a status, in the same jobs."""
    p = build.freeze().params
    targets = list(target_names)
    quarters = quarters_between(p.start_date, build.anchor) + 1
    dates = [o for o in origin_dates(build.anchor, p.test_len, p.horizon) if o > p.start_date]
    origins = [quarters_between(p.start_date, o) for o in dates]
    rows = cut_lineage(histories(build, [SET], targets))
    month = build.feat_q().where(F.col("features_type") == SET[0]).select("feature", "availability").distinct().orderBy("feature")
    months = [0] * len(targets) + [r["availability"] for r in month.collect()]     # one number a component
    keep = kept_components(rows, quarters, len(targets), p.max_nulls_q)
    fits = coefficients(_segments(rows, origins, quarters, keep, p.var_block), len(origins), len(keep), p.var_block, p)
    draws = cut_lineage(_draws(fits, p))
    out = _forecasts(rows, draws, origins, quarters, keep, [months[i] for i in keep], len(targets), availabilities, p)
    names = F.array(*(F.lit(t) for t in targets))
    first = F.array(*(F.lit(o) for o in dates))
    origin = F.element_at(first, F.col("vintage") + 1)
    return out.select(
        F.lit(run_id).alias("run_id"), F.lit("mfvar").alias("model"), "entity", F.element_at(names, F.col("target") + 1).alias("target"),
        F.lit(SET[0]).alias("features_type"), "availability", "horizon", origin.alias("origin"),
        F.add_months(origin, 3 * (F.col("horizon") - 1)).alias("date"), "pred", "lo", "hi", "status", "n_draws")


def fit_mfvar(build, availability: int, target_names: list[str], run_id: str) -> DataFrame:
    """:func:`fit_mfvars` for one availability."""
    return fit_mfvars(build, [availability], target_names, run_id)
