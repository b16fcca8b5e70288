"""The VAR against NumPy: vintages from segments, draws, conditioned paths."""

import dataclasses

import numpy as np
import pytest

from panelcast.models import mfvar as V
from panelcast.params import Params

P = Params(var_draws=60, horizon=3, max_nulls_q=4)
Q, ORIGINS = 40, [25, 30, 36]


def histories(spark, entities=15, seed=0, holes=0.03):
    """Two targets and three monthly features of a stable VAR(1)."""
    rng = np.random.default_rng(seed)
    k = 5
    a = rng.normal(size=(k, k)) * 0.15 + 0.4 * np.eye(k)
    out = []
    for e in range(entities):
        x = np.zeros((Q, k))
        for t in range(1, Q):
            x[t] = a @ x[t - 1] + 0.1 + rng.normal(size=k) * 0.3
        x[rng.random((Q, k)) < holes] = np.nan
        out.append((f"e{e}", x))
    none = lambda v: [None if np.isnan(i) else float(i) for i in v]
    rows = [(0, e, [(t, none(x[t, 2:]), none(x[t, :2])) for t in range(Q)]) for e, x in out]
    df = spark.createDataFrame(rows, "fs int, entity string, h array<struct<q int, v array<double>, y array<double>>>").repartition(4)
    return df, out


def gram(data, keep, origin):
    z = [np.r_[1.0, x[t - 1, keep], x[t, keep]] for _, x in data for t in range(1, origin)]
    z = np.array([r for r in z if not np.isnan(r).any()])
    return z.T @ z


@pytest.mark.parametrize("block", [3, 512])
def test_every_vintage_from_prefix_sums_equals_its_own_rows(spark, block):
    import pickle

    df, data = histories(spark)
    keep = V.kept_components(df, Q, 2, 4)
    assert keep == [i for i in range(5) if i < 2 or np.mean([np.isnan(x[:, i]).sum() for _, x in data]) <= 4]
    seg = V._segments(df, ORIGINS, Q, keep, block)
    pairs = -(-(2 * len(keep) + 1) // block)
    assert seg.count() <= len(ORIGINS) * pairs * (pairs + 1) // 2     # no copy of anything to a later vintage
    got = {r["vintage"]: pickle.loads(r["fit"]) for r in V.coefficients(seg, len(ORIGINS), len(keep), block, P).collect()}
    for j, o in enumerate(ORIGINS):
        want = V.minnesota(gram(data, keep, o), len(keep), P)
        for name in ("c", "A", "sigma", "xx"):
            assert np.allclose(got[j][name], want[name], rtol=1e-9, atol=1e-12)


def test_components_with_many_nulls_go_but_targets_stay(spark):
    df, _ = histories(spark, entities=3, holes=0.5)
    assert V.kept_components(df, Q, 2, 4) == [0, 1]
    assert V.kept_components(df.limit(0), Q, 2, 4) == []


def _fit(seed=0, n=40):
    rng = np.random.default_rng(seed)
    x = np.zeros((n, 3))
    for t in range(1, n):
        x[t] = np.array([[0.9, 0.1, 0], [0, 0.8, 0], [0.1, 0, 0.95]]) @ x[t - 1] + rng.normal(size=3)
    z = np.hstack([np.ones((n - 1, 1)), x[:-1], x[1:]])
    return V.minnesota(z.T @ z, 3, P)


def test_draws_are_reproducible_stable_and_centred():
    fit = _fit()
    whole, a, b = V.draw_block(fit, 7, 2, 0, 400), V.draw_block(fit, 7, 2, 0, 50), V.draw_block(fit, 7, 2, 50, 350)
    for i in range(3):
        assert np.array_equal(whole[i], np.concatenate([a[i], b[i]]))       # whatever the blocks
    assert not np.array_equal(whole[0], V.draw_block(fit, 8, 2, 0, 400)[0])
    assert max(V.radius(m) for m in whole[1]) < 1
    tight = {**fit, "xx": fit["xx"] * 1e6, "prec": fit["prec"] * 1e6, "n": 1e6}
    if V.radius(fit["A"]) < 1:
        c, m, s = V.draw_block(tight, 1, 0, 0, 200)
        assert np.allclose(m.mean(axis=0), fit["A"], atol=1e-2) and np.allclose(s.mean(axis=0), fit["sigma"], rtol=0.05)
    free = [x for x in (np.linalg.eigvals(np.array(m)) for m in whole[1])]
    assert len(free) == 400


def test_explosive_draws_are_rejected():
    fit = _fit()
    assert V.draw_block({**fit, "A": np.eye(3) * 3, "prec": fit["prec"] * 1e9}, 1, 0, 0, 5)[0].shape == (0, 3)


def test_gaussian_path_equals_a_plain_computation():
    rng, k, h = np.random.default_rng(0), 4, 3
    b = rng.normal(size=(k, k))
    c, a, s = rng.normal(size=k), rng.normal(size=(k, k)) * 0.2, b @ b.T + np.eye(k)
    for obs in ([], [1, 3], [3]):
        z, cur = rng.normal(size=k), rng.normal(size=k)
        mean, sd = V.gaussian_path(c, a, s, z, cur, obs, [0, 2], h)
        un = [i for i in range(k) if i not in obs]
        m = c + a @ z
        v, p = m.copy(), np.zeros((k, k))
        gain = s[np.ix_(un, obs)] @ np.linalg.inv(s[np.ix_(obs, obs)]) if obs else np.zeros((len(un), 0))
        v[obs] = cur[obs]
        v[un] = m[un] + gain @ (v[obs] - m[obs])
        p[np.ix_(un, un)] = s[np.ix_(un, un)] - gain @ s[np.ix_(obs, un)]
        for i in range(h):
            if i:
                v, p = c + a @ v, a @ p @ a.T + s
            assert np.allclose(mean[:, i], v[[0, 2]]) and np.allclose(sd[:, i] ** 2, np.diag(p)[[0, 2]])


def test_simulated_band_agrees_with_the_gaussian_one_when_parameters_are_known():
    rng, k, n = np.random.default_rng(3), 4, 40_000
    b = rng.normal(size=(k, k)) * 0.5
    c, a, s = rng.normal(size=k), rng.normal(size=(k, k)) * 0.2, b @ b.T + 0.3 * np.eye(k)
    z, cur = rng.normal(size=k), rng.normal(size=k)
    sim = V.Simulator(np.tile(c, (n, 1)), np.tile(a, (n, 1, 1)), np.tile(s, (n, 1, 1)))
    for obs in ([], [2], [1, 2]):
        paths = sim.paths(z, cur, obs, [0, 3], 3, np.random.default_rng(5))
        mean, sd = V.gaussian_path(c, a, s, z, cur, obs, [0, 3], 3)
        lo, mid, hi = np.quantile(paths, [0.16, 0.5, 0.84], axis=0)
        assert np.allclose(mid, mean, atol=0.02) and np.allclose(hi - lo, 2 * V.Z68 * sd, rtol=0.04)


def test_states_meet_the_draws_of_their_vintage(spark):
    df, data = histories(spark)
    keep = V.kept_components(df, Q, 2, 4)
    months = [0, 0, 1, 2, 3]
    seg = V._segments(df, ORIGINS, Q, keep, 512)
    fits = V.coefficients(seg.where("seg > 0"), len(ORIGINS), len(keep), 512, P)    # the first vintage has no rows: no fit
    got = {}
    for p in (P, dataclasses.replace(P, var_draws=0)):
        out = V._forecasts(df, V._draws(fits, p), ORIGINS, Q, keep, [months[i] for i in keep], 2, (1, 3), p)
        rows = {(r["vintage"], r["entity"], r["availability"], r["target"], r["horizon"]): r for r in out.collect()}
        assert len(rows) == out.count() == len(data) * len(ORIGINS) * 2 * 2 * 3
        got[p.var_draws] = rows
    for key, r in got[60].items():
        x, o = dict(data)[key[1]], ORIGINS[key[0]]
        if key[0] == 0:
            assert r["status"] == "no_fit" and r["pred"] is None
            continue
        assert r["status"] == ("incomplete_state" if np.isnan(x[o - 1, keep]).any() else "ok")
        assert r["lo"] <= r["pred"] <= r["hi"] and 0 < r["n_draws"] <= 60
        assert got[0][key]["status"] == r["status"] and got[0][key]["n_draws"] == 0
    again = V._forecasts(df.repartition(2), V._draws(fits, P), ORIGINS, Q, keep, [months[i] for i in keep], 2, (1, 3), P)
    assert {(r["vintage"], r["entity"], r["availability"], r["target"], r["horizon"]): r for r in again.collect()} == got[60]
