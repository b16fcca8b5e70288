"""The factor model against NumPy on whole histories."""

import numpy as np
import pytest

from panelcast.models import factor as M

Q, ORIGINS, TARGETS = 60, [40, 50], 2


def planted(entities=12, p=6, k=2, holes=0.0, seed=1):
    rng = np.random.default_rng(seed)
    load = rng.normal(size=(p, k)) * np.array([2.0, 1.0][:k])
    out = []
    for e in range(entities):
        f = np.zeros((Q, k))
        for t in range(1, Q):
            f[t] = f[t - 1] * np.array([0.8, 0.4][:k]) + rng.normal(size=k)
        v = f @ load.T + rng.normal(size=(Q, p)) * 0.1 + 5
        y = np.column_stack([1 + f[:, 0], -f[:, -1]]) + rng.normal(size=(Q, TARGETS)) * 0.05
        v[rng.random((Q, p)) < holes] = np.nan
        out.append((e, v, y, f))
    return out


def frame(spark, data, fs=0):
    none = lambda a: [None if np.isnan(x) else float(x) for x in a]
    rows = [(fs, f"e{e}", [(t, none(v[t]), none(y[t])) for t in range(Q)]) for e, v, y, _ in data]
    return spark.createDataFrame(rows, "fs int, entity string, h array<struct<q int, v array<double>, y array<double>>>").repartition(4)


def test_complete_data_give_plain_components(spark):
    data = planted()
    panel = M.Panel(frame(spark, data), ORIGINS, Q)
    scale = panel.scale()
    loads = panel.loadings(scale, 2, 200, 1e-9)
    for o in ORIGINS:
        x = np.vstack([v[:o] for _, v, _, _ in data])
        load = loads[f"0|{o}"]
        mean, sd, cols = load[:3]
        assert np.allclose(mean, x.mean(axis=0)) and np.allclose(sd, x.std(axis=0)) and list(cols) == list(range(6))
        z = (x - x.mean(axis=0)) / x.std(axis=0)
        want = M.components(z.T @ z, 2)[0]
        assert np.allclose(load.u, want, atol=1e-8)
        assert np.allclose(M.factors(z, load, 2), z @ want)


def test_holes_are_filled_from_the_factors_and_dead_columns_left_out(spark):
    whole, data = planted(holes=0.0), planted(holes=0.0)
    rng = np.random.default_rng(9)
    for _, v, _, _ in data:
        v[rng.random(v.shape) < 0.2] = np.nan
    wide = [(e, np.column_stack([v, np.full(Q, 3.0), np.where(np.arange(Q) < 45, np.nan, 1.0 * np.arange(Q))]), y, f) for e, v, y, f in data]
    panel = M.Panel(frame(spark, wide), [40], Q)
    load = panel.loadings(panel.scale(), 2, 200, 1e-9)["0|40"]
    mean, sd, cols = load[:3]
    assert list(cols) == list(range(6))
    full = M.Panel(frame(spark, whole), [40], Q)
    true = full.loadings(full.scale(), 2, 200, 1e-9)["0|40"].u
    zeros = np.vstack([(v[:40] - mean[:6]) / sd[:6] for _, v, _, _ in data])
    naive = M.components(np.nan_to_num(zeros).T @ np.nan_to_num(zeros), 2)[0]
    off = lambda a: np.abs(a @ a.T - true @ true.T).max()
    assert off(load.u) < 0.03 and off(load.u) <= off(naive) + 1e-3
    got = np.vstack([M.factors(((v[:40] - mean[:6]) / sd[:6])[:, cols], load, 2) for _, v, _, _ in data])
    f = np.vstack([f[:40] for _, _, _, f in data])
    ok = ~np.isnan(got).any(axis=1)
    fit = np.linalg.lstsq(np.column_stack([np.ones(ok.sum()), got[ok]]), f[ok], rcond=None)[0]
    rest = f[ok] - np.column_stack([np.ones(ok.sum()), got[ok]]) @ fit
    assert (1 - rest.var(axis=0) / f[ok].var(axis=0) > 0.97).all()


@pytest.mark.parametrize("order", [1, 2])
def test_forecasts_equal_numpy(spark, order):
    data, horizon, k = planted(holes=0.05), 3, 2
    panel = M.Panel(frame(spark, data), ORIGINS, Q)
    loads = panel.loadings(panel.scale(), k, 200, 1e-9)
    fits = M._regressions(panel, loads, [1, k], [order], horizon, TARGETS)
    got = {(r["entity"], r["q"], r["k"], r["ord"], r["target"], r["horizon"]): (r["pred"], r["sd"])
           for r in M._forecasts(panel, loads, fits, [1, k], [order], horizon).collect()}
    for o in ORIGINS:
        f = {e: M._observed(v, f"0|{o}", k, loads) for e, v, _, _ in data}
        rows = [(e, t) for e, *_ in data for t in range(order, o) if not np.isnan(f[e][t - order:t + 1]).any()]
        x = np.array([np.r_[1.0, f[e][t - order:t][::-1].ravel()] for e, t in rows])
        a = np.linalg.lstsq(x, np.array([f[e][t] for e, t in rows]), rcond=None)[0]
        res = np.array([f[e][t] for e, t in rows]) - x @ a
        noise = res.T @ res / len(rows)
        ys = {e: y for e, _, y, _ in data}
        for target in range(TARGETS):
            rows = [(e, t) for e, *_ in data for t in range(o) if not np.isnan(f[e][t]).any()]
            x = np.array([np.r_[1.0, f[e][t]] for e, t in rows])
            label = np.array([ys[e][t, target] for e, t in rows])
            beta = np.linalg.lstsq(x, label, rcond=None)[0]
            s2 = ((label - x @ beta) ** 2).mean()
            for e, *_ in data:
                if np.isnan(f[e][o - order + 1:o + 1]).any():
                    assert (f"e{e}", o, k, order, target, 1) not in got
                    continue
                past, cov = [f[e][o - j] for j in range(order)], {0: np.zeros((k, k))}
                jump = [np.eye(k)]                      # responses to a shock, by age
                for h in range(horizon):
                    if h:
                        past = [a[0] + sum(a[1 + j * k:1 + (j + 1) * k].T @ past[j] for j in range(order)), *past[:order - 1]]
                        jump.append(sum(a[1 + j * k:1 + (j + 1) * k].T @ jump[-1 - j] for j in range(min(order, len(jump)))))
                        cov[h] = sum(m @ noise @ m.T for m in jump[:h])
                    pred, sd = got[f"e{e}", o, k, order, target, h + 1]
                    assert pred == pytest.approx(beta[0] + beta[1:] @ past[0], abs=1e-6)
                    assert sd == pytest.approx(np.sqrt(beta[1:] @ cov[h] @ beta[1:] + s2), abs=1e-6)
            for h in range(1, horizon + 1):
                rows = [(e, t) for e, *_ in data for t in range(1, o - h + 1) if not np.isnan(f[e][t]).any()]
                x = np.array([np.r_[1.0, f[e][t], ys[e][t - 1, target]] for e, t in rows])
                b = np.linalg.lstsq(x, np.array([ys[e][t + h - 1, target] for e, t in rows]), rcond=None)[0]
                for e, *_ in data:
                    if not np.isnan(f[e][o]).any():
                        assert got[f"e{e}", o, k, 0, target, h][0] == pytest.approx(b @ np.r_[1.0, f[e][o], ys[e][o - 1, target]], abs=1e-6)
