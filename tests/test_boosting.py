"""Boosted trees of many groups against plain per-group loops, whole blocks against split ones."""

import math
import random

import numpy as np
import pytest

from panelcast.models import histboost as H

FEATURES, BINS = 4, 6


def rows_of(seed, groups=3, n=70):
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        for i in range(n + 10 * g):
            x = [rng.randint(0, BINS) for _ in range(FEATURES)]
            y = math.sin(x[0]) + 0.3 * x[1] * (x[2] > 2) + rng.gauss(0, 0.2)
            out.append((g, 1 if i % 3 else 2, y, bytes(x)))
    out += [(0, 3, 9.0, bytes(FEATURES)), (1, 1, None, bytes(FEATURES))]
    return out + [(7, 1, rng.gauss(0, 1), bytes([k % 5, 0, 0, 1])) for k in range(20)]   # a group without validation rows


def side_gain(r, l2):
    return sum(r) ** 2 / (len(r) + l2) if len(r) + l2 else 0.0


def plain_tree(x, g, p):
    """Leaf of every row and the leaves' values, by trying every split."""
    at, feature, cut = [0] * len(x), [], []
    for _ in range(p.depth):
        nodes = range(1 << len(feature))
        tried = {}
        for f in range(FEATURES):
            for b in range(p.bins + 1):
                for n in nodes:
                    mine = [i for i in range(len(x)) if at[i] == n]
                    left, right = [g[i] for i in mine if x[i][f] <= b], [g[i] for i in mine if x[i][f] > b]
                    ok = min(len(left), len(right)) >= p.min_rows
                    tried[n, f, b] = side_gain(left, p.l2) + side_gain(right, p.l2) - side_gain(left + right, p.l2) if ok else 0.0
        picks = {}
        for n in nodes:
            total = {(f, b): sum(tried[k, f, b] for k in nodes) if p.symmetric else tried[n, f, b] for f in range(FEATURES) for b in range(p.bins + 1)}
            best = min(k for k in total if total[k] >= max(total.values()) * (1 - H.TIE))
            picks[n] = best if total[best] > 1e-12 else None
        feature.append(picks)
        at = [2 * a + (picks[a] is not None and x[i][picks[a][0]] > picks[a][1]) for i, a in enumerate(at)]
    leaves = {}
    for n in range(1 << p.depth):
        r = [g[i] for i in range(len(x)) if at[i] == n]
        leaves[n] = p.rate * sum(r) / (len(r) + p.l2) if len(r) + p.l2 else 0.0

    def value(row):
        a = 0
        for picks in feature:
            a = 2 * a + (picks[a] is not None and row[picks[a][0]] > picks[a][1])
        return leaves[a]

    return value


def plain_fit(rows, p, trees):
    """Scores after every number of trees, as functions of a row."""
    x, y = [r[3] for r in rows], np.array([r[2] for r in rows])
    start = [y.mean()] if p.heads == 1 else [y.mean(), math.log(y.std())]
    score = np.repeat(np.array(start)[:, None], len(y), axis=1)
    out = []
    for _ in range(trees):
        grown = [plain_tree(x, list(g), p) for g in H.gradients(p.kind, y, score)]
        for head, tree in enumerate(grown):
            score[head] += [tree(r) for r in x]
        out.append(grown)
    return start, out


def plain_score(start, grown, x):
    return np.array([[s + sum(t[h](r) for t in grown) for r in x] for h, s in enumerate(start)])


CASES = {
    "squared": H.BoostParams(trees=12, depth=2, rate=0.5, patience=3, bins=BINS, refresh=4, l2=1.0),
    "crps": H.BoostParams(kind="crps", trees=14, depth=2, rate=0.6, patience=3, bins=BINS, refresh=3, l2=0.0),
}


@pytest.mark.parametrize("kind", sorted(CASES))
def test_equals_plain_loops_and_stops_at_the_best_number(spark, kind):
    p, rows = CASES[kind], rows_of(3 if kind == "squared" else 4)
    df = spark.createDataFrame(rows, "grp int, part int, y double, x binary").repartition(5)
    one = H.fit(df, p)
    import dataclasses

    split = H.fit(df, dataclasses.replace(p, block_rows=16))   # every group over many blocks: a job a level
    probe = [bytes([a, b, c, 1]) for a in range(0, BINS + 1, 2) for b in range(0, BINS + 1, 3) for c in (0, 5)]
    kept = {}
    for g in (0, 1, 2, 7):
        train = [r for r in rows if r[0] == g and r[1] == 1 and r[2] is not None]
        valid = [r for r in rows if r[0] == g and r[1] == 2]
        start, grown = plain_fit(train, p, p.trees)
        if valid:
            y = np.array([r[2] for r in valid])
            loss = [H.loss(p.kind, y, plain_score(start, grown[:m], [r[3] for r in valid])).mean() for m in range(p.trees + 1)]
            best, known = 1, 1
            while known < p.trees and known - best < p.patience:
                known += 1
                best = min(range(1, known + 1), key=lambda m: loss[m])
        else:
            best = p.trees
        kept[g] = best
        start, grown = plain_fit(train + valid, p, best)
        want = plain_score(start, grown, probe)
        x = np.frombuffer(b"".join(probe), dtype=np.uint8).reshape(len(probe), -1)
        for fitted in (one, split):
            assert len(fitted.trees[g]) == best
            assert np.allclose(fitted.score(g, x), want, atol=1e-9)
            if valid:
                assert np.allclose(fitted.losses[g], loss[:len(fitted.losses[g])], atol=1e-9)
    assert kept[7] == p.trees and any(1 < kept[g] < p.trees for g in (0, 1, 2))


def test_a_job_a_level_whatever_the_number_of_groups(spark, monkeypatch):
    p = H.BoostParams(trees=2, depth=2, bins=BINS, block_rows=16, patience=9)
    levels = []
    real = H._histograms
    monkeypatch.setattr(H, "_histograms", lambda active, pending, growing, level, q: levels.append((level, len(active))) or real(active, pending, growing, level, q))
    for groups in (1, 6):
        levels.clear()
        H.fit(spark.createDataFrame(rows_of(1, groups, 40)[:-20], "grp int, part int, y double, x binary"), p)
        assert levels == [(0, groups), (1, groups), (0, groups), (1, groups), (0, groups)] or len(levels) <= 6


def test_no_rows_and_closed_forms(spark):
    empty = H.fit(spark.createDataFrame([], "grp int, part int, y double, x binary"), CASES["squared"])
    assert empty.trees == {}
    y, mean, sd = np.array([0.3, -1.0]), np.array([0.1, 0.4]), np.array([0.7, 1.3])
    grid = np.linspace(-12, 12, 200_001)
    for k in range(2):
        cdf = H.normal_cdf((grid - mean[k]) / sd[k])
        assert H.crps(y, mean, sd)[k] == pytest.approx(((cdf - (grid >= y[k])) ** 2).sum() * (grid[1] - grid[0]), abs=1e-3)
    # the steps go down the loss
    score = np.stack([mean, np.log(sd)])
    g = H.gradients("crps", y, score)
    for h in range(2):
        step = np.zeros_like(score)
        step[h] = 1e-4 * g[h]
        assert (H.loss("crps", y, score + step) < H.loss("crps", y, score)).all()
