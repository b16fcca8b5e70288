import random

import numpy as np

from panelcast.llm import near_dup as N
from tests.llm import brute
from tests.llm.conftest import SF, prose


def _corpus():
    rng = random.Random(7)
    rows, i = [], 0
    for _ in range(6):
        base = prose(rng, 120).split()
        for edits in (0, 0, 1, 2, 3, 4, 6, 9):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(len(w))] = prose(rng, 1)
            rows.append((i, " ".join(w)))
            i += 1
    rows += [(i + k, t) for k, t in enumerate([None, "", " \n ", "one two", "ONE  two", "one two three four", prose(rng, 20_000)])]
    return rows + [(rows[0][0], rows[0][1])]


def _got(df, p):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in N.near_components(df, p).collect()}


def test_equals_brute_force(spark, frame):
    rows = _corpus()
    df = frame(rows, "doc_id long, text string")
    for k in (4, 5):
        comp = brute.near_components(rows, k)
        want = {i: (len(brute.shingles(t, k)), comp[i], comp[i] == i) for i, t in rows}
        assert _got(df, N.ForestParams(width=k)) == want


def test_small_regions_and_pieces_find_the_same_components(spark, frame):
    """Regions are cut and clusters split into pieces; the exact join finds what that parts."""
    rows = _corpus()
    comp = brute.near_components(rows, 5)
    df = frame(rows, "doc_id long, text string")
    for p in (N.ForestParams(region_rows=3, piece_shingles=500), N.ForestParams(region_rows=2)):
        assert {i: c[1] for i, c in _got(df, p).items()} == comp


def test_exact_stars_confirm_the_threshold():
    a = np.arange(100, dtype=np.uint64)
    sets = [a, a[:80], a[:79], a + np.uint64(1000)]
    assert N.exact_stars(np.array([9, 4, 7, 1]), sets, 80) == [(4, 9), (4, 7)] or \
        set(N.exact_stars(np.array([9, 4, 7, 1]), sets, 80)) == {(4, 9), (4, 7)}
    assert N.exact_stars(np.array([9, 7]), [a, a[:79]], 80) == []


def test_recall_of_the_forest_at_the_threshold(spark, frame):
    """Pairs just above 0.8 are all found: 150 planted pairs."""
    rng = random.Random(11)
    rows = []
    for i in range(150):
        w = prose(rng, 230).split()
        v = list(w)
        for at in rng.sample(range(0, 220, 10), 5):
            v[at + 5] = "changed" + str(at)
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    comp = brute.near_components(rows, 5)
    assert {i: c[1] for i, c in _got(frame(rows, "doc_id long, text string"), N.ForestParams()).items()} == comp


def test_null_ids_extra_columns_and_empty_tables(spark, frame):
    text = prose(random.Random(1), 50)
    df = frame([(2, text, "x"), (1, text, "y"), (None, text, "z"), (None, None, None)], "doc_id long, text string, gone_id string")
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(str, (r["gone_id"] for r in kept.collect()))) == ["None", "y", "z"]
    assert N.near_components(frame([], "doc_id long, text string")).collect() == []


def test_query_equals_brute_force_on_the_small_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    comp = brute.near_components(rows, 4)
    assert {r["doc_id"]: r["component_id"] for r in N.op6_minhash_near_dedup(spark, SF).collect()} == comp


def _chain(rng, steps, words=60, move=3):
    """Texts of a sliding window over one long prose: neighbours link, distant ones share nothing."""
    w = prose(rng, words + steps * move).split()
    return [" ".join(w[k * move:k * move + words]) for k in range(steps)]


def test_clusters_beyond_the_piece_bound_equal_brute_force(spark, frame):
    """Chains far longer than a piece, where no hub is near most of the members."""
    rng = random.Random(5)
    texts = _chain(rng, 10) + _chain(rng, 5)
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    comp = brute.near_components(rows, 5)
    assert len(set(comp.values())) == 2
    df = frame(rows, "doc_id long, text string")
    p = N.ForestParams(piece_shingles=60, near_pct=0, depth=1, salt_rows=2, common_shingles=5)
    assert {i: c[1] for i, c in _got(df, p).items()} == comp


def test_a_crowded_region_parts_no_other_region(spark, frame):
    """One group is larger than a region may be; the pairs elsewhere are found as without it, in tables of many partitions."""
    rng = random.Random(13)
    texts = []
    base = prose(rng, 120).split()
    for k in range(30):
        w = list(base)
        w[4 * k:4 * k + 1] = [f"changed{k}"]
        texts.append(" ".join(w))
    for _ in range(60):
        w = prose(rng, 120).split()
        texts += [" ".join(w), " ".join(w[:60] + ["changed"] + w[61:])]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    comp = brute.near_components(rows, 5)
    assert len(set(comp.values())) == 61
    name = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few rows are one partition
    was = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        got = _got(frame(rows, "doc_id long, text string", 8), N.ForestParams(region_rows=10))
    finally:
        spark.conf.set(name, was)
    assert {i: c[1] for i, c in got.items()} == comp
