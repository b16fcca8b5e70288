import random

from panelcast.llm import decontaminate as D
from tests.llm import brute
from tests.llm.conftest import prose


def _case():
    rng = random.Random(3)
    items = [(i, prose(rng, rng.choice([1, 2, 3, 8, 13, 14, 40]))) for i in range(25)]
    items += [(100, items[6][1]), (100, items[6][1]), (101, None), (102, ""), (103, "Ünïcode, ÄÖ 7x! " * 5), (104, " ".join(["same"] * 30))]
    docs = []
    for i in range(40):
        w = prose(rng, rng.randint(0, 80)).split()
        for _ in range(rng.randint(0, 2)):
            take = rng.choice(items)[1]
            take = (take or "").split()
            cut = take[rng.randint(0, 3):rng.randint(5, 60)]
            at = rng.randint(0, len(w))
            w[at:at] = cut
        docs.append((i, ", ".join(w).upper() if i % 3 else "\n".join(w)))
    docs += [(50, None), (51, ""), (50, items[6][1]), (None, items[6][1]), (52, "same " * 500), (53, items[6][1] + " ?? " + items[6][1])]
    return docs, items


def test_equals_brute_force(spark, frame):
    docs, items = _case()
    got = D.hit_report(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"))
    rows = sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]) for r in got.collect()), key=str)
    want = []
    for i, t in docs:
        n, hit, found = brute.contamination(t, items)
        want.append((i, n, hit, found, hit > 0 and 20 * hit >= n))
    assert rows == sorted(want, key=str)


def test_a_tiny_bitmap_only_costs_candidates(spark, frame):
    docs, items = _case()
    d, b = frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")
    key = lambda r: str((r["doc_id"], r["n_hit"], r["items"]))
    assert sorted(map(key, D.hit_report(d, b, D.DecontaminationParams(bitmap_bits=8)).collect())) == sorted(map(key, D.hit_report(d, b).collect()))


def test_keep_clean_and_empty_tables(spark, frame):
    docs, items = _case()
    d = frame([(i, t, "x") for i, t in docs], "doc_id long, text string, gone_id string")
    b = frame(items, "item_id long, text string")
    bad = {t for _, t in docs for n, hit, _ in [brute.contamination(t, items)] if hit and 20 * hit >= n}
    kept = D.keep_clean(d, b)
    assert kept.columns == d.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(i) for i, t in docs if t not in bad)
    assert D.keep_clean(d, frame([], b.schema)).count() == len(docs)
    assert D.hit_report(frame([], d.schema), b).collect() == []


def test_keep_clean_judges_rows_that_share_an_id_one_by_one(spark, frame):
    from panelcast.llm import decontaminate as M

    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    rows = [(None, item), (None, "nothing of it here"), (None, None), (5, item + " and more"), (5, "a clean text"), (6, "clean as well")]
    got = M.keep_clean(frame(rows, "doc_id long, text string"), frame([("i", item)], "item_id string, text string"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [rows[1], rows[2], rows[4], rows[5]]))
