import math
import random
import re
from collections import Counter

import pytest

from panelcast.llm import lexical as L
from tests.llm.brute import lower
from tests.llm.conftest import prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall(lower(t or ""))


def brute(docs, items, top=10):
    """(item_id, rank, doc_id, score), items in order; null doc_ids last."""
    held = [(i, Counter(w), len(w)) for i, t in docs if (w := terms(t))]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in held:
            m = 25 + 75 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(found[:top])]
    return out


def _tables():
    rng = random.Random(4)
    pool = [prose(rng, rng.randint(1, 40)) for _ in range(30)]
    docs = [(k, rng.choice(pool) if k % 3 else prose(rng, rng.randint(1, 60))) for k in range(200)]
    docs += [(500, None), (501, ""), (502, "!!! ..."), (None, pool[0]), (None, pool[1]), (7, pool[2]), (7, pool[2]),
             (503, "Éan ÉAN an-AN chi_chi 12 x2"), (504, "an " * 30_000 + pool[3])]
    docs += [(600 + k, pool[4]) for k in range(40)]
    items = [(f"i{k}", prose(rng, rng.randint(1, 12))) for k in range(25)]
    items += [("twice", "an an an chi"), ("twice", "dor el"), ("none", None), ("empty", ""), ("odd", "?!"), ("unknown", "zzzz qqqq"),
              ("copy", pool[4]), (None, "12 éan ÉAN"), ("mixed", "zzzz an")]
    return docs, items


@pytest.mark.parametrize("p", [L.SearchParams(), L.SearchParams(block_items=4, chunk_cells=8), L.SearchParams(block_postings=20, top=3)])
def test_equals_brute_force(spark, frame, p):
    docs, items = _tables()
    got = L.search(frame([(i, t, 1, "m") for i, t in docs], "doc_id long, text string, n int, bag string"),
                   frame([(i, t, 0) for i, t in items], "item_id string, text string, item int", 2), p=p)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(docs, items, p.top), key=str)


def test_ties_go_to_the_smallest_doc_ids_across_classes(spark, frame):
    # the same score from two different classes: the words differ, their counts do not
    docs = [(k, "alpha beta" if k % 2 else "alpha gamma") for k in range(40)] + [(k, "delta delta") for k in range(100, 140)]
    items = [("a", "alpha"), ("bg", "beta gamma")]
    got = L.search(frame(docs, "doc_id long, text string", 7), frame(items, "item_id string, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs, items))
    assert [r["doc_id"] for r in got.where("item_id = 'a'").orderBy("rank").collect()] == list(range(10))


def test_classes_are_few_and_hold_the_smallest_members(spark, frame):
    docs = [(k, "alpha beta zeta") for k in range(300, 0, -1)] + [(1000 + k, "alpha beta omega") for k in range(5)] + [(2000, "alpha alpha")]
    held = L.bags(frame(docs, "doc_id long, text string", 5), {b"alpha": 0, b"beta": 1})
    got = sorted((r["members"] for r in L.classes(held, 306, 917, L.SearchParams()).collect()), key=str)
    assert got == [list(range(1, 11)), [2000]]


def test_empty_tables_and_schema(spark, frame):
    d, i = "doc_id long, text string", "item_id int, text string"
    some, item = frame([(1, "an chi")], d), frame([(1, "an chi")], i)
    for a, b in ((frame([], d), item), (some, frame([], i)), (frame([(1, None)], d), item), (some, frame([(1, "zz")], i))):
        got = L.search(a, b)
        assert got.collect() == [] and got.columns == ["item_id", "rank", "doc_id", "score"]
    assert L.search(some, item).dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
