import random

import numpy as np

from panelcast.llm import license_scan as S
from panelcast.llm.common import word_hashes
from tests.llm.conftest import SF, prose


def _full(doc, tpl):
    """Best local alignment without a band: (score, matched) by the whole table."""
    rows = [[(0, 0)] * (len(doc) + 1) for _ in range(len(tpl) + 1)]
    best = (0, 0)
    for i in range(1, len(tpl) + 1):
        for j in range(1, len(doc) + 1):
            s, m = rows[i - 1][j - 1]
            cell = (s + 2, m + 1) if doc[j - 1] == tpl[i - 1] else (s - 1, m)
            cell = max(cell, (rows[i - 1][j][0] - 1, rows[i - 1][j][1]), (rows[i][j - 1][0] - 1, rows[i][j - 1][1]), key=lambda x: x[0])
            rows[i][j] = cell if cell[0] > 0 else (0, 0)
            if rows[i][j][0] > best[0]:
                best = rows[i][j]
    return best


def test_winnowing_keeps_one_gram_of_every_window():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 50):
        g = rng.integers(0, 9, n, dtype=np.uint64)
        kept = set(S.winnow(g, 3).tolist())
        assert all(kept & set(range(i, i + 3)) for i in range(max(0, n - 2))) and (not n or kept)
        for i in range(max(0, n - 2)):
            w = g[i:i + 3]
            assert i + max(k for k in range(3) if w[k] == w.min()) in kept


def test_banded_scan_finds_what_full_alignment_finds():
    rng = random.Random(9)
    p = S.ScanParams()
    index = S.Index(S.TEMPLATES, p)
    for name, text in S.TEMPLATES.items():
        words = [w.decode() for w in S.words_of(text.encode())]
        for edits in (0, 1, 2):
            w = list(words)
            for _ in range(min(edits, len(w) // 8)):
                k = rng.randrange(1, len(w) - 1)
                w[k:k + 1] = rng.choice([[], ["xx"], [w[k], "yy"]])
            before = prose(rng, 30).split()
            doc = word_hashes(S.words_of(" ".join([*before, *w, *prose(rng, 30).split()]).encode()))
            score, matched = _full(doc.tolist(), index.words[name].tolist())
            got = [m for m in index.scan(doc, p) if m[0] == name]
            assert len(got) == 1 and got[0][1] == matched
            assert got[0][2] == 30 and got[0][3] <= 30 + len(w)


def test_nulls_repeats_ties_empty_and_long_texts(spark, frame):
    mit = "Released under the MIT License."
    rows = [(1, None, 1), (2, "", 1), (3, mit, 1), (3, mit, 1), (None, mit.upper(), 1), (4, f"{mit} and again: {mit}", 1),
            (5, "word " * 30_000 + mit, 1), (6, "Released under the MIT Licence.", 1)]
    df = frame(rows, "doc_id long, text string, license int")
    got = sorted(((r["doc_id"], r["license"], r["coverage_pct"], r["first_word"], r["end_word"]) for r in S.scan(df).collect()), key=str)
    assert got == sorted([(3, "MIT-notice", 100, 0, 5), (3, "MIT-notice", 100, 0, 5), (None, "MIT-notice", 100, 0, 5),
                          (4, "MIT-notice", 100, 0, 5), (4, "MIT-notice", 100, 7, 12), (5, "MIT-notice", 100, 30_000, 30_005),
                          (6, "MIT-notice", 80, 0, 4)], key=str)
    assert S.scan(frame([], df.schema)).collect() == []
    assert S.scan(df, {}).collect() == [] and S.scan(df, {"none": "..."}).collect() == []


def test_blocks_of_templates_give_the_same_matches(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = sorted(map(tuple, S.scan(docs).collect()))
    assert whole == sorted(map(tuple, S.scan(docs, p=S.ScanParams(index_bytes=600)).collect()))
    texts = [r["text"] or "" for r in docs.collect()]
    for name in ("MIT-notice", "GPL-3.0-notice", "CC-BY-NC-4.0", "Apache-2.0-notice"):
        assert sum(m[1] == name for m in whole) == sum(t.count(S.TEMPLATES[name]) for t in texts)
