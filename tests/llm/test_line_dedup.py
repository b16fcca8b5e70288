import random

from panelcast.llm import line_dedup as L
from tests.llm import brute


def _rows():
    rng = random.Random(2)
    pool = [f"line number {i} of the pool" for i in range(12)] + ["short", "", "   ", "ÉCLAIR au café", "\tPadded LINE here \r", "padded line here"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    return rows + [(None, pool[0]), (70, None), (71, ""), (5, pool[1] + "\n" + pool[2]), (72, "\n\n"), (73, pool[3] + "\n" + pool[3]),
                   (74, "\n".join([pool[4]] * 3000))]


def test_equals_brute_force_for_any_batches_and_fanout(spark, frame):
    rows = _rows()
    df = frame(rows, "doc_id long, text string")
    want = sorted(brute.line_dedup(rows), key=str)
    for p in (L.LineParams(), L.LineParams(batches=1), L.LineParams(batches=7, fanout=3)):
        assert sorted(map(tuple, L.dedup_lines(df, p).collect()), key=str) == want


def test_dedup_keeps_columns_rows_and_texts(spark, frame):
    rows = _rows()
    df = frame([(i, t, i, "b") for i, t in rows], "doc_id long, text string, gone long, h1 string")
    got = L.dedup(df)
    assert got.columns == df.columns
    want = sorted(((i, t if t is None else k, i, "b") for (i, t), (_, _, _, k) in zip(rows, brute.line_dedup(rows))), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_empty_table(spark, frame):
    assert L.dedup_lines(frame([], "doc_id long, text string")).collect() == []
