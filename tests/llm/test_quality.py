import random

from pyspark.sql import functions as F

from panelcast.llm import quality as Q
from tests.llm import brute
from tests.llm.conftest import prose


def _rows():
    rng = random.Random(4)
    ten = prose(rng, 10)
    texts = [None, "", " \n\t", "a b c", prose(rng, 25), " ".join([ten] * 5), prose(rng, 30) + " " + ten + " x " + ten,
             "word " * 40, "x\n" * 30 + prose(rng, 30), "### $$$ %%% " * 20 + prose(rng, 10), "é" * 400 + " " + prose(rng, 25),
             "a b " * 25, prose(rng, 20_000), "same line here\n" * 9 + prose(rng, 60), " ".join("abcdefg")]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(8, 60))) for _ in range(30)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, texts[4]), (4, texts[4])]


def test_measures_and_verdicts_equal_brute_force(spark, frame):
    rows = _rows()
    df = frame(rows, "doc_id long, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = sorted(((r["doc_id"], *(r[n] for n in names)) for r in Q.report(df).collect()), key=str)
    assert got == sorted(((i, *(brute.quality(t)[n] for n in names)) for i, t in rows), key=str)


def test_every_order_of_the_cascade_gives_the_same_verdict(spark, frame):
    rows = _rows()
    df = frame([(i, t, "w", "l") for i, t in rows], "doc_id long, text string, words string, lines string")
    want = sorted(str(i) for i, t in rows if brute.quality(t)["kept"])
    kept = Q.keep(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    rules = Q.rules(F.col("text"))
    for names in (list(rules), list(rules)[::-1]):
        assert sorted(str(r["doc_id"]) for r in df.where(Q.cascade(rules, names).isNull()).collect()) == want


def test_order_is_by_rejection_per_cost():
    assert Q.order([("slow", 2.0, 0.5), ("quick", 0.1, 0.2), ("idle", 0.1, 0.0), ("tie", 0.1, 0.0)]) == ["quick", "slow", "idle", "tie"]


def test_empty_table(spark, frame):
    df = frame([], "doc_id long, text string")
    assert Q.report(df).collect() == [] and Q.keep(df).collect() == []
    assert [s[2] for s in Q.profile(df)] == [0.0] * 5


def test_main_path_has_no_python(spark, frame):
    plan = Q.report(frame(_rows(), "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
