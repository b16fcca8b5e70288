import importlib

from tests.llm import brute
from tests.llm.conftest import SF


def test_stages_equal_brute_force_one_by_one(spark):
    from tokenizers import Tokenizer

    from panelcast.llm.bpe import default_vocabulary

    pipe = importlib.import_module("corpus_pipeline")
    assert [n for n, _ in pipe.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "bpe_ids"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]

    want = [[r for r in rows if brute.quality(r[1])["kept"]]]
    want.append([(i, t) for i, _, _, t in brute.line_dedup(want[-1])])
    comp = brute.near_components(want[-1], 5)
    want.append([r for r in want[-1] if comp[r[0]] == r[0]])
    want.append([r for r in want[-1] for n, hit, _ in [brute.contamination(r[1], items)] if not (hit and 20 * hit >= n)])
    for (name, stage), expected in zip(pipe.STAGES[:-1], want):
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        assert sorted(tuple(r) for r in docs.select("doc_id", "text").collect()) == sorted(expected), name
        assert docs.where("n_chars <> char_length(text)").count() == 0, name
    library = Tokenizer.from_file(default_vocabulary())
    final = {r["doc_id"]: r for r in pipe.STAGES[-1][1](spark, docs, SF).collect()}
    assert {i: r["ids"] for i, r in final.items()} == {i: library.encode(t).ids for i, t in want[-1]}
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in final.values())
    assert {r["doc_id"]: r["ids"] for r in pipe.run(spark, SF).collect()} == {i: r["ids"] for i, r in final.items()}
