import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from panelcast.llm import packing as P
from tests.llm.conftest import SF
from tests.llm.test_bpe import ODD


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.default_vocabulary())


def test_fast_ids_equal_the_library(library):
    fast, rng = P.load(P.default_vocabulary()), random.Random(6)
    assert fast.fast
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(12)) for _ in range(2000)]
    words = sorted(library.get_vocab())
    texts += [library.decode([rng.randrange(50256) for _ in range(rng.randint(1, 6))]) for _ in range(6000)]
    texts += ["a" * 3000, " " * 1001 + "x", "aaab" * 500, "é" * 700, "<|endoftext|>" * 3, "", *words[:2000]]
    for t in texts:
        assert fast.ids(t) == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_runs_of_white_space_need_no_pattern_that_looks_ahead(library):
    import regex

    fast, rng = P.load(P.default_vocabulary()), random.Random(8)
    assert "(?!" not in fast.encoding._pat_str
    white = regex.findall(r"\s", "".join(map(chr, range(0x3001))))
    texts = [f"a{x}{y}b{y}{x}{y}1{x}!{y}" for x in white for y in white] + [f"{x}\x1c{y}a\x1f{x}\u180e{y}" for x in white for y in white]
    texts += ["".join(rng.choice([" ", " ", "\n", "\t", "\r", "\xa0", "\u2003", "it's", "word", "7", "!", "é", "\x1d", "字"]) for _ in range(40)) for _ in range(3000)]
    texts += ["def f(x):\n    return  x  \n\n\n  # done \n", "   ", " \n \n", "  a", "a  ", "\n\na"]
    for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert fast.ids(t) == e.ids, repr(t)
        assert fast.closed(t, 0, "<u4").tolist() == [*e.ids, 0]


def test_a_vocabulary_of_another_form_goes_to_the_library(tmp_path, library):
    import json

    with open(P.default_vocabulary(), encoding="utf-8") as f:
        spec = json.load(f)
    a, b = spec["model"]["merges"][:2]
    spec["model"]["merges"][:2] = [b, a]
    with open(tmp_path / "other.json", "w", encoding="utf-8") as f:
        json.dump(spec, f)
    other = P.FastIds(str(tmp_path / "other.json"))
    assert not other.fast
    assert other.ids("the other thing <|endoftext|>") == Tokenizer.from_file(str(tmp_path / "other.json")).encode("the other thing <|endoftext|>").ids


def test_closest_fill_equals_all_multisets():
    rng = random.Random(1)
    for _ in range(300):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(rng.randint(0, 4))}
        room = rng.randint(0, 30)
        sums = {sum(n * c for n, c in zip(counts, some)) for some in itertools.product(*(range(c + 1) for c in counts.values()))}
        got = P.closest_fill(counts, room)
        assert all(c <= counts[n] for n, c in got.items())
        assert sum(n * c for n, c in got.items()) == max(s for s in sums if s <= room)


def _docs(rng, n):
    return [(k, np.arange(k * 1000, k * 1000 + rng.choice([1, 2, 7, 33, 64, 63, 65, 200, rng.randint(1, 300)]), dtype="<u4")) for k in range(n)]


@pytest.mark.parametrize("pool_rows", [2, 7, 50, 10_000])
def test_every_id_once_and_no_padding(pool_rows):
    rng = random.Random(pool_rows)
    for docs in ([], _docs(rng, 1), _docs(rng, 400), [(k, np.arange(40, dtype="<u4")) for k in range(90)]):
        windows = list(P._sequences(iter(docs), P.PackParams(capacity=64, pool_rows=pool_rows)))
        sizes = [sum(len(ids) for _, _, ids in w) for w in windows]
        assert all(s == 64 or s & (s - 1) == 0 for s in sizes)
        assert sum(s < 64 for s in sizes) <= 6
        parts = defaultdict(list)
        for doc, start, ids in itertools.chain.from_iterable(windows):
            parts[doc].append((start, ids.tolist()))
        for doc, ids in docs:
            found = sorted(parts.pop(doc))
            assert [x for _, piece in found for x in piece] == ids.tolist()
            assert [s for s, _ in found] == list(itertools.accumulate([0, *(len(x) for _, x in found)]))[:-1]
        assert not parts


def test_most_windows_need_no_cut():
    rng = random.Random(3)
    docs = [(k, np.zeros(rng.randint(1, 1023), dtype="<u4")) for k in range(3000)]
    windows = list(P._sequences(iter(docs), P.PackParams(pool_rows=500)))
    assert sum(map(len, windows)) - len(docs) < len(windows) / 3   # concatenating would cut at every window


def _check(rows, texts, library):
    """Every piece against the library's ids; ``texts`` are (doc_id, text), no doc_id twice."""
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for i, t in texts}
    cover, at = defaultdict(list), defaultdict(list)
    for r in rows:
        whole = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(whole) and r["length"] > 0
        assert r["ids_crc32"] == zlib.crc32(whole[r["start"]:r["start"] + r["length"]].tobytes())
        cover[r["doc_id"]].append((r["start"], r["length"]))
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(cover) == set(ids)
    for held, total in [*((c, len(ids[i])) for i, c in cover.items()), *((s, None) for s in at.values())]:
        end = 0
        for start, n in sorted(held):
            assert start == end
            end += n
        assert end == total if total is not None else end in {1 << k for k in range(11)}
    return at


def test_query_over_the_whole_table(spark, library):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    _check(P.op11_packing(spark, SF).collect(), texts, library)


def test_nulls_repeats_long_texts_and_clashing_names(spark, frame, library):
    rows = [(1, "hello world", 5, "x"), (2, None, 6, "y"), (None, "naïve café\n", 7, None), (3, "", 8, "z"), (4, "word " * 50_000, 9, "long")]
    df = frame(rows, "doc_id long, text string, start long, ids string", 1)
    from pyspark.sql import functions as F

    got = P.pack(df).withColumn("ids_crc32", F.crc32("ids")).collect()
    _check(got, [(r[0], r[1]) for r in rows], library)
    twice = P.pack(frame([rows[0]] * 700, df.schema, 2)).collect()
    assert Counter(r["doc_id"] for r in twice)[1] >= 700 and sum(r["length"] for r in twice) == 700 * 3
    assert P.pack(frame([], df.schema)).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        P.Packer(P.PackParams(capacity=100))
