import random

import pytest
from tokenizers import Tokenizer

from panelcast.llm import bpe
from tests.llm.brute import sha

ODD = ["a", "A", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "ß", "1", "²", "½", "漢", "😀", "👩‍👩‍👧", "'s", "'ll", "<|endoftext|>",
       "<|endoftext", "​", "　", "՘", "꟎", "\U00031350", "!!", "́", "xxxxxxxxx", "  "]


@pytest.fixture(scope="module")
def own():
    return bpe.load(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def test_ids_and_text_equal_the_library(own, library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(12)) for _ in range(1000)]
    texts += ["a" * 3000, " " * 1001 + "x", "aaab" * 500, "é" * 700, "=-" * 900, "<|endoftext|>" * 3, ""]
    for t, got in zip(texts, own.ids(texts), strict=True):
        ids = library.encode(t, add_special_tokens=False).ids
        assert got == ids, repr(t)
        assert own.text(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_token_encodes_to_itself(own):
    words = sorted((w, t) for t, w in own.bytes_of.items() if t in own.parts)
    assert list(own.encode_pieces([w for w, _ in words])) == [(t,) for _, t in words]


def test_small_caches_do_not_change_the_ids(library):
    small = bpe.Bpe(bpe.default_vocabulary())
    small.piece_bytes, small.piece_chars, small.pair_limit = 900, 4, 5
    texts = ["The quick brown fox jumps over the lazy dog, again and again and again.", "dogs", "", "The lazy quickest fox"]
    assert small.ids(texts) == small.ids(texts) == [library.encode(t).ids for t in texts]


def test_round_trip_with_nulls_repeats_and_extra_columns(spark, frame, library):
    rows = [(1, "hello world", "x"), (1, "hello world", "x"), (2, None, None), (None, "naïve café\n", "y"), (3, "", "z"),
            (4, "word " * 50_000, "long")]
    df = frame(rows, "doc_id long, text string, tokens string")
    done = bpe.decode(bpe.encode(df)).collect()
    assert sorted((r["doc_id"] or -1, r["decoded"]) for r in done) == sorted((r[0] or -1, r[1] or "") for r in rows)
    assert all(r["ids"] == library.encode(r["text"] or "").ids and "tokens" in r.asDict() for r in done)
    assert sorted(map(str, bpe.round_trip(df).collect())) == sorted(map(str, done))
    assert bpe.encode(frame([], df.schema)).count() == 0
    with pytest.raises(ValueError, match="already"):
        bpe.encode(df.withColumnRenamed("tokens", "IDS"), out="ids")


def test_query_over_the_whole_table(spark, library):
    from tests.llm.conftest import SF

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in bpe.op1_bpe_round_trip(spark, SF).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(t))
