import random
import time
from pathlib import Path

import numpy as np
import pytest

from panelcast.llm import bpe
from panelcast.llm import token_store as T
from tests.llm.brute import sha
from tests.llm.conftest import SF, prose


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_feistel_is_a_keyed_bijection(n):
    f = T.Feistel(n, 5, 6)
    x = np.arange(n)
    y = f.slot(x)
    assert sorted(y.tolist()) == list(range(n)) and (f.index(y) == x).all()
    if n > 50:
        assert (y != T.Feistel(n, 6, 6).slot(x)).any() and (y != x).any()


def _store(spark, frame, tmp_path, rows, p):
    df = frame(rows, "doc_id long, text string, slot long")
    folder = f"file://{tmp_path}/shards"
    manifest, shards = T.write(df, folder, p=p)
    return folder, manifest.collect(), sorted(map(tuple, shards.collect()))


def test_round_trip_resume_and_fixed_stride(spark, frame, tmp_path):
    own = bpe.load(bpe.default_vocabulary())
    p = T.StoreParams(seq_len=8, shard_rows=5)
    rows = [(i, f"document {i} " * (i % 7), 0) for i in range(40)] + [(99, None, 0), (None, "no id", 0), (3, "document 3 " * 3, 0), (98, "x" * 5000, 0)]
    folder, manifest, shards = _store(spark, frame, tmp_path, rows, p)
    n = len(manifest)
    assert sorted(r["slot"] for r in manifest) == list(range(n))
    assert [s[0] for s in shards] == list(range(-(-n // 5))) and sum(s[2] for s in shards) == n
    for shard, file, records, _ in shards:
        assert (tmp_path / "shards" / file).stat().st_size == records * p.stride
    back = {r["slot"]: r["ids"] for r in T.read(spark, folder, p).collect()}
    got = {}
    for r in manifest:
        got.setdefault(r["doc_id"], []).append((r["part"], back[r["slot"]][:r["n_ids"]]))
    want = {}
    for i, t, _ in rows:
        ids = [*own.ids([t or ""])[0], p.end_token]
        want.setdefault(i, []).extend((k // 8, ids[k:k + 8]) for k in range(0, len(ids), 8))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}
    part = {r["slot"]: r["ids"] for r in T.read(spark, folder, p, first=7, last=18).collect()}
    assert part == {s: back[s] for s in range(7, 18)}


def test_empty_table(spark, frame, tmp_path):
    folder, manifest, shards = _store(spark, frame, tmp_path, [], T.StoreParams())
    assert manifest == [] and shards == []


def test_query_stores_the_whole_table(spark):
    own = bpe.load(bpe.default_vocabulary())
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = [*own.ids([r["text"] or ""])[0], 50256]
        want |= {(r["doc_id"], k // 512, sha(",".join(map(str, ids[k:k + 512])))) for k in range(0, len(ids), 512)}
    got = T.op5_token_shards(spark, SF).collect()
    assert {(r["doc_id"], r["part"], r["ids_sha256"]) for r in got} == want and len(got) == len(want)
    assert sorted(r["slot"] for r in got) == list(range(len(want)))
    assert all(r["shard"] == r["slot"] // 4096 and r["offset"] == r["slot"] % 4096 * (4 + 2 * 512) for r in got)


def test_a_folder_with_shards_is_refused(spark, frame, tmp_path):
    p = T.StoreParams(seq_len=8, shard_rows=5)
    _store(spark, frame, tmp_path, [(i, "some words of a text", 0) for i in range(30)], p)
    with pytest.raises(ValueError, match="holds shards already"):
        _store(spark, frame, tmp_path, [(1, "short", 0)], p)


def test_beside_the_shards_lie_compressed_ids_and_no_shuffle(spark, frame, tmp_path, monkeypatch):
    kept, cut = [], T.cut
    monkeypatch.setattr(T, "cut", lambda df: kept.append(cut(df)) or kept[-1])

    def shuffled():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum(f.stat().st_size for d in disk.localDirs() for f in Path(d.getPath()).rglob("shuffle_*.data"))

    rng = random.Random(5)
    rows = [(i, prose(rng, 2_000), 0) for i in range(120)]
    df = frame(rows, "doc_id long, text string, slot long").cache()
    assert df.count() == 120
    before, p = shuffled(), T.StoreParams(seq_len=64, shard_rows=32)
    manifest, shards = T.write(df, f"file://{tmp_path}/shards", p=p)
    ids = 2 * sum(r["n_ids"] for r in manifest.collect())
    for _ in range(40):  # they are removed in the background
        if (left := shuffled() - before) < ids / 10:
            break
        time.sleep(0.25)
    assert left < ids / 10
    assert sum(len(r["ids"]) for r in kept[0].collect()) < 0.9 * ids
    assert [r["shard"] for r in shards.orderBy("shard").collect()] == list(range(-(-manifest.count() // 32)))
    df.unpersist()


def test_blocks_within_a_task_are_numbered_on(spark, frame, tmp_path):
    p = T.StoreParams(seq_len=8, shard_rows=5, block_bytes=40, rounds_out=3)
    rows = [(i, "some words of a text " * (1 + i % 9), 0) for i in range(50)]
    folder, manifest, shards = _store(spark, frame, tmp_path, rows, p)
    assert sorted(r["slot"] for r in manifest) == list(range(len(manifest))) and sum(s[2] for s in shards) == len(manifest)
    own, texts = bpe.load(bpe.default_vocabulary()), {i: t for i, t, _ in rows}
    back = {r["slot"]: r["ids"] for r in T.read(spark, folder, p).collect()}
    for r in manifest:
        ids = [*own.ids([texts[r["doc_id"]]])[0], p.end_token]
        assert back[r["slot"]] == ids[8 * r["part"]:8 * r["part"] + 8]


@pytest.mark.parametrize("wide", [False, True])
def test_digests_are_made_where_the_ids_are_read(spark, frame, tmp_path, wide):
    p = T.StoreParams(seq_len=8, shard_rows=5, wide=wide)
    rows = [(i, f"document {i}, " * (i % 7) + "\u0000\n\n  x", 0) for i in range(40)] + [(99, None, 0)]
    folder, manifest, _ = _store(spark, frame, tmp_path, rows, p)
    every = T.read(spark, folder, p).collect()
    want = {r["slot"]: sha(",".join(map(str, r["ids"]))) for r in every}
    got = T.read(spark, folder, p, columns=("ids_sha256", "slot"))
    assert got.columns == ["ids_sha256", "slot"] and {r["slot"]: r["ids_sha256"] for r in got.collect()} == want
    assert {r["slot"]: r["n_ids"] for r in every} == {r["slot"]: r["n_ids"] for r in manifest} and all(len(r["ids"]) == r["n_ids"] for r in every)
    some = T.read(spark, folder, p, first=7, last=18, columns=("slot", "n_ids", "ids_sha256")).collect()
    assert {r["slot"]: r["ids_sha256"] for r in some} == {s: want[s] for s in range(7, 18)}
    assert T._digest(np.array([0, 7, 65535, 10], dtype="<u2")) == sha("0,7,65535,10")
