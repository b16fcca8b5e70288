"""Token ids as fixed-stride binary shards in training order.

Every document's ids, closed by the end token, are cut into sequences of ``seq_len``.  The n sequences
get the indices 0..n-1 in input order (a task's first index is the sum of the tasks before it), and
a keyed Feistel network over the next even power of two, walked along its cycle until it lands
below n, maps each index to its global slot: a bijection that needs no state and no sort of all keys.
Slots are range-partitioned into shards of ``shard_rows``; each shard is one file of records of
``stride`` bytes, so slot s is at byte (s mod shard_rows) * stride of shard s div shard_rows, and a
reader resumes anywhere with that arithmetic.

A record is the count of its ids (little-endian uint32), then ``seq_len`` ids (uint16 if the vocabulary
fits, else uint32), unused ones zero.  A shard is written under a name of its own attempt and then
moved to its place, so a repeated task leaves the same file.  The sequences are checkpointed once, since the
permutation needs n; only the tasks' counts reach the driver.

Ids are those of the tokenizers library (``packing.FastIds``).  Disk beside the shards: the checkpoint holds the
ids as compressed blocks of ``block_bytes``, and the shards are written in ``rounds_out`` rounds, each a contiguous range
of shards.  A round reads the blocks, shuffles the sequences of its own range only, and its shuffle files
are removed as it ends, so a ``rounds_out``-th of the ids lies in a shuffle at a time.

Defined cases: null and empty texts give one sequence with the end token alone; a null ``doc_id`` is
kept as null in the manifest; repeated rows are stored each; extra columns are ignored; an empty
table writes no shard.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import bpe, packing
from panelcast.llm.common import U64, chunks, cut, mix, table, tenant, text_bytes
from panelcast.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class StoreParams:
    seq_len: int = 512
    shard_rows: int = 4096      # 4 MB a shard at two bytes an id
    key: int = 0x5EED
    rounds: int = 6
    end_token: int = 50256
    wide: bool = False          # ids of four bytes, for vocabularies beyond 65,536
    block_bytes: int = 1 << 20  # ids of a compressed block of the checkpoint
    rounds_out: int = 4         # rounds in which the shards are written

    @property
    def dtype(self) -> np.dtype:
        return np.dtype("<u4" if self.wide else "<u2")

    @property
    def stride(self) -> int:
        return 4 + self.seq_len * self.dtype.itemsize


class Feistel:
    """A keyed permutation of 0..n-1."""

    def __init__(self, n: int, key: int, rounds: int):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = U64((1 << self.half) - 1)
        self.keys = mix(np.arange(1, rounds + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(key & ((1 << 64) - 1)))

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> U64(self.half), x & self.mask
        for k in self.keys:
            left, right = right, left ^ (mix(right + k) & self.mask)
        return (left << U64(self.half)) | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> U64(self.half), x & self.mask
        for k in self.keys[::-1]:
            left, right = right ^ (mix(left + k) & self.mask), left
        return (left << U64(self.half)) | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = step(x.astype(U64))
        while (out := x >= U64(self.n)).any():
            x[out] = step(x[out])
        return x

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self._once)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self._back)


# an ended execution's shuffle files are removed at once, not when the driver happens to collect its garbage
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BLOCK = "task int, at long, doc_id array<bigint>, part array<int>, n_ids array<int>, ids binary"
SHARD = "shard long, file string, records long, sha256 string"


def _blocks(path: str, p: StoreParams):
    """The sequences of a task in their order, as blocks with their ids compressed; ``at`` is the number of the block's first one in its task."""
    known = packing.known(path)
    schema = pa.schema([("task", pa.int32()), ("at", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("part", pa.list_(pa.int32())),
                        ("n_ids", pa.list_(pa.int32())), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tenant("packing", packing.load.cache_clear)
        closed = packing.load(path, known).closed
        codec, task = pa.Codec("zstd", 2), TaskContext.get().partitionId()

        def sequences():
            for b in batches:
                for i, t in zip(b.column("doc_id").to_pylist(), text_bytes(b, "text"), strict=True):
                    ids = closed(t.decode(), p.end_token, p.dtype)
                    for part, at in enumerate(range(0, len(ids), p.seq_len)):
                        yield i, part, ids[at:at + p.seq_len]

        def block(at: int, held: list[tuple]) -> tuple:
            docs, parts, ids = zip(*held, strict=True)
            return task, at, docs, parts, [len(x) for x in ids], codec.compress(np.concatenate(ids).tobytes(), asbytes=True)

        def rows():
            at, held, size = 0, [], 0
            for s in sequences():
                held.append(s)
                size += s[2].nbytes
                if size >= p.block_bytes:
                    yield block(at, held)
                    at, held, size = at + len(held), [], 0
            if held:
                yield block(at, held)

        yield from chunks(rows(), schema, size=4)

    return run


def _numbered(batches: Iterator[pa.RecordBatch], n: int, p: StoreParams) -> Iterator[tuple[dict, np.ndarray]]:
    """Each block with the slots of its sequences."""
    perm = Feistel(n, p.key, p.rounds)
    for b in batches:
        for k in range(b.num_rows):
            block = {c: b.column(c)[k] for c in b.schema.names}
            first = block["first"].as_py()
            yield block, perm.slot(np.arange(first, first + len(block["n_ids"].values))).astype(np.int64)


def _manifest(n: int, p: StoreParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, slot in _numbered(batches, n, p):
            yield pa.RecordBatch.from_arrays([pa.array(slot), *(block[c].values for c in ("doc_id", "part", "n_ids"))],
                                             names=["slot", "doc_id", "part", "n_ids"])

    return run


def _records(n: int, p: StoreParams, first: int, last: int):
    """``(slot, n_ids, ids)`` of the sequences whose slots are from ``first`` up to, not including, ``last``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for block, slot in _numbered(batches, n, p):
            mine = np.flatnonzero((slot >= first) & (slot < last))
            if not len(mine):
                continue
            n_ids = block["n_ids"].values.to_numpy()
            ends = np.concatenate(([0], np.cumsum(n_ids, dtype=np.int64) * p.dtype.itemsize))
            raw = memoryview(codec.decompress(block["ids"].as_buffer(), decompressed_size=int(ends[-1])))
            ids = pa.array([raw[ends[k]:ends[k + 1]].tobytes() for k in mine], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(slot[mine]), pa.array(n_ids[mine]), ids], names=["slot", "n_ids", "ids"])

    return run


def _write_shards(folder: str, p: StoreParams):
    schema = pa.schema([("shard", pa.int64()), ("file", pa.string()), ("records", pa.int64()), ("sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        pad = b"\0" * p.stride

        def put(shard: int, blob: bytearray, records: int) -> tuple:
            file = f"shard-{shard:09d}.bin"
            attempt = f"{root}/{file}.{uuid.uuid4().hex}"
            with store.open_output_stream(attempt) as f:
                f.write(bytes(blob))
            store.move(attempt, f"{root}/{file}")
            return shard, file, records, hashlib.sha256(blob).hexdigest()

        def rows():
            shard, blob, records = -1, bytearray(), 0
            for b in batches:
                for s, n, ids in zip(*(b.column(c).to_pylist() for c in ("slot", "n_ids", "ids")), strict=True):
                    if s // p.shard_rows != shard:
                        if records:
                            yield put(shard, blob, records)
                        shard, blob, records = s // p.shard_rows, bytearray(), 0
                    record = n.to_bytes(4, "little") + ids
                    blob += record + pad[len(record):]
                    records += 1
            if records:
                yield put(shard, blob, records)

        yield from chunks(rows(), schema, size=64)

    return run


def write(docs: DataFrame, folder: str, path: str | None = None, p: StoreParams = StoreParams()) -> tuple[DataFrame, DataFrame]:
    """Write the shards of ``docs(doc_id, text)`` into ``folder`` (a URI every executor can write to).

    A folder that holds shards is refused.  Returns the manifest ``(slot, doc_id, part, n_ids)`` and the shards ``(shard, file, records, sha256)``.
    """
    path = path or bpe.default_vocabulary()
    spark = docs.sparkSession
    blocks = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_blocks(path, p), BLOCK))
    counts = sorted((r["task"], r["n"]) for r in blocks.groupBy("task").agg(F.sum(F.size("n_ids")).alias("n")).collect())
    total, first = 0, []
    for t, n in counts:
        first.append((t, total))
        total += n
    before = spark.createDataFrame(first, "task int, before long")
    blocks = blocks.join(F.broadcast(before), "task").withColumn("first", F.col("before") + F.col("at"))  # one row per task
    root, made = folder.rstrip("/"), spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = made.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(made)
    if any(f.getPath().getName().startswith("shard-") for f in store.listStatus(made)):
        raise ValueError(f"{folder} holds shards already, and a shorter run would leave some of them; name a new folder")
    shards, most = -(-total // p.shard_rows), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rounds = max(1, min(shards, p.rounds_out))
    done = [_round(blocks, root, total, p, shards * r // rounds, shards * (r + 1) // rounds, most) for r in range(rounds)]
    manifest = blocks.select("first", "doc_id", "part", "n_ids").mapInArrow(_manifest(max(total, 1), p), "slot long, doc_id long, part int, n_ids int")
    return manifest, functools.reduce(DataFrame.unionByName, done)


def _round(blocks: DataFrame, root: str, total: int, p: StoreParams, first: int, last: int, most: int) -> DataFrame:
    """Write the shards from ``first`` up to, not including, ``last``; the shuffle's files go with the round."""
    spark = blocks.sparkSession
    tasks = max(1, min(last - first, most))
    # slots are even by construction, so the ranges are computed, not sampled
    task = F.floor((F.floor(F.col("slot") / p.shard_rows) - first) * tasks / max(1, last - first)).cast("int")
    was = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")  # read as a DataFrame is made
    try:
        return cut(blocks.select("first", "n_ids", "ids")
                   .mapInArrow(_records(max(total, 1), p, first * p.shard_rows, last * p.shard_rows), "slot long, n_ids int, ids binary")
                   .repartitionById(tasks, task).sortWithinPartitions("slot")
                   .mapInArrow(_write_shards(root, p), SHARD))
    finally:
        spark.conf.unset(CLEAN) if was is None else spark.conf.set(CLEAN, was)


@functools.lru_cache(maxsize=1)
def _decimals() -> np.ndarray:
    """The two-byte numbers as text with a comma, in six bytes each."""
    return np.array([b"%d," % k for k in range(1 << 16)], dtype="S6")


def _digest(ids: np.ndarray) -> str:
    """SHA-256 of the decimal ids joined by commas."""
    if ids.dtype.itemsize > 2:
        return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
    return hashlib.sha256(_decimals()[ids].tobytes().translate(None, b"\0")[:-1]).hexdigest()


READ = {"slot": "long", "n_ids": "int", "ids": "array<int>", "ids_sha256": "string"}


def read(spark: SparkSession, folder: str, p: StoreParams = StoreParams(), first: int = 0, last: int | None = None,
         columns: Sequence[str] = ("slot", "n_ids", "ids")) -> DataFrame:
    """``columns`` of the slots from ``first`` up to, not including, ``last``.

    ``ids_sha256`` is of the decimal ids joined by commas, made where the ids are read so that they need not leave the task.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(folder) \
        .select(F.regexp_extract("path", r"shard-(\d+)\.bin$", 1).cast("long").alias("shard"), "content")
    files = files.where(F.col("shard") >= first // p.shard_rows)
    if last is not None:
        files = files.where(F.col("shard") * p.shard_rows < last)
    step = max(1, min(2_000, (16 << 20) // p.stride))
    made = {
        "slot": lambda slot, n, ids: pa.array(slot),
        "n_ids": lambda slot, n, ids: pa.array(n.astype(np.int32)),
        "ids": lambda slot, n, ids: pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(n))).astype(np.int32),
                                                             ids[np.arange(p.seq_len) < n[:, None]].astype(np.int32)),
        "ids_sha256": lambda slot, n, ids: pa.array([_digest(x[:k]) for x, k in zip(ids, n.tolist(), strict=True)], pa.string()),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, blob in zip(b.column("shard").to_pylist(), b.column("content"), strict=True):
                raw = np.frombuffer(blob.as_buffer(), np.uint8).reshape(-1, p.stride)
                begin = shard * p.shard_rows
                end = len(raw) if last is None else min(len(raw), last - begin)
                for at in range(max(0, first - begin), end, step):
                    part = raw[at:min(at + step, end)]
                    n, ids = part[:, :4].copy().view("<u4").ravel().astype(np.int64), part[:, 4:].copy().view(p.dtype)
                    slot = np.arange(begin + at, begin + at + len(part))
                    yield pa.RecordBatch.from_arrays([made[c](slot, n, ids) for c in columns], names=list(columns))

    return files.mapInArrow(run, ", ".join(f"{c} {READ[c]}" for c in columns))


def op5_token_shards(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` as shards in the shared folder, read back: one row per stored sequence."""
    p = StoreParams()
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-shards-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    manifest, _ = write(table(spark, sf_dir, "documents", "doc_id", "text"), folder, p=p)
    back = read(spark, folder, p, columns=("slot", "ids_sha256"))
    return manifest.join(back, "slot").select(
        "slot", "doc_id", "part", F.col("n_ids").cast("long").alias("n_ids"),
        F.floor(F.col("slot") / p.shard_rows).alias("shard"),
        (F.col("slot") % p.shard_rows * p.stride).alias("offset"), "ids_sha256")
