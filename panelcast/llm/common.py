"""Helpers shared by the text operators: table reads, lineage cuts, hashing and components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import ensure_checkpoint_dir

# The six white-space bytes that separate words; ``bytes.split()`` and ``bytes.strip()`` use the same set.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One of the given tables, pruned to ``columns`` (all when none is named)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ascii_lower(col):
    """Lower-case A-Z only (``lower()`` would change other letters too)."""
    return F.translate(col, UPPER, LOWER)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that ``df`` does not have (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


_tenants: dict[str, Callable[[], object]] = {}


def tenant(name: str, release: Callable[[], object] = lambda: None) -> None:
    """Called as a task begins: a Python worker is used again by later stages, and what another operator's tasks
    keep in it (a vocabulary, word hashes) is released, and given back to the system, before this one fills its own."""
    if name in _tenants:
        return
    others = list(_tenants.values())
    _tenants.clear()
    _tenants[name] = release
    if others:
        for r in others:
            r()
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


class WordHash(dict):
    """word bytes -> 64-bit hash; bounded in bytes, so that a worker's memory is bounded too."""

    limit = 48 << 20    # bytes of words and entries
    longest = 256       # a longer word is not kept

    def __init__(self):
        super().__init__()
        self.held = 0

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= self.longest:
            if self.held >= self.limit:
                self.clear()
            self[word] = h
            self.held += 150 + len(word)
        return h

    def clear(self) -> None:
        super().clear()
        self.held = 0


_words = WordHash()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words.__getitem__, words), dtype=U64, count=len(words))


# Odd multipliers of the k positions of a shingle (the golden ratio and other 64-bit mixing constants).
_POSITION = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                      0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=U64)


def words_tenant() -> None:
    """For tasks that hash words."""
    tenant("words", _words.clear)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of a word-hash sequence, in text order (empty when it is shorter)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    out = np.zeros(n, dtype=U64)
    for j in range(k):
        out += mix(h[j:j + n] + U64(j)) * _POSITION[j]
    return mix(out)


def text_bytes(batch: pa.RecordBatch, column: str) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    for v in batch.column(column).cast(pa.binary()):
        yield v.as_py() or b""


def chunks(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000, weight=None, most: int = 16 << 20):
    """Group result rows into record batches of at most ``size`` rows and about ``most`` bytes."""
    buf: list[tuple] = []
    held = 0
    for r in rows:
        buf.append(r)
        held += weight(r) if weight else 0
        if len(buf) >= size or held >= most:
            yield _batch(buf, schema)
            buf, held = [], 0
    if buf:
        yield _batch(buf, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                      schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (long ids): rows ``(id, component)``, ids without an edge left out.

    ``component`` is the smallest reachable id.  Every round maps each label to the smallest label next
    to it, follows that pointer once more, and contracts the edges; a label that is the smallest of its
    neighbourhood points at itself, so pointers always go down and the rounds end after about log(n).
    Every join is an equi-join on a label (a hot label is a skewed join, which AQE splits) and every
    grouping is a ``min`` that combines before the shuffle.  Lineage is cut after each round.
    """
    edges = cut(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    label = None  # (id, component), as contracted so far
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")).withColumnRenamed("a", "v")
        up = cut(up)
        for _ in range(2):  # follow the pointers: p(p(v))
            far = up.select(F.col("v").alias("q"), F.col("p").alias("pp"))
            up = up.join(far, up["p"] == far["q"]).select("v", F.col("pp").alias("p"))
        up = cut(up)
        if label is None:
            label = up.select(F.col("v").alias("id"), F.col("p").alias("component"))
        else:
            label = cut(label.join(up, label["component"] == up["v"], "left")
                        .select("id", F.coalesce("p", "component").alias("component")))
        pa_, pb = up.select(F.col("v").alias("a"), F.col("p").alias("pa")), up.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        edges = cut(edges.join(pa_, "a").join(pb, "b").where("pa <> pb")
                    .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
    if label is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return label
