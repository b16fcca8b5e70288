"""Ranked lexical search by bag deduplication.

1. The items are taken in blocks of at most ``block_items`` items and ``block_postings`` (item, term)
   pairs.  A block's vocabulary and postings are what is broadcast, and that bound is their size; more
   items mean more blocks, each one pass over the documents.
2. Every whole document is cut into terms and restricted to the vocabulary: its bag is the sorted
   ``(term, tf)`` pairs, next to its length ``n``.  The bags are checkpointed; N, L and the df of the
   vocabulary are grouped sums over them.
3. Documents with the same bag and the same length weight ``m`` score alike for every item, so they are one
   class: rows meet by the hash of both, and bag and ``m`` themselves are grouping keys, which verifies the hash.
   Of a class only the ``top`` smallest doc_ids can ever be returned, and each task drops the others before
   the shuffle, so a text that stands in a third of all rows sends ``top`` rows a task.
4. A task scores its classes once, all items together, over the postings, and keeps per item its ``top``
   classes by score and smallest doc_id.  That loses nothing: a document of any later class has ``top``
   documents before it, one of each of those classes.
5. The kept classes are expanded to their members by ascending doc_id and ranked per item.

Scores are 64-bit integers throughout; only the term weight takes a logarithm, in doubles.

Defined cases: null and empty texts have no terms, do not count in N and match nothing; an item without
terms, or whose terms stand in no document, has no rows; a null doc_id is ranked after all others of equal score;
rows that repeat a doc_id are ranked one by one, rows that repeat an item_id are items of their own, each with
ranks from 1; no documents or no items give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import chunks, cut, table, text_bytes

# A-Z to a-z, and every ASCII character that is neither a letter nor a digit to a space.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
PAIR = np.dtype([("term", "<u4"), ("tf", "<u4")])


@dataclass(frozen=True)
class SearchParams:
    top: int = 10
    k1_thousandths: int = 8         # score = w * (10**9 tf) div (1000 tf + k1_thousandths m)
    length_pct: int = 75            # m = 100 - length_pct + (length_pct n N) div L
    block_items: int = 2_048
    block_postings: int = 500_000   # about 30 MB with the vocabulary
    chunk_cells: int = 1 << 20      # (class, item) scores held at once by a task


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


class Block:
    """Items and their vocabulary: term bytes -> id, and per term its postings (item, repeats)."""

    def __init__(self):
        self.ids: list = []
        self.vocabulary: dict[bytes, int] = {}
        self._postings: list[tuple[int, int, int]] = []

    def add(self, item_id, terms: Counter) -> None:
        for t, q in terms.items():
            self._postings.append((self.vocabulary.setdefault(t, len(self.vocabulary)), len(self.ids), q))
        self.ids.append(item_id)

    def full(self, p: SearchParams) -> bool:
        return len(self.ids) >= p.block_items or len(self._postings) >= p.block_postings

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first posting of every term and the end, items, repeats), ordered by term."""
        a = np.array(sorted(self._postings), dtype=np.int64).reshape(-1, 3)
        return np.searchsorted(a[:, 0], np.arange(len(self.vocabulary) + 1)), a[:, 1], a[:, 2]


def blocks(items: DataFrame, item_id: str, text: str, p: SearchParams) -> Iterator[Block]:
    """The items' blocks; only the one in hand is on the driver."""
    block = Block()
    for r in items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).toLocalIterator():
        terms = Counter(terms_of((r["t"] or "").encode()))
        if terms:
            block.add(r["i"], terms)
        if block.full(p):
            yield block
            block = Block()
    if block.ids:
        yield block


def _bags(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("bag", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.get

        def rows(b: pa.RecordBatch):
            for i, t in zip(b.column("doc_id").to_pylist(), text_bytes(b, "text"), strict=True):
                words = terms_of(t)
                if words:
                    tf = Counter(map(find, words))
                    tf.pop(None, None)
                    yield i, len(words), np.array(sorted(tf.items()), dtype="<u4").tobytes()

        for b in batches:
            yield from chunks(rows(b), schema, size=4_000, weight=lambda r: len(r[2]))

    return run


def bags(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n, bag)`` of every document with a term, in the shared checkpoint folder."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    pruned = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return cut(pruned.mapInArrow(_bags(shared), "doc_id long, n long, bag binary"))


def _term_counts(size: int):
    schema = pa.schema([("term", pa.int64()), ("df", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            held = np.frombuffer(b"".join(v.as_py() for v in b.column("bag")), dtype=PAIR)
            total += np.bincount(held["term"], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], schema=schema)

    return run


def weights(held: DataFrame, size: int, n_docs: int) -> np.ndarray:
    """w of every term of the vocabulary (its size is the block's bound)."""
    df = np.zeros(size, dtype=np.int64)
    for r in held.select("bag").mapInArrow(_term_counts(size), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)


def classes(held: DataFrame, n_docs: int, n_terms: int, p: SearchParams) -> DataFrame:
    """``(bag, m, members)``: one row per class of equal bag and m, with its ``top`` smallest doc_ids in order."""
    m = F.expr(f"{100 - p.length_pct}L + ({p.length_pct}L * n * {n_docs}L) div {n_terms}L")
    rows = held.where(F.length("bag") > 0).select("doc_id", "bag", m.alias("m")).withColumn("h", F.xxhash64("bag", "m"))
    first = F.row_number().over(Window.partitionBy("h", "bag", "m").orderBy(F.col("doc_id").asc_nulls_last()))
    few = rows.withColumn("at", first).where(F.col("at") <= p.top)
    return few.groupBy("h", "bag", "m").agg(F.sort_array(F.collect_list(F.struct("at", "doc_id"))).alias("s")) \
        .select("bag", "m", F.col("s.doc_id").alias("members"))


_SCORED = "item int, score long, members array<long>"


def _score(shared, p: SearchParams):
    schema = pa.schema([("item", pa.int32()), ("score", pa.int64()), ("members", pa.list_(pa.int64()))])
    last = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_items, w, (start, of, q) = shared.value
        step = max(1, p.chunk_cells // n_items)
        best = _Best(n_items, p.top)

        def score(bag: list[bytes], m: np.ndarray, members: list[list[int]]) -> None:
            sizes = np.array([len(x) // PAIR.itemsize for x in bag])
            pairs = np.frombuffer(b"".join(bag), dtype=PAIR)
            row, term, tf = np.repeat(np.arange(len(bag)), sizes), pairs["term"].astype(np.int64), pairs["tf"].astype(np.int64)
            part = w[term] * ((1_000_000_000 * tf) // (1000 * tf + p.k1_thousandths * m[row]))
            sums = np.zeros(len(bag) * n_items, dtype=np.int64)
            count = start[term + 1] - start[term]
            ends = np.cumsum(count)
            at, size = 0, 4 * p.chunk_cells
            while at < len(term):  # so many postings at once, one term at least
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
                c = count[at:to]
                k = np.repeat(np.arange(at, to), c)
                posting = np.arange(len(k)) - np.repeat(np.cumsum(c) - c, c) + start[term[k]]
                np.add.at(sums, row[k] * n_items + of[posting], part[k] * q[posting])
                at = to
            best.add(sums.reshape(len(bag), n_items), np.array([last if x[0] is None else x[0] for x in members]), members)

        for b in batches:
            bag, m, members = (b.column(c) for c in ("bag", "m", "members"))
            for at in range(0, b.num_rows, step):
                score(bag.slice(at, step).to_pylist(), m.slice(at, step).to_numpy(), members.slice(at, step).to_pylist())
        yield from chunks(best.rows(), schema)

    return run


class _Best:
    """Per item the ``top`` classes seen so far, by falling score and rising smallest doc_id."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.least = np.ones(n_items, dtype=np.int64)   # a class below this score cannot enter
        self.item = self.score = self.first = np.empty(0, dtype=np.int64)
        self.members: list[list[int]] = []

    def add(self, sums: np.ndarray, first: np.ndarray, members: list[list[int]]) -> None:
        row, item = np.nonzero(sums >= self.least)
        if not len(row):
            return
        all_items = np.concatenate([self.item, item])
        score = np.concatenate([self.score, sums[row, item]])
        firsts = np.concatenate([self.first, first[row]])
        order = np.lexsort((firsts, -score, all_items))
        starts = np.searchsorted(all_items[order], np.arange(len(self.least) + 1))
        rank = np.arange(len(order)) - starts[all_items[order]]
        keep = order[rank < self.top]
        old = len(self.members)
        self.members = [self.members[k] if k < old else members[row[k - old]] for k in keep.tolist()]
        self.item, self.score, self.first = all_items[keep], score[keep], firsts[keep]
        full = order[rank == self.top - 1]
        self.least[all_items[full]] = score[full]

    def rows(self) -> Iterator[tuple]:
        yield from zip(self.item.tolist(), self.score.tolist(), self.members, strict=True)


def _search_block(docs: DataFrame, block: Block, doc_id: str, text: str, p: SearchParams) -> DataFrame | None:
    """``(item, rank, doc_id, score)`` of one block; None when no document has a term."""
    spark = docs.sparkSession
    held = bags(docs, block.vocabulary, doc_id, text)
    total = held.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms")).first()
    if not total["n"]:
        return None
    w = weights(held, len(block.vocabulary), total["n"])
    shared = spark.sparkContext.broadcast((len(block.ids), w, block.postings()))
    scored = classes(held, total["n"], total["terms"], p).mapInArrow(_score(shared, p), _SCORED)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return scored.select("item", "score", F.explode("members").alias("doc_id")) \
        .withColumn("rank", rank).where(F.col("rank") <= p.top)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
           p: SearchParams = SearchParams()) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``top`` documents with a score above 0."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType
    names = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)])
    parts = []
    for block in blocks(items, item_id, text, p):
        found = _search_block(docs, block, doc_id, text, p)
        if found is not None:
            ids = spark.createDataFrame(list(enumerate(block.ids)), names)  # at most block_items rows
            parts.append(cut(found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")))
    if not parts:
        out = T.StructType([names[1], T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()),
                            T.StructField("score", T.LongType())])
        return spark.createDataFrame([], out)
    return reduce(DataFrame.unionByName, parts)


def op13_ranked_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, over all ``documents``."""
    return search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, ws, len(ws) AS n
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents)
  WHERE len(ws) > 0),
i AS (
  SELECT row_number() OVER () AS k, item_id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
it AS (SELECT k, item_id, t, count(*) AS q FROM i GROUP BY k, item_id, t),
s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
tf AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ws) AS t FROM d)
  WHERE t IN (SELECT t FROM it) GROUP BY r, t),
w AS (
  SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, s GROUP BY t, n_docs),
m AS (SELECT r, doc_id, 100 - 75 + (75 * n * n_docs) // n_terms AS m FROM d, s),
sc AS (
  SELECT k, item_id, r, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM it JOIN tf USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY k, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM sc WHERE score > 0)
WHERE rank <= 10
"""
