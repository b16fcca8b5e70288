"""Benchmark decontamination as a prefix-filtered set join.

1. Every item becomes windows of ``window`` consecutive words (a shorter item is one window).  Equal
   windows are one row, so a prompt that many items share is looked up once.
2. A window is the set of its ``shingle``-word shingles.  Shingles are ordered by rarity, their count in
   all documents.  A window that must be contained whole needs a prefix of one token only: its rarest
   shingle, the first one where that shingle repeats.
3. Documents emit a candidate wherever one of those tokens occurs, with the words around it.  The join on
   the token keeps the candidates whose window fits (positional bound: it starts at or after the first
   word; length bound: it ends at or before the last) and whose words are exactly the window's.
4. A document's hits are the union of its windows' spans.

Documents are scanned twice, once to count the benchmark's shingles and once to emit candidates; both
scans test shingles against a bitmap of ``2**bitmap_bits`` bits, the only thing that is broadcast and of
that size whatever the benchmark's.  Shuffled are counts (one row per shingle and task), candidates, and
per document one row of spans.  A passage that stands in a third of all documents is a skewed join key,
which AQE splits; no two documents ever meet.

Defined cases: null and empty texts have no words, no hits and are clean; a null ``doc_id`` or ``item_id`` is
judged like any other (a null item_id counts as an item, and stands in no id list); rows that repeat a
doc_id are judged, and kept or dropped, one by one; repeated items count once per item_id; an empty benchmark hits nothing;
extra columns pass through ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import U64, chunks, cut, fresh, shingle_hashes, table, text_bytes, word_hashes, words_tenant

# A-Z to a-z, and every ASCII character that is neither a letter nor a digit to a space.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class DecontaminationParams:
    window: int = 13
    shingle: int = 3
    bitmap_bits: int = 22          # 512 KB
    min_hit_pct: int = 5           # contaminated from so many hit words, per cent


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def _windows(p: DecontaminationParams):
    """Per item window: its length, shingle width, word hashes end to end, and the hash of every shingle."""
    schema = pa.schema([("item_id", pa.string()), ("len", pa.int32()), ("width", pa.int32()), ("words", pa.binary()),
                        ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_tenant()
        def rows(b: pa.RecordBatch):
            for i, t in zip(b.column("item_id").to_pylist(), text_bytes(b, "text"), strict=True):
                h = word_hashes(words_of(t))
                size = min(p.window, len(h))
                for at in range(len(h) - size + 1 if size else 0):
                    w = h[at:at + size]
                    k = min(p.shingle, size)
                    yield i, size, k, w.tobytes(), shingle_hashes(w, k).view(np.int64).tolist()

        for b in batches:
            yield from chunks(rows(b), schema)

    return run


def bitmap(tokens: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the column ``token``, built by a grouped aggregate; at most 2**bits / 64 rows reach the driver."""
    slot = F.col("token").bitwiseAND((1 << bits) - 1)
    got = (tokens.groupBy(F.shiftright(slot, 6).alias("at"))
           .agg(F.bit_or(F.expr("shiftleft(1L, cast(token & 63 as int))")).alias("v")).toPandas())
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[got["at"].to_numpy()] = got["v"].to_numpy()
    return out.view(np.uint8)


def _marked(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Positions of the hashes whose bit is set."""
    slot = h & U64(len(bits) * 8 - 1)
    return np.flatnonzero((bits[(slot >> U64(3)).astype(np.int64)] >> (slot & U64(7)).astype(np.uint8)) & 1)


def _token_counts(widths: list[int], shared):
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_tenant()
        bits = shared.value
        held: list[np.ndarray] = []
        size = 0

        def flush():
            v, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(n, pa.int64())], schema=schema)

        for b in batches:
            for t in text_bytes(b, "text"):
                h = word_hashes(words_of(t))
                for k in widths:
                    s = shingle_hashes(h, k)
                    got = s[_marked(s, bits)]
                    if len(got):
                        held.append(got)
                        size += len(got)
                if size > 500_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _candidates(widths: list[int], p: DecontaminationParams, shared):
    """Per document its words' count and where a prefix token may occur, with the words around it."""
    at_type = pa.list_(pa.struct([("token", pa.int64()), ("pos", pa.int32()), ("before", pa.int32()), ("around", pa.binary())]))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("at", at_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_tenant()
        bits = shared.value

        def rows(b: pa.RecordBatch):
            for r, i, t in zip(b.column("row").to_pylist(), b.column("doc_id").to_pylist(), text_bytes(b, "text"), strict=True):
                h = word_hashes(words_of(t))
                at = []
                for k in widths:
                    s = shingle_hashes(h, k)
                    for pos in _marked(s, bits).tolist():
                        low = max(0, pos - p.window + k)
                        at.append({"token": int(s[pos].view(np.int64)), "pos": pos, "before": pos - low,
                                   "around": h[low:pos + p.window].tobytes()})
                yield r, i, len(h), at

        for b in batches:
            yield from chunks(rows(b), schema, size=5_000, weight=lambda r: 128 * len(r[3]))

    return run


def hit_report(docs: DataFrame, benchmark: DataFrame, p: DecontaminationParams = DecontaminationParams(),
               doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(row, doc_id, n_words, n_hit, n_items, items, contaminated)`` for every row of ``docs``.

    ``items`` are the ids, as sorted strings, of the items with a window in the text.  ``row`` tells
    repeated rows apart.
    """
    spark = docs.sparkSession
    items = (benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).alias("text"))
             .mapInArrow(_windows(p), "item_id string, len int, width int, words binary, tokens array<long>"))
    items = cut(items.distinct())
    windows = cut(items.groupBy("words").agg(F.first("len").alias("len"), F.first("width").alias("width"),
                                             F.first("tokens").alias("tokens")))
    widths = [r[0] for r in windows.select("width").distinct().collect()]  # at most ``shingle`` numbers

    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).alias("text"))
    seen = spark.sparkContext.broadcast(bitmap(windows.select(F.explode("tokens").alias("token")), p.bitmap_bits))
    counts = cut(docs.select("text").mapInArrow(_token_counts(widths, seen), "token long, n long")
                 .groupBy("token").agg(F.sum("n").alias("n")))

    token = windows.select("words", "len", F.posexplode("tokens").alias("offset", "token"))
    rarest = (token.join(counts, "token")  # a window with a shingle that no document has is contained in none
              .groupBy("words").agg(F.min_by(F.struct("token", "offset", "len"), F.struct("n", "token", "offset")).alias("r"),
                                    F.count("token").alias("found"), F.first("len").alias("size")))
    whole = windows.select("words", F.size("tokens").alias("tokens"))
    prefix = cut(rarest.join(whole, "words").where(F.col("found") == F.col("tokens"))
                 .select("words", "r.token", "r.offset", "r.len"))
    rare = spark.sparkContext.broadcast(bitmap(prefix.select("token"), p.bitmap_bits))

    scanned = cut(docs.mapInArrow(_candidates(widths, p, rare), "row long, doc_id long, n_words long, "
                                  "at array<struct<token:long,pos:int,before:int,around:binary>>"))
    cand = scanned.where(F.size("at") > 0).select("row", "n_words", F.explode("at").alias("c")).select("row", "n_words", "c.*")
    hit = (cand.join(prefix, "token")
           .where((F.col("pos") >= F.col("offset")) & (F.col("pos") - F.col("offset") + F.col("len") <= F.col("n_words")))
           .where(F.substring(F.col("around"), 8 * (F.col("before") - F.col("offset")) + 1, 8 * F.col("len")) == F.col("words"))
           .select("row", (F.col("pos") - F.col("offset")).alias("start"), "len", "words"))
    hit = cut(hit)
    spans = (hit.groupBy("row").agg(F.collect_set(F.struct("start", "len")).alias("spans"))
             .select("row", covered_words(F.col("spans")).alias("n_hit")))
    of_item = items.select("words", "item_id").distinct()
    found = (hit.select("row", "words").distinct().join(of_item, "words").select("row", "item_id").distinct()
             .groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items")))
    n_hit, n_items = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("n_items", F.lit(0).cast("long"))
    return (scanned.select("row", "doc_id", "n_words").join(spans, "row", "left").join(found, "row", "left")
            .select("row", "doc_id", "n_words", n_hit.alias("n_hit"), n_items.alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= p.min_hit_pct * F.col("n_words"))))


def covered_words(spans):
    """Words inside the union of ``(start, len)`` spans."""
    state = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("end"))

    def step(a, s):
        stop = s["start"] + s["len"]
        more = F.greatest(F.lit(0), stop - F.greatest(s["start"], a["end"]))
        return F.struct((a["total"] + more).alias("total"), F.greatest(a["end"], stop).alias("end"))

    return F.aggregate(F.sort_array(spans), state, step, lambda a: a["total"])


def keep_clean(docs: DataFrame, benchmark: DataFrame, p: DecontaminationParams = DecontaminationParams(),
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, without contaminated documents.

    Every row is judged by its own text: rows are told apart by the hash of doc_id and text, so a row that shares a
    doc_id, or a null one, with a contaminated row stays unless its text is contaminated too.
    """
    (name,) = fresh(docs, "gone_row")
    key = F.xxhash64(F.col(doc_id).cast("string"), F.col(text))
    gone = hit_report(docs.select(key.alias("doc_id"), F.col(text).alias("text")), benchmark, p).where("contaminated") \
        .select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, key == F.col(name), "left_anti")


def op9_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` against every item of ``benchmark``."""
    got = hit_report(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return got.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      "contaminated")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS size, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT size FROM win),
dwin AS (
  SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, lens WHERE len(ws) >= size)),
hit AS (SELECT doc_id, i, size, item_id FROM dwin JOIN win USING (size, g)),
spot AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit
         FROM (SELECT doc_id, i, unnest(range(0, size)) AS k FROM hit) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN spot ON spot.doc_id = d.doc_id LEFT JOIN ids ON ids.doc_id = d.doc_id
"""
