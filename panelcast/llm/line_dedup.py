"""Line dedup over levelled sorted runs of line hashes.

A run is a table ``(h1, h2, owner)`` of distinct line keys, hash-partitioned and sorted by the key's
128-bit hash, with the smallest doc_id that holds the key.  Documents are taken in ``batches`` ranges
of ascending doc_id.  Each batch's distinct keys are merge-joined with the runs: keys found there
belong to an earlier document, the others (anti-join) become a new run of level 0.  Once ``fanout``
runs stand on a level they are compacted into one sorted run of the next level, so a batch meets few
runs.  The batch's lines whose key has an earlier owner are dropped.

Shuffles: the line hashes once per batch (pre-aggregated to one row per key and task), the hits
back to the documents, and the texts once.  A line that stands in a third of all documents is one
row per task in the runs; only the lookup of its owner is skewed, an equi-join that AQE splits.

Defined cases: a null or empty text is one empty line; a null ``doc_id`` neither owns nor loses
lines; rows that repeat a doc_id are one document (each keeps or loses the same lines); extra columns
pass through ``dedup``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import chunks, cut, fresh, table, tenant, text_bytes


@dataclass(frozen=True)
class LineParams:
    min_chars: int = 10   # shorter keys are never dropped
    batches: int = 4      # ranges of ascending doc_id
    fanout: int = 2       # runs of a level before they are compacted


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The key of every line (None: too short): stripped of white space at both ends, A-Z lower-cased."""
    out: list[bytes | None] = []
    for line in text.lower().split(b"\n"):  # bytes.lower() changes A-Z only
        key = line.strip()                  # bytes.strip() takes exactly space and \t\n\v\f\r
        n = len(key)
        if n < min_chars or (n < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
            out.append(None)
        else:
            out.append(xxhash.xxh3_128_digest(key))
    return out


def _key_rows(min_chars: int):
    schema = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tenant("lines")

        def rows(b: pa.RecordBatch):
            for i, t in zip(b.column("doc_id").to_pylist(), text_bytes(b, "text"), strict=True):
                for k in {k for k in line_keys(t, min_chars) if k}:
                    yield i, int.from_bytes(k[:8], "little", signed=True), int.from_bytes(k[8:], "little", signed=True)

        for b in batches:
            yield from chunks(rows(b), schema)

    return run


def _rebuild(min_chars: int, schema: pa.Schema):
    """Adds n_lines, n_dropped and the kept text; ``gone`` holds the dropped keys' hashes end to end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tenant("lines")

        def rows(b: pa.RecordBatch):
            for i, t, gone in zip(b.column("doc_id").to_pylist(), text_bytes(b, "text"), b.column("gone").to_pylist(), strict=True):
                lines = t.split(b"\n")
                if gone:
                    lost = {g[0].to_bytes(8, "little", signed=True) + g[1].to_bytes(8, "little", signed=True)
                            for g in ((x["h1"], x["h2"]) for x in gone)}
                    kept = [x for x, k in zip(lines, line_keys(t, min_chars), strict=True) if k not in lost]
                    yield i, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()
                else:
                    yield i, len(lines), 0, t.decode()

        for b in batches:
            yield from chunks(rows(b), schema, size=2_000, weight=lambda r: len(r[3]))

    return run


def compact(levels: list[list[DataFrame]], fanout: int) -> None:
    """Merge full levels upwards; keys of different runs are disjoint, so merging is a sorted union."""
    for depth, runs in enumerate(levels):
        if len(runs) >= fanout:
            merged = runs[0]
            for r in runs[1:]:
                merged = merged.unionByName(r)
            if depth + 1 == len(levels):
                levels.append([])
            levels[depth + 1].append(_sorted_run(merged))
            runs.clear()


def _sorted_run(df: DataFrame) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartition(n, "h1", "h2").sortWithinPartitions("h1", "h2"))


def dropped_keys(docs: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """``(doc_id, h1, h2)``: the line keys each document loses.  ``docs(doc_id, text)``."""
    lines = docs.where("doc_id IS NOT NULL").mapInArrow(_key_rows(p.min_chars), "doc_id long, h1 long, h2 long")
    cuts = _batch_edges(docs, p.batches)
    batch = F.lit(0)
    for c in cuts:
        batch = batch + (F.col("doc_id") > c).cast("int")
    lines = cut(lines.withColumn("batch", batch))
    levels: list[list[DataFrame]] = [[]]
    hits: DataFrame | None = None
    for b in range(len(cuts) + 1):
        own = (lines.where(F.col("batch") == b).groupBy("h1", "h2")
               .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")))
        own = _sorted_run(own)
        old = own
        found: list[DataFrame] = []
        for run in (r for level in reversed(levels) for r in level):
            found.append(old.join(run, ["h1", "h2"]).select("h1", "h2", "owner"))
            old = old.join(run.select("h1", "h2"), ["h1", "h2"], "left_anti")
        new = cut(old.select("h1", "h2", F.col("first").alias("owner"), "last").sortWithinPartitions("h1", "h2"))
        found.append(new.where("last > owner").select("h1", "h2", "owner"))
        for f in found:
            f = f.select(F.lit(b).alias("batch"), "h1", "h2", "owner")
            hits = f if hits is None else hits.unionByName(f)
        levels[0].append(new.select("h1", "h2", "owner"))
        compact(levels, p.fanout)
    return (lines.join(cut(hits), ["batch", "h1", "h2"]).where("doc_id > owner").select("doc_id", "h1", "h2"))


def _batch_edges(docs: DataFrame, batches: int) -> list[int]:
    """The doc_ids that end all batches but the last, from approximate quantiles (a few numbers, whatever the size)."""
    q = [i / batches for i in range(1, batches)]
    got = docs.select(F.percentile_approx("doc_id", F.array(*map(F.lit, q)), 1000)).first()[0] if q else []
    return sorted(set(got or []))


def dedup_lines(docs: DataFrame, p: LineParams = LineParams(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_text)`` for every row of ``docs``."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    gone = dropped_keys(docs, p).groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("gone"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_text", pa.string())])
    return (docs.join(gone, "doc_id", "left")
            .mapInArrow(_rebuild(p.min_chars, schema), "doc_id long, n_lines long, n_dropped long, kept_text string"))


def dedup(docs: DataFrame, p: LineParams = LineParams(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with their repeated lines taken out of ``text``; same columns, same rows.

    Texts that lose nothing are carried over as they are; the others are rebuilt and matched by doc_id.
    """
    lean = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    gone_name, id_name = fresh(docs, "gone", "gone_id")
    gone = (dropped_keys(lean, p).groupBy(F.col("doc_id").alias(id_name))
            .agg(F.collect_list(F.struct("h1", "h2")).alias(gone_name)))
    kept = F.arrow_udf(_kept_texts(p.min_chars), "string")
    return (docs.join(gone, F.col(doc_id).cast("long") == F.col(id_name), "left")
            .withColumn(text, F.when(F.col(gone_name).isNull(), F.col(text)).otherwise(kept(F.col(text), F.col(gone_name))))
            .select(*docs.columns))


def _kept_texts(min_chars: int):
    def kept(texts: pa.Array, gone: pa.Array) -> pa.Array:
        tenant("lines")
        out = []
        for t, g in zip(texts.cast(pa.binary()), gone.to_pylist(), strict=True):
            raw = t.as_py()
            if raw is not None and g is not None:
                lost = {x["h1"].to_bytes(8, "little", signed=True) + x["h2"].to_bytes(8, "little", signed=True) for x in g}
                raw = b"\n".join(x for x, k in zip(raw.split(b"\n"), line_keys(raw, min_chars), strict=True) if k not in lost)
            out.append(raw)
        return pa.array(out, pa.binary()).cast(pa.string())

    return kept


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Line dedup over every whole text of ``documents``."""
    return dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text")) \
        .select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
owners AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING min(doc_id) < max(doc_id)),
judged AS (SELECT keyed.*, coalesce(owner < doc_id, false) AS gone FROM keyed LEFT JOIN owners USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
