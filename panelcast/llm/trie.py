"""Prefix trie of conversations by ROLLUP over positional turn columns.

1. Every turn becomes a digest of its role and text next to its length in code points.  Turns are numbered
   without gathering a conversation: equal rows are counted first, the counts are range-partitioned and sorted by
   (conversation, turn, digest), each task numbers its run, and a conversation that crosses a border adds what the
   tasks before hold of it (one row per border, the only thing that is broadcast).
2. ``block`` consecutive turns of a conversation are one row of positional columns.  A block also has the node
   at which it starts: the depth, and 128 bits that are the running XOR of the position-keyed hashes of
   all turns before.  Running values are taken over spans of ``span`` blocks and within them, so a conversation
   of any length is never one window.
3. One ROLLUP over (start node, t0 .. t7) aggregates all prefixes of all blocks together, and ``grouping_id`` tells how
   many columns a row kept, hence its depth.  Prefixes of a long conversation continue in its further blocks, whose
   start node keeps the prefixes of different openings apart.
4. Subtree sums need no walk.  A node belongs to its smallest member; the nodes of one owner are a chain down
   to that conversation's end, so a subtree's sum is the sum of its members' whole chains less what the owner's own
   chain holds above the node.  A second ROLLUP sums the chains, and the leaves (one owner each), per prefix.
5. The ids that end at a node are hashed in ascending order: range-partitioned by (node, id), each task joins
   its run into texts of bounded size, and the texts of a node are streamed through SHA-256, so a node that a
   third of all conversations end at costs a task its digits, not its rows, and no memory.

Defined cases: rows without a conv_id belong to no conversation and are left out; a null turn comes first, and turns of
equal number are ordered by digest; repeated rows are turns of their own; null role or text is empty; a
conversation left without turns is a member of the root only; an empty table has no nodes; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import chunks, cut, table


@dataclass(frozen=True)
class TrieParams:
    block: int = 8              # turns of a block, columns of the ROLLUP
    span: int = 1_024           # blocks, or depths, of one running window
    text_bytes: int = 1 << 16   # of joined ids in one row
    family: int = 100           # rebuild: conversation c opens with turns of c - c % family
    openings: int = 6           # rebuild: crc32(c) % openings turns


def digest(role: Column, text: Column) -> Column:
    """128 bits of a turn; the role's length keeps role and text apart."""
    return F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation: what the task holds of it before each row."""
    part = TaskContext.get().partitionId()
    now, held = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        c, k = b.column("c").to_numpy(), b.column("k").to_numpy()
        first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        total = np.cumsum(k) - k
        before = total - np.repeat(total[first], np.diff(np.r_[first, len(c)]))
        if now is not None and c[0] == now:
            before[:first[1] if len(first) > 1 else len(c)] += held
        now, held = c[-1], before[-1] + k[-1]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before), pa.array(np.full(len(c), part, dtype=np.int32))],
                                         names=[*b.schema.names, "before", "part"])


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(c, pos, d, n)``: every turn's place in its conversation, digest and code points."""
    who, what = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("c"), F.col(turn).alias("at"), digest(who, what).alias("d"), F.char_length(what).alias("n"))
    rows = rows.groupBy("c", "at", "d", "n").agg(F.count(F.lit(1)).alias("k"))
    order = [F.col("c"), F.col("at").asc_nulls_first(), F.col("d")]
    runs = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("c", "d", "n", "k")
    runs = cut(runs.mapInArrow(_number, "c long, d binary, n int, k long, before long, part int"))
    held = runs.groupBy("c", "part").agg(F.sum("k").alias("own"))
    earlier = F.sum("own").over(Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    more = held.select("c", "part", earlier.alias("more")).where("more > 0")    # at most one row a task
    start = F.coalesce("more", F.lit(0)) + F.col("before")
    return runs.join(F.broadcast(more), ["c", "part"], "left") \
        .select("c", F.explode(F.sequence(start, start + F.col("k") - 1)).alias("pos"), "d", "n")


def rebuild(own: DataFrame, p: TrieParams = TrieParams()) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with another one's first turns: ``(c, pos, d, n)`` of the rebuilt turns, and all ``c``.

    Conversation c opens with the first h turns of c - c % ``family`` (all, if it has fewer; none, if it is absent) and
    goes on with its own after the first h; h is crc32 of the decimal c modulo ``openings``.
    """
    sizes = cut(own.groupBy("c").agg(F.count(F.lit(1)).alias("size")))
    of = sizes.select("c", (F.col("c") - F.col("c") % p.family).alias("base"), (F.crc32(F.col("c").cast("string")) % p.openings).alias("h"))
    base = sizes.select(F.col("c").alias("base"), F.col("size").alias("there"))
    of = cut(of.join(base, "base", "left").select("c", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("head")))
    later = own.join(of, "c").where("pos >= h").select("c", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "d", "n")
    heads = own.where(F.col("pos") < p.openings - 1).withColumnRenamed("c", "base")
    first = of.where("head > 0").join(heads, "base").where("pos < head").select("c", "pos", "d", "n")
    return later.unionByName(first), of.select("c")


def _running(df: DataFrame, key: str, order: str, values: list[str], agg, p: TrieParams) -> DataFrame:
    """``df`` with ``agg`` of every value over the rows before it within ``key``, in two parts (null: none): within its span
    of ``order`` (``_in``) and over the spans before (``_span``)."""
    spans = df.withColumn("span", F.floor(F.col(order) / p.span))
    one = spans.groupBy(key, "span").agg(*(agg(v).alias(v) for v in values))
    before = Window.partitionBy(key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    one = one.select(key, "span", *(agg(v).over(before).alias(f"{v}_span") for v in values)).where("span > 0")
    inside = Window.partitionBy(key, "span").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumns({f"{v}_in": agg(v).over(inside) for v in values}).join(one, [key, "span"], "left")


def _xor(*cols) -> Column:
    out = F.lit(0).cast("long")
    for c in cols:
        out = out.bitwiseXOR(F.coalesce(c, F.lit(0).cast("long")))
    return out


def _mix(seed: int, pos: Column, d: Column) -> Column:
    return F.when(d.isNotNull(), F.xxhash64(F.lit(seed), pos, d))


def blocks(rebuilt: DataFrame, convs: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """``(c, key(block, x1, x2), t0 .., y1, y2, size)``: one row per conversation and block, one for an empty conversation."""
    slot = F.col("pos") % p.block
    cols = [F.max(F.when(slot == i, F.struct("d", "n"))).alias(f"t{i}") for i in range(p.block)]
    hashes = [F.bit_xor(_mix(s, F.col("pos"), F.col("d"))).alias(f"y{s}") for s in (1, 2)]
    rows = rebuilt.withColumn("block", F.floor(F.col("pos") / p.block)) \
        .groupBy("c", "block").agg(*cols, *hashes, F.count(F.lit(1)).alias("size"))
    rows = cut(rows)
    none = convs.join(rows.where("block = 0").select("c"), "c", "left_anti").select(
        "c", F.lit(0).cast("long").alias("block"), *(F.lit(None).cast(rows.schema[f"t{i}"].dataType).alias(f"t{i}") for i in range(p.block)),
        *(F.lit(0).cast("long").alias(y) for y in ("y1", "y2")), F.lit(0).cast("long").alias("size"))
    rows = _running(rows, "c", "block", ["y1", "y2"], F.bit_xor, p)
    start = F.struct("block", *(_xor(f"y{s}_in", f"y{s}_span").alias(f"x{s}") for s in (1, 2)))
    keep = [*(f"t{i}" for i in range(p.block)), "y1", "y2", "size"]
    zero = F.lit(0).cast("long")
    return cut(rows.select("c", start.alias("key"), *keep)
               .unionByName(none.select("c", F.struct("block", zero.alias("x1"), zero.alias("x2")).alias("key"), *keep)))


NODE = ["depth", "x1", "x2"]


def _rollup(rows: DataFrame, p: TrieParams, *aggs: Column) -> DataFrame:
    """Every prefix of every block: the node's id ``depth, x1, x2``, its parent's ``p1, p2``, its last turn, and the aggregates."""
    names = [f"t{i}" for i in range(p.block)]
    out = rows.rollup("key", *names).agg(F.grouping_id().alias("gid"), *aggs)
    kept = F.lit(p.block) - F.bit_count("gid")
    out = out.withColumn("kept", kept).withColumn("last", F.when(F.col("kept") > 0, F.element_at(F.array(*names), F.greatest("kept", F.lit(1)))))
    # a row that kept a column without a turn is no prefix; a block's start is the last prefix of the block before
    out = out.where((F.col("last").isNotNull() & (F.col("kept") > 0)) | ((F.col("kept") == 0) & (F.col("key.block") == 0)))
    at = F.col("key.block") * p.block
    ids = {f"x{s}": _xor(f"key.x{s}", *(_mix(s, at + i, F.col(f"{t}.d")) for i, t in enumerate(names))) for s in (1, 2)}
    up = {f"p{s}": _xor(f"x{s}", _mix(s, at + F.col("kept") - 1, F.col("last.d"))) for s in (1, 2)}
    return out.withColumns({"depth": at + F.col("kept"), **ids}).withColumns(up).drop("key", "gid", "kept", *names)


def _join_ids(p: TrieParams):
    schema = pa.schema([*((c, pa.int64()) for c in NODE), ("first", pa.int64()), ("ids", pa.string()), ("held", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            node, buf, size = None, [], 0
            for b in batches:
                for *key, c in zip(*(b.column(x).to_pylist() for x in (*NODE, "c")), strict=True):
                    if buf and (key != node or size >= p.text_bytes):
                        yield (*node, buf[0], ",".join(map(str, buf)), len(buf))
                        buf, size = [], 0
                    node = key
                    buf.append(c)
                    size += 20
            if buf:
                yield (*node, buf[0], ",".join(map(str, buf)), len(buf))

        yield from chunks(rows(), schema, weight=lambda r: len(r[4]), most=4 << 20)

    return run


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([*((c, pa.int64()) for c in NODE), ("n_ends", pa.int64()), ("ends_sha256", pa.string())])

    def rows():
        node, sha, held = None, None, 0
        for b in batches:
            for *key, ids, n in zip(*(b.column(x).to_pylist() for x in (*NODE, "ids", "held")), strict=True):
                if key != node:
                    if node is not None:
                        yield (*node, held, sha.hexdigest())
                    node, sha, held = key, hashlib.sha256(), 0
                elif held:
                    sha.update(b",")
                sha.update(ids.encode())
                held += n
        if node is not None:
            yield (*node, held, sha.hexdigest())

    yield from chunks(rows(), schema)


def _ends(rows: DataFrame, p: TrieParams) -> DataFrame:
    """``(depth, x1, x2, n_ends, ends_sha256)`` of the nodes at which conversations end."""
    ends = rows.groupBy("c").agg(F.sum("size").alias("depth"), F.bit_xor("y1").alias("x1"), F.bit_xor("y2").alias("x2"))
    node = ", ".join(f"{c} long" for c in NODE)
    texts = ends.repartitionByRange(*NODE, "c").sortWithinPartitions(*NODE, "c") \
        .mapInArrow(_join_ids(p), f"{node}, first long, ids string, held long")
    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "ids", "held") \
        .mapInArrow(_hash_ids, f"{node}, n_ends long, ends_sha256 string")


def trie(rebuilt: DataFrame, convs: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """One row per node of the trie over ``(c, pos, d, n)``; ``convs`` names every conversation.

    ``depth, x1, x2`` is a node's id and ``p1, p2`` that of its parent; ``turn`` is the digest of its last turn.
    """
    rows = blocks(rebuilt, convs, p)
    nodes = _rollup(rows, p, F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id"))
    saved = (F.col("n_convs") - 1) * F.coalesce("last.n", F.lit(0))
    nodes = nodes.select(*NODE, "p1", "p2", "n_convs", "conv_id", F.col("last.d").alias("turn"), saved.alias("saved"))
    nodes = cut(nodes.join(_ends(rows, p), NODE, "left"))

    leaf = (F.col("n_ends") == F.col("n_convs")).cast("long")
    chain = nodes.groupBy(F.col("conv_id").alias("c")).agg(F.sum("saved").alias("chain"), F.sum(F.coalesce(leaf, F.lit(0))).alias("leaves"))
    under = _rollup(rows.join(chain, "c", "left").select("key", *(f"t{i}" for i in range(p.block)), "chain", "leaves"), p,
                    F.sum("chain").alias("chains"), F.sum("leaves").alias("n_leaves")).select(*NODE, "chains", "n_leaves")
    above = _running(nodes.select(*NODE, "conv_id", "saved"), "conv_id", "depth", ["saved"], F.sum, p) \
        .select(*NODE, (F.coalesce("saved_in", F.lit(0)) + F.coalesce("saved_span", F.lit(0))).alias("above"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    full = nodes.join(under, NODE).join(above, NODE).join(children, NODE, "left").select(
        *NODE, "p1", "p2", "turn", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        (F.col("chains") - F.col("above")).alias("saved_tokens"), F.coalesce("n_ends", F.lit(0)).alias("n_ends"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    # the root may have a third of all nodes as children, and is one row
    root = nodes.where("depth = 0").agg(F.min("conv_id").alias("root"))
    top = full.where("depth <= 1").crossJoin(F.broadcast(root)) \
        .withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.col("root"))).drop("root")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    return top.unionByName(full.where("depth > 1").join(parents, ["depth", "p1", "p2"], "left"))


def with_texts(nodes: DataFrame, conversations: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """``nodes`` with the role and text of their last turn (null at the root) as ``last_role`` and ``last_text``."""
    who, what = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    said = conversations.select(digest(who, what).alias("turn"), who.alias("last_role"), what.alias("last_text")).dropDuplicates(["turn"])
    return nodes.join(said, "turn", "left")


def op12_conversation_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Every node of the trie over all rebuilt ``conversations``."""
    rebuilt, convs = rebuild(turns(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))
    return trie(rebuilt, convs).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


OP12_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT c, CAST(c AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL
  SELECT c, s, i + 1,
         CASE WHEN (CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE v END) % 2 = 1
              THEN xor((CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE v END) // 2,
                       CAST(3988292384 AS BIGINT))
              ELSE (CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE v END) // 2 END
  FROM crc WHERE i < 8 * length(s)),
said AS (
  SELECT c, d, n, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, d) - 1 AS p
  FROM (SELECT conv_id AS c, turn, length(coalesce(text, '')) AS n,
               md5(concat(CAST(length(coalesce(role, '')) AS VARCHAR), ':', coalesce(role, ''), coalesce(text, ''))) AS d
        FROM conversations WHERE conv_id IS NOT NULL)),
size AS (SELECT c, count(*) AS n FROM said GROUP BY c),
head AS (
  SELECT crc.c, crc.c - crc.c % 100 AS base, xor(v, CAST(4294967295 AS BIGINT)) % 6 AS h,
         least(xor(v, CAST(4294967295 AS BIGINT)) % 6, coalesce(b.n, 0)) AS k
  FROM crc LEFT JOIN size AS b ON b.c = crc.c - crc.c % 100 WHERE i = 8 * length(s)),
made AS (
  SELECT head.c, p, d, n FROM head JOIN said ON said.c = base WHERE p < k
  UNION ALL
  SELECT head.c, p - h + k AS p, d, n FROM head JOIN said ON said.c = head.c WHERE p >= h),
path AS (
  SELECT head.c, coalesce(string_agg(d, '' ORDER BY p), '') AS way, count(d) AS len, list(n ORDER BY p) AS ns
  FROM head LEFT JOIN made ON made.c = head.c GROUP BY head.c),
step AS (
  SELECT c, len, dep, substr(way, 1, 32 * dep) AS node, CASE WHEN dep = 0 THEN 0 ELSE ns[dep] END AS n
  FROM (SELECT c, way, len, ns, unnest(range(0, len + 1)) AS dep FROM path)),
node AS (
  SELECT node, dep, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n) AS saved,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE dep = len), '') AS ends
  FROM step GROUP BY node, dep),
kids AS (SELECT substr(node, 1, 32 * (dep - 1)) AS node, count(*) AS n_children FROM node WHERE dep > 0 GROUP BY 1),
above AS (
  SELECT substr(node.node, 1, 32 * k) AS node, saved, kids.node IS NULL AS leaf
  FROM (SELECT node, saved, unnest(range(0, dep + 1)) AS k FROM node) AS node LEFT JOIN kids ON kids.node = node.node),
sums AS (SELECT node, count(*) FILTER (WHERE leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM above GROUP BY node)
SELECT node.conv_id, CAST(node.dep AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(node.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, saved_tokens,
       sha256(node.ends) AS ends_sha256
FROM node JOIN sums ON sums.node = node.node LEFT JOIN kids ON kids.node = node.node
LEFT JOIN node AS up ON node.dep > 0 AND up.node = substr(node.node, 1, 32 * (node.dep - 1)) AND up.dep = node.dep - 1
"""
