"""MinHash near-dedup over an LSH forest.

1. Every document becomes its set of word shingles, a 128-bit digest of that set, its size and a
   MinHash signature of ``hashes`` values.  Documents with the same set are one class (one row).
2. The forest is ``trees`` sorted orders of the classes, each by its own permutation of the signature.
   Classes that share the first ``depth`` values stand next to each other, a region.  In one pass over
   each sorted order, the classes of a region are compared by signature, and those that agree in
   ``near_pct`` per cent of the values are joined into candidate clusters (a star per cluster and
   region, never all pairs).  A region of more than ``region_rows`` classes adapts its depth: it is cut
   where neighbours share the shortest prefix, so that what stays together shares a longer one, and the
   neighbours across a cut, the longest common prefix there, are still compared.  All classes of such regions
   are searched again by the exact join of step 3, so what a cut parts is not lost.
3. Candidate clusters (connected components of the stars) are confirmed on the full shingle sets: each
   cluster is searched breadth-first with exact intersections, and gives a star per true component.
   A cluster of more than ``piece_shingles`` shingles is first split into pieces by deepening
   ``piece_trees`` trees until each fits, with the cluster's hub, the class closest to its modal
   signature, in every piece.  That only settles most links cheaply; every pair of classes that is still
   in different components is then searched by an exact prefix-filtered join of the full sets, its hot
   shingles salted, and checked by exact intersection.
4. The confirmed links' components are the result.

A pair at the threshold of 0.8 shares a region in at least one tree with probability
1 - (1 - 0.8**3)**24 > 0.9999999, and then only has to be connected by signature, not adjacent.
Confirmation loses no link, whatever the size of the cluster.

Bounds: rows a class are trees + 2, and in an oversized cluster ``piece_trees`` sets and a prefix of about
a fifth of its shingles; a task holds a region chunk of ``region_rows`` signatures or a piece; the driver
receives at most ``common_shingles`` hashes, which only order the prefixes.  Hot keys: exact copies collapse map-side; a hot region is
range-partitioned by its deeper labels.

Defined cases: null and empty texts have an empty set and link with nothing; a null ``doc_id`` is never
linked, has a null component and is kept; rows that repeat a doc_id are one node; extra columns pass
through ``keep_one``; an empty table gives an empty result; ties (equal sets) belong to the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import U64, chunks, components, cut, fresh, mix, shingle_hashes, table, text_bytes, word_hashes, words_tenant


@dataclass(frozen=True)
class ForestParams:
    width: int = 5                  # words a shingle
    threshold_pct: int = 80         # Jaccard similarity, per cent
    hashes: int = 96
    trees: int = 24
    depth: int = 3                  # least common prefix of a region
    near_pct: int = 58              # signature agreement of a candidate link (0.8 less five standard errors)
    region_rows: int = 4096
    piece_shingles: int = 1 << 22   # 32 MB of hashes
    piece_trees: int = 4            # trees an oversized cluster is first split by
    order_sample: int = 20_000      # sets whose common shingles go last in the prefix order
    common_shingles: int = 100_000
    salt_rows: int = 4096           # entries of a shingle that one task pairs with all the others
    seed: int = 20240601


def text_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, an empty one none."""
    h = word_hashes(text.lower().split())
    if len(h) == 0:
        return np.empty(0, dtype=U64)
    if len(h) < width:
        return mix(shingle_hashes(h, len(h)) + U64(len(h)))
    return np.unique(shingle_hashes(h, width))


class MinHash:
    def __init__(self, p: ForestParams):
        rng = np.random.default_rng(p.seed)
        self.a = rng.integers(0, 1 << 63, p.hashes, dtype=U64) * U64(2) + U64(1)
        self.b = rng.integers(0, 1 << 63, p.hashes, dtype=U64)

    def signature(self, s: np.ndarray) -> np.ndarray:
        out = np.full(len(self.a), np.iinfo(U64).max, dtype=U64)
        for i in range(0, len(s), 1024):
            np.minimum(out, ((s[None, i:i + 1024] * self.a[:, None]) + self.b[:, None]).min(axis=1), out=out)
        return (out >> U64(32)).astype(np.uint32)


def _orders(p: ForestParams) -> np.ndarray:
    """Per tree a permutation of the signature's positions; the first ``depth`` ones differ between trees
    as far as the hashes last."""
    rng = np.random.default_rng(p.seed + 1)
    first = np.concatenate([rng.permutation(p.hashes) for _ in range(-(-p.trees * p.depth // p.hashes))])
    out = np.empty((p.trees, p.hashes), dtype=np.int64)
    for t in range(p.trees):
        head = first[t * p.depth:(t + 1) * p.depth]
        out[t] = np.concatenate([head, rng.permutation(np.setdiff1d(np.arange(p.hashes), head))])
    return out


def _signatures(p: ForestParams):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_tenant()
        mh = MinHash(p)

        def rows(b: pa.RecordBatch):
            for i, t in zip(b.column("doc_id").to_pylist(), text_bytes(b, "text"), strict=True):
                s = text_set(t, p.width)
                if len(s) == 0:
                    yield i, 0, 0, 0, None
                    continue
                d = xxhash.xxh3_128_digest(s.tobytes())
                yield (i, len(s), int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True),
                       mh.signature(s).tobytes())

        for b in batches:
            yield from chunks(rows(b), schema)

    return run


def _heads(sig: bytes, order: np.ndarray, trees, depth: int) -> list[bytes]:
    """The tree and the first ``depth`` values of the sorted label, per tree."""
    s = np.frombuffer(sig, dtype=np.uint32).astype(">u4")
    return [bytes([t]) + s[order[t, :depth]].tobytes() for t in trees]


def _region(head: bytes) -> int:
    return xxhash.xxh3_64_intdigest(head) - (1 << 63)


def _regions(p: ForestParams):
    """Per class and tree the region's hash: light rows, to find the regions that several classes share."""
    schema = pa.schema([("region", pa.int64()), ("tree", pa.int32()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_tenant()
        order = _orders(p)
        for b in batches:
            yield from chunks(((_region(head), t, i)
                               for i, sig in zip(b.column("id").to_pylist(), b.column("sig").to_pylist(), strict=True)
                               for t, head in enumerate(_heads(sig, order, range(p.trees), p.depth))), schema)

    return run


def _labels(p: ForestParams):
    """Per class and listed tree the whole sorted label: the first values in full, one byte of each later one;
    ``crowded`` where the region is among the ``hot`` ones."""
    schema = pa.schema([("region", pa.int64()), ("label", pa.binary()), ("id", pa.int64()), ("crowded", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = _orders(p)

        def rows(b: pa.RecordBatch):
            for i, sig, trees, hot in zip(*(b.column(c).to_pylist() for c in ("id", "sig", "trees", "hot")), strict=True):
                low = (np.frombuffer(sig, dtype=np.uint32) & np.uint32(255)).astype(np.uint8)
                for t, head in zip(trees, _heads(sig, order, trees, p.depth), strict=True):
                    region = _region(head)
                    yield region, head + low[order[t, p.depth:]].tobytes(), i, region in hot

        for b in batches:
            yield from chunks(rows(b), schema)

    return run


def _near_stars(p: ForestParams):
    """Over one sorted slice of the forest: stars (smallest id, member) of the classes near each other."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    head = 1 + 4 * p.depth
    most = 2 * p.region_rows

    def stars(ids: np.ndarray, sig: np.ndarray):
        need = p.near_pct * p.hashes
        left = np.arange(len(ids))
        while len(left) > 1:
            group, left = [left[0]], left[1:]
            at = 0
            while at < len(group) and len(left):
                near = 100 * (sig[left] == sig[group[at]]).sum(axis=1, dtype=np.int64) >= need
                group.extend(left[near])
                left = left[~near]
                at += 1
            if len(group) > 1:
                root = ids[group].min()
                yield from ((int(root), int(x)) for x in ids[group] if x != root)

    def region(buf: list[tuple[bytes, int]], whole: bool) -> tuple[list, list]:
        """Pairs of the region's first chunk, and the rows left for the next one."""
        n = len(buf)
        raw = np.frombuffer(b"".join(x[0] for x in buf), dtype=np.uint8).reshape(n, -1)
        ids = np.array([x[1] for x in buf], dtype=np.int64)
        sig = np.concatenate([raw[:, 4:head:4], raw[:, head:]], axis=1)
        end = n
        if n > p.region_rows or not whole:
            same = raw[1:] == raw[:-1]
            lcp = np.where(same.all(axis=1), raw.shape[1], same.argmin(axis=1))
            low, high = max(1, p.region_rows // 2), min(p.region_rows, n - 1)
            end = low + int(lcp[low - 1:high].argmin())  # the shallowest boundary in the second half
        out = list(stars(ids[:end], sig[:end]))
        if end < n and 100 * (sig[end - 1] == sig[end]).sum() >= p.near_pct * p.hashes:
            out.append((int(ids[end - 1]), int(ids[end])))
        return out, buf[end:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            buf: list[tuple[bytes, int]] = []
            for b in batches:
                for label, i in zip(b.column("label").to_pylist(), b.column("id").to_pylist(), strict=True):
                    if buf and buf[0][0][:head] != label[:head]:
                        while len(buf) > 1:
                            out, buf = region(buf, True)
                            yield from out
                        buf = []
                    buf.append((label, i))
                    if len(buf) >= most:
                        out, buf = region(buf, False)
                        yield from out
            while len(buf) > 1:
                out, buf = region(buf, True)
                yield from out

        yield from chunks(rows(), schema)

    return run


def _shingle_sets(p: ForestParams):
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from chunks(((i, text_set(t, p.width).tobytes())
                               for i, t in zip(b.column("id").to_pylist(), text_bytes(b, "text"), strict=True)),
                              schema, weight=lambda r: len(r[1]))

    return run


def exact_stars(ids: np.ndarray, sets: list[np.ndarray], threshold_pct: int) -> list[tuple[int, int]]:
    """Stars (smallest id, member) of the components that exact Jaccard similarity gives among ``sets``."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    flat = flat.astype(np.int32)
    start = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(int(flat.max()) + 1, dtype=np.uint8)
    left = np.arange(len(ids))
    pool, pool_start = flat, start[:-1]
    out = []
    while len(left) > 1:
        group, at = [left[0]], 0
        left, pool, pool_start = _without(left, pool, pool_start, size, left != left[0])
        while at < len(group) and len(left):
            i = group[at]
            own = flat[start[i]:start[i + 1]]
            mark[own] = 1
            shared = np.add.reduceat(mark[pool], pool_start, dtype=np.int64)
            mark[own] = 0
            link = (100 + threshold_pct) * shared >= threshold_pct * (size[left] + size[i])
            if link.any():
                group.extend(left[link])
                left, pool, pool_start = _without(left, pool, pool_start, size, ~link)
            at += 1
        if len(group) > 1:
            root = ids[group].min()
            out.extend((int(root), int(x)) for x in ids[group] if x != root)
    return out


def _without(left, pool, pool_start, size, keep):
    kept = left[keep]
    return kept, pool[np.repeat(keep, size[left])], np.concatenate([[0], np.cumsum(size[kept])[:-1]]).astype(np.int64)


def _confirm(p: ForestParams):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        sets = [np.frombuffer(s.as_py(), dtype=U64) for s in group.column("shingles")]
        ids = group.column("id").to_numpy()
        full = [i for i, s in enumerate(sets) if len(s)]  # a repeated doc_id may bring an empty text along
        got = exact_stars(ids[full], [sets[i] for i in full], p.threshold_pct) if len(full) > 1 else []
        return pa.table({"a": pa.array([x[0] for x in got], pa.int64()), "b": pa.array([x[1] for x in got], pa.int64())}, schema=schema)

    return run


def _pieces(cluster: DataFrame, classes: DataFrame, p: ForestParams) -> tuple[DataFrame, DataFrame | None]:
    """``(id, piece)``, and the members of the oversized clusters, if any.

    Clusters that fit are one piece; larger ones go by ever deeper labels, each tree anew."""
    weight = cluster.groupBy("cluster").agg(F.sum("n").alias("total"))
    big = cut(weight.where(F.col("total") > p.piece_shingles))
    whole = cluster.join(big, "cluster", "left_anti").select("id", F.xxhash64("cluster").alias("piece"))
    if big.isEmpty():
        return whole, None
    member = cut(cluster.join(big, "cluster").join(classes.select("id", "sig"), "id"))
    return whole.unionByName(_hub_rows_and_deep(member, p)), member.select("id").distinct()


def _hub_rows_and_deep(member: DataFrame, p: ForestParams) -> DataFrame:
    """``member(id, cluster, n, sig)`` of oversized clusters -> their pieces, each with the cluster's hub."""
    spark = member.sparkSession
    value = member.select("cluster", "id", F.explode(F.sequence(F.lit(0), F.lit(p.hashes - 1))).alias("at"), "sig") \
        .select("cluster", "id", "at", F.substring(F.col("sig"), F.col("at") * 4 + 1, F.lit(4)).alias("v"))
    mode = (value.groupBy("cluster", "at", "v").count()
            .groupBy("cluster", "at").agg(F.max_by("v", F.struct("count", "v")).alias("v")))
    score = value.join(mode, ["cluster", "at", "v"]).groupBy("cluster", "id").count()
    hub = cut(score.groupBy("cluster").agg(F.max_by("id", F.struct(F.col("count"), -F.col("id"))).alias("id")))
    rows = cut(member.mapInArrow(_tree_labels(p), "id long, cluster long, n long, tree int, label binary"))
    done: DataFrame | None = None
    for depth in range(1, p.hashes + 1):
        key = F.xxhash64("cluster", "tree", F.substring(F.col("label"), 1, depth))
        rows = rows.withColumn("piece", key)
        over = cut(rows.groupBy("piece").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"))
                   .where((F.col("total") > p.piece_shingles) & (F.col("rows") > 1)).select("piece"))
        fits = rows.join(over, "piece", "left_anti").select("id", "piece", "cluster")
        done = fits if done is None else done.unionByName(fits)
        if over.isEmpty():
            rows = spark.createDataFrame([], rows.schema)
            break
        rows = cut(rows.join(over, "piece", "left_semi"))
    # classes with equal labels throughout: any share of them will do, the exact join finds what is left
    rest = rows.select("id", F.xxhash64("piece", F.pmod(F.xxhash64("id"), F.lit(64))).alias("piece"), "cluster")
    done = cut(done.unionByName(rest))
    hubs = done.select("piece", "cluster").distinct().join(hub, "cluster").select("id", "piece")
    return done.select("id", "piece").unionByName(hubs).distinct()


def _tree_labels(p: ForestParams):
    schema = pa.schema([("id", pa.int64()), ("cluster", pa.int64()), ("n", pa.int64()), ("tree", pa.int32()), ("label", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = _orders(p)
        for b in batches:
            def rows(b=b):
                for i, c, n, sig in zip(*(b.column(x).to_pylist() for x in ("id", "cluster", "n", "sig")), strict=True):
                    low = (np.frombuffer(sig, dtype=np.uint32) & np.uint32(255)).astype(np.uint8)
                    for t in range(min(p.piece_trees, p.trees)):
                        yield i, c, n, t, low[order[t]].tobytes()
            yield from chunks(rows(), schema)

    return run


def _common(sets: DataFrame, p: ForestParams) -> tuple[np.ndarray, np.ndarray]:
    """The common shingles of a sample of ``sets``, sorted, and their counts.  They order the prefixes only."""
    n = max(1, sets.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.column("shingles").to_pylist():
                yield pa.record_batch({"s": pa.array(np.frombuffer(s, dtype=np.int64))})

    part = sets.select("shingles").sample(fraction=min(1.0, p.order_sample / n), seed=p.seed)
    top = (part.mapInArrow(run, "s long").groupBy("s").count().where("count > 1")
           .orderBy(F.desc("count"), "s").limit(p.common_shingles).orderBy("s").toArrow())
    return top.column("s").to_numpy().view(U64), top.column("count").to_numpy()


def _prefixes(p: ForestParams, common):
    """Per set its first shingles, rarest first: two sets at the threshold share one of them."""
    schema = pa.schema([("s", pa.int64()), ("id", pa.int64()), ("comp", pa.int64()), ("n", pa.int64()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = common.value
        order = np.argsort(known)
        known, count = known[order], count[order]

        def rows(b: pa.RecordBatch):
            for i, c, raw in zip(*(b.column(x).to_pylist() for x in ("id", "comp", "shingles")), strict=True):
                s = np.frombuffer(raw, dtype=U64)
                rank = np.zeros(len(s), dtype=np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    rank = np.where(known[at] == s, count[at], 0)
                first = s[np.lexsort((s, rank))[:len(s) + (-p.threshold_pct * len(s)) // 100 + 1]]
                for k, x in enumerate(first.view(np.int64).tolist()):
                    yield x, i, c, len(s), k

        for b in batches:
            yield from chunks(rows(b), schema)

    return run


def _verified(p: ForestParams):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(b: pa.RecordBatch):
            for i, j, x, y in zip(*(b.column(c).to_pylist() for c in ("a", "b", "x", "y")), strict=True):
                x, y = np.frombuffer(x, dtype=U64), np.frombuffer(y, dtype=U64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if (100 + p.threshold_pct) * shared >= p.threshold_pct * (len(x) + len(y)):
                    yield i, j

        for b in batches:
            yield from chunks(rows(b), schema)

    return run


def _plain(df: DataFrame) -> DataFrame:
    """``df`` without the plan statistics that checkpoints carry on; with them the later rounds of
    ``components`` took seconds each on 24 rows, probably because every join multiplies the size estimates."""
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(df._jdf.toJavaRDD(), df._jdf.schema()), spark)


def _rest_links(docs: DataFrame, member: DataFrame, comp: DataFrame, p: ForestParams) -> DataFrame:
    """All links ``(a, b)`` among ``member(id)`` between different components of ``comp(id, component)``.

    Two sets at the threshold share a shingle among their first ones in any common order, and at the first
    one they share both have enough shingles left; the pairs that pass are checked on the whole sets.
    """
    sets = (docs.withColumnRenamed("doc_id", "id").join(member, "id").mapInArrow(_shingle_sets(p), "id long, shingles binary")
            .where(F.length("shingles") > 0))
    sets = cut(sets.join(comp, "id", "left").select("id", F.coalesce("component", "id").alias("comp"), "shingles"))
    common = docs.sparkSession.sparkContext.broadcast(_common(sets, p))
    entry = cut(sets.mapInArrow(_prefixes(p, common), "s long, id long, comp long, n long, at long"))
    open_ = (entry.groupBy("s").agg(F.count(F.lit(1)).alias("rows"), F.min("comp").alias("low"), F.max("comp").alias("high"))
             .where("low < high").select("s", F.ceil(F.col("rows") / F.lit(p.salt_rows)).cast("long").alias("salts")))
    entry = cut(entry.join(open_, "s"))
    x = entry.select("s", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"), F.col("id").alias("a"),
                     F.col("comp").alias("ca"), F.col("n").alias("na"), F.col("at").alias("ia"))
    y = entry.select("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.col("id").alias("b"),
                     F.col("comp").alias("cb"), F.col("n").alias("nb"), F.col("at").alias("ib"))
    enough = F.expr(f"{100 + p.threshold_pct} * least(na - ia, nb - ib) >= {p.threshold_pct} * (na + nb)")
    pair = x.join(y, ["s", "salt"]).where((F.col("ca") < F.col("cb")) & enough).select("a", "b").distinct()
    one, other = (sets.select(F.col("id").alias(i), F.col("shingles").alias(v)) for i, v in (("a", "x"), ("b", "y")))
    return pair.join(one, "a").join(other, "b").mapInArrow(_verified(p), "a long, b long")


def near_components(docs: DataFrame, p: ForestParams = ForestParams(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spark = docs.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = cut(docs.mapInArrow(_signatures(p), "doc_id long, n long, d1 long, d2 long, sig binary"))
    linked = base.where("n > 0 AND doc_id IS NOT NULL")
    classes = cut(linked.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")))

    region = cut(classes.select("id", "sig").mapInArrow(_regions(p), "region long, tree int, id long"))
    shared = region.groupBy("region").count().where("count > 1")
    member = region.join(shared, "region").groupBy("id").agg(
        F.collect_list("tree").alias("trees"), F.collect_list(F.when(F.col("count") > p.region_rows, F.col("region"))).alias("hot"))
    forest = cut(classes.select("id", "sig").join(member, "id").mapInArrow(_labels(p), "region long, label binary, id long, crowded boolean"))
    # A region is whole in one task; one of more than region_rows classes is dealt out by range and cut, and what the cuts
    # part is searched below.  No join may stand between the forest and the repartition: after one by region Spark leaves the
    # repartition out, and once AQE broadcasts the join's small side it reads the other locally, which parts the regions.
    crowded = forest.where("crowded")
    cutting = not crowded.isEmpty()
    some = forest.where("NOT crowded") if cutting else forest
    stars = some.repartition(slices, "region").select("label", "id").sortWithinPartitions("label", "id").mapInArrow(_near_stars(p), "a long, b long")
    if cutting:
        stars = stars.unionByName(crowded.select("label", "id").repartitionByRange(slices, "label", "id")
                                  .sortWithinPartitions("label", "id").mapInArrow(_near_stars(p), "a long, b long"))
    cluster = components(stars).withColumnRenamed("component", "cluster")
    cluster = cut(cluster.join(classes.groupBy("id").agg(F.max("n").alias("n")), "id"))

    piece, oversized = _pieces(cluster, classes, p)
    piece = cut(piece)
    sets = (docs.join(piece.select(F.col("id").alias("doc_id")).distinct(), "doc_id")
            .withColumnRenamed("doc_id", "id").mapInArrow(_shingle_sets(p), "id long, shingles binary"))
    links = cut(piece.join(sets, "id").groupBy("piece").applyInArrow(_confirm(p), "a long, b long"))
    comp = components(links)
    rest = [] if oversized is None else [oversized.select("id")]
    if cutting:
        rest.append(crowded.select("id"))
    if rest:
        rest = cut(reduce(DataFrame.unionByName, rest).distinct())
        comp = components(_plain(links.unionByName(_rest_links(docs, rest, _plain(comp), p))))

    of_class = (classes.select("d1", "d2", "n", "id").join(comp, "id", "left")
                .select("d1", "d2", "n", F.coalesce("component", "id").alias("component")))
    found = (linked.select("doc_id", "n", "d1", "d2").join(of_class, ["d1", "d2", "n"])
             .select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")))
    alone = base.where("n = 0 OR doc_id IS NULL") \
        .select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, p: ForestParams = ForestParams(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, without the documents that are not the smallest id of their component."""
    gone = near_components(docs, p, doc_id, text).where(~F.col("kept"))
    (name,) = fresh(docs, "gone_id")
    gone = gone.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col(doc_id).cast("long") == F.col(name), "left_anti")


def op6_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``documents`` on 4-word shingles (the width its contract fixes)."""
    return near_components(table(spark, sf_dir, "documents", "doc_id", "text"), ForestParams(width=4))


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') || CASE WHEN len(ws) < 4 THEN ' ' ELSE '' END AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT a AS id, a AS r FROM edges
  UNION
  SELECT edges.b, reach.r FROM reach JOIN edges ON edges.a = reach.id WHERE reach.r < edges.b),
comp AS (SELECT id, min(r) AS component FROM reach GROUP BY id)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component, w.doc_id) AS component_id,
       coalesce(component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN sizes ON sizes.doc_id = w.doc_id LEFT JOIN comp ON comp.id = w.doc_id
"""
