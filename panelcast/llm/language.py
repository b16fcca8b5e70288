"""Language ID by Bayesian evidence fusion.

Four kinds of evidence about a text's language l are combined as log odds:

* the text: hashed byte trigrams under a multinomial model per language, counted over all labelled documents;
* the language declared in the markup, P(declared | l);
* the address suffix (a two-letter first path segment, else a two-letter top-level domain), P(suffix | l);
* the host, P(l | host), smoothed hierarchically: the host's counts lean on its domain's, the domain's
  on all rows'.  A row's own vote is taken out of its host's and domain's counts.

The last three tables are grouped aggregates over all rows, with the most likely language of the text
alone as each row's vote.  Missing evidence contributes nothing.

Shuffles: model counts (one row per language, bucket and task), evidence counts (combined before the
shuffle, so a host with a third of all rows is one row a task), and the rows' joins with them (AQE
splits a hot host).  The driver gets the text model, ``max_languages * buckets`` numbers at most.

Defined cases: null and empty texts, or markup without text, have no text evidence and no vote; rows
without any evidence get the most frequent language; null ids are carried along; repeated rows are judged
each; ties go to the language first in the alphabet; extra columns are ignored; an empty table gives an
empty result; training without any labelled text fails with a clear error unless nothing is to be judged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import ascii_lower, chunks, cut, table, text_bytes
from panelcast.llm.url_filter import url_host, url_path

_MARKUP = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


@dataclass(frozen=True)
class LanguageParams:
    bucket_bits: int = 13
    max_languages: int = 64       # bound of the model that the driver holds
    smooth: float = 0.5           # added to every trigram count
    text_weight: float = 1 / 3    # neighbouring trigrams share bytes
    host_weight: float = 4.0      # rows that the next level of the host prior counts for
    evidence_smooth: float = 1.0


def trigram_buckets(text: bytes, bits: int) -> np.ndarray:
    a = np.frombuffer(b" ".join(text.lower().split()), dtype=np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.empty(0, dtype=np.uint32)
    return (((a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]) * np.uint32(2654435761)) >> np.uint32(32 - bits)


def _count(p: LanguageParams):
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, t in zip(b.column("lang").to_pylist(), text_bytes(b, "text"), strict=True):
                got = trigram_buckets(t, p.bucket_bits)
                if lang not in total:
                    total[lang] = np.zeros(1 << p.bucket_bits, dtype=np.int64)
                total[lang] += np.bincount(got, minlength=1 << p.bucket_bits)
        yield from chunks(((lang, int(i), int(n[i])) for lang, n in total.items() for i in np.flatnonzero(n)), schema)

    return run


@dataclass(frozen=True)
class TextModel:
    languages: list[str]
    log_p: np.ndarray  # language x bucket


def train(docs: DataFrame, p: LanguageParams = LanguageParams()) -> TextModel:
    """``docs(text, lang)``; rows without a language are left out, all others count."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.trim(ascii_lower("lang")).alias("lang"), "text")
    names = [r[0] for r in known.select("lang").distinct().limit(p.max_languages + 1).collect()]
    if len(names) > p.max_languages:
        raise ValueError(f"more than {p.max_languages} languages; raise max_languages")
    got = (known.mapInArrow(_count(p), "lang string, bucket int, n long")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    names = sorted(names)
    n = np.full((len(names), 1 << p.bucket_bits), p.smooth)
    if len(got):
        n[np.searchsorted(names, got["lang"]), got["bucket"]] += got["n"]
    return TextModel(names, np.log(n / n.sum(axis=1, keepdims=True)))


def _score(p: LanguageParams, shared, markup: bool, names: list[str]):
    """Takes ``text`` away and adds the declared language, the text's log likelihood per language, and its vote."""
    declared_in = re.compile(rb"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p = shared.value
        for b in batches:
            declared, loglik, vote = [], [], []
            for t in text_bytes(b, "text"):
                said = None
                if markup:
                    m = declared_in.search(t)
                    said = m[1].lower().decode() if m else None
                    t = _MARKUP.sub(b" ", t)
                got = trigram_buckets(t, p.bucket_bits)
                like = p.text_weight * log_p[:, got].sum(axis=1)
                declared.append(said)
                loglik.append(like.tolist())
                vote.append(int(like.argmax()) if len(got) else None)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.array(declared, pa.string()), pa.array(loglik, pa.list_(pa.float64())), pa.array(vote, pa.int32())],
                names=[*names, "declared", "loglik", "vote"])

    return run


def identify(rows: DataFrame, model: TextModel, p: LanguageParams = LanguageParams(), markup: bool = True,
             text: str = "text", url: str | None = "url", host: str | None = None) -> DataFrame:
    """``rows`` without ``text``, with lang, probability, text_lang, declared, suffix.

    The host is that of ``url`` or the column ``host``.  With ``markup`` the text is HTML.
    """
    spark, names = rows.sparkSession, model.languages
    if not names:
        if rows.isEmpty():
            names = ["und"]
        else:
            raise ValueError("no labelled text to learn languages from")
    log_p = model.log_p if model.languages else np.zeros((1, 1 << p.bucket_bits))
    address = F.col(url) if url else F.lit(None).cast("string")
    at_host = url_host(address) if url else F.coalesce(F.col(host).cast("string"), F.lit("")) if host else F.lit("")
    segment = F.regexp_extract(ascii_lower(url_path(address)), r"^/([a-z]{2})(?:/|$)", 1)
    top = F.regexp_extract(at_host, r"\.([a-z]{2})$", 1)
    suffix = F.coalesce(F.nullif(segment, F.lit("")), F.nullif(top, F.lit("")))
    keep = [c for c in rows.columns if c != text]
    made = {"lang", "probability", "text_lang", "declared", "suffix", "at_host", "at_domain", "loglik", "vote", "post", "text"}
    if clash := made & {c.lower() for c in keep}:
        raise ValueError(f"rename the input columns {sorted(clash)}; the result uses these names")
    base = (rows.select(*keep, F.col(text).alias("text"))
            .withColumns({"at_host": at_host, "suffix": suffix if url else F.lit(None).cast("string")})
            .withColumn("at_domain", F.substring_index("at_host", ".", -2)))
    lean = base.drop("text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lean.schema)
    base = cut(base.mapInArrow(_score(p, spark.sparkContext.broadcast(log_p), markup, lean.columns),
                               f"{kinds}, declared string, loglik array<double>, vote int"))

    langs = range(len(names))
    voted = base.where("vote IS NOT NULL")
    votes = F.array(*[F.count_if(F.col("vote") == i).cast("double") for i in langs])
    whole = voted.agg(votes.alias("n")).first()["n"] or [0.0 for _ in langs]
    share = [(x + 1) / (sum(whole) + len(names)) for x in whole]
    by_host = voted.where("at_host <> ''").groupBy("at_host").agg(votes.alias("host_n"))
    by_domain = voted.where("at_host <> ''").groupBy("at_domain").agg(votes.alias("domain_n"))

    def likelihood(column: str, out: str) -> DataFrame:
        """log P(value | l) for every value of the column: its share among the votes for l."""
        own = voted.where(F.col(column).isNotNull())
        total = own.agg(votes.alias("n"), F.count_distinct(column).alias("k")).first()
        a = p.evidence_smooth
        logs = [F.log((F.col("n")[i] + a) / F.lit((total["n"][i] if total["n"] else 0) + a * (total["k"] + 1))) for i in langs]
        return own.groupBy(column).agg(votes.alias("n")).select(column, F.array(*logs).alias(out))

    own_vote = [F.when(F.col("vote") == i, 1.0).otherwise(0.0) for i in langs]
    out = (base.join(by_host, "at_host", "left").join(by_domain, "at_domain", "left")
           .join(likelihood("declared", "of_declared"), "declared", "left").join(likelihood("suffix", "of_suffix"), "suffix", "left"))
    k = p.host_weight

    def leaned(n: str, i: int, before):
        rest = [F.coalesce(F.col(n)[j] - own_vote[j], F.lit(0.0)) for j in langs]
        every = rest[0]
        for r in rest[1:]:
            every = every + r
        return (rest[i] + k * before) / (every + k)

    post = [F.col("loglik")[i] + F.coalesce(F.col("of_declared")[i], F.lit(0.0)) + F.coalesce(F.col("of_suffix")[i], F.lit(0.0))
            + F.log(leaned("host_n", i, leaned("domain_n", i, F.lit(share[i])))) for i in langs]
    best = F.array_max("post")
    label = F.array(*map(F.lit, names))
    return (out.withColumn("post", F.array(*post))
            .select(*keep, F.get(label, F.array_position("post", best).cast("int") - 1).alias("lang"),
                    F.round(1 / F.aggregate("post", F.lit(0.0), lambda a, x: a + F.exp(x - best)), 4).alias("probability"),
                    F.get(label, F.col("vote")).alias("text_lang"), "declared", "suffix"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every row of ``documents`` (host: its source) and ``pages`` (markup, address and host)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    model = train(docs)
    of_docs = identify(docs.select("doc_id", "text", "source"), model, markup=False, url=None, host="source") \
        .withColumn("page_id", F.lit(None).cast("long")).drop("source")
    of_pages = identify(table(spark, sf_dir, "pages", "page_id", "url", "html"), model, text="html") \
        .withColumn("doc_id", F.lit(None).cast("long")).drop("url")
    cols = ["doc_id", "page_id", "lang", "probability", "text_lang", "declared", "suffix"]
    return of_docs.select(*cols).unionByName(of_pages.select(*cols))
