"""Quality rules: a short-circuit cascade of native column expressions.

Every rule is one boolean column over ``text`` that says "reject".  ``profile`` measures each rule's
cost (seconds) and selectivity (share rejected) on a bounded sample, ``order`` sorts the rules by
rejection per cost, and ``cascade`` chains them in that order into one CASE, which Spark evaluates
lazily: a document rejected by a cheap rule never pays for a later one.  The order changes the cost
and the *named* reason only, never the verdict, since a document is kept only if no rule rejects it.

Only DataFrame functions are used.  Defined cases: a null or empty text has no words and fails
``few_words``; a null ``doc_id`` is judged like any other row; repeated rows are judged each; extra
columns pass through ``keep``; an empty table gives an empty result; an empty sample keeps the
declared order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import SPACE, fresh

WINDOW = 8


@dataclass(frozen=True)
class QualityParams:
    """Thresholds; ratios are whole per cents so that every comparison is exact in integers."""

    min_words: int = 20
    max_repeat_pct: int = 30       # words in repeated 8-word windows, per cent of words
    max_symbol_pct: int = 10       # symbols, per cent of words
    max_dup_line_pct: int = 50     # repeated lines, per cent of lines with a word
    min_mean_word: int = 3         # code points a word, on average
    max_mean_word: int = 12
    sample_rows: int = 500         # rows used to estimate cost and selectivity, and
    sample_chars: int = 20_000     # characters of each: the estimate's bound on the driver, 40 MB at most
    rounds: int = 1                # timed runs of each rule on the sample


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once inside one expression, so that ``body`` can use it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def symbols(text: Column) -> Column:
    return F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^#*$%&|<>]+", "")).cast("long")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(f"[^{SPACE}]"))


def repeat_words(words: Column) -> Column:
    """Words inside 8-word windows that occur at least twice in the text.

    Window hashes are compared as an array: only if some are equal are they sorted with their
    positions, so that repeats are neighbours; the words covered by the repeated windows are the sum,
    over their sorted positions, of the gap to the next one, 8 at most.
    """
    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)]))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def repeated(s: Column) -> Column:
        same = F.filter(s, lambda x, j: F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))
                        | ((j > 0) & (F.get(s, F.greatest(j - 1, F.lit(0)))["h"] == x["h"])))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def counted(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")) \
            .otherwise(let(let(pairs, repeated), covered))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")) \
        .otherwise(let(let(hashes, windows), counted))


def rules(text: Column, p: QualityParams = QualityParams()) -> dict[str, Column]:
    """name -> "reject" over the text itself, each self-contained so that CASE can skip it."""
    words = words_of(text)
    return {
        "few_words": F.size(words) < p.min_words,
        "symbols": let(F.size(words), lambda n: 100 * symbols(text) > p.max_symbol_pct * n),
        "word_length": let(words, lambda w: (word_chars(w) < p.min_mean_word * F.size(w))
                           | (word_chars(w) > p.max_mean_word * F.size(w))),
        "duplicate_lines": let(worded_lines(text), lambda ls: 100 * (F.size(ls) - F.size(F.array_distinct(ls)))
                               > p.max_dup_line_pct * F.size(ls)),
        "repeats": let(words, lambda w: 100 * repeat_words(w) > p.max_repeat_pct * F.size(w)),
    }


def measured_rules(c: dict[str, Column], p: QualityParams = QualityParams()) -> dict[str, Column]:
    """The same rules over the columns of :func:`measure`."""
    return {
        "few_words": c["n_words"] < p.min_words,
        "symbols": 100 * c["n_symbols"] > p.max_symbol_pct * c["n_words"],
        "word_length": (c["word_chars"] < p.min_mean_word * c["n_words"]) | (c["word_chars"] > p.max_mean_word * c["n_words"]),
        "duplicate_lines": 100 * c["n_dup_lines"] > p.max_dup_line_pct * c["n_lines"],
        "repeats": 100 * c["n_repeat_words"] > p.max_repeat_pct * c["n_words"],
    }


def profile(docs: DataFrame, p: QualityParams = QualityParams(), text: str = "text") -> list[tuple[str, float, float]]:
    """(rule, seconds, share rejected) on the first ``sample_rows`` rows; one small job a rule.

    ``take`` reads only as many partitions as it needs.  The sample decides the order of the rules, never a
    verdict, so cutting its texts and taking the first rows can cost time at worst.
    """
    some = docs.select(F.substring(F.col(text), 1, p.sample_chars).alias("text")).take(p.sample_rows)
    sample = docs.sparkSession.createDataFrame([(r["text"],) for r in some], "text string")
    out = []
    for name, reject in rules(F.col("text"), p).items():
        job = sample.select(F.count_if(reject))
        took = []
        for _ in range(p.rounds):
            t = time.perf_counter()
            hit = job.first()[0]
            took.append(time.perf_counter() - t)
        out.append((name, min(took), hit / len(some) if some else 0.0))
    return out


def order(stats: list[tuple[str, float, float]]) -> list[str]:
    """Most rejection per second first; ties keep the declared order."""
    return [s[0] for s in sorted(stats, key=lambda s: -(s[2] / max(s[1], 1e-6)))]


def cascade(rule_set: dict[str, Column], names: list[str]) -> Column:
    """The first rule, in the given order, that rejects the document; null if none does."""
    out = F.when(rule_set[names[0]], F.lit(names[0]))
    for n in names[1:]:
        out = out.when(rule_set[n], F.lit(n))
    return out


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words for every whole text."""
    words, lines = fresh(docs, "words", "lines")
    return (docs.withColumn(words, words_of(F.col(text))).withColumn(lines, worded_lines(F.col(text)))
            .withColumns({"n_words": F.size(words).cast("long"), "word_chars": word_chars(F.col(words)),
                          "n_symbols": symbols(F.col(text)), "n_lines": F.size(lines).cast("long"),
                          "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
                          "n_repeat_words": repeat_words(F.col(words))})
            .drop(words, lines))


def report(docs: DataFrame, p: QualityParams = QualityParams(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the measured columns, ``base_failed``, ``kept`` and ``reason`` (the cascade's first rejecting rule)."""
    names = order(profile(docs, p, text))
    m = measure(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    c = {x: F.col(x) for x in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")}
    r = measured_rules(c, p)
    return m.select("doc_id", *c, (r["few_words"] | r["repeats"]).alias("base_failed"), cascade(r, names).alias("reason")) \
        .withColumn("kept", F.col("reason").isNull())


def keep(docs: DataFrame, p: QualityParams = QualityParams(), text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that no rule rejects; the cascade stops at the first rejection."""
    names = order(profile(docs, p, text))
    return docs.where(cascade(rules(F.col(text), p), names).isNull())


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Quality rules over every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return report(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept")


OP10_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c >= 2),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, range(0, 8) AS t(k) GROUP BY r),
base AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * n_words
            OR word_chars < 3 * n_words OR word_chars > 12 * n_words
            OR 100 * n_dup_lines > 50 * n_lines) AS kept
FROM base
"""
