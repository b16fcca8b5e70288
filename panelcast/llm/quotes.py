"""Chat formatting by quotation linking.

1. Every message is parsed into quote levels: a line that starts with n marks ``>`` has level n.  Lines of
   one level in a row are a passage; level 0 is the message's own text.
2. Passages are normalised (words in lower case, single spaces) and hashed, whole and line by line.
3. Quoted hashes are joined to the own-text hashes of original messages: an earlier turn of the same
   conversation if one holds it, else the earliest message of all that does, if that is earlier.
   The message that explains the most quoted words of a level is the one quoted there.
4. A message replies to the one quoted at level 1.  Following the replies upwards, by pointers that double
   their reach each round, gives its thread; a message without a reply belongs to its conversation's first turn.
   A reply always comes after what it replies to, so a thread sorted by (conversation, turn) is in reply order.

Messages come back without their quotes, formatted with their role, sorted by thread.  No conversation or
thread is collected: originals are minima (combined before the shuffle), and a conversation or a passage
that holds a third of all rows is a skewed equi-join.  Rounds are the logarithm of the longest chain.

Defined cases: null and empty texts have no passages and an empty clean text; a null conv_id or turn
cannot be quoted nor quote and is its own thread with null keys; a null role is "user"; rows that repeat a
(conv_id, turn) are one message for linking and come back each; extra columns pass through; an empty table
gives an empty result; among equally good originals the earliest wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import cut, table, text_bytes

_MARKS = re.compile(rb"^(?:[ \t]*>)+[ \t]?")


def quote_levels(text: bytes) -> list[tuple[int, list[bytes]]]:
    """Runs of lines of one level, marks taken off; blank lines stay with the run they are in."""
    out: list[tuple[int, list[bytes]]] = []
    for line in text.split(b"\n"):
        m = _MARKS.match(line)
        level = m[0].count(b">") if m else 0
        body = line[m.end():] if m else line
        if out and out[-1][0] == level:
            out[-1][1].append(body)
        else:
            out.append((level, [body]))
    return out


def passage_keys(lines: list[bytes]) -> dict[int, int]:
    """hash -> number of words: the whole passage and each of its lines, normalised."""
    out = {}
    parts = [x.lower().split() for x in lines]
    whole = [w for x in parts for w in x]
    for words in [*parts, whole]:
        if words:
            out[xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)] = len(words)
    return out


def clean_text(runs: list[tuple[int, list[bytes]]]) -> str:
    return b"\n".join(line for level, lines in runs if level == 0 for line in lines).strip().decode()


_KEYS = pa.list_(pa.struct([("level", pa.int32()), ("key", pa.int64()), ("words", pa.int64())]))


def _parse(schema_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, clean, levels = [], [], []
            for t in text_bytes(b, "text"):
                runs = quote_levels(t)
                keys.append([{"level": level, "key": k, "words": n} for level, lines in runs for k, n in passage_keys(lines).items()])
                clean.append(clean_text(runs))
                levels.append(max(level for level, _ in runs))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in schema_names], pa.array(keys, _KEYS), pa.array(clean, pa.string()),
                                              pa.array(levels, pa.int32())], names=[*schema_names, "passages", "clean", "levels"])

    return run


def link(messages: DataFrame) -> DataFrame:
    """``messages(conv_id, turn, passages)`` -> ``(conv_id, turn, level, to_conv, to_turn, words)`` of every quoted message."""
    each = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", F.inline("passages"))
    own = each.where("level = 0").select("key", "conv_id", "turn")
    quoted = cut(each.where("level > 0").groupBy("conv_id", "turn", "level", "key").agg(F.max("words").alias("words")))
    wanted = quoted.select("key").distinct()
    held = own.join(wanted, "key", "left_semi")
    near = held.groupBy("key", "conv_id").agg(F.min("turn").alias("near_turn"))
    far = held.groupBy("key").agg(F.min(F.struct("conv_id", "turn")).alias("far"))
    here = F.struct("conv_id", "turn")
    same = F.when(F.col("near_turn") < F.col("turn"), F.struct("conv_id", F.col("near_turn").alias("turn")))
    found = (quoted.join(near, ["key", "conv_id"], "left").join(far, "key", "left")
             .withColumn("to", F.coalesce(same, F.when(F.col("far") < here, F.col("far")))).where("to IS NOT NULL"))
    # a whole passage of one line has one key, so words count once per key
    return (found.groupBy("conv_id", "turn", "level", "to").agg(F.sum("words").alias("words"))
            .groupBy("conv_id", "turn", "level")
            .agg(F.min_by(F.struct("to", "words"), F.struct(-F.col("words"), F.col("to"))).alias("b"))
            .select("conv_id", "turn", "level", F.col("b.to.conv_id").alias("to_conv"), F.col("b.to.turn").alias("to_turn"), "b.words"))


def threads(messages: DataFrame, links: DataFrame) -> DataFrame:
    """``(conv_id, turn, reply_conv, reply_turn, thread_conv, thread_turn, depth)``; depth counts replies."""
    known = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    first = known.groupBy("conv_id").agg(F.min("turn").alias("first"))
    reply = links.where("level = 1").select("conv_id", "turn", F.col("to_conv").alias("reply_conv"), F.col("to_turn").alias("reply_turn"))
    node = cut(known.join(first, "conv_id").join(reply, ["conv_id", "turn"], "left")
               .withColumns({"up_conv": F.coalesce("reply_conv", "conv_id"), "up_turn": F.coalesce("reply_turn", "first"),
                             "depth": F.col("reply_conv").isNotNull().cast("long")}).drop("first"))
    while True:
        up = node.select(F.col("conv_id").alias("uc"), F.col("turn").alias("ut"), F.col("up_conv").alias("up2_conv"),
                         F.col("up_turn").alias("up2_turn"), F.col("depth").alias("more"))
        moved = node.join(up, (F.col("up_conv") == F.col("uc")) & (F.col("up_turn") == F.col("ut")))
        changed = (F.col("up2_conv") != F.col("up_conv")) | (F.col("up2_turn") != F.col("up_turn"))
        nxt = cut(moved.select("conv_id", "turn", "reply_conv", "reply_turn", F.col("up2_conv").alias("up_conv"),
                               F.col("up2_turn").alias("up_turn"),
                               F.when(changed, F.col("depth") + F.col("more")).otherwise(F.col("depth")).alias("depth"),
                               changed.alias("moved")))
        node = nxt.drop("moved")
        if nxt.where("moved").isEmpty():
            return node.withColumnsRenamed({"up_conv": "thread_conv", "up_turn": "thread_turn"})


RESULTS = ("passages", "clean", "levels", "n_quotes", "n_linked", "reply_conv", "reply_turn", "thread_conv", "thread_turn", "depth", "formatted")


def build(conversations: DataFrame) -> DataFrame:
    """``conversations`` without ``text``, sorted by thread, with levels, n_quotes, n_linked, reply and thread keys,
    depth, the clean text and its chat format.  Input columns with a name of ``RESULTS`` (in any case) are replaced."""
    conversations = conversations.drop(*(c for c in conversations.columns if c.lower() in RESULTS))
    names = [c for c in conversations.columns if c != "text"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in conversations.schema if f.name != "text")
    parsed = cut(conversations.mapInArrow(
        _parse(names), f"{kinds}, passages array<struct<level:int,key:long,words:long>>, clean string, levels int"))
    links = cut(link(parsed))
    tree = threads(parsed, links)
    count = links.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n_linked"))
    quoted = F.size(F.filter("passages", lambda x: x["level"] > 0)).cast("long")
    out = (parsed.withColumn("n_quotes", quoted).drop("passages")
           .join(tree, ["conv_id", "turn"], "left").join(count, ["conv_id", "turn"], "left")
           .withColumns({"n_linked": F.coalesce("n_linked", F.lit(0).cast("long")),
                         "thread_conv": F.coalesce("thread_conv", "conv_id"), "thread_turn": F.coalesce("thread_turn", "turn"),
                         "depth": F.coalesce("depth", F.lit(0).cast("long")),
                         "formatted": F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "clean", F.lit("\n"))}))
    order = ["thread_conv", "thread_turn", "conv_id", "turn"]
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(n, *order).sortWithinPartitions(*order)


def op8_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All of ``conversations`` in reply order without quotes."""
    got = build(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return got.select("conv_id", "turn", "role", "thread_conv", "thread_turn", "reply_conv", "reply_turn", "depth", "levels",
                      "n_quotes", "n_linked", F.sha2("formatted", 256).alias("formatted_sha256"))
