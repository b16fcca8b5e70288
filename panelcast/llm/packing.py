"""Packing of documents into fixed windows by minimum bin slack.

A document is its token ids closed by the end token.  Its whole windows of ``capacity`` ids are sequences of
their own; what remains, 1 to ``capacity`` - 1 ids, joins the pool of its task.  A window is then filled from
the pool: the longest remainder is its seed, and a subset-sum dynamic programme over the multiset of the other
lengths (one big integer as the bitset of reachable sums, a length's copies added in powers of two) finds
the multiset that comes closest to the capacity, with counts read back along the stored bitsets.  A multiset that
fills its window is used as often as the counts allow.  A seed that cannot be filled to the last id waits while any other
multiset can, and where none can, remainders wait for more documents; only when a full pool stays over half its
size, or the task ends, is one remainder cut to close a gap, so every window is full.  The last ids of a task, less than one window, become sequences of a power of two each,
which are not padded.  So nothing is padded at all, and a task leaves at most log2(capacity) short sequences.

Documents never meet across tasks: there is no shuffle, and a task holds one batch of texts, ``pool_rows``
remainders of at most ``capacity`` ids, and the vocabulary.  A sequence's id is its task's number and a running
number; a lost task is repeated on the same rows and gives the same sequences.

Ids are those of the tokenizers library without its cost: ``FastIds`` merges by rank and is exact where it is
used (see there); all other texts go to the library itself.

Defined cases: null and empty texts are the end token alone; a null doc_id and repeated rows are packed like any
other row; a text of any length is packed whole; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import functools
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.bpe import _byte_letters, default_vocabulary
from panelcast.llm.common import chunks, table, tenant


@dataclass(frozen=True)
class PackParams:
    capacity: int = 1024        # a power of two
    end_token: int = 0
    pool_rows: int = 4_096      # remainders that a task holds: 16 MB at most


LOOK = r"\s+(?!\S)|\s+"  # how the usual pattern ends


@dataclass(frozen=True)
class Known:
    """What the libraries were asked for a vocabulary: the driver asks once and sends it along, so that no task has to."""

    lost: tuple[str, ...]   # tokens that their own bytes do not give
    white: str              # white space
    odd: str                # characters that the two libraries treat differently


def _every() -> str:
    """All characters but letters in every version of Unicode that a library could follow: ideographs, syllables (and surrogates after them)."""
    known = [(0x3400, 0x4DB6), (0x4E00, 0x9FA6), (0xAC00, 0xE000), (0x20000, 0x2A6D7)]
    return "".join(map(chr, chain.from_iterable(map(range, [0, *(b for _, b in known)], [*(a for a, _ in known), 0x110000]))))


class FastIds:
    """``ids(texts)`` as the tokenizers library gives them with ``add_special_tokens=False``.

    Merging the neighbours whose joined bytes have the lowest rank equals merging by the file's list of pairs if
    every token is what its own bytes encode to, ranks are the order of the list, and no two pairs make the same
    token: two neighbours that make a token's bytes have then been merged in the order in which those bytes
    alone would be, so they are that token's pair.  Tokens that their own bytes do not give are
    never made by the library and are left out.  Where the ranks are not of that form, the library encodes.

    The two libraries may follow different Unicode versions.  Every letter, number and space is shown to both
    once; texts with a character that they treat differently, or with a special token, go to the library.

    The usual pattern looks ahead only to leave the last white space of a run of two or more to what follows it. A
    text is cut at those places beforehand (few texts have any), so that a pattern without that look splits the rest alike.
    """

    def __init__(self, path: str, known: Known | None = None):
        import regex
        import tiktoken

        import public_tokenizers

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = _byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        order = [vocab[m] for m in merged]
        self.fast = order == sorted(set(order)) and self._plain(spec) and public_tokenizers.PATTERN.endswith(LOOK)
        self.always = set(special)
        if not self.fast:
            return
        lost = known.lost if known else [w for w, i in vocab.items() if w not in special and [t.id for t in self.library.model.tokenize(w)] != [i]]
        ranks = {bytes(letter[c] for c in w): vocab[w] for w in vocab.keys() - special - set(lost)}
        pattern = public_tokenizers.PATTERN.removesuffix(LOOK) + r"\s+"
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        every = "" if known else _every()
        white = known.white if known else "".join(regex.findall(r"\p{White_Space}", every))
        some, other = ("".join(re.escape(c) for c in white if c != x) for x in ("", " "))
        self._pair = re.compile(f"[{other}](?:(?=[{some}])|(?<=[{some}][{other}]))").search  # beside two blanks
        self._runs = re.compile(f"([{some}]+)(?=[{some}][^{some}])").split
        self.known = known or Known(tuple(lost), white, self._odd(every))
        self.always |= set(self.known.odd)

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    def _odd(self, every: str) -> str:
        """The characters that the two libraries treat differently."""
        import regex

        out, asked = [], regex.findall(r"[\p{L}\p{N}\s]", every)
        for k in range(0, len(asked), 4_096):
            probes = [f"a{c}a 1{c}1 !{c}! {c}" for c in asked[k:k + 4_096]]
            there = self.library.encode_batch(probes, add_special_tokens=False)
            out += [c for c, t, e in zip(asked[k:], probes, there) if e.ids != self._split(t)]
        return "".join(out)

    @staticmethod
    def _plain(spec: dict) -> bool:
        """Byte-level pieces by the usual pattern and nothing else around the merges."""
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        return pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) \
            and not spec.get("normalizer") and not model.get("dropout") and not model.get("ignore_merges") \
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")

    @functools.cached_property
    def _needs_library(self):
        return re.compile("|".join(map(re.escape, sorted(self.always)))).search if self.always else lambda t: None

    def ids(self, text: str) -> list[int]:
        if not self.fast or self._needs_library(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self._split(text)

    def _split(self, text: str) -> list[int]:
        if "  " not in text and not self._pair(text):
            return self.encoding.encode_ordinary(text)
        return list(chain.from_iterable(map(self.encoding.encode_ordinary, self._runs(text))))

    def closed(self, text: str, end: int, dtype) -> np.ndarray:
        """The ids of ``text`` and the end token."""
        ids = self.ids(text)
        ids.append(end)
        return np.fromiter(ids, dtype, len(ids))


@functools.lru_cache(maxsize=2)
def load(path: str, known: Known | None = None) -> FastIds:
    """One vocabulary per Python worker."""
    return FastIds(path, known)


@functools.lru_cache(maxsize=2)
def known(path: str) -> Known | None:
    """For the driver, which keeps no vocabulary; None where the library encodes."""
    found = FastIds(path)
    return found.known if found.fast else None


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths (length -> count, at most ``counts``) whose sum is the largest that is not over ``room``.

    Longer lengths come first, so that short ones are left for later windows where the sum allows it.
    """
    goal, reach, mask = 1 << room, 1, (2 << room) - 1
    steps: list[tuple[int, int, int]] = []   # (reachable before, length, copies taken or left together)
    for length in sorted((x for x in counts if 0 < x <= room and counts[x]), reverse=True):
        left, some = min(counts[length], room // length), 1
        while left and not reach & goal:
            take = min(some, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            some *= 2
        if reach & goal:
            break
    at, out = reach.bit_length() - 1, defaultdict(int)
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            out[length] += take
            at -= length * take
    return dict(out)


class Packer:
    """Remainders in, full windows out.  A piece is ``(document, start, ids)``; documents are any objects."""

    def __init__(self, p: PackParams):
        if p.capacity < 1 or p.capacity & (p.capacity - 1):
            raise ValueError("the capacity must be a power of two")
        self.p = p
        self.stock: dict[int, list[tuple]] = defaultdict(list)
        self.counts: dict[int, int] = {}
        self.rows = self.total = 0

    def put(self, piece: tuple) -> None:
        n = len(piece[2])
        self.stock[n].append(piece)
        self.counts[n] = self.counts.get(n, 0) + 1
        self.rows += 1
        self.total += n

    def _take(self, n: int) -> tuple:
        self.rows -= 1
        self.total -= n
        self.counts[n] -= 1
        if not self.counts[n]:
            del self.counts[n]
        return self.stock[n].pop()

    def _fill(self, seed: int, room: int, cut: bool) -> Iterator[list[tuple]]:
        """Windows of ``seed`` + ``room`` ids; none if the best multiset leaves a gap and cutting is not allowed."""
        rest = dict(self.counts)
        if seed:
            rest[seed] -= 1
        picked = closest_fill(rest, room)
        gap = room - sum(n * c for n, c in picked.items())
        if gap and not cut:
            return
        want = dict(picked)
        if seed:
            want[seed] = want.get(seed, 0) + 1
        for _ in range(1 if gap else min(self.counts[n] // c for n, c in want.items())):
            window = [self._take(n) for n, c in sorted(want.items(), reverse=True) for _ in range(c)]
            if gap:  # every length left is over the gap, or the sum would not be the largest
                doc, start, ids = self._take(max(self.counts))
                window.append((doc, start, ids[:gap]))
                self.put((doc, start + gap, ids[gap:]))
            yield window

    def windows(self, cut_above: int) -> Iterator[list[tuple]]:
        """Full windows without a cut as long as there are any; one with a cut while over ``cut_above`` rows are left."""
        while self.total >= self.p.capacity:
            done, seed = False, max(self.counts)
            for seed, cut in ((seed, False), (0, False), (seed, True)):
                if cut and self.rows <= cut_above:
                    return
                for w in self._fill(seed, self.p.capacity - seed, cut):
                    done = True
                    yield w
                if done:
                    break

    def tail(self) -> Iterator[list[tuple]]:
        """What is left as sequences of a power of two each."""
        size = self.p.capacity
        while size:
            if self.total >= size:
                yield next(self._fill(0, size, True))
            else:
                size >>= 1


def _sequences(docs: Iterable[tuple], p: PackParams) -> Iterator[list[tuple]]:
    """The windows of ``(document, ids)``, ids with the end token."""
    pool = Packer(p)
    for doc, ids in docs:
        whole = len(ids) - len(ids) % p.capacity
        for at in range(0, whole, p.capacity):
            yield [(doc, at, ids[at:at + p.capacity])]
        if whole < len(ids):
            pool.put((doc, whole, ids[whole:].copy()))
        if pool.rows >= p.pool_rows:
            yield from pool.windows(p.pool_rows // 2)
    yield from pool.windows(0)
    yield from pool.tail()


PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", p: PackParams = PackParams()) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ids as unsigned 32-bit little-endian numbers."""
    path = path or default_vocabulary()
    asked = known(path)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tenant("packing", load.cache_clear)
        closed = load(path, asked).closed
        first = TaskContext.get().partitionId() << 40

        def encoded():
            for b in batches:
                for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                    ids = closed(t.as_py() or "", p.end_token, "<u4")
                    yield (i, len(ids)), ids

        def rows():
            for k, window in enumerate(_sequences(encoded(), p)):
                offset = 0
                for (i, n), start, ids in window:
                    yield i, start, len(ids), n, first + k, offset, ids.tobytes()
                    offset += len(ids)

        yield from chunks(rows(), schema, size=4_000, weight=lambda r: len(r[6]), most=4 << 20)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PACKED)


def op11_packing(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` in sequences of at most 1024 ids, one row per piece."""
    done = pack(table(spark, sf_dir, "documents", "doc_id", "text"))
    return done.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
