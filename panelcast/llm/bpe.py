"""Byte-pair encoding and decoding by per-prefix dynamic programming.

A byte-pair encoding is valid if and only if every two neighbouring tokens are compatible, that is if
merging the two alone would not cross their border.  Hence each prefix of a piece of text has exactly
one last token: the one among the tokens that end there whose start is the end of a prefix with a
compatible last token.  For every prefix the tokens that end there come from a suffix automaton of the
vocabulary (read one byte, then all matches are the tokens on the state's suffix-link path), the last
token is stored, and following the stored tokens back from the end gives the ids.  No merge queue runs.

``encode`` and ``decode`` are exact twins of what the vocabulary file's own library gives (special
tokens in the text included).  Documents never meet: there is no shuffle, a task needs the vocabulary,
two bounded caches (pieces, token pairs) and one batch.

Defined cases: null and empty texts have no tokens and decode to the empty text; a null ids array decodes
to the empty text; a null ``doc_id`` and repeated rows are carried along; extra columns pass through;
an empty table gives an empty result; a text without any white space is one long piece, linear in its length.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import table, tenant

NEVER = 1 << 30


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class SuffixAutomaton:
    """The suffix automaton of a set of byte strings, with the tokens that end in each state.

    ``matches[state]`` are ``(length, token)``, longest first: the tokens among the state's own strings
    and those of its suffix links.  A reader that has matched ``m`` bytes skips tokens longer than ``m``.
    """

    def __init__(self, tokens: list[tuple[bytes, int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for word, _ in tokens:
            last = 0
            for c in word:
                last = self._extend(last, c)
        own: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for word, t in tokens:
            s = 0
            for c in word:
                s = self.next[s][c]
            own[s].append((len(word), t))
        self.matches: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.matches[s] = (*sorted(own[s], reverse=True), *self.matches[self.link[s]])

    def _new(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state of the strings that end where ``p`` + ``c`` does, made from ``q`` if that has longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c, self.next[last][c])
        cur = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            self.link[cur] = self._split(p, c, self.next[p][c])
        return cur


class Bpe:
    """A byte-level vocabulary: ``ids(texts)`` and ``text(ids)``."""

    piece_bytes = 128 << 20  # of pieces whose ids are kept, by ``_cost``
    piece_chars = 64        # a longer piece is not kept
    pair_limit = 400_000    # token pairs whose compatibility is kept (about 40 MB)

    def __init__(self, path: str, patterns: tuple[str, str] | None = None):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = _byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        raw = {w: bytes(letter[c] for c in w) for w in vocab}
        self.bytes_of: dict[int, bytes] = {i: raw[w] for w, i in vocab.items()}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            t = vocab[a + b]
            self.merge[vocab[a], vocab[b]] = r
            if t not in self.parts:
                self.rank[t], self.parts[t] = r, (vocab[a], vocab[b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: c.encode() for c, i in self.special.items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        reachable = [(b, i) for i, b in self.bytes_of.items() if i in self.parts or (len(b) == 1 and i not in self.special.values())]
        self.automaton = SuffixAutomaton(reachable)
        self.compatible: dict[int, bool] = {}  # both ids in one number
        self.pieces: dict[str | int, tuple[int, ...]] = {}
        self.held = 0
        self.find_low, self.find_full = (re.compile(x).findall for x in patterns or piece_patterns(path))

    def _spine(self, t: int, side: int) -> list[tuple[int, int, int]]:
        """(token, made at, merged away at) along one edge of a token's merge tree, the token first."""
        out, until = [], NEVER
        while True:
            made = self.rank.get(t, -1)
            out.append((t, made, until))
            if t not in self.parts:
                return out
            t, until = self.parts[t][side], made

    def can_follow(self, a: int, b: int) -> bool:
        """No merge crosses the border of ``a`` and ``b``.

        A crossing merge of rank m joins an edge node x of ``a`` and y of ``b`` while both stand.  Equal
        ranks merge from the left: x's own merge comes before the crossing one, y's comes after it.
        """
        left = self._spine(b, 0)
        for x, made_x, until_x in self._spine(a, 1):
            for y, made_y, until_y in left:
                m = self.merge.get((x, y))
                if m is not None and made_x <= m < until_x and made_y <= m <= until_y:
                    return False
        return True

    def encode_pieces(self, pieces: list[bytes]) -> Iterator[tuple[int, ...]]:
        """The ids of each piece.  What is stored for a prefix serves the next piece as far as the two agree,
        so sorted pieces cost their new bytes only."""
        sa, pairs = self.automaton, self.compatible
        nxt, link, length, matches = sa.next, sa.link, sa.length, sa.matches
        before = b""
        # per prefix: the automaton's state, the bytes it has matched, and (length, id) of the last token
        path: list[tuple[int, int, tuple[int, int]]] = [(0, 0, (0, 0))]
        for piece in pieces:
            if len(pairs) > self.pair_limit:
                pairs.clear()
            same = 0
            for x, y in zip(before, piece):
                if x != y:
                    break
                same += 1
            del path[same + 1:]
            before = piece
            state, matched, _ = path[same]
            for end in range(same + 1, len(piece) + 1):
                c = piece[end - 1]
                step = nxt[state].get(c)
                while step is None:
                    state = link[state]
                    matched = length[state]
                    step = nxt[state].get(c)
                state = step
                matched += 1
                for found in matches[state]:
                    size, t = found
                    if size > matched:
                        continue
                    if size == end:
                        break
                    key = path[end - size][2][1] << 32 | t
                    ok = pairs.get(key)
                    if ok is None:
                        ok = pairs[key] = self.can_follow(path[end - size][2][1], t)
                    if ok:
                        break
                else:
                    raise ValueError(f"no token ends at byte {end} of {piece!r}")
                path.append((state, matched, found))
            out, end = [], len(piece)
            while end:
                size, t = path[end][2]
                out.append(t)
                end -= size
            out.reverse()
            yield tuple(out)

    def _split(self, text: str) -> list[str | int]:
        """The text's pieces in order; special tokens as their ids."""
        # one code unit a character in UTF-16: nothing beyond the basic plane
        find = self.find_low if text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text) else self.find_full
        if self.special_split is None or not any(s in text for s in self.special):
            return find(text)
        out: list[str | int] = []
        for part in self.special_split.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out.extend(find(part))
        return out

    def ids(self, texts: list[str]) -> list[list[int]]:
        """The ids of every text.  Pieces that are not known yet are encoded together, in sorted order."""
        split = [self._split(t) for t in texts]
        wanted = set().union(*split)
        new = wanted.difference(self.pieces)
        cost = sum(map(_cost, new))
        if self.held + cost > self.piece_bytes:
            self.pieces.clear()
            self.held, new = 0, wanted
            cost = sum(map(_cost, new))
        self.held += cost
        for i in [x for x in new if isinstance(x, int)]:
            self.pieces[i] = (i,)
            new.discard(i)
        raw = sorted((w.encode(), w) for w in new)
        self.pieces.update(zip((w for _, w in raw), self.encode_pieces([r for r, _ in raw])))
        known = self.pieces.__getitem__
        out = [list(chain.from_iterable(map(known, pieces))) for pieces in split]
        for w in [w for w in new if len(w) > self.piece_chars]:
            self.held -= _cost(w)
            del self.pieces[w]
        return out

    def text(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _cost(piece: str | int) -> int:
    """Bytes of a kept piece: its text, its tuple of ids and its place in the dictionary, at most one id a byte."""
    return 200 + 9 * len(piece) if isinstance(piece, str) else 150


def _ranges(chars: list[str]) -> str:
    """The characters as the inside of a regular expression's class."""
    out: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


@functools.lru_cache(maxsize=2)
def piece_patterns(path: str) -> tuple[str, str]:
    """The byte-level pre-tokeniser's rule, with its library's own notion of letters and numbers.

    Libraries follow different Unicode versions, so every letter and number that one of them knows is
    shown once to the pre-tokeniser: it is a letter if it stays with an "a", a number if with a "1".
    The first pattern is for texts of the basic plane only, whose classes are plain bitmaps.  The driver
    finds the patterns and sends them along, so that no task loads those libraries.
    """
    import regex
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def known(kind) -> list[str]:
        every = ("".join(map(chr, range(k, k + 0x800))) for k in range(0, 0x110000, 0x800) if not 0xD800 <= k < 0xE000)
        return [c for part in every for c in kind(part)]

    def probed(kind, friend: str) -> list[str]:
        cand, out = known(kind), []
        for k in range(0, len(cand), 4096):
            part = cand[k:k + 4096]
            whole = {a for _, (a, b) in split("\n".join(friend + c for c in part)) if b - a == 2}
            out += [c for i, c in enumerate(part) if 3 * i in whole]
        return out

    space = known(regex.compile(r"\s").findall)
    letters, numbers = probed(regex.compile(r"\p{L}").findall, "a"), probed(regex.compile(r"\p{N}").findall, "1")

    def pattern(last: str) -> str:
        s, w, n = (_ranges([c for c in x if c <= last]) for x in (space, letters, numbers))
        return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{w}]+| ?[{n}]+| ?[^{s}{w}{n}]+|[{s}]+(?![^{s}])|[{s}]+"

    return pattern("\uffff"), pattern("\U0010ffff")


@functools.lru_cache(maxsize=2)
def load(path: str, patterns: tuple[str, str] | None = None) -> Bpe:
    """One vocabulary per Python worker."""
    return Bpe(path, patterns)


def _release() -> None:
    load.cache_clear()
    token_bytes.cache_clear()


@functools.lru_cache(maxsize=2)
def token_bytes(path: str) -> dict[int, bytes]:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letter = _byte_letters()
    return {i: bytes(letter[c] for c in w) for w, i in spec["model"]["vocab"].items()} \
        | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}


def encode(docs: DataFrame, path: str | None = None, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs``, all columns, with the token ids of ``text`` as an array column ``out``."""
    path = path or default_vocabulary()
    patterns = piece_patterns(path)
    return _mapped(docs, text, {out: _IDS}, lambda: _encoder(path, patterns))


def decode(rows: DataFrame, path: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows``, all columns, with the text of the token ids as a column ``out``."""
    path = path or default_vocabulary()
    return _mapped(rows, ids, {out: _TEXT}, lambda: _decoder(path))


def round_trip(docs: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs``, all columns, with the ids of ``text`` and the text of those ids, in one pass through one worker."""
    path = path or default_vocabulary()
    patterns = piece_patterns(path)

    def both():
        tenant("bpe", _release)
        bpe, known = load(path, patterns), token_bytes(path).__getitem__

        def run(texts: pa.Array) -> list[pa.Array]:
            found = bpe.ids([t or "" for t in texts.to_pylist()])
            return [pa.array(found, _IDS[1]), pa.array([_text_of(x, known) for x in found], pa.string())]

        return run

    return _mapped(docs, text, {ids: _IDS, decoded: _TEXT}, both)


_IDS, _TEXT = ("array<int>", pa.list_(pa.int32())), ("string", pa.string())
GROUP_BYTES = 2 << 20


def _text_of(ids, known) -> str:
    return b"".join(map(known, ids)).decode("utf-8", "replace")


def _encoder(path: str, patterns: tuple[str, str]):
    tenant("bpe", _release)
    bpe = load(path, patterns)
    return lambda texts: [pa.array(bpe.ids([t or "" for t in texts.to_pylist()]), _IDS[1])]


def _decoder(path: str):
    tenant("bpe", _release)
    known = token_bytes(path).__getitem__

    def run(ids: pa.Array) -> list[pa.Array]:
        return [pa.array([_text_of(x or (), known) for x in ids.to_pylist()], pa.string())]

    return run


def _mapped(df: DataFrame, source: str, outs: dict[str, tuple[str, pa.DataType]], make) -> DataFrame:
    """``df`` with more columns computed from ``source``, in groups of about ``GROUP_BYTES`` of it."""
    if clash := {o.lower() for o in outs} & {c.lower() for c in df.columns}:
        raise ValueError(f"the input has columns {sorted(clash)} already; choose other names")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = make()
        for b in batches:
            col = b.column(b.schema.get_field_index(source))
            rows = max(1, len(col) * GROUP_BYTES // max(1, col.nbytes))
            for start in range(0, len(col), rows):
                part = b.slice(start, rows)
                yield pa.RecordBatch.from_arrays([*part.columns, *many(col.slice(start, rows))], names=[*part.schema.names, *outs])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *(f"`{o}` {k}" for o, (k, _) in outs.items())])
    return df.mapInArrow(run, schema)


def op1_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded again, as digests."""
    done = round_trip(table(spark, sf_dir, "documents", "doc_id", "text"))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
