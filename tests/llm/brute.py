"""Plain-Python versions of the operators' results, one document or pair at a time."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def lower(s: str) -> str:
    return s.translate(_LOWER)


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def quality(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    at: dict = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    out = {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
           "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}
    out["base_failed"] = n < 20 or 100 * len(covered) > 30 * n
    out["kept"] = not (out["base_failed"] or 100 * out["n_symbols"] > 10 * n or not 3 * n <= out["word_chars"] <= 12 * n
                       or 100 * out["n_dup_lines"] > 50 * len(lines))
    return out


def line_dedup(rows: list[tuple], min_chars: int = 10) -> list[tuple]:
    key = lambda x: lower(x.strip(" \t\n\v\f\r"))
    owner: dict[str, set] = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= min_chars:
                owner.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < min_chars or min(owner[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text: str | None, k: int) -> frozenset:
    w = WORD.findall(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def near_components(rows: list[tuple], k: int, pct: int = 80) -> dict:
    sets = {i: shingles(t, k) for i, t in rows if i is not None}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y:
                c = len(x & y)
                if 100 * c >= pct * (len(x) + len(y) - c):
                    lo, hi = sorted((find(a), find(b)))
                    up[hi] = lo
    return {i: find(i) for i in ids}


def contamination(text: str | None, items: list[tuple], window: int = 13) -> tuple[int, int, list[str]]:
    words = ALNUM.findall(lower(text or ""))
    hit, found = set(), set()
    for item, t in items:
        w = ALNUM.findall(lower(t or ""))
        size = min(window, len(w))
        for j in range(len(w) - size + 1 if size else 0):
            for i in range(len(words) - size + 1):
                if words[i:i + size] == w[j:j + size]:
                    hit.update(range(i, i + size))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)
