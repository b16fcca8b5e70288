import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from panelcast.llm import trie as T
from tests.llm.brute import sha

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _key(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def ordered(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            out[c].append((turn is not None, turn or 0, _key(role, text), (role, text)))
    return {c: [x[-1] for x in sorted(v, key=lambda x: x[:3])] for c, v in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    """The nodes of the trie over conversations given as lists of (role, text)."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    saved = {n: (len(m) - 1) * (len(n[-1][1]) if n else 0) for n, m in members.items()}
    leaves = {}
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in kids[n]) or 1
        saved[n] += sum(saved[k] for k in kids[n])
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
                   sha(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(n)))) for n, m in members.items())


def _rows():
    rng = random.Random(8)
    said = [(r, t) for r in ("user", "assistant", None, "") for t in ("hi", "é漢😀", "", None, "a longer answer", "user")]
    rows = []
    for c in [*range(0, 40), 100, 101, 150, 199, 205, 250, -3, -100, -150, 10**12]:
        for k in range(rng.randint(1, 9)):
            rows.append((c, k, *rng.choice(said[:3] if k < 3 else said)))
    rows += [(300 + k, t, "user", f"same {t}") for k in range(30) for t in range(6)]           # exact copies
    rows += [(400, None, "user", "late"), (400, None, "user", "early"), (400, 3, "user", "x"), (400, 3, "user", "x"), (400, 3, "assistant", "x")]
    rows += [(None, 0, "user", "nobody"), (500, 7, None, None), (501, 7, "user", "one")]
    rows += [(600 + k, t, "user", f"long {t}" if t < 30 + k else f"own {k} {t}") for k in range(4) for t in range(70)]
    rows += [(700, 1, "user", "again")] * 50
    return rows


def _got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()))


@pytest.mark.parametrize("p", [T.TrieParams(), T.TrieParams(block=2, span=2, text_bytes=40), T.TrieParams(block=3, span=5)])
def test_equals_brute_force(spark, frame, p):
    rows = _rows()
    df = frame([(*r, 1, "x") for r in rows], "conv_id long, turn int, role string, text string, pos int, depth string", 5)
    made, convs = T.rebuild(T.turns(df), p)
    want = rebuilt(ordered(rows))
    assert _got(T.trie(made, convs, p)) == brute(want)
    assert any(not t for t in want.values())


def test_conversations_as_they_are_and_their_texts(spark, frame):
    rows = _rows()
    df = frame(rows, "conv_id long, turn int, role string, text string", 4)
    own = T.turns(df)
    nodes = T.trie(own, own.select("c").distinct())
    assert _got(nodes) == brute(ordered(rows))
    told = T.with_texts(nodes, df).where("depth > 0").groupBy("last_role", "last_text").count().collect()
    want = defaultdict(int)
    for n in {tuple(t[:d + 1]) for t in ordered(rows).values() for d in range(len(t))}:
        want[n[-1]] += 1
    assert {(r[0], r[1]): r[2] for r in told} == want


def test_a_conversation_over_many_tasks(spark, frame):
    rows = [(1, t, "user", f"turn {t}") for t in range(900)] + [(2, t, "user", f"turn {t}") for t in range(5)] + [(0, 0, "user", "a")]
    df = frame(rows, "conv_id long, turn int, role string, text string", 6)
    own = T.turns(df)
    assert sorted((r["c"], r["pos"]) for r in own.collect()) == sorted((c, t) for c, t, _, _ in rows)
    assert _got(T.trie(own, own.select("c").distinct(), T.TrieParams(span=4))) == brute(ordered(rows))


def test_empty_table(spark, frame):
    df = frame([], "conv_id long, turn int, role string, text string")
    made, convs = T.rebuild(T.turns(df))
    assert _got(T.trie(made, convs)) == []
    one = frame([(5, None, None, None)], df.schema)
    made, convs = T.rebuild(T.turns(one))
    assert _got(T.trie(made, convs)) == brute(rebuilt({5: [("", "")]}))
