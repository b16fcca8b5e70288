import hashlib
import random

from panelcast.llm import quotes as C
from tests.llm.conftest import SF


def _rows():
    return [
        (1, 0, "user", "Hello there\nHow are you?"),
        (1, 1, "assistant", "> how  are YOU?\nFine."),
        (1, 2, "user", ">> How are you?\n> Fine.\nGood."),
        (2, 0, "user", "A new topic"),
        (2, 1, "assistant", "> Fine.\nFrom elsewhere"),
        (2, 2, "user", "> nobody said this\nHm."),
        (2, 5, "user", "> From elsewhere\n> A new topic\n\nBoth."),
        (3, 0, None, None),
        (3, 1, "user", "Fine."),
        (3, 1, "user", "Fine."),
        (0, 3, "user", "> Hello there\n> How are you?\nearlier conversation cannot quote a later one"),
        (None, 0, "user", "> Fine.\nlost"),
    ]


def _brute(rows):
    """One message at a time: originals by scanning all others, threads by following replies."""
    keys = {}
    for c, t, _, x in rows:
        if c is not None:
            for level, lines in C.quote_levels((x or "").encode()):
                keys.setdefault((c, t), {}).setdefault(level, {}).update(C.passage_keys(lines))
    first = {}
    for c, t in keys:
        first[c] = min(first.get(c, t), t)
    reply = {}
    for m, levels in keys.items():
        votes = {}
        for k, n in levels.get(1, {}).items():
            holders = [o for o in keys if k in keys[o].get(0, {}) and o < m]
            same = [o for o in holders if o[0] == m[0]]
            every = [o for o in keys if k in keys[o].get(0, {})]
            to = min(same) if same else min(every) if every and min(every) < m else None
            if to:
                votes[to] = votes.get(to, 0) + n
        if votes:
            reply[m] = min(votes, key=lambda o: (-votes[o], o))
    out = {}
    for m in keys:
        top, depth = m, 0
        while top in reply:
            top, depth = reply[top], depth + 1
        out[m] = (reply.get(m), (top[0], first[top[0]]), depth)
    # a reply's conversation start may itself be a reply: follow on
    for m in keys:
        top, depth = m, 0
        while True:
            if top in reply:
                top, depth = reply[top], depth + 1
            elif (top[0], first[top[0]]) != top:
                top = (top[0], first[top[0]])
            else:
                break
        out[m] = (reply.get(m), top, depth)
    return out


def _check(spark, frame, rows):
    got = C.build(frame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(rows)
    want = _brute(rows)
    for r in got:
        m = (r["conv_id"], r["turn"])
        if m[0] is None:
            assert r["reply_conv"] is None and r["thread_conv"] is None and r["n_linked"] == 0
            continue
        reply, thread, depth = want[m]
        assert (r["reply_conv"], r["reply_turn"]) == (reply or (None, None)), m
        assert ((r["thread_conv"], r["thread_turn"]), r["depth"]) == (thread, depth), m
    return got


def test_links_threads_and_clean_texts(spark, frame):
    got = _check(spark, frame, _rows())
    text = {(r["conv_id"], r["turn"]): r["formatted"] for r in got}
    assert text[1, 2] == "<|user|>\nGood.\n" and text[3, 0] == "<|user|>\n\n" and text[2, 5] == "<|user|>\nBoth.\n"
    at = {(r["conv_id"], r["turn"]): k for k, r in enumerate(got)}
    assert all(at[r["reply_conv"], r["reply_turn"]] < at[r["conv_id"], r["turn"]] for r in got if r["reply_conv"] is not None)


def test_random_quoting_equals_brute_force(spark, frame):
    rng = random.Random(8)
    rows, said = [], []
    for c in range(8):
        for t in range(rng.randint(1, 9)):
            own = " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(rng.randint(1, 3)))
            lines = [f"{'>' * rng.randint(1, 3)} {rng.choice(said)}" for _ in range(rng.randint(0, 2)) if said]
            rows.append((c, t, "user", "\n".join([*lines, own])))
            said.append(own)
    _check(spark, frame, rows)


def test_parsing_of_levels():
    runs = C.quote_levels(b"a\n> b\n>c\n>> d\n > > e\nf > g")
    assert [(n, [x.decode() for x in v]) for n, v in runs] == [(0, ["a"]), (1, ["b", "c"]), (2, ["d", "e"]), (0, ["f > g"])]


def test_extra_columns_long_texts_and_empty_tables(spark, frame):
    df = frame([(1, 0, "user", "> q\n" * 20_000 + "x", 7)], "conv_id long, turn long, role string, text string, keys int")
    assert [r["keys"] for r in C.build(df).collect()] == [7]
    assert C.build(frame([], df.schema)).collect() == []


def test_query_returns_every_message_without_its_quotes(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    got = C.op8_chat_formatting(spark, SF).collect()
    assert len(got) == len(rows)
    digest = {(r["conv_id"], r["turn"]): r["formatted_sha256"] for r in got}
    for r in rows:
        clean = C.clean_text(C.quote_levels((r["text"] or "").encode()))
        assert digest[r["conv_id"], r["turn"]] == hashlib.sha256(f"<|{r['role']}|>\n{clean}\n".encode()).hexdigest()


def test_columns_named_like_results_are_replaced(spark, frame):
    rows = [(1, 0, "user", "hello there everyone here", 1, 2, 3), (1, 1, "user", "> hello there everyone here\nyes", 4, 5, 6)]
    plain = frame([r[:4] for r in rows], "conv_id long, turn int, role string, text string")
    clash = frame(rows, "conv_id long, turn int, role string, text string, Clean int, depth int, n_linked int")
    got = C.build(clash)
    assert sorted(got.columns) == sorted(C.build(plain).columns)
    assert sorted(map(str, got.select(*sorted(got.columns)).collect())) == sorted(map(str, C.build(plain).select(*sorted(got.columns)).collect()))
