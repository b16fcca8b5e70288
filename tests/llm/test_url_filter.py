from itertools import combinations

from panelcast.llm import url_filter as U

URLS = [None, "", "no scheme", "http://Example.ORG", "http://example.org/es/1?x", "https://a.example.org/en/12#t", "http://x.org/q",
        "http://notexample.org/es/1", "ftp://u@b.COM/fr/", "http://b.com/de/7", "http://b.com/de", "http://com/fr/?a=1&b", "a\nb://c.net/p q/9",
        "http://n.net?x://y/z", "http://spam.net/buy/1?ref=1", "http://spam.net/buy/2?ref=2", "http://ok.net/buy/3", "http://spam.net/read/4"]


def _host_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


def _listed(host, path):
    fits = [(h + p, v) for v, h, p in U.LIST if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0])) if fits else (None, None)


def test_hosts_paths_and_list_rules(spark, frame):
    df = frame(list(enumerate(URLS)), "page_id long, url string")
    got = {r["page_id"]: r for r in U.judge(df, frame([], "page_id long, bad boolean")).collect()}
    for i, u in enumerate(URLS):
        host, path = _host_path(u)
        rule, verdict = _listed(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict or "allow"), u


def test_mined_rules_equal_brute_force(spark, frame):
    """All subsets of all labelled URLs' tokens, counted one by one."""
    urls = [f"http://{h}.net/{p}/{i}?ref={i}" for i in range(10) for h in ("spam", "ok") for p in ("buy", "read")]
    bad = ["spam" in u and ("buy" in u or i % 3 == 0) or i % 11 == 0 for i, u in enumerate(urls)]
    pages = frame(list(enumerate(urls)), "page_id long, url string")
    labels = frame([*enumerate(bad), (0, None), (999, True)], "page_id long, bad boolean")
    p = U.RuleParams(min_support=0.05, min_pages=2, min_confidence=0.6)
    tokens = {r["page_id"]: frozenset(r["t"]) for r in pages.select("page_id", U.url_tokens(pages["url"]).alias("t")).collect()}
    seen, hits = {}, {}
    for i, t in tokens.items():
        for n in range(1, len(t) + 1):
            for s in combinations(sorted(t), n):
                seen[s] = seen.get(s, 0) + 1
                hits[s] = hits.get(s, 0) + bool(bad[i])
    want = {s for s, n in seen.items() if hits[s] >= 2 and hits[s] / n >= 0.6}
    got = {tuple(sorted(r["tokens"])) for r in U.mine(pages, labels, p).collect()}
    assert want and got == want
    verdict = {r["page_id"]: r["verdict"] for r in U.judge(pages, labels, p, rules=(("allow", "nowhere", "/"),)).collect()}
    assert {i for i, v in verdict.items() if v == "block"} == {i for i, t in tokens.items() if any(t.issuperset(s) for s in want)}


def test_nulls_repeats_clashes_and_empty_tables(spark, frame):
    df = frame([(None, URLS[4], "x"), (1, URLS[4], "y"), (1, URLS[4], "y")], "page_id long, url string, hit_url string")
    labels = frame([(None, True), (1, None)], "page_id long, bad boolean")
    got = U.judge(df, labels)
    assert got.columns == [*df.columns, "host", "path", "rule", "verdict"]
    assert [r["verdict"] for r in got.collect()] == ["block"] * 3
    assert U.judge(frame([], df.schema), labels).collect() == []


def test_main_path_has_no_python(spark, frame):
    pages = frame(list(enumerate(URLS)), "page_id long, url string")
    labels = frame([(i, i % 2 == 0) for i in range(len(URLS))], "page_id long, bad boolean")
    plan = U.judge(pages, labels)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("PythonUDF", "Pandas", "MapInArrow"))


def test_columns_named_like_results_are_replaced(spark, frame):
    rows = [(i, u, f"mine {i}", "x", True) for i, u in enumerate(URLS)]
    labels = frame([(0, True)], "page_id long, bad boolean")
    got = U.judge(frame(rows, "page_id long, url string, Host string, rule string, kept boolean"), labels)
    want = U.judge(frame([(r[0], r[1], r[4]) for r in rows], "page_id long, url string, kept boolean"), labels)
    assert sorted(got.columns) == sorted(want.columns) == ["host", "kept", "page_id", "path", "rule", "url", "verdict"]
    assert sorted(map(str, got.select(*sorted(got.columns)).collect())) == sorted(map(str, want.select(*sorted(want.columns)).collect()))
