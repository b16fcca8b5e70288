import pytest

from panelcast.llm import language as G
from tests.llm.conftest import SF


def test_held_out_accuracy_of_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars >= 100")
    model = G.train(docs.where("doc_id % 4 <> 0"))
    got = G.identify(docs.where("doc_id % 4 = 0").select("doc_id", "text", "source", docs["lang"].alias("truth")), model,
                     markup=False, url=None, host="source").collect()
    assert len(got) >= 30 and sum(r["lang"] == r["truth"] for r in got) >= 0.97 * len(got)


def _pages(n=12):
    fr = "le la les des un une et que qui dans pour avec sur pas"
    rows = [(i, f"http://fr{i % 3}.site.net/fr/{i}", f'<html lang="fr"><p>{fr} {fr}</p></html>') for i in range(n)]
    rows += [(100 + i, f"http://en{i % 3}.other.net/en/{i}", '<html lang="en"><p>the of and to in that it was for on with</p></html>') for i in range(n)]
    return rows


def _train(frame):
    return G.train(frame([("le la les des un une et que qui dans pour avec sur pas " * 5, "fr"), (None, "fr"), ("x", None),
                          ("the of and to in that it was for on with as his they be at one " * 5, "en")], "text string, lang string"))


def test_markup_address_and_host_decide_where_the_text_does_not(spark, frame):
    rows = _pages() + [(200, "http://fr1.site.net/x", "<html><p></p></html>"), (201, "http://new.net/fr/1", None), (202, None, '<HTML class=a LANG=en-GB>'),
                       (203, "http://fr9.site.net/", "")]
    got = {r["page_id"]: r for r in G.identify(frame(rows, "page_id long, url string, html string"), _train(frame), text="html").collect()}
    assert [got[i]["lang"] for i in (200, 201, 202, 203)] == ["fr", "fr", "en", "fr"]
    assert got[200]["text_lang"] is None and got[202]["declared"] == "en" and got[201]["suffix"] == "fr"
    assert all(got[i]["lang"] == ("fr" if i < 100 else "en") for i in got if i < 200)


def test_strong_text_beats_a_wrong_declaration(spark, frame):
    page = (300, "http://en1.other.net/en/9", '<html lang="en"><p>' + "le la les des un une et que qui dans pour avec sur pas " * 9 + "</p></html>")
    got = {r["page_id"]: r["lang"] for r in G.identify(frame([*_pages(), page], "page_id long, url string, html string"), _train(frame), text="html").collect()}
    assert got[300] == "fr"


def test_fused_posterior_equals_a_plain_computation(spark, frame):
    import math

    import numpy as np

    rows, model, p = _pages(5) + [(7, "http://fr1.site.net/en/1", "<p>la to un of</p>")], _train(frame), G.LanguageParams()
    got = {r["page_id"]: r for r in G.identify(frame(rows, "page_id long, url string, html string"), model, text="html").collect()}
    seen = []
    for i, u, h in rows:
        t = G.trigram_buckets(G._MARKUP.sub(b" ", h.encode()), p.bucket_bits)
        like = p.text_weight * model.log_p[:, t].sum(axis=1)
        host = u.split("/")[2]
        lang = "fr" if 'lang="fr"' in h else "en" if 'lang="en"' in h else None
        seen.append((i, host, ".".join(host.split(".")[-2:]), lang, u.split("/")[3], like, int(like.argmax())))
    count = lambda f: np.array([sum(f(s) and s[6] == k for s in seen) for k in range(2)], float)
    share = (count(lambda s: True) + 1) / (len(seen) + 2)
    for i, host, domain, lang, suffix, like, vote in seen:
        own = np.eye(2)[vote]
        d = count(lambda s: s[2] == domain) - own
        prior = (d + p.host_weight * share) / (d.sum() + p.host_weight)
        h = count(lambda s: s[1] == host) - own
        prior = (h + p.host_weight * prior) / (h.sum() + p.host_weight)
        post = like + np.log(prior)
        for at, value in ((3, lang), (4, suffix)):
            if value:
                total, kinds = count(lambda s: s[at] is not None), len({s[at] for s in seen if s[at]})
                post = post + np.log((count(lambda s: s[at] == value) + 1) / (total + kinds + 1))
        best = int(post.argmax())
        assert got[i]["lang"] == model.languages[best]
        assert math.isclose(got[i]["probability"], 1 / np.exp(post - post.max()).sum(), abs_tol=1e-4)


def test_nulls_repeats_clashes_and_empty_tables(spark, frame):
    model = _train(frame)
    rows = [(None, None, None), (1, "http://a.net/fr/", "le la les"), (1, "http://a.net/fr/", "le la les")]
    df = frame(rows, "page_id long, url string, html string")
    assert len(G.identify(df, model, text="html").collect()) == 3
    with pytest.raises(ValueError, match="rename"):
        G.identify(df.withColumnRenamed("page_id", "Vote"), model, text="html")
    empty = frame([], df.schema)
    assert G.identify(empty, model, text="html").collect() == []
    none = G.train(frame([], "text string, lang string"))
    assert G.identify(empty, none, text="html").collect() == []
    with pytest.raises(ValueError, match="labelled"):
        G.identify(df, none, text="html")


def test_query_covers_both_tables(spark):
    got = G.op7_language_id(spark, SF).collect()
    assert len(got) == 250 and all(r["lang"] in ("de", "en", "es", "fr") for r in got)
