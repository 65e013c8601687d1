import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import quality as Q
from larkspur.llm import url_filter as U

from .helpers import awkward, empty, words


def stats(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return dict(zip(Q.STATISTICS, Q.statistics(data, np.array([0, len(data)]))[0], strict=True))


def test_statistics_of_one_text():
    s = stats("Ab ab\nx1 $$\nAb ab")
    assert (s["n_bytes"], s["n_words"], s["n_lines"]) == (17, 6, 3)
    assert s["upper"] == 2 / 17 and s["symbols"] == 2 / 17 and s["digits"] == 1 / 17
    assert s["distinct_words"] == 3 / 6 and s["same_as_last"] == 2 / 6 and s["distinct_lines"] == 2 / 3 and s["symbol_ends"] == 1 / 6
    assert s["word_length"] == 2.0 and s["short_words"] == 1.0
    assert set(stats("").values()) == {0.0}


def test_statistics_do_not_depend_on_neighbours():
    texts = ["Ab ab$", "", "x y z\n", "$", "é é", "no end", "  lead"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    both = Q.statistics(data, offsets)
    for row, t in zip(both, texts, strict=True):
        assert dict(zip(Q.STATISTICS, row, strict=True)) == stats(t)


def test_held_out_accuracy_and_column_equals_the_model(spark):
    draw, rows, labels = random.Random(0), [], []
    for i in range(600):
        w = words(i, draw.randint(5, 60))
        bad = i % 4 == 0
        rows.append((i, " ".join(x + "###" if bad and i % 8 else x for x in (w if i % 8 else [w[0]] * len(w)))))
        labels.append((i, 0 if bad else 1))
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    measured = Q.measured(df, ["doc_id"]).cache()
    model = Q.train(measured.where("doc_id % 5 <> 0"), lab)
    assert 1 <= len(model.rules) < 200
    got = Q.score(measured, model).collect()
    right = [(r["score"] >= 0.3) == (r["doc_id"] % 4 != 0) for r in got if r["doc_id"] % 5 == 0]
    assert np.mean(right) > 0.97
    x = np.array([[r[s] for s in Q.STATISTICS] for r in got])
    want = 1 / (1 + np.exp(-(model.intercept + sum(w * Q.applies(rule, x) for rule, w in model.rules))))
    assert np.abs(want - [r["score"] for r in got]).max() < 1e-9


def test_quality_awkward(spark):
    m = Q.measured(awkward(spark), ["doc_id"])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in Q.score(m, Q.train(m, none)).collect()} == {0.5}
    only = spark.createDataFrame([(4, 1), (4, 1), (None, 0), (3, None)], "doc_id long, quality int")
    assert all(0.9 < r["score"] < 1 for r in Q.score(m, Q.train(m, only)).collect())
    assert Q.measured(empty(spark), ["doc_id"]).count() == 0


@pytest.mark.parametrize("url,host,path", [("http://A.Example.org/en/1?x#y", "a.example.org", "/en/1"), ("https://b.com#f", "b.com", ""), ("https://b.com?q/x", "b.com", ""), ("b.com/x", "", ""), (None, "", ""), ("x://h/p://q", "h", "/p://q"), ("://", "", "")])
def test_parts(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "u string").select(U.host(F.col("u")).alias("h"), U.path(F.col("u")).alias("p")).first()
    assert (row["h"], row["p"]) == (host, path)


def link(url):
    return f'<head><LINK href="{url}" rel="canonical"></head>'


def test_blocks_reach_aliases_and_allows_hold(spark):
    pages = [
        (1, "http://x.net/a", link("http://shop.com/de/1")),  # alias of a blocked URL that is no page
        (2, "http://x.net/b", "<meta http-equiv='refresh' content='0; url=/a'>"),  # alias of an alias
        (3, "https://good.org/b", link("http://x.net/b#f")),  # allowed by rule, stays allowed
        (4, "http://y.net/free", link("//y.net/other")),
        (5, "http://sub.example.org/en/19", None),
        (6, "http://myexample.org/en/19", ""),
        (7, None, link("http://shop.com/de/1")),
        (8, "http://shop.com/fr/x", link("http://x.net/a")),
        (8, "http://shop.com/fr/x", link("http://x.net/a")),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in U.judge(df).collect()}
    assert got == {1: (None, "block"), 2: (None, "block"), 3: ("org/", "allow"), 4: (None, "allow"), 5: ("example.org/en/1", "block"), 6: ("org/", "allow"), 7: (None, "allow"), 8: ("com/fr/", "allow")}
    more = spark.createDataFrame([("http://y.net/other", "http://a.com/de/"), (None, "x")], "from_url string, to_url string")
    got = {r["page_id"]: r["verdict"] for r in U.judge(df, redirects=more).collect()}
    assert got[4] == "block"
    assert U.judge(df.limit(0)).count() == 0


def test_links_of_all_kinds_resolve():
    t = lambda *tags: U.link_targets("http://H.net/d/p.html?x=1", tags)
    rel = '<link rel="canonical" href="{}">'
    assert t(rel.format("b")) == ["http://H.net/d/b"] and t(rel.format("../a")) == ["http://H.net/a"] and t(rel.format("?q=1&amp;r=2")) == ["http://H.net/d/p.html?q=1&r=2"]
    assert t(rel.format("//Q.org/x")) == ["http://Q.org/x"] and t(rel.format("/r")) == ["http://H.net/r"] and t(rel.format("https://z.org/?u=a://b")) == ["https://z.org/?u=a://b"]
    assert t("<link href=b rel='alternate CANONICAL'>") == ["http://H.net/d/b"] and t('<base href="/other/">', rel.format("b")) == ["http://H.net/other/b"]
    assert t('<meta content="5;URL=\'n.html\'" http-equiv=Refresh>') == ["http://H.net/d/n.html"] and t('<meta http-equiv="refresh" content="30">') == []
    assert t('<link rel="stylesheet" href="canonical.css">', "<link rel=canonical>", rel.format("http://[bad")) == ["http://[bad"] and t(rel.format("//[bad")) == []


def closure(pages):
    """Components by repeated relaxation over the links, resolved by the standard library."""
    import re
    from html import unescape
    from urllib.parse import urljoin

    strip = lambda u: re.sub(r"^[^/]*", lambda m: m[0].lower(), u.split("://", 1)[1].split("#")[0])
    root = {strip(u): strip(u) for _, u, _ in pages}
    edges = []
    for _, u, h in pages:
        for href in re.findall(r'rel="canonical" href="([^"]*)"', h or ""):
            edges.append((strip(u), strip(urljoin(u, unescape(href)))))
            root.setdefault(edges[-1][1], edges[-1][1])
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_verdicts_equal_an_independent_closure(spark):
    draw, pages = random.Random(3), []
    hosts = ["shop.com", "a.net", "b.net", "sub.example.org", "c.net"]
    for i in range(160):
        url = f"http://{draw.choice(hosts)}/{draw.choice(['de', 'fr', 'en', 'x'])}/{i}"
        to = draw.choice([f"http://{draw.choice(hosts)}/{draw.choice(['de', 'x'])}/{draw.randrange(160)}", f"{draw.randrange(160)}", f"../x/{draw.randrange(160)}", f"//b.net/x/{draw.randrange(40)}", f"http://shop.com/de/{draw.randrange(9)}", f"?p={i % 5}&amp;z", "/x/1"])
        pages.append((i, url, f'<link rel="canonical" href="{to}">' if i % 3 else "<p>no link to canonical pages</p>"))
    pages.append((999, "http://a.net/x/long", "<p>" + "word " * 200_000 + '</p><link rel="canonical" href="http://shop.com/de/long">'))
    root = closure(pages)

    def own(u):
        h, _, p = u.partition("/")
        fits = [(len(rh + rp), v) for v, rh, rp in U.RULES if (h == rh or h.endswith("." + rh)) and ("/" + p if _ else "").startswith(rp)]
        return max(fits)[1] if fits else None

    bad = {r for n, r in root.items() if own(n) == "block"}
    want = {i: own(u.split("://")[1]) or ("block" if root[u.split("://")[1]] in bad else "allow") for i, u, _ in pages}
    got = {r["page_id"]: r["verdict"] for r in U.judge(spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit("x"), "__url": F.lit("y")})).collect()}
    assert got == want and sum(v == "block" and own(u.split("://")[1]) is None for (_, u, _), v in zip(pages, want.values(), strict=True)) > 5


@pytest.mark.parametrize("junk", ["<link ", '<link "', "<meta '\" ", "<link rel=canonical <meta "])
def test_a_page_of_unclosed_tags_is_read_once(spark, junk):
    """A megabyte of tags that never close takes no more than its length, and a link after them still counts."""
    import time

    html = junk * (1_000_000 // len(junk)) + "'\"> <link rel=canonical href='http://shop.com/de/x'>"
    df = spark.createDataFrame([(1, "http://a.net/p", html), (2, "http://b.net/", "<p>canonical</p>")], "page_id long, url string, html string")
    U.judge(df.limit(1).withColumn("html", F.lit("x"))).collect()
    began = time.time()
    got = {r["page_id"]: r["verdict"] for r in U.judge(df).collect()}
    assert got == {1: "block", 2: "allow"} and time.time() - began < 60
