import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hangscope.llm import url_filter as U
from hangscope.llm.common import table
from hangscope.llm.queries import op8_url_filter


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def rule(host, path):
    fits = [(len(h + p), -i, h + p, v) for i, (v, h, p) in enumerate(U.RULES) if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def normal(url):
    s = "".join("0" if c in "0123456789" else c for c in (url or "").lower())
    return "^" * (U.ORDER - 1) + "".join(c if c in "abcdefghijklmnopqrstuvwxyz0./-_%~:?#=&+" else "*" for c in s) + "$"


def crc(s):
    import zlib

    return zlib.crc32(s.encode())


def by_hand(urls):
    """(host, path, rule, verdict) of each url by plain recursion over counts."""
    urls = list(urls)
    rows = [(*split(u),) for u in urls]
    told = [(normal(u), rule(h, p)[1]) for u, (h, p) in zip(urls, rows)]
    grams, follow = {v: Counter() for v in ("allow", "block")}, {}
    for s, v in told:
        if v and crc(s) % U.HELD_OUT:
            for i in range(U.ORDER - 1, len(s)):
                for k in range(U.ORDER):
                    ctx = s[i - k:i]
                    grams[v][ctx + s[i]] += 1
                    follow.setdefault((v, ctx), Counter())[s[i]] += 1
    seen = set(grams["allow"]) | set(grams["block"])

    def prob(v, ctx, c):
        lower = prob(v, ctx[1:], c) if ctx else 1 / U.SYMBOLS
        f = follow.get((v, ctx))
        return lower if not f else (f[c] + len(f) * lower) / (sum(f.values()) + len(f))

    def score(s):
        total = 0.0
        for i in range(U.ORDER - 1, len(s)):
            if s[i] in seen:
                total += math.log(prob("allow", s[i - U.ORDER + 1:i], s[i])) - math.log(prob("block", s[i - U.ORDER + 1:i], s[i]))
            else:
                total += sum(math.log(w("allow", s[i - k:i]) / w("block", s[i - k:i])) for k in range(1, U.ORDER))
        return total / (len(s) - U.ORDER + 1)

    def w(v, ctx):
        f = follow.get((v, ctx))
        return 1.0 if not f else len(f) / (sum(f.values()) + len(f))

    held = [(score(s), v) for s, v in told if v and crc(s) % U.HELD_OUT == 0]
    good, bad = ([round(x, 9) for x, v in held if v == kind] for kind in ("allow", "block"))
    limit = None
    if good and bad:
        lo, hi = min(good + bad), max(good + bad)
        at = lambda x: math.floor((x - lo) / ((hi - lo) / U.BINS)) if hi > lo else 0
        error = [sum(at(x) < cut for x in good) / len(good) + sum(at(x) >= cut for x in bad) / len(bad) for cut in range(U.BINS + 1)]
        best = [cut for cut, e in enumerate(error) if e <= min(error) + 1e-12]
        limit = lo + best[len(best) // 2] * ((hi - lo) / U.BINS)
    out = []
    for (h, p), (s, v) in zip(rows, told):
        out.append((h, p, rule(h, p)[0], v or ("allow" if limit is None or round(score(s), 9) >= round(limit, 9) else "block")))
    return out


def test_tables_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.url for r in table(spark, sf, "pages").collect()}
    hand = dict(zip(pages, by_hand(pages.values())))
    rows = op8_url_filter(spark, sf).collect()
    assert len(rows) == len(pages) and {r.verdict for r in rows} == {"allow", "block"}
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows} == hand


EDGE = [None, "", "no scheme", "http://", "HTTP://A.Net", "http://a.net/", "https://x.EXAMPLE.net/en/1?q#f", "http://example.net/fr/", "http://notexample.com/de/",
        "http://EXAMPLE.com/de/x", "http://org/fr/a", "http://a.org/fr", "x://b.org?/fr/", "http://c.net#/", "http://é.ñ/ü\n/x", "a://b://c.net/d", "http://" + "l" * 50000 + ".net/" + "p" * 50000]


def test_edges(spark):
    pages = spark.createDataFrame([(i, u, "s", 1) for i, u in enumerate(EDGE)] + [(0, None, "s", 1), (None, EDGE[5], "s", 1)], "page_id long, url string, s string, n int")
    rows = U.judge(pages).collect()
    assert len(rows) == len(EDGE) + 2
    for r in rows:
        u = EDGE[5] if r.id is None else EDGE[r.id]
        assert (r.host, r.path) == split(u) and r.rule == rule(*split(u))[0] and r.verdict in ("allow", "block")
        assert r.rule is None or r.verdict == rule(*split(u))[1]


def test_what_follows_the_path_counts(spark):
    """Two urls that differ only after ``?``, and two without a scheme, are judged apart."""
    told = [f"http://h{i}.net/p?spam=cheap&pills={i}" for i in range(40)] + [f"http://h{i}.org/fr/p?lang=fr&page={i}" for i in range(40)]
    asked = ["http://h.com/p?spam=cheap&pills=7", "http://h.com/p?lang=fr&page=7", "spam=cheap&pills=7", "lang=fr&page=7"]
    pages = spark.createDataFrame(list(enumerate(told + asked)), "page_id long, url string")
    score = {r.id: r.score for r in U.judge(pages).collect()}
    assert score[80] < score[81] and score[82] < score[83]


def test_cut_separates_held_out_urls(spark):
    """The middle of the cuts with the fewest errors, not the middle of the means."""
    rows = [("block", 1, x) for x in (-1.0, -0.9, -0.8, 0.1)] + [("allow", 9, x) for x in (0.3, 0.35, 3.0)]
    cut = U.threshold(spark.createDataFrame(rows, "verdict string, n long, score double"))
    assert 0.1 < cut < 0.3
    overlap = spark.createDataFrame(rows + [("block", 1, 0.5)], "verdict string, n long, score double")
    assert 0.1 < U.threshold(overlap) < 0.3 and U.threshold(overlap.filter("verdict = 'allow'")) is None
    assert U.threshold(spark.createDataFrame([("block", 1, 2.0), ("allow", 1, 2.0)], "verdict string, n long, score double")) == 2.0


def test_nothing_told_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://b.net/x")], "page_id long, url string")
    assert {r.id: r.verdict for r in U.judge(pages).collect()} == {1: "allow", 2: "block"}
    assert U.judge(pages.filter("false")).count() == 0


def test_shuffled_model_scores_alike(spark, monkeypatch):
    urls = [f"http://h{i}.{d}/{p}/{i}" for i in range(60) for d, p in (("net", "x"), ("org", "fr"), ("com", "aa"))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    some = {(r.id, r.verdict) for r in U.judge(pages).collect()}
    monkeypatch.setattr(U, "BROADCAST_ROWS", -1)
    assert {(r.id, r.verdict) for r in U.judge(pages).collect()} == some
