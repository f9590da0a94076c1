import hashlib
import re

import pytest

from hangscope.llm import decontaminate as D
from hangscope.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def ws(text):
    return WORD.findall((text or "").translate(LOWER))


def by_hand(docs, items, size=10):
    wins = {}
    for i in items:
        w = ws(i.text)
        for a in range(max(1, len(w) - size + 1)) if w else ():
            wins.setdefault(tuple(w[a:a + size]), set()).add(None if i.item_id is None else str(i.item_id))
    lens = {len(k) for k in wins}
    out = []
    for d in docs:
        w, hit, found = ws(d.text), set(), set()
        for n in lens:
            for a in range(len(w) - n + 1):
                got = wins.get(tuple(w[a:a + n]))
                if got is not None:
                    hit |= set(range(a, a + n))
                    found |= got - {None}
        out.append((d.doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return sorted(out, key=str)


def got(docs, items):
    return sorted([(r.doc, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in D.contamination(docs, items).collect()], key=str)


PHRASE = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"


@pytest.fixture(scope="module")
def edge(spark):
    words = PHRASE.split()
    docs = [(1, PHRASE, "x"), (2, "pre " + PHRASE.upper() + " post " + PHRASE, "x"), (3, " ".join(words[:9]), "x"), (4, None, "x"), (5, "", "x"), (6, "...", "x"),
            (7, "short item here and more", "x"), (None, PHRASE, "x"), (1, PHRASE, "x"), (1, "another text " + PHRASE, "x"), (8, "a a a a a a a a a a a a a a", "x"),
            (9, "filler " * 60000 + PHRASE + " filler" * 60000, "x"), (10, " ".join(words[:5] + ["odd"] + words[5:]), "x"), (11, "x" + PHRASE, "x"), (12, "short item heré", "x")]
    items = [(1, PHRASE, 0), (2, "short item here", 0), (3, None, 0), (4, "", 0), (10, PHRASE, 0), (None, "another text alpha", 0), (5, "a a a a a a a a a a a", 0), (2, "short item here", 0)]
    return spark.createDataFrame(docs, "doc_id long, text string, th string").repartition(3), spark.createDataFrame(items, "item_id long, text string, doc int")


def test_edges(edge):
    docs, items = edge
    assert got(docs, items) == by_hand(docs.collect(), items.collect())


def test_edges_without_broadcast(edge, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(D, "sized", lambda df, limit=-1: df)
    docs, items = edge
    assert got(docs, items) == by_hand(docs.collect(), items.collect())


def test_empty(edge):
    docs, items = edge
    assert got(docs.filter("false"), items) == []
    assert got(docs, items.filter("false")) == by_hand(docs.collect(), [])


def test_clean_documents(edge):
    docs, items = edge
    assert sorted(r.doc_id for r in D.clean_documents(docs, items).collect()) == sorted(d for d, _, hit, _, _ in by_hand(docs.collect(), items.collect()) if not hit)


def test_tables(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    assert got(docs, items) == by_hand(docs.collect(), items.collect())


def test_proximity(edge):
    docs, items = edge
    texts = D.corpus(docs)
    wins, _ = D.item_windows(items.filter("item_id = 1"))
    anchor = D.anchors(wins, D.term_counts(texts, wins))
    near = D.proximity_matches(D.build_postings(texts, anchor), anchor, 1).select("doc", "shift").distinct().collect()
    assert {r.doc for r in near if r.shift == 0} >= {1, 2, 9, None}
    assert all(abs(r.shift) <= 1 for r in near)
