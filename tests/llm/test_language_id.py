import random

import numpy as np
import pytest

from hangscope.llm import language_id as L
from hangscope.llm.queries import op4_language_id


def test_posteriors_equal_plain_chain(monkeypatch):
    monkeypatch.setattr(L, "SEGMENT", 4)
    monkeypatch.setattr(L, "ROWS", 3)
    rng = np.random.default_rng(0)
    m = L.Model(["a", "b", "c"], None, rng.normal(size=3), rng.normal(size=(3, 3)))
    lens = np.array([0, 1, 3, 4, 5, 17, 0, 9])
    psi = np.exp(rng.normal(size=(lens.sum(), 3)))
    post, sums = L.posteriors(psi, lens, m)
    move, at = np.exp(m.trans), 0
    for n, total in zip(lens, sums):
        p = psi[at:at + n]
        a, b = np.empty((n, 3)), np.ones((n, 3))
        for t in range(n):
            a[t] = (np.exp(m.start) if t == 0 else a[t - 1] @ move) * p[t]
        for t in range(n - 2, -1, -1):
            b[t] = move @ (b[t + 1] * p[t + 1])
        g = a * b
        g = g / g.sum(1, keepdims=True) if n else g
        assert np.allclose(post[at:at + n], g) and np.allclose(total, g.sum(0))
        at += n


def test_gradient_equals_difference():
    """Word posteriors and expected transitions are the derivatives of the log partition function."""
    rng = np.random.default_rng(1)
    lens, start, trans = np.array([3, 5]), rng.normal(size=2), rng.normal(size=(2, 2))
    e = rng.normal(size=(8, 2))

    def log_z(e, trans):
        total, at = 0.0, 0
        for n in lens:
            a = np.exp(start + e[at])
            for t in range(1, n):
                a = (a @ np.exp(trans)) * np.exp(e[at + t])
            total, at = total + np.log(a.sum()), at + n
        return total

    post, pairs = L._marginals(np.exp(e), lens, start, trans)
    h = 1e-6
    for i in range(8):
        d = np.zeros_like(e)
        d[i, 1] = h
        assert abs((log_z(e + d, trans) - log_z(e - d, trans)) / (2 * h) - post[i, 1]) < 1e-5
    d = np.zeros((2, 2))
    d[0, 1] = h
    assert abs((log_z(e, trans + d) - log_z(e, trans - d)) / (2 * h) - pairs[0, 1]) < 1e-5


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op4_language_id(spark, sf).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out and truth[r.doc_id][0] is not None and r.lang_pred != L.UND]
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    rng = random.Random(1)
    say = {"aa": ["kala", "mala", "sala", "tala"], "bb": ["xoxo", "zozo", "wowo", "yoyo"]}
    rows = [(i, " ".join(rng.choices(say[y], k=40)), y, "x") for i, y in enumerate(["aa", "bb"] * 60)]
    rows += [(1000, None, "aa", "x"), (1001, "123 !!", "bb", "x"), (1002, "", None, "x"), (None, "kala mala", "aa", "x"), (1003, "kala " * 200 + "zozo " * 100, None, "x"),
             (1003, "kala " * 200 + "zozo " * 100, None, "x"), (1004, "w" * 100_000 + " xoxo" * 5000, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    model = L.train(docs)
    assert model.langs == ["aa", "bb"]
    got = L.identify(docs, model, spans=True).collect()
    assert got[0].asDict().keys() == {"doc_id", "lang", "lang_pred", "score", "spans"}
    by = {r.doc_id: r for r in got}
    assert [(by[i].lang_pred, by[i].score, by[i].spans) for i in (1000, 1001, 1002)] == [(L.UND, 0.0, [])] * 3
    assert by[None].lang_pred == "aa" and by[1003].lang_pred == "aa" and by[1004].lang_pred == "bb" and len(got) == len(rows)
    spans = by[1003].spans
    assert [s["lang"] for s in spans] == ["aa", "bb"] and abs(spans[0]["last"] - 199) <= 1 and spans[1]["last"] == 299
    assert all(r.lang_pred == r.lang for r in got if r.doc_id is not None and r.doc_id < 1000)
    kept = L.identify(docs, model, keep_text=True)
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(r.doc_id, r.text) for r in docs.collect()}


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "aa")], "doc_id long, text string, lang string")
    assert L.train(docs) is None
    assert [(r.lang_pred, r.score) for r in L.identify(docs, None).collect()] == [(L.UND, 0.0)] * 2
    assert L.identify(docs.filter("false"), None).count() == 0


def test_cache_limit_does_not_change_results(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdexyz", k=rng.randrange(1, 9))) for _ in range(rng.randrange(0, 80))) for _ in range(40)]
    model = L.fit([("ab"[i % 2], t) for i, t in enumerate(texts)], epochs=1)
    full = L.Labeller(model).label(texts)
    monkeypatch.setattr(L, "CACHE_WORDS", 60)
    small = L.Labeller(model)
    parts = [small.label([t])[0] for t in texts]
    assert [f[0] for f in full] == [p[0] for p in parts] and np.allclose([f[1] for f in full], [p[1] for p in parts])
