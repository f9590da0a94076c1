import numpy as np
import pytest

from hangscope.llm import ann as A
from hangscope.llm.common import table


def brute(ids, x, k, every=20):
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        s = (x * x[q]).sum(1)
        keep = ids != ids[q]
        order = np.lexsort((ids[keep], -s[keep]))[:k]
        out[int(ids[q])] = list(zip(ids[keep][order].tolist(), s[keep][order].tolist()))
    return out


def found(df, k):
    out = {}
    for r in sorted(A.nearest(df, k).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def recall(a, b):
    return np.mean([len({v for v, _ in a.get(q, [])} & {v for v, _ in n}) / max(1, len(n)) for q, n in b.items()])


def test_recall_on_tables(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    p = df.toPandas()
    ids, x = p.vec_id.to_numpy(), np.stack(p.embedding).astype(float)
    got, hand = found(df, 20), brute(ids, x, 20)
    assert got.keys() == hand.keys() and recall(got, hand) >= 0.9
    at = {i: v for i, v in zip(ids, x)}
    assert all(abs(s - at[q] @ at[v]) < 1e-12 for q, n in got.items() for v, s in n)


def test_several_parts_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_ROWS", 200)
    monkeypatch.setattr(A, "BLOCK_QUERIES", 16)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 4000)] + 0.3 * rng.normal(size=(4000, 16))).astype(np.float32).astype(float)
    x[1000:2300] = x[1000]      # a third of the rows hold one vector
    df = spark.createDataFrame([(i, v.tolist(), "x", 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, part string, score int")
    router = A.fit(A.valid_vectors(df), 10)
    assert router.parts > 4 and router.probes < router.parts
    got, hand = found(df, 10), brute(np.arange(4000), x, 10)
    assert recall(got, hand) >= 0.9
    # ties of the common vector go to the smallest ids
    assert all([v for v, _ in got[q]] == [v for v, _ in hand[q]] for q in range(1000, 2300, 20))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    vecs = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (40, [0.0, 0.0]), (60, None), (80, [nan, 1.0]), (100, [1.0, None]), (120, [inf, 0.0]), (140, []), (160, [1.0, 2.0, 3.0]),
            (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [-1.0, 0.0]), (3, [2.0, 0.0]), (3, [2.0, 0.0]), (None, [1.0, 1.0]), (20, [0.0, 1.0])]
    df = spark.createDataFrame(vecs, "vec_id int, embedding array<float>")
    got = found(df, 20)
    assert {q: [v for v, _ in n] for q, n in got.items()} == {0: [3, 1, 2, 20], 20: [0, 1, 2, 3]}
    assert got[0][0] == (3, 2.0) and found(df, 2)[0] == [(3, 2.0), (1, 1.0)]
    assert found(df.filter("false"), 20) == {} and found(df.filter("vec_id = 40"), 20) == {}


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(0)
    x = np.repeat(np.eye(8), 50, axis=0) + 0.05 * rng.normal(size=(400, 8))
    graph = A.neighbour_graph(x, 8)
    part = A.balanced_parts(x, graph, 8, rng)
    assert np.bincount(part, minlength=8).max() <= np.ceil(1.1 * 50) and (part[graph] != part[:, None]).mean() < 0.3
