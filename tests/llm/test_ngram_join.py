import random

import numpy as np
import pytest

from hangscope.llm import ngram_join as J
from hangscope.llm.common import table, word_list


def shingles(text, n=5):
    w = word_list(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def by_hand(rows):
    """(class_id, n_links) of each row, over all pairs."""
    sets = [frozenset(shingles(r.text)) for r in rows]
    near = lambda a, b: a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if near(sets[i], sets[j]):
                links[i] += 1
                links[j] += 1
                group[root(i)] = root(j)
    ids = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            k = root(i)
            ids[k] = min(ids.get(k, r.doc_id), r.doc_id)
    return sorted([(r.doc_id, ids.get(root(i)), links[i]) for i, r in enumerate(rows)], key=str)


def got(docs):
    return sorted([(r.doc, r.class_id, r.n_links) for r in J.jaccard_groups(docs).collect()], key=str)


def prose(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def copy(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 9)}"
    return w


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    texts = []
    for size in (2, 3, 5, 12):
        base = prose(rng, rng.randrange(60, 400))
        texts += [" ".join(copy(rng, base, rng.randrange(0, 4))) for _ in range(size)]
    texts += [" ".join(prose(rng, rng.randrange(1, 200))) for _ in range(60)]
    passage = prose(rng, 60)
    texts += [" ".join(prose(rng, rng.randrange(5, 150)) + passage) for _ in range(80)]
    texts += ["one two three four", "ONE, two; three four", "one two three", "", "!!", None, "É one two three four five", "é one two three four five"]
    texts += texts[:3]
    rows = [(i, t, "x", 0) for i, t in enumerate(texts)] + [(3, texts[3], "x", 0), (None, texts[0], "x", 0), (None, "alone here with nobody around me", "x", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, node string, cid int").repartition(3)


def test_equals_brute_force(corpus):
    assert got(corpus) == by_hand(corpus.collect())


def test_tables(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert got(docs) == by_hand(docs.collect())


def test_dense_groups_stay_whole(spark, monkeypatch):
    """Many more near copies than a bucket holds, and as many texts around one passage: groups as by hand, no other links."""
    monkeypatch.setattr(J, "SMALL", 24)
    monkeypatch.setattr(J, "WORK", 5)
    monkeypatch.setattr(J, "BLOCK", 12)
    rng = random.Random(9)
    base, passage = prose(rng, 150), prose(rng, 40)
    near = [" ".join(copy(rng, base, rng.randrange(1, 3))) for _ in range(150)]
    chain = [base[k:] + [f"c{k}x{i}" for i in range(k)] for k in range(0, 40, 2)]
    shared = [" ".join(prose(rng, 40) + passage) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(near + [" ".join(c) for c in chain] + shared)), "doc_id long, text string")
    hand, found = by_hand(docs.collect()), got(docs)
    assert [x[:2] for x in found] == [x[:2] for x in hand]
    assert all(f[2] <= h[2] and (f[2] > 0) == (h[2] > 0) for f, h in zip(found, hand))


def test_dense_groups_count_every_link(spark, monkeypatch):
    """As above, with copies of some: the links within a group that no bucket compares are counted too."""
    monkeypatch.setattr(J, "SMALL", 24)
    monkeypatch.setattr(J, "COUNTED", 40)
    rng = random.Random(11)
    base, passage = prose(rng, 150), prose(rng, 40)
    near = [" ".join(copy(rng, base, rng.randrange(1, 5))) for _ in range(150)]
    chain = [base[k:] + [f"c{k}x{i}" for i in range(k)] for k in range(0, 40, 2)]
    shared = [" ".join(prose(rng, 40) + passage) for _ in range(100)]
    docs = spark.createDataFrame(list(enumerate(near + near[:10] + [" ".join(c) for c in chain] + shared)), "doc_id long, text string")
    assert got(docs) == by_hand(docs.collect())


def test_common_counts_equal_brute_force():
    rng = np.random.default_rng(5)
    always, sometimes = rng.integers(0, 1 << 63, 30).astype(np.uint64), rng.integers(0, 1 << 63, 9000).astype(np.uint64)
    xs, ys = ([np.unique(np.concatenate([always, rng.choice(sometimes, int(k))])) for k in rng.integers(0, 400, n)] for n in (90, 70))
    assert (J._common(xs, ys) == [[len(np.intersect1d(x, y)) for y in ys] for x in xs]).all()


def test_remainder_is_exact(spark, monkeypatch):
    """With no level to split on, what is left of large buckets is still compared."""
    monkeypatch.setattr(J, "LEVELS", 0)
    monkeypatch.setattr(J, "BLOCK", 2)
    monkeypatch.setattr(J, "SMALL", 2)
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, " ".join(copy(rng, b, 1))) for i, b in enumerate([prose(rng, 90)] * 1 + [prose(rng, 80)] * 9 + [prose(rng, 70)] * 7)], "doc_id long, text string")
    assert [x[:2] for x in got(docs)] == [x[:2] for x in by_hand(docs.collect())]


def test_one_of_each_group(corpus):
    kept = J.one_of_each_group(corpus)
    hand = by_hand(corpus.collect())
    assert kept.columns == corpus.columns
    # every group with an id keeps its smallest; the null-id document of its own stays too
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for _, c, _ in hand if c is not None})
    assert sum(r.doc_id is None for r in kept.collect()) == 1


def test_clashing_columns_stay(corpus):
    clash = corpus.withColumnsRenamed({"node": "_t", "cid": "own_0"})
    kept = J.one_of_each_group(clash)
    assert kept.columns == clash.columns and {(r["_t"], r["own_0"]) for r in kept.collect()} == {("x", 0)}


def test_done_sets_miss_no_partner():
    """The share of picks that a similar set of any smaller size shares, and the tail that a set leaves large buckets by."""
    assert [J.picks_to_be_done(k, 0.8, 1e-4) for k in (0, 1, 4, 18)] == [1, 2, 5, 12]
    rng = np.random.default_rng(3)
    seeds = [J._seed(r) for r in range(200)]
    for common, a, b in ((800, 200, 0), (800, 100, 100), (80, 0, 20)):
        c, x, y = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (common, a, b))
        one, two = np.sort(np.concatenate([c, x])), np.sort(np.concatenate([c, y]))
        picks = [(set(J._picks(one, s, J.FIRST).tolist()), set(J._picks(two, s, J.FIRST).tolist())) for s in seeds]
        for i in (0, 1):
            assert sum(len(p[0] & p[1]) for p in picks) > 0.75 * sum(len(p[i]) for p in picks)


def test_empty(corpus):
    assert got(corpus.filter("false")) == []


def test_sets_of_long_and_odd_texts(monkeypatch):
    monkeypatch.setattr(J, "PIECE", 200)
    rng = random.Random(1)
    texts = [" ".join(prose(rng, n)) for n in (1, 4, 5, 6, 300, 2000)] + ["a " * 3000, "x" * 1000, "x" * 900 + " y " + "z" * 900, " " * 1000 + "a b c d e f" + " " * 900 + "g", None]
    for t, s in zip(texts, J.shingle_sets(texts)):
        assert len(s) == len(shingles(t))
    whole = [J.shingle_sets([t])[0] for t in texts]
    monkeypatch.setattr(J, "PIECE", 1 << 18)
    assert all((a == b).all() for a, b in zip(whole, J.shingle_sets(texts)))


def test_sketches_let_similar_sets_pass():
    """Pairs at the threshold pass, pairs well below it mostly don't, at any size."""
    rng = np.random.default_rng(2)
    for n in (4, 20, 100, 600, 3000):
        passed = {}
        for similarity in (0.8, 0.6):
            own = round(n * (1 - similarity) / 2)
            pairs = [(np.concatenate([c, rng.integers(0, 1 << 63, own).astype(np.uint64)]), np.concatenate([c, rng.integers(0, 1 << 63, own).astype(np.uint64)]))
                     for c in (rng.integers(0, 1 << 63, n - 2 * own).astype(np.uint64) for _ in range(300))]
            sa, sb = (np.frombuffer(b"".join(J._sketch(p[i]) for p in pairs), np.uint64).reshape(300, -1) for i in (0, 1))
            size = np.array([len(a) for a, _ in pairs])
            passed[similarity] = J._alike(sa, sb, size, size, 0.8).mean()
        assert passed[0.8] == 1 and (n < 100 or passed[0.6] < 0.05)


def test_runs_meet_recall():
    """Share of pairs at the threshold that meet in a first-level bucket, and the bound on runs."""
    runs = J.runs_for(J.RECALL, J.SIMILARITY)
    rng = np.random.default_rng(0)
    seeds, met = [J._seed(r) for r in range(runs)], 0
    for _ in range(300):
        common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (800, 100, 100))
        x, y = np.sort(np.concatenate([common, a])), np.sort(np.concatenate([common, b]))
        met += any(set(J._picks(x, s, J.FIRST).tolist()) & set(J._picks(y, s, J.FIRST).tolist()) for s in seeds)
    assert met == 300
