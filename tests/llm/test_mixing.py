import numpy as np
import pytest
from pyspark.sql import functions as F

from hangscope.llm import mixing as M
from hangscope.llm.common import table


def fitted(spark, n, p, targets, **kw):
    df = spark.createDataFrame([(i, i, int(a), 1, [float(x) for x in b]) for i, (a, b) in enumerate(zip(n, p))], "doc long, th long, n_tokens long, times int, p array<double>")
    rows = sorted(M.fit_rates(df, targets, **kw).collect(), key=lambda r: r.doc)
    return np.array([r.rate for r in rows])


def is_least_change(n, p, r, tol):
    """Whether rates are those of least change among all with their totals: max(0, 1 - p . y) for one y."""
    live = r > 1e-9
    y = np.linalg.lstsq(p[live], 1 - r[live], rcond=None)[0]
    return np.allclose(1 - p[live] @ y, r[live], atol=tol) and (1 - p[~live] @ y < tol).all()


def is_least_squares(n, p, r, aim, tol):
    """The conditions of nonnegative least squares: no gradient where the rate is positive, none that would lift a rate of zero."""
    slope = p @ np.linalg.pinv((p * n[:, None]).T @ p / n.sum(), rcond=1e-9) @ ((n * r) @ p / n.sum() - aim)
    return np.abs(slope[r > 1e-6]).max() < tol and slope[r <= 1e-6].min(initial=0) > -tol


@pytest.mark.parametrize("targets", [{"high": 0.5, "low": 0.3, "toxic": 0.2}, {"high": 1.0}, {"toxic": 1.0}, {"high": 0.9, "low": 0.1, "toxic": 0.0}])
def test_rates_are_the_least_squares(spark, targets):
    rng = np.random.default_rng(2)
    n, p = rng.integers(1, 500, 300).astype(float), rng.dirichlet([0.6, 0.3, 0.2], 300)
    aim = np.array([targets.get(d, 0.0) for d in M.DOMAINS])
    r = fitted(spark, n, p, targets)
    assert (r >= 0).all() and is_least_squares(n, p, r, aim / aim.sum(), 1e-4)
    if all(targets.get(d, 0) > 0 for d in M.DOMAINS):
        assert np.allclose((n * r) @ p / n.sum(), aim, atol=1e-6) and is_least_change(n, p, r, 1e-6)


def test_edge_targets_take_tens_of_steps():
    """Targets that some nonnegative rates attain by construction, up to mixes of two extreme documents: met, by the least change."""
    rng = np.random.default_rng(2)
    for trial in range(60):
        n, p = rng.integers(1, 500, 400).astype(float), rng.dirichlet([0.6, 0.3, 0.2], 400)
        if trial % 2:
            aim = p[rng.choice(400, 3, replace=False)].T @ [0.2, 0.3, 0.5]
        else:
            aim = 0.995 * p[np.argsort(p[:, 2])[-2:]].mean(0) + 0.005 * p.mean(0)

        def look(y):
            r = np.maximum(0, 1 - p @ y)
            return (n * r * r).sum() / n.sum() / 2, (n * r) @ p / n.sum(), (p * (n * (r > 0))[:, None]).T @ p / n.sum()

        y, miss, looks = M.find_multipliers(look, aim)
        assert looks < 100 and np.abs(miss).max() < 5e-6 and np.allclose((n * np.maximum(0, 1 - p @ y)) @ p / n.sum() - aim, miss)


def test_targets_beyond_four_copies_are_met(spark):
    rng = np.random.default_rng(2)
    n, p = rng.integers(1, 500, 300).astype(float), rng.dirichlet([0.6, 0.3, 0.2], 300)
    aim = [0.2, 0.2, 0.6]
    r = fitted(spark, n, p, dict(zip(M.DOMAINS, aim)))
    assert r.min() >= 0 and r.max() > 4 and np.allclose((n * r) @ p / n.sum(), aim, atol=1e-5)


def test_miss_is_told(spark):
    """No mix of two kinds of documents is all toxic; the least squares are reached and the rest of each target is returned."""
    n, p = np.array([10.0, 30.0, 20.0]), np.array([[0.5, 0.3, 0.2], [0.2, 0.2, 0.6], [0.5, 0.3, 0.2]])
    df = spark.createDataFrame([(i, i, int(a), 1, b.tolist()) for i, (a, b) in enumerate(zip(n, p))], "doc long, th long, n_tokens long, times int, p array<double>")
    with pytest.warns(UserWarning, match="targets missed"):
        rows = sorted(M.fit_rates(df, {"toxic": 1.0}).collect(), key=lambda r: r.doc)
    r, miss = np.array([x.rate for x in rows]), np.array(rows[0].miss)
    assert all(x.miss == rows[0].miss for x in rows) and np.allclose((n * r) @ p / n.sum() - [0, 0, 1], miss, atol=1e-9) and abs(miss).max() > 0.01
    slope = p @ np.linalg.pinv((p * n[:, None]).T @ p / n.sum(), rcond=1e-9) @ miss
    assert np.abs(slope[r > 0]).max() < 1e-2 and slope[r == 0].min(initial=0) > -1e-2


def test_tables_meet_targets_and_classify(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = M.mix(docs, labels).collect()
    n, p, r = (np.array([x[c] if c != "n" else x["n_tokens"] * x["times"] for x in rows], float) for c in ("n", "p", "rate"))
    assert sum(x["times"] for x in rows) == docs.count()
    assert np.allclose((n * r) @ p / n.sum(), [M.TARGETS[d] for d in M.DOMAINS], atol=1e-5) and (r >= 0).all()
    truth = {x.doc_id: "toxic" if x.toxic == 1 else "low" if x.quality == 0 else "high" for x in labels.collect()}
    sampled = {x.doc for x in M.labelled_sample(labels).collect()}
    assert np.mean([M.DOMAINS[int(np.argmax(x.p))] == truth[x.doc] for x in rows if x.doc in truth and x.doc in sampled]) > 0.9


def test_edges(spark):
    text = ["good words here " * 30, "junk junk junk " * 40, "", None, "!!", "good words " * 40000]
    docs = spark.createDataFrame([(i, text[i % 6], "x", 2.0) for i in range(120)] + [(0, text[0], "x", 2.0), (None, "odd one", "x", 2.0)], "doc_id long, text string, th string, rate double")
    labels = spark.createDataFrame([(i, 1 - (i % 6 == 1), 0) for i in range(0, 60)] + [(None, 1, 1), (3, None, None), (9999, 1, 1), (0, 1, 0)], "doc_id long, quality int, toxic int")
    rows = M.mix(docs, labels, {"high": 0.5, "low": 0.5}).collect()
    assert sum(r.times for r in rows) == docs.count()
    assert all(r.rate == 1.0 for r in rows if r.n_tokens == 0) and all(abs(sum(r.p) - 1) < 1e-9 and r.rate >= 0 for r in rows)
    out = M.apply_rates(docs, M.mix(docs, labels, {"high": 0.5, "low": 0.5}))
    assert out.columns == docs.columns
    clash = docs.withColumnsRenamed({"th": "__t", "rate": "own_0"}).withColumn("OWN_1", F.lit(7)).withColumn("times", F.lit("t"))
    kept = M.apply_rates(clash, M.mix(clash, labels, {"high": 0.5, "low": 0.5}))
    assert kept.columns == clash.columns and {(r["own_0"], r["OWN_1"], r["times"], r["__t"]) for r in kept.collect()} == {(2.0, 7, "t", "x")}
    none = M.mix(docs, labels.filter("false"))
    assert all(r.p == [1 / 3] * 3 for r in none.collect())
    assert M.mix(docs.filter("false"), labels).count() == 0


def test_apply_rates_repeats_and_thins(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(2000)], "doc_id long, text string")
    rates = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("th"), F.when(F.col("doc_id") < 1000, 2.25).otherwise(0.5).alias("rate"))
    got = {r.doc_id: r["count"] for r in M.apply_rates(docs, rates).groupBy("doc_id").count().collect()}
    a, b = (np.array([got.get(i, 0) for i in s]) for s in (range(1000), range(1000, 2000)))
    assert set(a) == {2, 3} and abs(a.mean() - 2.25) < 0.06 and set(b) == {0, 1} and abs(b.mean() - 0.5) < 0.06
