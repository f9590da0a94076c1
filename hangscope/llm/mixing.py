"""Mixing sources to target weights by soft domain membership.

A classifier learned from a labelled table gives each document a posterior over
domains: words that labelled documents of one domain hold far more often than
the others form that domain's lexicon, and a linear discriminant over lexicon
scores and shape (length, repetition, characters per word) turns them into posteriors.  Rates r >= 0, one per
document, are then fitted so that the expected tokens of each domain,
sum of r_i * n_i * p_i, meet the targets in least squares (weighted by the
inverse of the domains' Gram matrix); rates have no upper bound.

The fit is projected gradient in its lazy form: the gradients are summed, and
the projection onto nonnegative rates is applied to the sum.  As the gradient
of a rate is its document's posteriors times one vector, the sum is a vector of
as many numbers as there are domains, ``y``, and a rate is max(0, 1 - p . y):
an attainable target is met with the least change of rates.  Each step takes
the metric of the documents whose rate is above zero, and is shortened until the
(convex) dual falls; so targets at the edge of what the posteriors allow take
some tens of steps too.  ``SMOOTH``, the weight of the rates' change beside
the miss, lets targets beyond that end in least squares.  The fit ends when the
gradient of the dual is below a tenth of ``CLOSE``; what is left to each target is a
column of the result and, beyond ``CLOSE``, a warning.

DataFrame functions only.  The texts are read twice: once for the labelled
sample (at most ``SAMPLE`` rows, by hash), once for all features, which are
then a narrow table.  A step is one aggregate of a few sums per pair of
domains; the driver holds ``y``, never rates.

Edge cases: null, empty and wordless texts have no tokens and the rate 1; a
label row without document, with a null flag or id is not learned from; a
domain without labelled documents has posterior 0; with no labels at all,
posteriors are equal; target weights need not add up to 1; targets
beyond what posteriors allow are met in least squares; repeated rows have equal rates; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_names, words, written
from .decontaminate import sized

DOMAINS = ["high", "low", "toxic"]
TARGETS = {"high": 0.85, "low": 0.10, "toxic": 0.05}
SAMPLE = 20_000
MIN_DOCS = 5           # labelled documents that must hold a lexicon word
MIN_LOG_RATIO = 2.0
CLOSE = 1e-6           # of the total: largest miss of a target that isn't told
SMOOTH = 1e-11         # weight of the rates' change beside the miss
FEATURES = ["f_low", "f_toxic", "f_distinct", "f_chars", "f_words"]


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, "toxic").when(quality == 0, "low").when((quality == 1) & (toxic == 0), "high")


def labelled_sample(labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """``doc, domain, half`` of at most ``limit`` labelled ids; half 0 learns the lexicon, half 1 the discriminant."""
    rows = labels.select(F.col("doc_id").alias("doc"), domain_of(F.col("quality"), F.col("toxic")).alias("domain")).filter(
        "doc IS NOT NULL AND domain IS NOT NULL").distinct()
    h = F.xxhash64(F.lit("labelled"), "doc")
    return written(rows.orderBy(h, "doc", "domain").limit(limit).withColumn("half", F.pmod(h, F.lit(2))), "labelled")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))


def learn_lexicon(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``word, w_low, w_toxic``: log ratio of a word's share of a domain's labelled documents to its share of the others', where high."""
    half = sample.filter("half = 0")
    held = _texts(docs).join(F.broadcast(half), "doc").select("domain", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    sizes = {r["domain"]: r["n"] for r in half.groupBy("domain").agg(F.count("*").alias("n")).collect()}  # at most a row per domain
    total = sum(sizes.values())
    counts = held.groupBy("word").agg(F.count("*").alias("n"), *[F.sum((F.col("domain") == d).cast("long")).alias(d) for d in ("low", "toxic")])

    def ratio(d: str) -> Column:
        n = sizes.get(d, 0)
        if not n or n == total:
            return F.lit(0.0)
        inside, outside = (F.col(d) + 0.5) / (n + 1.0), (F.col("n") - F.col(d) + 0.5) / (total - n + 1.0)
        value = F.log(inside / outside)
        return F.when((value > MIN_LOG_RATIO) & (F.col(d) >= MIN_DOCS), value).otherwise(0.0)

    return written(counts.select("word", ratio("low").alias("w_low"), ratio("toxic").alias("w_toxic")).filter("w_low > 0 OR w_toxic > 0"), "lexicon")


def features(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``doc, th, n_tokens`` and FEATURES of each row, written."""
    w = _texts(docs).select("doc", "th", F.length("text").alias("chars"), words(F.col("text")).alias("w")).withColumn("d", F.array_distinct("w"))
    lengths = ["doc", "th", F.size("w").cast("long").alias("n_tokens"), F.size("d").alias("n_distinct"), "chars"]
    # one pass: a marker word keeps every document, lexicon words add their weight
    mark = lexicon.sparkSession.createDataFrame([("\x00", 0.0, 0.0)], "word string, w_low double, w_toxic double")
    known = written(lexicon.union(mark), "lexicon-marked")
    found = w.select(*lengths, F.explode(F.concat("d", F.array(F.lit("\x00")))).alias("word")).join(sized(known), "word")
    # equal (doc, th) are repeated rows of one text: every sum and the marker count it as often
    rows = found.groupBy("doc", "th", "n_tokens", "n_distinct", "chars").agg(
        F.sum("w_low").alias("low"), F.sum("w_toxic").alias("toxic"), F.sum((F.col("word") == "\x00").cast("long")).alias("times"))
    one = F.greatest("n_tokens", F.lit(1))
    return written(rows.select(
        "doc", "th", "n_tokens", "times", F.log1p(F.col("low") / F.col("times")).alias("f_low"), F.log1p(F.col("toxic") / F.col("times")).alias("f_toxic"),
        (F.col("n_distinct") / one).alias("f_distinct"), F.log1p(F.col("chars") / one).alias("f_chars"), F.log1p("n_tokens").alias("f_words")), "features")


def fit_discriminant(feats: DataFrame, sample: DataFrame) -> dict[str, list[float]]:
    """Linear score of each domain (a constant and a weight per feature), from means and the pooled covariance."""
    rows = feats.join(F.broadcast(sample.filter("half = 1")), "doc")
    k = len(FEATURES)
    products = [(a, b) for a in range(k) for b in range(a, k)]
    got = rows.groupBy("domain").agg(F.count("*").alias("n"), *[F.sum(f).alias(f) for f in FEATURES],
                                     *[F.sum(F.col(FEATURES[a]) * F.col(FEATURES[b])).alias(f"{a}_{b}") for a, b in products]).collect()  # a row per domain
    if not got:
        return {}
    means, scatter, total = {}, np.zeros((k, k)), sum(r["n"] for r in got)
    for r in got:
        m = np.array([r[f] for f in FEATURES]) / r["n"]
        s = np.zeros((k, k))
        for a, b in products:
            s[a, b] = s[b, a] = r[f"{a}_{b}"]
        scatter += s - r["n"] * np.outer(m, m)
        means[r["domain"]] = (m, r["n"] / total)
    cov = scatter / max(total - len(got), 1)
    cov += np.eye(k) * (1e-3 * np.trace(cov) / k + 1e-9)
    out = {}
    for d, (m, prior) in means.items():
        w = np.linalg.solve(cov, m)
        out[d] = [float(math.log(prior) - 0.5 * m @ w), *map(float, w)]
    return out


def posteriors(feats: DataFrame, scores: dict[str, list[float]]) -> DataFrame:
    """Adds ``p``: posteriors in the order of DOMAINS."""
    if not scores:
        return feats.withColumn("p", F.array(*[F.lit(1.0 / len(DOMAINS)) for _ in DOMAINS]))
    lin = {d: F.lit(c[0]) + sum(F.lit(w) * F.col(f) for w, f in zip(c[1:], FEATURES)) for d, c in scores.items()}
    top = F.greatest(*lin.values()) if len(lin) > 1 else next(iter(lin.values()))
    e = {d: F.exp(x - top) for d, x in lin.items()}
    total = sum(e.values())
    return feats.withColumn("p", F.array(*[(e[d] / total) if d in e else F.lit(0.0) for d in DOMAINS]))


def find_multipliers(look, aim: np.ndarray, steps: int | None = None, close: float = CLOSE) -> tuple[np.ndarray, np.ndarray, int]:
    """``y`` of the rates max(0, 1 - p . y), the miss that they leave, and how often ``look`` was called (``steps`` at most).

    ``look(y)`` gives, over all documents with the weight of their tokens, half
    the mean squared rate, the domains' shares, and the Gram matrix of those
    with a rate above zero."""
    y = np.zeros(len(aim))
    looks, metric = 0, None

    def at(y):
        nonlocal looks, metric
        looks += 1
        half, shares, gram = look(y)
        metric = gram if metric is None else metric     # of all documents, at y = 0
        drift = SMOOTH * (metric @ y)
        return half + aim @ y + y @ drift / 2, shares - aim - drift, gram, shares - aim

    value, slope, gram, miss = at(y)
    # what no document has posteriors for can't be changed
    reach = np.linalg.pinv(metric, rcond=1e-9) @ metric
    while np.abs(reach @ slope).max() > close / 10 and looks != steps:
        slope = reach @ slope
        move, step = np.linalg.lstsq(gram + SMOOTH * metric, slope, rcond=None)[0], 1.0
        if slope @ move <= 1e-15:
            break
        while looks != steps:
            found = at(y + step * move)
            if found[0] <= value - 1e-4 * step * (slope @ move) or step < 1e-8:
                break
            step /= 4
        if found[0] >= value:
            break
        y = y + step * move
        value, slope, gram, miss = found
    return y, miss, looks


def fit_rates(docs: DataFrame, targets: dict[str, float] = TARGETS, steps: int | None = None, close: float = CLOSE) -> DataFrame:
    """``rate`` for each row of ``docs`` (``n_tokens, times, p``): nonnegative, and the domains' expected tokens in proportion ``targets``.

    ``miss``, the same in all rows, has the share of the total by which each of DOMAINS is off its target.  ``steps`` limits the fit."""
    k = len(DOMAINS)
    n, p = (F.col("n_tokens") * F.col("times")).cast("double"), F.col("p")
    total = docs.agg(F.sum(n).alias("n")).first()["n"]
    if not total:
        return docs.withColumn("rate", F.lit(1.0)).withColumn("miss", F.array(*[F.lit(0.0)] * k))
    aim = np.array([targets.get(d, 0.0) for d in DOMAINS])
    aim = aim / max(aim.sum(), 1e-300)

    def rate(y) -> Column:
        return F.greatest(F.lit(0.0), F.lit(1.0) - sum(p[i] * F.lit(float(v)) for i, v in enumerate(y)))

    def look(y):
        held = docs.select(n.alias("n"), rate(y).alias("r"), "p")
        live = F.when(F.col("r") > 0, F.col("n")).otherwise(0.0)
        got = held.agg(F.sum(F.col("n") * F.col("r") * F.col("r")).alias("half"), *[F.sum(F.col("n") * F.col("r") * p[a]).alias(f"s{a}") for a in range(k)],
                       *[F.sum(live * p[a] * p[b]).alias(f"g{a}{b}") for a in range(k) for b in range(a, k)]).first()
        gram = np.array([[got[f"g{min(a, b)}{max(a, b)}"] for b in range(k)] for a in range(k)])
        return got["half"] / total / 2, np.array([got[f"s{a}"] for a in range(k)]) / total, gram / total

    y, miss, looks = find_multipliers(look, aim, steps, close)
    if np.abs(miss).max() > close:
        warnings.warn(f"targets missed after {looks} steps, by domain: {dict(zip(DOMAINS, miss.round(6).tolist()))}", stacklevel=2)
    off = F.array(*[F.lit(float(x)) for x in miss])
    return written(docs.withColumn("rate", F.when(F.col("n_tokens") > 0, rate(y)).otherwise(1.0)).withColumn("miss", off), "rates")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """``doc, th, n_tokens, times, p, rate, miss`` of each distinct (id, text) of ``docs``; ``times`` is its number of rows, ``miss`` what is left to the targets."""
    sample = labelled_sample(labels)
    feats = features(docs, learn_lexicon(docs, sample))
    known = written(posteriors(feats, fit_discriminant(feats, sample)).select("doc", "th", "n_tokens", "times", "p"), "posteriors")
    return fit_rates(known, targets)


def apply_rates(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """``docs`` with each row repeated floor(rate) times, and once more with the probability of the rest (by hash of id and text)."""
    doc, th, copies = own_names(docs, 3)
    u = F.pmod(F.xxhash64(F.lit("mix"), "doc", "th"), F.lit(1 << 30)) / float(1 << 30)
    times = (F.floor("rate") + (u < F.col("rate") - F.floor("rate")).cast("long")).cast("int")
    r = rates.select(F.col("doc").alias(doc), F.col("th").alias(th), times.alias(copies)).filter(F.col(copies) > 0)
    out = docs.join(r, docs["doc_id"].eqNullSafe(r[doc]) & (F.xxhash64(docs["text"]) == r[th]))
    kept = out.select(*[docs[f"`{c}`"] for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copies))
    return kept.drop(copies)
