"""URL filters: host rules, and a character language-model ratio for the rest.

Rules name a host (and all its subdomains) and a path start; the longest that
fits decides.  The urls that rules accept and reject train two smoothed
variable-order Markov models over characters (Witten-Bell interpolation, up to
``ORDER`` characters).  Every other url gets the difference of its two
log-likelihoods per character, over the whole url with its scheme, query and
fragment; it is accepted at or above a threshold.  That is calibrated on a
held-out fifth of the ruled urls, which did not train the models: of ``BINS``
cuts over the range of their scores the one with the least sum of the shares of
accepted urls below it and rejected ones above (the middle one of equals).

DataFrame functions only.  Urls are pre-aggregated to distinct ones
with their counts; all rows count in training.  Characters fall into a fixed
alphabet of ``SYMBOLS``, so the models together have at most
SYMBOLS^1 + ... + SYMBOLS^ORDER rows whatever the corpus; they are broadcast
only if counted at ``BROADCAST_ROWS`` or less, and joined by shuffle beyond.

Edge cases: a null url (judged like an empty one), or one without ``://``, has
an empty host and path and no rule; two rules of one length: the first in the list; when training lacks
accepted or rejected urls, nothing can be told and the verdict is allow; a
symbol that training never saw says nothing; repeated rows get equal verdicts;
other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, written

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
ORDER = 4
ALPHABET = "abcdefghijklmnopqrstuvwxyz0./-_%~:?#=&+"      # 0 stands for any digit, * for all other characters
SYMBOLS = len(ALPHABET) + 2   # that are predicted: the alphabet, * and the end mark $; ^ marks the start
BINS = 512
BROADCAST_ROWS = 300_000
HELD_OUT = 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(raw), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule that decides (like ``net/``) and its verdict; nulls if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in reversed(sorted(rules, key=lambda r: -len(r[1] + r[2]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def normal(url: Column) -> Column:
    """The url in the models' alphabet, with its ends marked."""
    text = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"[0-9]", "0")
    return F.concat(F.lit("^" * (ORDER - 1)), F.regexp_replace(text, f"[^{re.escape(ALPHABET)}]", "*"), F.lit("$"))


def _spots(urls: DataFrame) -> DataFrame:
    """A row per character to predict (``i`` is its place in ``s``)."""
    return urls.withColumn("i", F.explode(F.sequence(F.lit(ORDER), F.length("s"))))


def _gram(end: Column, k: int) -> Column:
    return F.substring(F.col("s"), end - (k - 1), F.lit(k))


def train(urls: DataFrame) -> DataFrame:
    """The model from ``s, verdict, n``: ``gram, dp`` (log ratio of its last character's two probabilities after the others) and
    ``db`` (log ratio of the two weights left to shorter contexts after it, as a context)."""
    grams = _spots(urls).select("verdict", "n", F.explode(F.array(*[_gram(F.col("i"), k) for k in range(1, ORDER + 1)])).alias("gram"))
    of = lambda v: F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v)
    counts = written(grams.groupBy("gram").agg(of("allow"), of("block")), "gram-counts")
    context = F.expr("left(gram, length(gram) - 1)").alias("ctx")
    totals = written(counts.groupBy(context).agg(
        *[F.sum(v).alias(f"n_{v}") for v in ("allow", "block")], *[F.sum((F.col(v) > 0).cast("long")).alias(f"t_{v}") for v in ("allow", "block")]), "contexts")

    def weight(v: str) -> Column:   # left to the shorter context; all of it where the class never saw the context
        return F.when(F.col(f"n_{v}") > 0, F.col(f"t_{v}") / (F.col(f"n_{v}") + F.col(f"t_{v}"))).otherwise(F.lit(1.0))

    def own(v: str) -> Column:
        return F.when(F.col(f"n_{v}") > 0, F.col(v) / (F.col(f"n_{v}") + F.col(f"t_{v}"))).otherwise(F.lit(0.0))

    levels, shorter = [], None
    for k in range(1, ORDER + 1):
        at = counts.filter(F.length("gram") == k).withColumn("ctx", context).join(totals, "ctx")
        if shorter is None:
            at = at.withColumn("q_allow", F.lit(1.0 / SYMBOLS)).withColumn("q_block", F.lit(1.0 / SYMBOLS))
        else:
            at = at.withColumn("suffix", F.expr("right(gram, length(gram) - 1)")).join(shorter, "suffix")
        at = at.select("gram", *[(own(v) + weight(v) * F.col(f"q_{v}")).alias(f"p_{v}") for v in ("allow", "block")])
        levels.append(at)
        shorter = at.select(F.col("gram").alias("suffix"), F.col("p_allow").alias("q_allow"), F.col("p_block").alias("q_block"))
    probs = levels[0]
    for more in levels[1:]:
        probs = probs.union(more)
    backoff = totals.select("ctx", (F.log(weight("allow")) - F.log(weight("block"))).alias("db"))
    model = probs.join(backoff, F.col("gram") == F.col("ctx"), "full")
    return written(model.select(F.coalesce("gram", "ctx").alias("gram"), (F.log("p_allow") - F.log("p_block")).alias("dp"), "db"), "url-model")


def score(urls: DataFrame, model: DataFrame) -> DataFrame:
    """``s, score`` of distinct normalised urls: mean log ratio per character."""
    small = model.count() <= BROADCAST_ROWS
    at = _spots(urls.select("s").distinct())
    for k in range(1, ORDER + 1):
        p = model.filter("dp IS NOT NULL").select(F.col("gram").alias(f"g{k}"), F.col("dp").alias(f"p{k}")).filter(F.length(f"g{k}") == k)
        at = at.withColumn(f"g{k}", _gram(F.col("i"), k)).join(F.broadcast(p) if small else p, f"g{k}", "left").drop(f"g{k}")
        if k < ORDER:
            b = model.filter("db IS NOT NULL").select(F.col("gram").alias(f"h{k}"), F.col("db").alias(f"b{k}")).filter(F.length(f"h{k}") == k)
            at = at.withColumn(f"h{k}", _gram(F.col("i") - 1, k)).join(F.broadcast(b) if small else b, f"h{k}", "left").drop(f"h{k}")
    d = F.coalesce("p1", F.lit(0.0))
    for k in range(2, ORDER + 1):
        d = F.coalesce(F.col(f"p{k}"), F.coalesce(f"b{k - 1}", F.lit(0.0)) + d)
    # rounded so that the order of summation can't move a verdict
    return at.select("s", d.alias("d")).groupBy("s").agg(F.round(F.avg("d"), 9).alias("score"))


def threshold(scored: DataFrame) -> float | None:
    """The cut that separates held-out accepted and rejected urls (``verdict, n, score``) best; None if either lacks."""
    of = lambda v: F.sum(F.when(F.col("verdict") == v, F.col("n"))).alias(v)
    row = scored.agg(of("allow"), of("block"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    if row["allow"] is None or row["block"] is None:
        return None
    width = (row["hi"] - row["lo"]) / BINS
    bins = scored.groupBy((F.floor((F.col("score") - row["lo"]) / width) if width else F.lit(0)).alias("bin")).agg(of("allow"), of("block")).collect()
    counts = {r["bin"]: (r["allow"] or 0, r["block"] or 0) for r in bins}     # BINS + 1 rows at most
    below, above, errors = 0, row["block"], []
    for cut in range(BINS + 1):
        errors.append(below / row["allow"] + above / row["block"])
        allowed, blocked = counts.get(cut, (0, 0))
        below, above = below + allowed, above - blocked
    best = [cut for cut, e in enumerate(errors) if e <= min(errors) + 1e-12]
    return round(row["lo"] + best[len(best) // 2] * width, 9)


def judge(pages: DataFrame, id_col: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """``id, host, path, rule, verdict, score`` of each row; score is null where a rule decides."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url"))
    host, path = host_and_path(F.col("url"))
    name, verdict = rule_of(host, path, rules)
    keys = rows.groupBy("url").agg(F.count("*").alias("n"))
    keys = written(keys.select("url", "n", verdict.alias("verdict"), normal(F.col("url")).alias("s")), "urls")
    held = F.crc32("s") % HELD_OUT == 0
    told = keys.filter("verdict IS NOT NULL").select("s", "verdict", "n", held.alias("held"))
    model = train(told.filter("NOT held"))
    scores = written(score(keys.filter(F.col("verdict").isNull() | held), model), "url-scores")
    limit = threshold(told.filter("held").join(scores, "s"))
    by_score = F.lit("allow") if limit is None else F.when(F.col("score") < limit, "block").otherwise("allow")
    unruled = keys.filter("verdict IS NULL").join(scores, "s").select("url", "score", by_score.alias("v"))
    out = rows.join(unruled, "url", "left")
    return out.select("id", host.alias("host"), path.alias("path"), name.alias("rule"), F.coalesce(verdict, F.col("v")).alias("verdict"), "score")
