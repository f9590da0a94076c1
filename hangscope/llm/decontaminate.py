"""Benchmark decontamination with a distributed positional inverted index.

Test items are cut into windows of consecutive words.  The rarest terms of each
window over the training corpus are its anchors.  One pass over the corpus
stores the postings of all anchors (term, document, position) as a table.
Candidate starts of a window are the offset-adjusted postings of its rarest
anchor, intersected with those of the next; the window's other words are then
compared at each surviving start in the document, so a match is exact.
``proximity_matches`` takes the same lists with a slack in place of equality.

DataFrame functions only.  What grows with the corpus: two passes over the texts
(term counts, pre-aggregated; postings of anchors), a third over the documents
with candidates, and shuffles of anchor postings, which are rare by choice.
Whole texts are shuffled only if candidate documents are more than
``BROADCAST_ROWS``.  The vocabulary and the anchors of the test items, and the
keys of candidate documents, are broadcast only after their rows have been
counted and are at most ``BROADCAST_ROWS``; beyond that they are joined by
shuffle, where adaptive execution splits frequent terms.

A document is identified by its id and text hash.  Edge cases: null, empty and
wordless texts and items have no words, no windows and no hits; an item of
fewer words than a window is one window; equal windows of several items are
matched once and count for each item; a null item id marks hits but is not
listed among items; repeated rows give repeated result rows; a null doc_id is
kept.  Empty tables give no hits.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import words, written

WINDOW = 10
ANCHORS = 2
BROADCAST_ROWS = 200_000
LENGTH_TERM = "\x00"   # not a word: its one posting in a document holds the number of words


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The (written) table, to be broadcast if it has been counted as small."""
    return F.broadcast(df) if df.count() <= limit else df


def corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, th, text``: id, hash of the text, text."""
    t = F.col(f"`{text}`")
    return docs.select(F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(t).alias("th"), t.alias("text"))


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (``win, terms``) and which items have them (``win, item``)."""
    ws = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), words(F.col(f"`{text}`")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = ws.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("terms"))
    cut = written(cut.distinct(), "item-windows")
    wins = written(cut.select("terms").distinct().select(F.monotonically_increasing_id().alias("win"), "terms"), "windows")
    return wins, cut.join(wins, "terms").select("win", "item")


def tokens(texts: DataFrame) -> DataFrame:
    """``doc, th, pos, term`` of every word, and the length posting."""
    return texts.select("doc", "th", F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(LENGTH_TERM)))).alias("pos", "term"))


def term_counts(texts: DataFrame, wins: DataFrame) -> DataFrame:
    """``term, n``: places in the corpus of each term of the windows."""
    vocabulary = written(wins.select(F.explode("terms").alias("term")).distinct(), "vocabulary")
    return written(tokens(texts).join(sized(vocabulary), "term").groupBy("term").agg(F.count("*").alias("n")), "term-counts")


def anchors(wins: DataFrame, counts: DataFrame, k: int = ANCHORS) -> DataFrame:
    """``win, rank, term, off``: the k rarest terms of each window all of whose terms occur, with an offset in the window."""
    spots = wins.select("win", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "term")).join(counts, "term")
    by_win = W.partitionBy("win")
    ranked = spots.withColumn("known", F.count("*").over(by_win)).filter("known = len").withColumn(
        "rank", F.row_number().over(by_win.orderBy("n", "off")))
    return written(ranked.filter(F.col("rank") <= k).select("win", "rank", "term", "off"), "anchors")


def build_postings(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: ``doc, th, pos, term`` of the given terms, and each document's length posting."""
    wanted = written(terms.select("term").union(terms.sparkSession.createDataFrame([(LENGTH_TERM,)], "term string")).distinct(), "anchor-terms")
    return written(tokens(texts).join(sized(wanted), "term"), "postings")


def starts(postings: DataFrame, anchor: DataFrame) -> DataFrame:
    """``doc, th, win, start``: offset-adjusted postings of one anchor of each window."""
    return postings.join(sized(anchor), "term").select("doc", "th", "win", (F.col("pos") - F.col("off")).alias("start")).filter("start >= 0")


def _same_doc(a: DataFrame, b: DataFrame):
    return a["doc"].eqNullSafe(b["doc"]) & (a["th"] == b["th"])


def phrase_matches(texts: DataFrame, wins: DataFrame, postings: DataFrame, anchor: DataFrame, k: int = ANCHORS) -> DataFrame:
    """``doc, th, start, len, win`` of every place where a window's words stand in a row."""
    found = starts(postings, anchor.filter("rank = 1").select("win", "term", "off")).distinct()
    for rank in range(2, k + 1):
        more = starts(postings, anchor.filter(f"rank = {rank}").select("win", "term", "off"))
        # windows of fewer words have fewer anchors
        few = anchor.groupBy("win").agg(F.max("rank").alias("most")).filter(f"most < {rank}").select("win")
        more = more.unionByName(found.join(F.broadcast(few) if few.count() <= BROADCAST_ROWS else few, "win", "left_semi"))
        on = found["doc"].eqNullSafe(more["doc"]) & (found["th"] == more["th"]) & (found["win"] == more["win"]) & (found["start"] == more["start"])
        found = found.join(more, on, "left_semi")
    found = found.join(sized(wins), "win").select("doc", "th", F.struct("start", "win", "terms").alias("c"))
    # candidates of one text: at most its length times the windows that share their rarest terms
    per_doc = written(found.groupBy("doc", "th").agg(F.collect_list("c").alias("cs")), "candidates")
    keys = per_doc.select("doc", "th")
    few = sized(keys)
    held = texts.join(few, _same_doc(texts, few), "left_semi")
    held = held.select("doc", "th", words(F.col("text")).alias("w")).dropDuplicates(["doc", "th"])
    hits = F.filter("cs", lambda c: F.slice(F.col("w"), c["start"] + 1, F.size(c["terms"])) == c["terms"])
    checked = held.join(per_doc, _same_doc(held, per_doc)).select(held["doc"], held["th"], F.explode(hits).alias("c"))
    return checked.select("doc", "th", F.col("c.start").alias("start"), F.size("c.terms").alias("len"), F.col("c.win").alias("win"))


def proximity_matches(postings: DataFrame, anchor: DataFrame, slack: int) -> DataFrame:
    """``doc, th, win, start, shift``: places where a window's two rarest terms stand within ``slack`` words of their distance in it."""
    width = slack + 1
    first, second = (starts(postings, anchor.filter(f"rank = {r}").select("win", "term", "off")).distinct() for r in (1, 2))
    cell = F.floor(F.col("start") / width)
    left = first.select("*", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    right = second.select(F.col("doc").alias("d2"), F.col("th").alias("t2"), F.col("win").alias("w2"), F.col("start").alias("s2"), cell.alias("cell2"))
    on = (F.col("doc").eqNullSafe(F.col("d2"))) & (F.col("th") == F.col("t2")) & (F.col("win") == F.col("w2")) & (F.col("cell") == F.col("cell2"))
    near = left.join(right, on).filter(F.abs(F.col("s2") - F.col("start")) <= slack)
    return near.select("doc", "th", "win", "start", (F.col("s2") - F.col("start")).alias("shift")).distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc, th, n_words, n_hit, n_items, items_sha256``, a row per row of ``docs``."""
    texts = corpus(docs, doc_id, text)
    wins, of_item = item_windows(items, item_id, item_text, window)
    anchor = anchors(wins, term_counts(texts, wins))
    postings = build_postings(texts, anchor)
    matches = written(phrase_matches(texts, wins, postings, anchor), "matches")

    # words inside any match: each match adds what lies beyond the matches before it
    spans = matches.select("doc", "th", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    earlier = W.partitionBy("doc", "th").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(earlier), F.lit(0))))
    n_hit = spans.select("doc", "th", fresh.alias("fresh")).groupBy("doc", "th").agg(F.sum("fresh").alias("n_hit"))
    listed = (matches.select("doc", "th", "win").distinct().join(sized(written(of_item, "window-items")), "win")
              .groupBy("doc", "th").agg(F.array_sort(F.collect_set("item")).alias("found")))
    lengths = postings.filter(F.col("term") == LENGTH_TERM).select("doc", "th", F.col("pos").cast("long").alias("n_words"))
    hits = n_hit.join(listed, n_hit["doc"].eqNullSafe(listed["doc"]) & (n_hit["th"] == listed["th"]), "left").select(n_hit["doc"], n_hit["th"], "n_hit", "found")
    hits = hits.select(F.col("doc").alias("d2"), F.col("th").alias("t2"), "n_hit", "found")
    out = lengths.join(hits, F.col("doc").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("t2")), "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return out.select("doc", "th", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(found).cast("long").alias("n_items"),
                      F.sha2(F.array_join(found, ","), 256).alias("items_sha256"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` without any hit; all columns."""
    bad = contamination(docs, items).filter("n_hit > 0").select(F.col("doc").alias("_doc"), F.col("th").alias("_th")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_doc"]) & (F.xxhash64(docs["text"]) == bad["_th"]), "left_anti")


ORACLE = r"""
WITH cut(s, t) AS (VALUES ('ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')),
d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), s, t), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents, cut),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''), s, t), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark, cut),
bi AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS phrase FROM bi),
lens AS (SELECT DISTINCT n FROM win),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM di),
hit AS (SELECT g.doc_id, g.n, g.i, win.item FROM grams g JOIN win ON g.phrase = win.phrase AND g.n = win.n),
places AS (SELECT DISTINCT doc_id, n, i FROM hit),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM places) GROUP BY 1),
hi AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
