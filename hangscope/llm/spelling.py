"""Spelling variant grouping: words one edit apart, found by asymmetric q-chunks.

Words are counted over whole texts.  Two words are near if they differ by one
inserted, deleted or replaced code point; a word's form is its most frequent
near word if that is ``RATIO`` times as frequent.

Join.  Of a pair the shorter word (of equal lengths, either) gives two disjoint
chunks, its halves; the other gives positional grams of the lengths of the
chunks.  One edit touches at most one chunk, so the other chunk is a gram of the longer word,
and its place is shifted by at most one: by nothing before the edit, by the
difference of the lengths after it.  Of all positional grams only those at such
places can meet a chunk, so only those are sent: two chunks and four grams a
word.  Words that share a chunk at its place are compared exactly.

Frequent chunks.  Where a chunk is that of many words, the words agree on that
half and the one edit lies in the other, the open part.  So such a bucket is
split by the same rule: the shorter word's open part gives two chunks, the
longer one's its grams, and the key grows by the chunk they share.  After
log2(length) splits the key is all of the word but one code point, and a
bucket holds at most the words that differ there.  The split loses no pair, so
nothing is capped, and no bucket of more than ``PAIRS`` candidate pairs is
joined before its open part is a single code point.

All of it is DataFrame code: keys are 64-bit hashes of the agreed text and its
place, candidates are checked on the words themselves.

Edge cases: null, empty and wordless texts give no words; a null doc_id counts
as empty text in the checksum; repeated rows count again; other columns are
ignored; an empty table gives an empty result.  Ties go to the smaller word in
code-point order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, written

RUNS = "[A-Za-z\\u00C0-\\u00FF]+"
LENGTH, COUNT, RATIO = 6, 5, 5
SLIP = 199             # one run in so many loses a code point
PAIRS = 20_000         # candidate pairs of a bucket that are compared without splitting it


def slipped(word: Column, doc_id: Column, slip: int = SLIP) -> Column:
    """The word, without one of its code points if ``slip`` divides the checksum of ``<doc_id>:<word>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word))
    at = (h % F.length(word)).cast("int")
    return F.when(h % slip == 0, F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2, F.length(word)))).otherwise(word)


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, count: int = COUNT, slip: int = SLIP) -> DataFrame:
    """``word, n`` of the words of at least ``length`` code points that occur at least ``count`` times."""
    runs = docs.select(F.col(f"`{doc_id}`").alias("d"), F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(RUNS), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= length).select("d", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    words = runs.select(slipped(F.col("run"), F.col("d"), slip).alias("word")).filter(F.length("word") >= length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= count)


# An open word: `word, n, key, at, size`, open part `size` code points from `at` (from 1); the rest is what `key` stands for.
def _part(at: Column, size: Column) -> Column:
    return F.substr(F.col("word"), at, size)


def _opened(open_: DataFrame, is_long: bool) -> DataFrame:
    """The open words below the two chunks of the shorter word's open part (of ``size`` code points; the longer's has ``size + more``)."""
    half, rest = F.floor(F.col("size") / 2).cast("int"), F.ceil(F.col("size") / 2).cast("int")
    more = F.col("more") if is_long else F.lit(0)
    # the first chunk is where it was; the second one is shifted by the difference of the lengths
    first = F.struct(F.xxhash64("key", F.lit(0), _part(F.col("at"), half)).alias("key"), (F.col("at") + half).alias("at"), rest.alias("size"))
    second = F.struct(F.xxhash64("key", F.lit(1), _part(F.col("at") + half + more, rest)).alias("key"), F.col("at").alias("at"), half.alias("size"))
    return open_.withColumn("next", F.explode(F.array(first, second))).select("word", "n", *(["more"] if is_long else []), "next.*")


def _near(short: DataFrame, long: DataFrame) -> DataFrame:
    """``a, na, b, nb`` near words of one bucket."""
    a = short.select("key", F.col("word").alias("a"), F.col("n").alias("na"))
    b = long.select("key", F.col("word").alias("b"), F.col("n").alias("nb"), "more")
    both = a.join(b, "key").filter((F.col("more") == 1) | (F.col("a") < F.col("b")))
    return both.filter(F.levenshtein("a", "b", 1) == 1).select("a", "na", "b", "nb")


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """Each pair of near words once: ``a, na, b, nb`` of ``word, n`` (written; words of at least two code points)."""
    size = F.length("word")
    short = words.select("word", "n", size.cast("long").alias("key"), F.lit(1).alias("at"), size.alias("size"))
    long = words.withColumn("more", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        "word", "n", "more", (size - F.col("more")).cast("long").alias("key"), F.lit(1).alias("at"), (size - F.col("more")).alias("size"))
    found = None
    while True:
        short, long = _opened(short, False), _opened(long, True)
        load = short.groupBy("key").agg(F.count("*").alias("s"), F.max("size").alias("left")).join(
            long.groupBy("key").agg(F.count("*").alias("l")), "key")
        crowded = written(load.filter((F.col("s") * F.col("l") > pairs) & (F.col("left") > 1)).select("key"), "crowded")
        some = not crowded.isEmpty()
        near = _near(short.join(crowded, "key", "left_anti"), long.join(crowded, "key", "left_anti")) if some else _near(short, long)
        found = near if found is None else found.union(near)
        if not some:
            return found.distinct()
        short, long = (written(x.join(crowded, "key", "left_semi"), "open") for x in (short, long))


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """``word, root`` of ``word, form``: the end of each chain of at most ``steps`` forms, which doubles what it follows in each round."""
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(steps, 1)))):
        now = written(now, "roots")
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return now


def variants(words: DataFrame, ratio: int = RATIO, pairs: int = PAIRS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ``word, n``."""
    words = written(words.select("word", "n"), "words")
    found = written(near_pairs(words, pairs), "near-words")
    both = found.union(found.select("b", "nb", "a", "na"))
    best = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("nb")).alias("n"), F.col("b").alias("word"))).alias("best"))
    frequent = -F.col("best.n") >= ratio * F.col("n")
    told = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.word")).alias("form"), F.when(frequent, -F.col("best.n")).alias("form_n")), "forms")
    # a form is at least `ratio` times as frequent, which bounds the chains
    most, least = told.agg(F.max("n"), F.min("n")).first()
    steps = 1 + int(math.log(most / least, ratio)) if most else 0
    ends = roots(told.filter("form is not null"), steps)
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of ``docs``."""
    return variants(word_counts(docs))


ORACLE = """
with recursive
steps(i, k, c) as (
  select i, 0, i from range(256) t(i) union all
  select i, k + 1, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end from steps where k < 8),
crc as (select list(c order by i) as t from steps where k = 8),
runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')) as run from documents)
  where length(run) >= 6 group by all),
hashed as (
  select run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, strlen(s) + 1), lambda i: ('0x' || substr(hex(encode(s)), 2 * i - 1, 2))::bigint)),
    lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1]))) as h
  from (select run, n, coalesce(cast(doc_id as varchar), '') || ':' || run as s from runs), crc),
slip as (
  select case when h % 199 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n from hashed),
words as (select word, cast(sum(n) as bigint) as n from slip where length(word) >= 6 group by word having sum(n) >= 5),
cut as (
  select word, n, i, substr(word, 1, i - 1) as pre, substr(word, i + 1) as post from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
found as (
  select x.word as a, x.n as na, y.word as b, y.n as nb from cut x join cut y using (i, pre, post) where x.word <> y.word union
  select x.word, x.n, w.word, w.n from cut x join words w on x.pre || x.post = w.word union
  select w.word, w.n, x.word, x.n from cut x join words w on x.pre || x.post = w.word),
best as (select a as word, count(*) as n_near, max(nb) as bn from found group by a),
form as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, f.b as form, f.nb as form_n from words w left join best using (word) left join (
    select a, na, min(b) as b, nb from found join best on a = word and nb = bn group by a, na, nb) f on w.word = f.a and f.nb >= 5 * f.na),
chain(word, root) as (
  select word, word from form union all
  select c.word, f.form from chain c join form f on c.root = f.word where f.form is not null)
select word, form, root, n, n_near, form_n from form join (select c.word, c.root from chain c join form f on c.root = f.word where f.form is null) using (word)
"""
