"""N-gram Jaccard join by chosen paths.

Documents become sets of word shingles.  In each of several runs a set picks
about ``FIRST`` of its shingles by a shared hash; sets that pick the same
shingle meet in a bucket.  A bucket of at most ``SMALL`` sets is compared by
brute force inside its task; a larger one is split again: its sets pick about
``NEXT`` further shingles by a hash that depends on the path so far, and so
on.  ``NEXT`` is 1 / similarity, so paths of less similar sets die out.  A pair
of similarity s or more shares a path in a run with a probability that depends
only on s and the two rates; ``runs_for`` gives the runs that reach the target
recall for a pair that only meets in buckets that must be split to the last
level.  A pair that shares shingles found in at most ``SMALL`` sets is missed
with a probability below 1e-6.

Dense buckets.  Of a set's picks at most the share ``1 - similarity`` misses a
given similar set, in expectation and independently of each other.  So a set
with so many picks in small buckets that all of them missing a partner has a
probability below ``MISS`` has met its partners there, whatever its other picks
are: a passage or line that many documents share doesn't send them on.  Only
sets that lie mostly in large buckets go on (a pair needs one of its sets to
be done).  In a bucket that is too large, each of those is first compared with
one set of it, the pivot: the one that shares the most, over all large buckets,
with others, which in a group of near copies is the text they stem from.  Then
the sets' groups are worked out from all links so far; sets of one group are
not compared again, and a bucket whose sets are all of one group ends.  So a
group of any number of near copies costs a few comparisons per member, not one
per pair.  Once the pairs of different groups left in large buckets are at most
``WORK`` times the sets (about the cost of hashing them), or after ``LEVELS``
splits, they are compared exactly, in blocks.  Until then large buckets are cut
by set size, since similar sets are of similar size, and split as above.

Every reported link is exact: candidates are first sifted by odd sketches (a
bit per bin tells whether an odd number of shingles falls into it, so the bits
in which two sketches differ count the shingles in which their sets do; a pair
at the threshold is lost with a probability of 3e-5), then compared on 64-bit
shingle sets.  Sets are built again from the texts only for candidates.
Documents with equal sets are one class before anything else, so exact copies
never meet.

Result: a row per document with the id of its group (connected documents, the
smallest id) and its number of links: documents with an equal set plus those
of the sets it is linked with.  In buckets of more than ``SMALL`` sets only links that
connect sets not yet known to be of one group are looked for; so the groups that
such buckets touch, unless all their pairs are links already, are counted again
at the end: all pairs of a group on their sets, block by block, and only a sum
per set leaves a task.  That costs a group's pairs in comparisons and its size
over ``COUNTED`` in sendings of each set.

Edge cases: a text of fewer words than a shingle is one shingle of all its
words; null, empty and wordless texts have no set, no links and are groups of
their own; a null doc_id joins groups but never names one unless all are null
(class_id null); repeated rows are copies of each other.  Other columns are
ignored.  Empty tables give empty results.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_BYTES, arrow_rows, map_arrow, own_names, written

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.99
FIRST, NEXT = 3.0, 1.25
SMALL, LEVELS = 256, 3
BLOCK = 2048           # sets of a large bucket compared at a time with as many others
COUNTED = 512          # sets of a group whose partners are counted at a time with as many others
SHINGLES = 1 << 20     # that such sets hold, about
BITS = 1024            # of a sketch
WORK = 3000            # pairs per set that may be left to the blocks
MISS = 1e-4            # probability that a set which leaves large buckets misses a partner
PICKS = 128            # counts of picks that are looked up
PAIRS = 1 << 17        # sketch pairs compared at a time
PIECE = 1 << 18        # bytes hashed at a time
TEXTS = 1000           # texts worked on at a time
SETS = 64              # sets, or pairs of them, sent to a Python worker at a time
BROADCAST_ROWS = 200_000

_U = np.uint64
_TABLE = np.random.default_rng(20_240_501).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_B = 0x9E3779B97F4A7C15
_POW: dict[str, np.ndarray] = {}
_FEW = re.compile(rb" *(?:[^ ]+ +){0,%d}" % (SHINGLE - 1))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _seed(*parts: int) -> np.uint64:
    x = np.zeros(1, np.uint64)
    for p in parts:
        x = mix(x + _U((p + 1) * _B & (1 << 64) - 1))
    return x[0]


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0 ** -53


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("up", ())) < n:
        size = max(n, 2 * PIECE)
        for name, b in (("up", _B), ("down", pow(_B, -1, 1 << 64))):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _POW[name] = np.cumprod(steps, dtype=np.uint64)
    return _POW["up"], _POW["down"]


def _hash_piece(buf: bytes, bounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of texts that lie at ``bounds`` in ``buf`` (words, gaps of spaces, a space at each end), and their text."""
    arr = np.frombuffer(buf, np.uint8)
    word = arr != 32
    edge = np.diff(word.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keep = word.copy()
    keep[ends] = True  # one gap byte after each word
    at = np.cumsum(keep) - keep
    starts_c, ends_c = at[starts], at[ends]
    up, down = _powers(int(at[-1]) + 2)
    kept = arr[keep]
    prefix = np.zeros(len(kept) + 1, np.uint64)
    np.cumsum(_TABLE[kept] * up[:len(kept)], out=prefix[1:])
    text = np.searchsorted(np.asarray(bounds), starts, side="right") - 1
    n_words = np.bincount(text, minlength=len(bounds))
    first = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    rank = np.arange(len(starts)) - first[text]
    short = n_words[text]
    head = np.where(short >= SHINGLE, rank + SHINGLE <= short, rank == 0)
    i = np.flatnonzero(head)
    last = np.minimum(i + SHINGLE, first[text[i]] + short[i]) - 1
    h = mix((prefix[ends_c[last]] - prefix[starts_c[i]]) * down[starts_c[i]])
    return h, text[i]


def shingle_sets(texts: list) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out: list = [np.empty(0, np.uint64)] * len(texts)
    group, bounds, owners, size = [], [], [], 0

    def flush():
        if group:
            h, t = _hash_piece(b" " + b"".join(group), bounds)
            cuts = np.searchsorted(t, np.arange(1, len(owners)))
            for i, part in zip(owners, np.split(h, cuts)):
                out[i] = np.unique(part)
            for x in (group, bounds, owners):
                x.clear()

    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8").translate(WORD_BYTES) + b" "
        if len(data) > PIECE:
            out[i] = _long_set(data)
            continue
        if size + len(data) > PIECE:
            flush()
            size = 0
        bounds.append(size + 1)
        group.append(data)
        owners.append(i)
        size += len(data)
    flush()
    return out


def _long_set(data: bytes) -> np.ndarray:
    """A long text in pieces; each reaches SHINGLE - 1 words into the next, so every shingle is in one of them."""
    if len(data.split(None, SHINGLE)) < SHINGLE:
        return np.unique(_hash_piece(b" " + data, [0])[0])
    parts, at = [], 0
    while at < len(data):
        end = data.find(b" ", min(at + PIECE, len(data) - 1))
        piece = data[at:_FEW.match(data, end).end()]
        if len(piece.split(None, SHINGLE)) >= SHINGLE:  # else no shingle starts here
            parts.append(np.unique(_hash_piece(b" " + piece + b" ", [0])[0]))
        at = end + 1
    return np.unique(np.concatenate(parts))


def runs_for(recall: float, similarity: float, first: float = FIRST, nxt: float = NEXT, levels: int = LEVELS) -> int:
    """Runs after which a pair of the similarity has shared a bucket at every level with probability ``recall``."""
    gone = 0.0
    for _ in range(levels):
        gone = math.exp(-nxt * similarity * (1 - gone))
    miss = math.exp(-first * similarity * (1 - gone))
    return max(1, math.ceil(math.log(1 - recall) / math.log(miss)))


def picks_to_be_done(picks: int, similarity: float, miss: float) -> int:
    """How many of its ``picks`` a set must have in small buckets, so that all of those miss a similar set with a probability of ``miss`` at most.

    Each pick is shared by the other set with a probability of at least the
    similarity: the larger set's picks are all picked by the smaller one if
    that holds the shingle, and the smaller one's at the ratio of their sizes."""
    tail = 0.0
    for t in range(picks, 0, -1):
        tail += math.comb(picks, t) * (1 - similarity) ** t * similarity ** (picks - t)
        if tail > miss:
            return t + 1
    return 1


def _sketch(s: np.ndarray) -> bytes:
    """For each of BITS bins whether an odd number of the hashes falls into it."""
    return np.packbits(np.bincount((mix(s ^ _U(0x5BF03635)) % _U(BITS)).astype(np.int64), minlength=BITS) & 1 == 1).tobytes()


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def _picks(s: np.ndarray, seed: np.uint64, rate: float) -> np.ndarray:
    """The nodes of the shingles that the set picks under the path ``seed``."""
    chosen = s[_unit(mix(s ^ seed)) * len(s) < rate]
    return mix(chosen + _U(int(seed) * 3 & (1 << 64) - 1))


def read_sets(docs: DataFrame, doc_id: str, text: str, runs: int) -> DataFrame:
    """``doc, th, n, k1, k2, nodes, sketch`` of each row: set size, 128-bit identity of the set, its nodes, its sketch."""
    t = F.col(f"`{text}`")
    src = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(t).alias("th"), t.alias("text"))
    schema = T.StructType([src.schema["doc"], T.StructField("th", T.LongType()), T.StructField("n", T.LongType()), T.StructField("k1", T.LongType()),
                           T.StructField("k2", T.LongType()), T.StructField("nodes", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])
    seeds = [_seed(r) for r in range(runs)]

    def run(batches):
        for b in (b.slice(k, TEXTS) for b in batches for k in range(0, b.num_rows, TEXTS)):
            sets = shingle_sets(b.column(2).to_pylist())
            keys = [[int(np.add.reduce(mix(s + _U(k))).astype(np.int64)) if len(s) else 0 for s in sets] for k in (1, 2)]
            nodes = [np.concatenate([_picks(s, seed, FIRST) for seed in seeds]).astype(np.int64) for s in sets]
            flat = pa.array(np.concatenate(nodes) if nodes else np.empty(0, np.int64))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in nodes])]).astype(np.int32)
            yield [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(k, pa.int64()) for k in keys),
                   pa.ListArray.from_arrays(pa.array(ends), flat), pa.array([_sketch(s) for s in sets], pa.binary())]

    return map_arrow(src, run, schema)


def build_sets(docs: DataFrame, doc_id: str, text: str, need: DataFrame) -> DataFrame:
    """``cid, toks`` (raw sorted hashes) of the classes in ``need`` (``cid, doc, th``: one row holding each)."""
    t = F.col(f"`{text}`")
    src = docs.select(F.col(f"`{doc_id}`").alias("d"), F.xxhash64(t).alias("t"), t.alias("text"))
    few = F.broadcast(need) if need.count() <= BROADCAST_ROWS else need
    held = src.join(few, src["d"].eqNullSafe(need["doc"]) & (src["t"] == need["th"])).select("cid", "text")
    schema = T.StructType([T.StructField("cid", T.LongType()), T.StructField("toks", T.BinaryType())])

    def run(batches):
        for b in (b.slice(k, TEXTS) for b in batches for k in range(0, b.num_rows, TEXTS)):
            yield [b.column(0), pa.array([s.tobytes() for s in shingle_sets(b.column(1).to_pylist())], pa.binary())]

    return map_arrow(held, run, schema).dropDuplicates(["cid"])


def _alike(sa: np.ndarray, sb: np.ndarray, na: np.ndarray, nb: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs of sketches and set sizes allow the similarity: bits that differ, against the mean plus four deviations at the threshold."""
    bits = np.bitwise_count(sa ^ sb).sum(1, dtype=np.int64)
    d = (na + nb) * ((1 - similarity) / (1 + similarity))     # most shingles that two such sets differ in
    mean = BITS / 2 * (1 - np.exp(-2 * d / BITS))
    deviation = np.sqrt(np.maximum(BITS / 4 * (1 - np.exp(-4 * d / BITS)) - d * np.exp(-4 * d / BITS), 0.25))
    return (bits <= mean + 4 * deviation + 1) & (np.minimum(na, nb) >= similarity * np.maximum(na, nb) - 1e-9)


PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def plausible(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``a, b`` whose sizes and sketches allow the similarity."""
    one = classes.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = classes.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ok = pa.array(_alike(_sketches(b.column(2)), _sketches(b.column(3)), b.column(4).to_numpy(), b.column(5).to_numpy(), similarity))
            yield [b.column(0).filter(ok), b.column(1).filter(ok)]

    return map_arrow(pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb", "na", "nb"), run, PAIR)


def box_pairs(rows: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Plausible pairs ``node, a, bs`` within buckets (``node, cid, root, n``) of sets of different groups.

    Buckets are bounded by the caller; the pairs compared never leave the
    task, and a pair is given out only by the first of the buckets it shares."""
    src = _with_nodes(rows, classes).select(F.explode("nodes").alias("node"), "cid", "root", "n", "sketch", "nodes")
    return _compare(src.withColumn("home", F.col("node")).withColumn("side", F.col("cid")), similarity)


def single(boxed: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of lists of partners."""
    each = boxed.select("a", F.explode("bs").alias("b"))
    return each.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _with_nodes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``cid, root, n, nodes, sketch``: each set once, with all its buckets."""
    return rows.groupBy("cid", "root", "n").agg(F.collect_list("node").alias("nodes")).join(classes.select("cid", "sketch"), "cid")


def _compare(src: DataFrame, similarity: float) -> DataFrame:
    """``node, a, bs``: pairs of rows of one ``node`` and different ``side`` as lists of partners, given out where their ``home`` is the
    first of the buckets (``nodes``) that both sets are in."""

    def pairs(node, cid, root, n, home, side, sketch, nodes, whole):
        """Pairs of the complete buckets, and the number of rows that belong to them."""
        edge = np.flatnonzero(np.diff(node)) + 1
        done = len(node) if whole else (int(edge[-1]) if len(edge) else 0)
        ends = np.concatenate([edge, [len(node)]])
        partners = (ends[np.searchsorted(ends, np.arange(done), side="right")] - np.arange(done) - 1) if done else np.empty(0, np.int64)
        out, at = [], 0
        while at < done:
            to = min(done, at + max(1, int(np.searchsorted(np.cumsum(partners[at:]), PAIRS, side="right"))))
            c = partners[at:to]
            i = np.repeat(np.arange(at, to), c)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
            ok = (root[i] != root[j]) & (side[i] != side[j]) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9)
            i, j = i[ok], j[ok]
            ok = _alike(sketch[i], sketch[j], n[i], n[j], similarity)
            i, j = i[ok], j[ok]
            ok = np.array([home[x] == min(nodes[x] & nodes[y]) for x, y in zip(i.tolist(), j.tolist())], bool)
            i, j = i[ok], j[ok]
            if len(i):      # i ascends, so a set's partners are neighbours
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(i)) + 1])
                out.append([pa.array(node[i[cuts]]), pa.array(cid[i[cuts]]),
                            pa.ListArray.from_arrays(pa.array(np.append(cuts, len(i)).astype(np.int32)), pa.array(cid[j]))])
                # partners get rows too, with no partners of their own, so that "a" names every set of a box
                others = np.unique(np.stack([node[j], cid[j]], 1), axis=0)
                out.append([pa.array(others[:, 0]), pa.array(others[:, 1]), pa.array([[]] * len(others), pa.list_(pa.int64()))])
            at = to
        return out, done

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            nodes = np.array([*map(frozenset, b.column(7).to_pylist()), None], object)[:-1]
            new = [*(b.column(i).to_numpy() for i in range(6)), _sketches(b.column(6)), nodes]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            out, done = pairs(*held, False)
            held = [x[done:] for x in held]
            yield from out
        if held is not None and len(held[0]):
            yield from pairs(*held, True)[0]

    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("a", T.LongType()), T.StructField("bs", T.ArrayType(T.LongType()))])
    dealt = src.repartition("node").sortWithinPartitions("node")
    return map_arrow(dealt.select("node", "cid", "root", "n", "home", "side", "sketch", "nodes"), run, schema)


def _similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
    return common >= similarity * (len(x) + len(y) - common) - 1e-9


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``a, b`` whose sets have at least the Jaccard similarity."""
    both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("toks").alias("ta")), "a").join(
        sets.select(F.col("cid").alias("b"), F.col("toks").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                ok.append(_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), similarity))
            ok = pa.array(ok, pa.bool_())
            yield [b.column(0).filter(ok), b.column(1).filter(ok)]

    return map_arrow(both, run, PAIR)


def _children(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The next level of ``node, cid, n``: each set's picks below each of its nodes.  A set is shuffled once, not once per node."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("cid", T.LongType()), T.StructField("n", T.LongType())])
    by_set = rows.groupBy("cid").agg(F.collect_list("node").alias("nodes"))   # a set has at most a few hundred nodes

    def run(batches):
        for b in batches:
            got, at, size = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for cid, nodes, toks in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                s = np.frombuffer(toks.as_buffer(), np.uint64)
                got += [_picks(s, _U(v & (1 << 64) - 1), NEXT).astype(np.int64) for v in nodes]
                picked = sum(map(len, got[len(got) - len(nodes):]))
                at.append(np.full(picked, cid))
                size.append(np.full(picked, len(s)))
            yield [pa.array(np.concatenate(x).astype(np.int64)) for x in (got, at, size)]

    return map_arrow(by_set.join(sets, "cid").select("cid", "nodes", "toks"), run, schema)


def _buckets(rows: DataFrame, roots: DataFrame | None, name: str) -> DataFrame:
    """``node, cid, n, root, m`` of the buckets that hold sets of different groups, written."""
    if roots is not None:       # a set meets its group once, not once per bucket
        by_set = rows.groupBy("cid", "n").agg(F.collect_list("node").alias("nodes")).join(roots, "cid", "left")
        rows = by_set.select(F.explode("nodes").alias("node"), "cid", "n", F.coalesce("root", "cid").alias("root"))
    else:
        rows = rows.select("node", "cid", "n", F.col("cid").alias("root"))
    stats = rows.groupBy("node").agg(F.count("*").alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi")
    return written(rows.join(stats.select("node", "m"), "node"), name)


def _pivot_pairs(large: DataFrame) -> DataFrame:
    """Each set of a large bucket with the bucket's pivot."""
    by_set = large.groupBy("cid").agg((F.sum("m") + F.pmod(F.xxhash64("cid"), F.lit(1024)) / 2048).alias("shared"), F.collect_list("node").alias("nodes"))
    rows = by_set.select(F.explode("nodes").alias("node"), "cid", "shared")
    pivots = rows.groupBy("node").agg(F.max_by("cid", "shared").alias("pivot"))
    return rows.join(pivots, "node").filter("cid != pivot").select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b")).distinct()


def _undone(large: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """``cid`` of the sets whose picks in small buckets don't suffice to have met their partners there."""
    need = F.array(*[F.lit(picks_to_be_done(k, similarity, MISS)) for k in range(PICKS)])
    held = large.groupBy("cid").agg(F.count("*").alias("large")).join(classes.select("cid", F.size("nodes").alias("picks")), "cid")
    # a set of more picks than are looked up needs the same share at most
    enough = F.when(F.col("picks") < PICKS, F.get(need, F.col("picks"))).otherwise(F.ceil(F.col("picks") * (picks_to_be_done(PICKS - 1, similarity, MISS) / (PICKS - 1))))
    return held.filter(F.col("picks") - F.col("large") < enough).select("cid")


def _by_size(rows: DataFrame, similarity: float) -> DataFrame:
    """Each bucket cut into bands of set size, so wide that similar sets are at most one apart; a set goes to its own band and the next."""
    band = F.floor(F.log("n") / math.log(1.01 / similarity))
    cut = lambda b: rows.select(F.xxhash64("node", b).alias("node"), "cid", "n")
    return cut(band).union(cut(band + 1))


def _block_pairs(rows: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """``node, a, bs``: all plausible pairs of different groups in large buckets, block by block (``node`` is a pair of blocks)."""
    nb = F.ceil(F.col("m") / BLOCK).cast("int")
    rows = rows.join(_with_nodes(rows, classes).select("cid", "nodes", "sketch"), "cid").withColumn("nb", nb)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    # inside a block every row is a side of its own
    side = F.when(F.col("own") == F.col("other"), F.col("cid")).otherwise((F.col("own") == i).cast("long"))
    return _compare(rows.select(F.xxhash64("node", i, j).alias("node"), "cid", "root", "n", F.col("node").alias("home"), side.alias("side"), "sketch", "nodes"), similarity)


def verified_boxes(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links ``a < b`` that connect, within each box, all sets that its verified pairs connect.

    A set is sent once to each box, not once to each pair, and a pair that links found before in the box already connect is left out."""
    members = (pairs.select("node", F.col("a").alias("cid")).distinct().join(sets, "cid")
               .select(F.col("node").alias("box"), "cid", "toks"))

    def run(p: pa.Table, m: pa.Table) -> pa.Table:
        held = {c: np.frombuffer(x.as_buffer(), np.uint64) for c, x in zip(m.column("cid").to_pylist(), m.column("toks"))}
        group, links = {c: c for c in held}, []

        def root(c):
            while group[c] != c:
                group[c] = c = group[group[c]]
            return c

        for a, bs in zip(p.column("a").to_pylist(), p.column("bs").to_pylist()):
            for b in bs:
                x, y = root(a), root(b)
                if x != y and _similar(held[a], held[b], similarity):
                    group[x] = y
                    links.append((min(a, b), max(a, b)))
        return pa.table([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return pairs.groupBy("node").cogroup(members.groupBy("box")).applyInArrow(run, PAIR)


def _common(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """The number of shingles that each of ``xs`` has in common with each of ``ys``: products of 0/1 columns for frequent shingles, pairs for the others."""
    kinds, at = np.unique(np.concatenate([*xs, *ys]), return_inverse=True)
    cut = sum(map(len, xs))
    cols = at[:cut], at[cut:]
    rows = [np.repeat(np.arange(len(z)), [len(v) for v in z]) for z in (xs, ys)]
    held = [np.bincount(c, minlength=len(kinds)) for c in cols]
    pairs = held[0] * held[1]
    frequent = pairs * 64 >= len(xs) * len(ys)
    out = np.zeros((len(xs), len(ys)), np.int64)
    place = np.cumsum(frequent) - 1
    some = [(r[frequent[c]], place[c[frequent[c]]]) for r, c in zip(rows, cols)]
    for k in range(0, int(frequent.sum()), 4096):
        one, two = (np.zeros((len(z), 4096), np.float32) for z in (xs, ys))
        for m, (r, c) in zip((one, two), some):
            now = (c >= k) & (c < k + 4096)
            m[r[now], c[now] - k] = 1
        out += (one @ two.T).astype(np.int64)
    rare = ~frequent & (pairs > 0)
    (rx, cx), (ry, cy) = ((r[rare[c]], c[rare[c]]) for r, c in zip(rows, cols))
    ry = ry[np.argsort(cy, kind="stable")]
    starts = np.cumsum(np.where(rare, held[1], 0)) - held[1]
    n = held[1][cx]
    ends = np.cumsum(n)
    k = 0
    while k < len(cx):
        to = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + 8 * PAIRS, side="right")))
        c = n[k:to]
        j = np.repeat(starts[cx[k:to]], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        out += np.bincount(np.repeat(rx[k:to], c) * len(ys) + ry[j], minlength=out.size).reshape(out.shape)
        k = to
    return out


def partner_counts(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``cid, linked``: how many documents the sets of its group that are similar to a set stand for (``cid, root, n, copies``).

    Each pair of blocks of a group is a task's; pairs never leave it."""
    stats = members.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / COUNTED), F.ceil(F.sum("n") / SHINGLES)).cast("int").alias("nb"))
    own = F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int")
    rows = members.join(stats, "root").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "copies").join(sets, "cid")

    def run(t: pa.Table) -> pa.Table:
        toks = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("toks")]
        own, cid, copies = (t.column(c).to_numpy() for c in ("own", "cid", "copies"))
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        x, y = np.flatnonzero(own == i), np.flatnonzero(own == j)
        linked = np.zeros(len(cid), np.int64)
        if len(x) and len(y):
            n = np.array([len(s) for s in toks])
            common = _common([toks[k] for k in x], [toks[k] for k in y])
            near = common >= similarity * (n[x][:, None] + n[y][None, :] - common) - 1e-9
            if i == j:
                np.fill_diagonal(near, False)
            linked[x] = near @ copies[y]
            if i != j:
                linked[y] = copies[x] @ near
        return pa.table([pa.array(cid), pa.array(linked)], names=["cid", "linked"])

    schema = T.StructType([T.StructField("cid", T.LongType()), T.StructField("linked", T.LongType())])
    return rows.groupBy("root", "i", "j").applyInArrow(run, schema).groupBy("cid").agg(F.sum("linked").alias("linked"))


def sets_of(docs: DataFrame, classes: DataFrame, doc_id: str, text: str, members: DataFrame, name: str) -> DataFrame:
    """``cid, toks`` of the ``members`` (``cid``), written."""
    need = written(members.distinct().join(classes, "cid").select("cid", "doc", "th"), f"needed-{name}")
    return written(build_sets(docs, doc_id, text, need), f"sets-{name}")


def count_links(docs: DataFrame, classes: DataFrame, links: DataFrame, roots: DataFrame, dense: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    """``cid, linked`` of the linked classes: from ``links``, and over all pairs of the groups that hold one of ``dense`` (``cid``) and pairs without a link."""
    touched = roots.join(dense, "cid", "left_semi").select("root").distinct()
    had = links.join(roots, links["a"] == roots["cid"]).groupBy("root").agg(F.count("*").alias("had"))
    whole = roots.groupBy("root").agg(F.count("*").alias("m")).join(had, "root").filter(F.col("had") * 2 == F.col("m") * (F.col("m") - 1))
    again = roots.join(touched, "root", "left_semi").join(whole, "root", "left_anti")
    again = written(again.join(classes.select("cid", "n", "copies"), "cid").select("cid", "root", "n", "copies"), "counted")
    both = links.select(F.col("a").alias("cid"), F.col("b").alias("o")).union(links.select("b", "a")).join(again, "cid", "left_anti")
    told = both.join(classes.select(F.col("cid").alias("o"), F.col("copies").alias("c")), "o").groupBy("cid").agg(F.sum("c").alias("linked"))
    if again.isEmpty():
        return told
    sets = sets_of(docs, classes, doc_id, text, again.select("cid"), "counted")
    return told.union(written(partner_counts(again, sets, similarity), "partner-counts"))


def find_links(docs: DataFrame, classes: DataFrame, doc_id: str, text: str, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verified links ``a < b`` between classes (``cid, doc, th, n, nodes, sketch``) that connect all groups, ``cid, root`` of the linked ones,
    and the ``cid`` of those that went on into large buckets, where links within a group may lack."""
    def check(pairs: DataFrame, name: str, boxed: DataFrame | None = None) -> DataFrame:
        pairs = written(pairs.distinct(), f"pairs-{name}")
        members = pairs.select(F.col("a").alias("cid")).union(pairs.select("b"))
        if boxed is not None:
            boxed = written(boxed, f"boxed-{name}")
            members = members.union(boxed.select("a"))
        sets = sets_of(docs, classes, doc_id, text, members, name)
        with arrow_rows(docs.sparkSession, SETS):
            good = verified(pairs, sets, similarity)
            return written(good if boxed is None else good.union(verified_boxes(boxed, sets, similarity)), f"verified-{name}")

    is_small, n_classes = F.col("m") <= SMALL, classes.count()

    def few_left(rows: DataFrame) -> bool:
        return (rows.filter(~is_small).agg(F.sum((F.col("m") - 1) / 2)).first()[0] or 0) <= WORK * n_classes

    rows = _buckets(classes.select(F.explode("nodes").alias("node"), "cid", "n"), None, "buckets")
    small, large = rows.filter(is_small), rows.filter(~is_small)
    dense = written(_undone(large, classes, similarity), "undone")
    rows = _buckets(large.join(dense, "cid", "left_semi"), None, "undone-buckets")
    large = rows.filter(~is_small)
    links = check(single(box_pairs(small.unionByName(rows.filter(is_small)), classes, similarity)).union(plausible(_pivot_pairs(large), classes, similarity)), "0")
    roots = components(links)
    for level in range(LEVELS + 1):
        if large.isEmpty():
            break
        rows = _buckets(large.select("node", "cid", "n"), roots, "open")
        if not few_left(rows) and level == 0:       # the bands of deeper buckets are those of their parents
            rows = _buckets(_by_size(rows, similarity), roots, "bands")
        large = rows.filter(~is_small)
        last = few_left(rows) or level == LEVELS
        boxed = box_pairs(rows.filter(is_small), classes, similarity)
        if last:
            new = check(links.limit(0), str(level + 1), boxed.union(_block_pairs(large, classes, similarity)))
        else:
            new = check(plausible(_pivot_pairs(large), classes, similarity), str(level + 1), boxed)
        links = written(links.union(new).distinct(), f"links-{level + 1}")
        roots = components(links)
        if last:
            break
        open_ = _buckets(large.select("node", "cid", "n"), roots, "open")
        sets = sets_of(docs, classes, doc_id, text, open_.select("cid"), f"large-{level}")
        with arrow_rows(docs.sparkSession, SETS):
            children = written(_children(open_, sets), "children")
        large = _buckets(children, roots, "child-buckets")
        # buckets that have become small are compared in the next round, by size
    return links, roots, dense


def components(links: DataFrame) -> DataFrame:
    """``cid, root`` of every class with a link: the smallest class it is connected with."""
    both = links.select("a", "b").union(links.select("b", "a"))
    roots = written(both.groupBy(F.col("a").alias("cid")).agg(F.min(F.least("a", "b")).alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("cid").alias("b"), F.col("root").alias("r")), "b").groupBy(F.col("a").alias("cid")).agg(F.min("r").alias("r"))
        step = roots.join(near, "cid").select("cid", F.least("root", "r").alias("new"), F.col("root").alias("old"))
        jump = roots.select(F.col("cid").alias("new"), F.col("root").alias("further"))
        moved = Observation()
        new = step.join(jump, "new").select("cid", F.least("new", "further").alias("root"), "old").observe(
            moved, F.count(F.when(F.col("root") != F.col("old"), 1)).alias("n"))
        roots = written(new.select("cid", "root", "old"), "roots").select("cid", "root")
        if not moved.get["n"]:
            return roots


def jaccard_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL,
                   counted: bool = True) -> DataFrame:
    """``doc, th, class_id, n_links, keep`` of each row; ``keep`` marks the rows of one (doc, th) per group.  ``n_links`` is null unless ``counted``."""
    rows = written(read_sets(docs, doc_id, text, runs_for(recall, similarity)), "set-rows")
    order = F.struct(F.col("doc").isNull().alias("z"), "doc", "th")
    classes = rows.filter("n > 0").groupBy("k1", "k2", "n").agg(F.min(order).alias("least"), F.count("*").alias("copies"), F.any_value("nodes").alias("nodes"),
                                                                F.any_value("sketch").alias("sketch"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("cid"), "k1", "k2", "n", "least", "least.doc", "least.th", "copies", "nodes", "sketch"), "classes")
    links, root, dense = find_links(docs, classes, doc_id, text, similarity)
    grouped = classes.join(root, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = grouped.groupBy("root").agg(F.min("least").alias("first"))
    info = grouped.join(named, "root")
    if counted:
        info = info.join(count_links(docs, classes, links, root, dense, doc_id, text, similarity), "cid", "left").withColumn(
            "n_links", F.coalesce("linked", F.lit(0)) + F.col("copies") - 1)
    else:
        info = info.withColumn("n_links", F.lit(None).cast("long"))
    info = info.select("k1", "k2", "n", "first", "n_links")
    alone = F.struct(F.col("doc").isNull().alias("z"), "doc", "th")
    out = rows.select("doc", "th", "k1", "k2", "n").join(info, ["k1", "k2", "n"], "left")
    first = F.coalesce("first", alone)
    return out.select("doc", "th", first["doc"].alias("class_id"), (F.coalesce("n_links", F.lit(0)) if counted else F.col("n_links")).cast("long").alias("n_links"),
                      (F.col("doc").eqNullSafe(first["doc"]) & F.col("th").eqNullSafe(first["th"])).alias("keep"))


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group."""
    doc, th, own = own_names(docs, 3)
    kept = jaccard_groups(docs, doc_id, text, counted=False).filter("keep").select(F.col("doc").alias(doc), F.col("th").alias(th)).distinct()
    src = docs.withColumn(own, F.xxhash64(F.col(f"`{text}`")))
    held = src.join(kept, src[f"`{doc_id}`"].eqNullSafe(kept[doc]) & (src[own] == kept[th]), "left_semi")
    return held.dropDuplicates([doc_id, own]).drop(own)
