"""Vector code compression: product codes by Lloyd's rounds that rescan only what may have changed.

Components become integers (``floor(SCALE * x)``), a vector is cut into
``parts`` equal consecutive parts, and each part position has a codebook of
``entries`` integer entries: at first the parts of the vectors with the
smallest ids.  A round assigns every part to its nearest entry (squared
Euclidean distance, the lower index on ties) and then moves each entry to the
componentwise ``floor(sum / count)`` of its parts; an entry without parts
stays.  After the last round parts are assigned once more.

Active entries: each assignment is kept with its exact distance.  In the next
round a part whose assigned entry did not move is compared only with the
entries that did (a moved entry wins if it is nearer, or as near with a lower
index; the others are where they were, and lost before); every other part
is compared with all entries.  The result is that of full rescans.

All sums, distances and errors are integers, so nothing depends on the order of
rows.  Distances come from float64 products where those are exact (below 2^53),
else from int64.

In Spark: vectors and their assignments are a table, written once per round
into the shared folder; tasks give partial sums per part position and entry,
which are added by a shuffle of at most ``parts * entries`` rows per task.
Only codebooks (``entries`` vectors) go through the driver.

Edge cases: null vectors, and those that are empty or hold a null or non-finite
component, are dropped, as are those whose length isn't that of the kept vector
with the smallest id (the smallest vector of that id); null ids come last
and count as one id.  Of repeated ids the smallest vector starts an entry; all
rows are coded.  Fewer than ``entries`` ids give smaller codebooks.  A length
that ``parts`` doesn't divide raises, as do components so large that 64 bits
can't hold a squared distance.  An empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, written

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
ROWS = 4096            # assigned at a time
SALTS = 16             # of a label's sum, so that no task joins all rows of a label


@dataclass
class Coded:
    rows: DataFrame          # id, label, codes (array of part positions), error
    books: np.ndarray        # entry, part position, place within the part


def integer_vectors(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """``id, label, v``: the rows that take part, with integer components."""
    x = F.col(f"`{vector}`")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    return vectors.filter(x.isNotNull() & (F.size(x) > 0) & F.coalesce(whole, F.lit(False))).select(
        F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").alias("label"), v.alias("v"))


def _exact(parts: np.ndarray, book: np.ndarray) -> bool:
    """Whether float64 products of these integers are exact; raises where int64 isn't enough either."""
    most = max((int(np.abs(a).max()) if a.size else 0) for a in (parts, book))
    worst = 4 * most * most * parts.shape[-1]
    if worst >= 1 << 62:
        raise ValueError(f"components up to {most}: squared distances don't fit 64 bits")
    return worst < 1 << 52


def distances(part: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of each of the parts (rows) to each of the entries, as int64."""
    if _exact(part, entries):
        a, b = part.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((part - e) ** 2).sum(1) for e in entries], 1)


def assign(part: np.ndarray, entries: np.ndarray, old: np.ndarray | None = None, kept: np.ndarray | None = None,
           moved: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part and its distance.  With the assignment before (``old``, distances ``kept``) and which entries ``moved``
    since, parts of unmoved entries are compared with moved ones only."""
    if old is None:
        d = distances(part, entries)
        code = d.argmin(1)
        return code, d[np.arange(len(d)), code]
    code, dist = old.copy(), kept.copy()
    again = moved[old]
    if again.any():
        d = distances(part[again], entries)
        near = d.argmin(1)
        code[again], dist[again] = near, d[np.arange(len(d)), near]
    rest, active = np.flatnonzero(~again), np.flatnonzero(moved)
    if len(rest) and len(active):
        d = distances(part[rest], entries[active])
        near = d.argmin(1)
        d, near = d[np.arange(len(d)), near], active[near]
        wins = (d < dist[rest]) | ((d == dist[rest]) & (near < code[rest]))
        code[rest[wins]], dist[rest[wins]] = near[wins], d[wins]
    return code, dist


def _matrix(column: pa.ListArray, width: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _lists(m: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), pa.array(m.ravel().astype(kind)))


def _assigned(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """``id, label, v, code, dist`` of ``id, label, v`` or, after a round, of its result."""
    _, parts, width = books.shape
    schema = T.StructType([rows.schema["id"], rows.schema["label"], T.StructField("v", T.ArrayType(T.LongType())),
                           T.StructField("code", T.ArrayType(T.ShortType())), T.StructField("dist", T.ArrayType(T.LongType()))])

    def run(batches):
        for b in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            v = _matrix(b.column(2), parts * width).reshape(-1, parts, width)
            was = None if moved is None else (_matrix(b.column(3), parts), _matrix(b.column(4), parts))
            code, dist = np.empty((len(v), parts), np.int64), np.empty((len(v), parts), np.int64)
            for p in range(parts):
                before = () if was is None else (was[0][:, p], was[1][:, p], moved[:, p])
                code[:, p], dist[:, p] = assign(v[:, p], books[:, p], *before)
            yield [b.column(0), b.column(1), b.column(2), _lists(code, np.int16), _lists(dist, np.int64)]

    return map_arrow(rows.select("id", "label", "v", *(["code", "dist"] if moved is not None else [])), run, schema)


def _moved_books(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: floor(sum / count) of the parts of each entry."""
    entries, parts, width = books.shape
    schema = T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("total", T.ArrayType(T.LongType()))])

    def run(batches):
        n, total = np.zeros(entries * parts, np.int64), np.zeros((entries * parts, width), np.int64)
        for b in batches:
            slot = (_matrix(b.column(1), parts) * parts + np.arange(parts)).ravel()
            v = _matrix(b.column(0), parts * width).reshape(-1, width)
            n += np.bincount(slot, minlength=len(n))
            order = np.argsort(slot, kind="stable")
            used, at = np.unique(slot[order], return_index=True)
            if len(used):
                total[used] += np.add.reduceat(v[order], at, axis=0)
        used = np.flatnonzero(n)
        if len(used):
            yield [pa.array(used.astype(np.int32)), pa.array(n[used]), _lists(total[used], np.int64)]

    sums = map_arrow(rows.select("v", "code"), run, schema)
    added = sums.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width)])
    out = books.copy()
    for r in added.collect():       # at most a row per entry and part position
        out[r.slot // parts, r.slot % parts] = [r[2 + i] // r.n for i in range(width)]
    return out


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE,
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Coded:
    """Codes and errors of all vectors that take part, and the codebooks."""
    src = integer_vectors(vectors, vec_id, vector, label, scale)
    order = F.col("id").asc_nulls_last()
    first = src.groupBy("id").agg(F.min("v").alias("v")).orderBy(order).limit(entries).collect()     # a codebook
    first = [r.v for r in first if len(r.v) == len(first[0].v)] if first else []
    if not first:
        empty = src.select("id", "label", F.array().cast("array<smallint>").alias("codes"), F.lit(0).cast("long").alias("error"))
        return Coded(empty.limit(0), np.zeros((0, parts, 0), np.int64))
    if len(first[0]) % parts:
        raise ValueError(f"vectors of {len(first[0])} components can't be cut into {parts} equal parts")
    length = len(first[0])
    fitting = src.filter(F.size("v") == length)
    if len(first) < entries:        # some of the smallest ids may have had vectors of another length
        first = [r.v for r in fitting.groupBy("id").agg(F.min("v").alias("v")).orderBy(order).limit(entries).collect()]
    books = np.array(first, np.int64).reshape(-1, parts, length // parts)
    rows, moved = fitting, None
    for k in range(rounds):
        rows = written(_assigned(rows, books, moved), f"codes-{k}")
        new = _moved_books(rows, books)
        moved, books = (new != books).any(2), new
    last = _assigned(rows, books, moved)
    error = F.aggregate("dist", F.lit(0).cast("long"), lambda a, d: a + d)
    return Coded(last.select("id", "label", F.col("code").alias("codes"), error.alias("error")), books)


def hex_code(codes: Column) -> Column:
    """Two lower-case hex digits for each index, in part order."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")), "")


def label_errors(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """``rows`` with ``label_error``, the error summed over equal labels (nulls together).  Labels are salted: no task holds all rows of one."""
    salt = F.pmod(F.xxhash64("id", "codes"), F.lit(salts)).cast("int")
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).select(
        F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("copy"))
    salted = rows.withColumn("salt", salt)
    return salted.join(sums, salted["label"].eqNullSafe(sums["of"]) & (salted["salt"] == sums["copy"])).drop("of", "copy", "salt")


def books_text(books: np.ndarray) -> str:
    """All components by part position, entry and place within the part, comma-joined."""
    return ",".join(map(str, books.transpose(1, 0, 2).ravel().tolist()))


def code_digests(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``."""
    coded = compress(vectors)
    rows = label_errors(written(coded.rows, "codes"))
    digest = hashlib.sha256(books_text(coded.books).encode()).hexdigest()
    return rows.select(F.col("id").alias("vec_id"), hex_code(F.col("codes")).alias("code"), "error", "label_error",
                       F.lit(digest).alias("codebooks_sha256"))


ORACLE = """
with recursive kept as (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(256.0 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (
  select row_number() over () as r, vec_id, label, v from kept),
cut as (
  select r, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) as x from parts, range(16) t(p)),
book0 as (
  select p, cast(e as bigint) as e, x as c from cut join (
    select r, row_number() over (order by vec_id) - 1 as e from parts qualify e < 64) using (r)),
near0 as (
  select r, p, x, min([list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e]) as best from cut join book0 using (p) group by r, p, x),
sum0 as (
  select p, cast(best[2] as bigint) as e, i, sum(x[i]) as s, count(*) as n from near0, range(1, (select len(v) // 16 + 1 from parts limit 1)) u(i) group by all),
book1 as (
  select b.p, b.e, coalesce(m.c, b.c) as c from book0 b left join (
    select p, e, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as c from sum0 group by p, e) m using (p, e)),
near1 as (
  select r, p, x, min([list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e]) as best from cut join book1 using (p) group by r, p, x),
sum1 as (
  select p, cast(best[2] as bigint) as e, i, sum(x[i]) as s, count(*) as n from near1, range(1, (select len(v) // 16 + 1 from parts limit 1)) u(i) group by all),
book2 as (
  select b.p, b.e, coalesce(m.c, b.c) as c from book1 b left join (
    select p, e, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as c from sum1 group by p, e) m using (p, e)),
near2 as (
  select r, p, min([list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e]) as best from cut join book2 using (p) group by r, p, x),
coded as (
  select r, string_agg(lpad(lower(to_hex(cast(best[2] as bigint))), 2, '0'), '' order by p) as code, cast(sum(best[1]) as bigint) as error from near2 group by r),
books as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from book2)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded join parts using (r), books
"""
