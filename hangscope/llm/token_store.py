"""Token-ID / binary output with keyed access through a minimal perfect hash.

File format (``write_store``), below one root folder:

* ``shards/NNNNNN.ids``: 16 bytes of header (``TOKIDS01``, bytes per id as
  little-endian uint32, 4 zero bytes), then raw little-endian ids, document
  after document in ascending key order (nulls first), each closed by the end
  id.  Ids take 2 bytes when the vocabulary allows, else 4.
* ``directory``: Parquet, a row per document (key, occurrence, shard, offset,
  n_tokens, start).
* ``index``: Parquet, a row per bucket of keys with the levels of a minimal
  perfect hash (bit arrays with ranks) and, at each slot, the key's 32-bit
  fingerprint, shard, offset, length and global start.

``lookup`` finds keys through the index alone: the bucket from the key's hash,
the slot from the first level whose bit is set, then one fingerprint compare
(an absent key is taken for a present one with probability 2^-32).
``read_ids`` opens only the byte range of a document.

Scale: the texts are shuffled once, by key range; encoding and writing are one
pass, a shard per task; shards are renamed into place when complete, so a lost
executor's task simply writes its shard again with the same bytes.  Keys,
never payloads, are shuffled for the index, in buckets of about
``BUCKET_KEYS`` keys.  Nothing but two row counts comes to the driver.

Edge cases: null text is an empty text (the end id alone).  A null key is a
key of its own.  Rows sharing a key are occurrences 0, 1, ... of it, in
ascending order of (xxhash64 of text, text); look them up as (key, occurrence).  A key may hold any
number of rows: the range partitioning also splits by text hash.  An empty table gives an empty
store whose lookups find nothing.  Columns other than key and text are ignored.
"""

from __future__ import annotations

import math
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import map_arrow, open_shared, scratch_dir, ship

MAGIC = b"TOKIDS01"
HEADER = 16
BUCKET_KEYS = 8192
GAMMA = 2.0          # bits per remaining key at each level
MAX_LEVELS = 64
READ_IDS = 1 << 20   # ids read at a time
CACHE_WORDS = 800_000


# --- encoding -----------------------------------------------------------------

_ENCODERS: dict[str, "Encoder"] = {}


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet's stand-ins: bytes that are not printable Latin-1 become letters from U+0100 up."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}


class _Words(dict):
    """pre-token -> raw ids, asking the library's model for a new one."""

    def __init__(self, model, dtype):
        self.model, self.code, self.letters = model, "H" if dtype.itemsize == 2 else "I", _byte_letters()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        tokens = self.model.tokenize(word.encode("utf-8").decode("latin-1").translate(self.letters))
        self[word] = ids = struct.pack(f"<{len(tokens)}{self.code}", *[t.id for t in tokens])
        return ids


class Encoder:
    """Whole-text ids from a tokenizers file.

    For byte-level BPE without normalizer or prefix space the ids of a text are
    the ids of its pre-tokens in a row, so each worker keeps a bounded table
    pre-token -> ids and asks the library only for new ones.  Texts with a
    character outside ASCII and Latin-1 letters (where this pre-token pattern
    equals the library's), or with the string of an added token, and other
    kinds of tokenizer, go to the library whole.
    """

    LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
    PRE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[^\s{LETTER}0-9]+|\s+(?!\S)|\s+")
    PLAIN = re.compile(rf"[\x00-\x1b\x20-\x7e{LETTER}]*")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        self.width = 2 if tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.by_word = (re.match(r"ByteLevel\(add_prefix_space=False, .*use_regex=True", repr(tok.pre_tokenizer)) is not None
                        and tok.normalizer is None)
        self.added = [t.content for t in tok.get_added_tokens_decoder().values()]
        self.table = _Words(tok.model, self.dtype)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str) -> bytes:
        """The text's ids, raw."""
        if not text:
            return b""
        if not self.by_word or not self.PLAIN.fullmatch(text) or any(a in text for a in self.added):
            return self.whole([text])[0]
        return b"".join(map(self.table.__getitem__, self.PRE.findall(text)))


def open_encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- writing ------------------------------------------------------------------

def _hashes(key):
    """Two hashes of the key; the flag tells null from every value."""
    return (F.xxhash64(F.lit(1), key.isNull(), key).alias("h1"), F.xxhash64(F.lit(2), key.isNull(), key).alias("h2"))


def shard_path(root: str, shard: int) -> str:
    return f"{root}/shards/{shard:06d}.ids"


def _write_shards(root: str, tokenizer: str, end_id: int):
    def write(batches):
        enc, shard = open_encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        fs, final = open_shared(shard_path(root, shard))
        out, tmp, at, last, occ = None, f"{final}.{uuid.uuid4().hex}", 0, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                fs.create_dir(final.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(tmp)
                out.write(MAGIC + enc.width.to_bytes(4, "little") + bytes(4))
            offsets, lens, occs = [], [], []
            h1, h2 = b.column(1).to_pylist(), b.column(2).to_pylist()
            for i, text in enumerate(b.column(3)):
                ids = enc.encode(text.as_py()) + end
                out.write(ids)
                n = len(ids) // enc.width
                occ, last = (occ + 1 if last == (h1[i], h2[i]) else 0), (h1[i], h2[i])
                offsets.append(at)
                lens.append(n)
                occs.append(occ)
                at += n
            yield [b.column(0), b.column(1), b.column(2), pa.array([shard] * b.num_rows, pa.int32()), pa.array(occs, pa.int64()),
                   pa.array(offsets, pa.int64()), pa.array(lens, pa.int64())]
        if out is not None:
            out.close()
            fs.move(tmp, final)

    return write


def write_store(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
                root: str | None = None, bucket_keys: int = BUCKET_KEYS, n_shards: int | None = None) -> str:
    """Encode ``docs`` into a store; returns its root folder.

    Without ``n_shards`` the session's shuffle settings size the shards.
    """
    spark = docs.sparkSession
    root = root or scratch_dir(spark, "tokens")
    k, t = F.col(f"`{key}`"), F.col(f"`{text}`")
    src = docs.select(k.alias("key"), *_hashes(k), t.alias("text"))
    order = [F.col("key"), F.xxhash64("text")]
    dealt = src.repartitionByRange(*([n_shards] if n_shards else []), *order).sortWithinPartitions(*order, "text")
    schema = T.StructType([src.schema["key"], *(T.StructField(n, T.LongType()) for n in ("h1", "h2")),
                           T.StructField("shard", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in ("occ", "offset", "n_tokens"))])
    map_arrow(dealt, _write_shards(root, tokenizer, end_id), schema).write.parquet(f"{root}/rows")
    rows = spark.read.schema(schema).parquet(f"{root}/rows")

    # a row per shard: ids in all shards before it
    per_shard = rows.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    base = per_shard.select("shard", (F.sum("ids").over(W.orderBy("shard")) - F.col("ids")).alias("base"))
    # a key that goes on in a later shard: its rows in the shards before
    w = W.partitionBy("h1", "h2").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    before = rows.groupBy("h1", "h2", "shard").agg(F.count("*").alias("n")).select(
        "h1", "h2", "shard", F.sum("n").over(w).alias("before")).filter("before > 0")
    directory = (rows.join(F.broadcast(base), "shard").join(before, ["h1", "h2", "shard"], "left")
                 .select("key", "h1", "h2", (F.col("occ") + F.coalesce("before", F.lit(0))).alias("occ"), "shard", "offset",
                         "n_tokens", (F.col("base") + F.col("offset")).alias("start")))
    directory.write.parquet(f"{root}/directory")
    build_index(spark, root, bucket_keys)
    return root


# --- the minimal perfect hash ---------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    return (_mix(a ^ _mix(b + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1))) % np.uint64(size)).astype(np.int64)


def build_mph(a: np.ndarray, b: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels (bit arrays) and the slot of each key, slots being 0 .. n-1 without gaps."""
    levels, slots, left, used = [], np.empty(len(a), np.int64), np.arange(len(a)), 0
    while len(left):
        if len(levels) == MAX_LEVELS:
            raise ValueError("two keys share both hashes")
        size = max(64, math.ceil(GAMMA * len(left) / 64) * 64)
        at = _place(a[left], b[left], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        placed = alone[at]
        slots[left[placed]] = used + np.cumsum(alone)[at[placed]] - 1
        used += int(alone.sum())
        levels.append(alone)
        left = left[~placed]
    return levels, slots


def find_slots(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 where no level has its bit."""
    slots, left, used = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
    for level, bits in enumerate(levels):
        at = _place(a[left], b[left], level, len(bits))
        hit, rank = bits[at], np.cumsum(bits)
        slots[left[hit]] = used + rank[at[hit]] - 1
        used += int(rank[-1])
        left = left[~hit]
    return slots


INDEX_SCHEMA = ("bucket long, n_keys long, sizes binary, bits binary, prints binary, shards binary, offsets binary, lens binary, starts binary")


def _u64(col) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False).view(np.uint64) if len(col) else np.empty(0, np.uint64)


def _index_bucket(t: pa.Table) -> pa.Table:
    a, b = (_u64(t.column(c).combine_chunks()) for c in ("a", "b"))
    levels, slots = build_mph(a, b)

    def at_slots(values, dtype):
        out = np.empty(len(values), dtype)
        out[slots] = values
        return [out.tobytes()]

    num = lambda c: t.column(c).to_numpy()
    return pa.table({
        "bucket": pa.array([t.column("bucket")[0].as_py()], pa.int64()), "n_keys": pa.array([len(a)], pa.int64()),
        "sizes": pa.array([np.array([len(x) for x in levels], "<u4").tobytes()], pa.binary()),
        "bits": pa.array([np.packbits(np.concatenate(levels)).tobytes()], pa.binary()),
        "prints": pa.array(at_slots((b & np.uint64(0xFFFFFFFF)).astype("<u4"), "<u4"), pa.binary()),
        "shards": pa.array(at_slots(num("shard"), "<i4"), pa.binary()), "offsets": pa.array(at_slots(num("offset"), "<i8"), pa.binary()),
        "lens": pa.array(at_slots(num("n_tokens"), "<i8"), pa.binary()), "starts": pa.array(at_slots(num("start"), "<i8"), pa.binary())})


def _keyed(df: DataFrame, n_buckets: int) -> DataFrame:
    """Adds the hashes of (key, occurrence) and their bucket."""
    a = F.xxhash64("h1", "occ")
    return df.withColumn("a", a).withColumn("b", F.xxhash64("h2", "occ")).withColumn("bucket", F.pmod(F.xxhash64(F.lit(3), F.col("a")), F.lit(n_buckets)))


def build_index(spark: SparkSession, root: str, bucket_keys: int = BUCKET_KEYS) -> None:
    rows = spark.read.parquet(f"{root}/directory")
    n_buckets = max(1, math.ceil(rows.count() / bucket_keys))
    keyed = _keyed(rows, n_buckets).select("bucket", "a", "b", "shard", "offset", "n_tokens", "start")
    keyed.groupBy("bucket").applyInArrow(_index_bucket, INDEX_SCHEMA).write.parquet(f"{root}/index")
    spark.range(1).select(F.lit(n_buckets).cast("long").alias("n_buckets")).write.parquet(f"{root}/meta")


def lookup(spark: SparkSession, root: str, keys: DataFrame, key: str = "key", occurrence: str | None = None) -> DataFrame:
    """``key, occ, shard, offset, n_tokens, start`` of each distinct (key, occurrence) that the store holds."""
    ship(spark)
    n_buckets = spark.read.parquet(f"{root}/meta").first().n_buckets
    k = F.col(f"`{key}`")
    occ = F.col(f"`{occurrence}`") if occurrence else F.lit(0)
    asked = _keyed(keys.select(k.alias("key"), *_hashes(k), occ.cast("long").alias("occ")).distinct(), n_buckets)
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{root}/index")
    asked = asked.select("bucket", "key", "occ", "a", "b")
    names = ["shard", "offset", "n_tokens", "start"]
    schema = T.StructType([asked.schema["key"], T.StructField("occ", T.LongType()), T.StructField("shard", T.IntegerType()),
                           *(T.StructField(n, T.LongType()) for n in names[1:])])

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        none = left.slice(0, 0 if not (left.num_rows and right.num_rows) else left.num_rows)
        cols = {n: np.empty(0, np.int64) for n in names}
        if none.num_rows:
            r = right.slice(0, 1).to_pylist()[0]
            bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
            levels = np.split(bits, np.cumsum(np.frombuffer(r["sizes"], "<u4")))[:-1]
            a, b = (_u64(none.column(c).combine_chunks()) for c in ("a", "b"))
            slots = find_slots(levels, a, b)
            ok = slots >= 0
            ok[ok] = np.frombuffer(r["prints"], "<u4")[slots[ok]] == (b[ok] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            none, slots = none.filter(pa.array(ok)), slots[ok]
            cols = {n: np.frombuffer(r[c], d)[slots] for n, c, d in zip(names, ("shards", "offsets", "lens", "starts"), ("<i4", "<i8", "<i8", "<i8"))}
        return pa.table([none.column("key"), none.column("occ"), pa.array(cols["shard"], pa.int32()), *(pa.array(cols[n], pa.int64()) for n in names[1:])],
                        names=["key", "occ", *names])

    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, schema)


def read_range(root: str, shard: int, offset: int, n: int):
    """The ids of one document, in arrays of at most READ_IDS."""
    fs, path = open_shared(shard_path(root, shard))
    with fs.open_input_file(path) as f:
        yield from _range(f, offset, n)


def _range(f, offset: int, n: int):
    f.seek(0)
    head = f.read(HEADER)
    if head[:8] != MAGIC:
        raise ValueError("not a shard of token ids")
    width = int.from_bytes(head[8:12], "little")
    f.seek(HEADER + offset * width)
    while n:
        got = np.frombuffer(f.read(min(n, READ_IDS) * width), f"<u{width}")
        if not len(got):
            raise ValueError("shard ends inside a document")
        yield got
        n -= len(got)


def read_digests(located: DataFrame, root: str) -> DataFrame:
    """Reads each located document's ids back from the shards: adds ``ids_crc32``, the crc32 of them as little-endian uint32."""
    schema = T.StructType([*located.schema.fields, T.StructField("ids_crc32", T.LongType())])
    names = located.columns
    at_shard, at_offset, at_n = (names.index(c) for c in ("shard", "offset", "n_tokens"))

    def read(batches):
        opened, f = None, None
        try:
            for b in batches:
                crcs = []
                for shard, offset, n in zip(*(b.column(i).to_pylist() for i in (at_shard, at_offset, at_n))):
                    if shard != opened:
                        if f is not None:
                            f.close()
                        fs, path = open_shared(shard_path(root, shard))
                        f, opened = fs.open_input_file(path), shard
                    crc = 0
                    for ids in _range(f, offset, n):
                        crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    crcs.append(crc)
                yield [*b.columns, pa.array(crcs, pa.int64())]
        finally:
            if f is not None:
                f.close()

    # neighbours in a shard go to one task; the shard's bytes are never shuffled
    dealt = located.withColumn("_blk", F.floor(F.col("offset") / (4 * READ_IDS))).repartition("shard", "_blk").sortWithinPartitions(
        "shard", "offset").drop("_blk")
    return map_arrow(dealt, read, schema)


def store_digests(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
                  n_shards: int | None = None) -> DataFrame:
    """Write ``docs`` to a store, look every key up and read every document back."""
    spark = docs.sparkSession
    root = write_store(docs, tokenizer, end_id, key, text, n_shards=n_shards)
    keys = docs.groupBy(F.col(f"`{key}`").alias("key")).agg(F.count("*").alias("n")).select(
        "key", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("occ"))
    found = lookup(spark, root, keys, occurrence="occ")
    return read_digests(found, root).select(F.col("key").alias(key), "start", "n_tokens", "ids_crc32", F.col("occ").alias("occurrence"), "shard", "offset")
