import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hangscope.llm import token_counts as C
from hangscope.llm import token_store as S

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
TRICKY = ["", None, " ", "a", "  two  spaces ", "it's we'll 'S don't", "tab\tnew\n\n line", "x<|endoftext|>y", "é à ç ñ ß", "½ ² ٣ 42",
          "emoji 😀 and 漢字", "é comb́ ining", "a b c", "<s> </s> <unk>", "a b " * 30000, "x" * 150000, "word " * 40000 + "\n\n" + "é " * 50000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "n", 1.0) for i, t in enumerate(TRICKY)] + [(3, "a", "n", 1.0), (3, "b", "n", 1.0), (None, "null key", "n", 1.0), (None, None, "n", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, `odd.name` double").repartition(3)


def expected(tok, rows):
    out, start = [], 0
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h)):
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [2]
        out.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_store_equals_library(spark, docs):
    got = S.store_digests(docs, BPE, 2).collect()
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got], key=str) == expected(Tokenizer.from_file(BPE), docs.withColumn('h', F.xxhash64('text')).collect())


def test_store_on_tables(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = S.store_digests(t, BPE, 2).collect()
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got], key=str) == expected(Tokenizer.from_file(BPE), t.withColumn('h', F.xxhash64('text')).collect())


def test_lookup_absent_and_occurrences(spark, docs):
    root = S.write_store(docs, BPE, 2, bucket_keys=4)
    keys = spark.createDataFrame([(i,) for i in [3, 999, -1, None]], "k long")
    assert {r.key for r in S.lookup(spark, root, keys, "k").collect()} == {3, None}
    r = S.lookup(spark, root, spark.createDataFrame([(3, 2)], "k long, o int"), "k", "o").first()
    ids = np.concatenate(list(S.read_range(root, r.shard, r.offset, r.n_tokens))).tolist()
    assert ids == Tokenizer.from_file(BPE).encode("b").ids + [2]


def test_empty_store(spark, docs):
    empty = docs.filter("false")
    assert S.store_digests(empty, BPE, 2).count() == 0
    root = S.write_store(empty, BPE, 2)
    assert S.lookup(spark, root, spark.createDataFrame([(1,)], "key long")).count() == 0


def test_hot_key_spans_shards(spark):
    hot = spark.range(400).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    rows = S.store_digests(hot, BPE, 2, n_shards=4).collect()
    assert sorted(r.occurrence for r in rows) == list(range(400)) and len({r.shard for r in rows}) > 1
    assert [r.start for r in sorted(rows, key=lambda r: r.occurrence)] == sorted(r.start for r in rows)


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 20000):
        a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in "ab")
        levels, slots = S.build_mph(a, b)
        assert sorted(slots) == list(range(n)) and (S.find_slots(levels, a, b) == slots).all()


@pytest.mark.parametrize("path", [PIECE, BPE])
def test_counts_equal_library(spark, docs, path):
    sp, tok = sentencepiece.SentencePieceProcessor(model_file=PIECE), Tokenizer.from_file(BPE)
    whole = (lambda t: len(sp.encode(t))) if path == PIECE else (lambda t: len(tok.encode(t, add_special_tokens=False).ids))
    base = docs.drop("n_tokens").withColumn("t2", F.col("text"))
    for r in C.count_tokens(base, path, batch_bytes=5000, split_bytes=300).collect():
        assert r.n_tokens == whole(r.t2 or ""), (r.t2 or "")[:50]


def test_counts_clash_and_empty(spark, docs):
    out = C.count_tokens(docs, PIECE)
    assert out.columns == ["doc_id", "odd.name", "n_tokens"] and out.count() == docs.count()
    assert C.count_tokens(docs.filter("false"), PIECE).count() == 0


@pytest.mark.parametrize("path", [PIECE, BPE])
def test_model_allows_splits(path):
    assert C.open_counter(path).splits
