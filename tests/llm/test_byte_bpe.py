import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from hangscope.llm import byte_bpe as B

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TRICKY = ["", None, " ", "a", "  two  spaces ", "it's we'll 'S don't", "tab\tnew\n\n line", "x<|endoftext|>y", "é à ç ñ ß", "½ ² ٣ 42", "emoji 😀 and 漢字",
          "é comb́ ining", "a b c", "\x00\x1c\x85\x7f", "x" * 20000, "ab" * 9999 + "!", " " * 5000, "a b " * 40000, "漢字" * 3000]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 1.0) for i, t in enumerate(TRICKY)] + [(3, "a", "clash", 1.0), (None, "null key", "clash", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, `odd.name` double").repartition(3)


def expected(library, rows):
    out = []
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        out.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_digests_equal_library(spark, docs, library):
    got = B.round_trip_digests(docs, PATH, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(library, docs.collect())


def test_digests_on_table(spark, sf_dir, library):
    t = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = B.round_trip_digests(t, PATH, public_tokenizers.PATTERN).collect()
    assert sorted(map(tuple, got), key=repr) == expected(library, t.collect())


def test_arrays_round_trip(spark, docs, library):
    encoded = B.encode_texts(docs, PATH, public_tokenizers.PATTERN, keep=["doc_id", "text", "odd.name"])
    for r in encoded.collect():
        assert r.ids == library.encode_ordinary(r.text or "")
    back = B.decode_ids(encoded, PATH, public_tokenizers.PATTERN, keep=["text"])
    assert all(bytes(r.data).decode() == (r.text or "") for r in back.collect())


def test_kept_columns_that_clash_are_replaced(spark, docs):
    got = B.round_trip_digests(docs, PATH, public_tokenizers.PATTERN, keep=["doc_id", "n_tokens", "odd.name"])
    assert got.columns == ["doc_id", "odd.name", "n_tokens", "ids_sha256", "decoded_sha256"] and got.schema["n_tokens"].dataType.simpleString() == "bigint"


def test_empty_table(spark, docs):
    assert B.round_trip_digests(docs.filter("false"), PATH, public_tokenizers.PATTERN).count() == 0
    assert B.encode_texts(docs.filter(F.lit(False)), PATH, public_tokenizers.PATTERN).count() == 0


def plain_merge(piece, ranks):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        known = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not known:
            return parts
        i = min(known)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_segment_tree_equals_plain_merges():
    rng = random.Random(7)
    for _ in range(400):
        letters = "abc"[:rng.randint(1, 3)]
        tokens = {bytes([ord(c)]) for c in "abc"} | {"".join(rng.choices(letters, k=rng.randint(2, 5))).encode() for _ in range(rng.randint(0, 12))}
        order = sorted(tokens)
        rng.shuffle(order)
        ranks = {t: i for i, t in enumerate(order)}
        piece = "".join(rng.choices(letters, k=rng.randint(0, 40))).encode()
        assert B.merge(piece, ranks, max(map(len, ranks))) == plain_merge(piece, ranks)


def test_pieces_are_forgotten_when_they_fill_the_cache(monkeypatch, library):
    monkeypatch.setattr(B, "CACHE_BYTES", 2000)
    codec = B.Codec(B.read_ranks(PATH), public_tokenizers.PATTERN)
    text = " ".join(f"word{i}" for i in range(500))
    assert codec.encode(text) == library.encode_ordinary(text)
    assert codec.held <= 2000 and len(codec) < 20 and len(codec.older) < 20


def test_random_texts(library):
    codec, rng = B.open_codec(PATH, public_tokenizers.PATTERN), random.Random(3)
    for _ in range(500):
        text = "".join(rng.choices("abE  \n\t's.,12é漢😀́ ", k=rng.randint(0, 200)))
        assert codec.encode(text) == library.encode_ordinary(text)
