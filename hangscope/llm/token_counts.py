"""Token counts: exact lengths from batch encoding, nothing but lengths kept.

``count_tokens`` adds the number of tokens that the library gives for each
whole text.  Texts go through Arrow batches; inside a task they are regrouped
into batches of about ``batch_bytes`` bytes, and a text longer than
``split_bytes`` is cut at safe boundaries, so no call encodes more than a
batch whatever the longest text is.

A cut is safe where the pieces encode to the same tokens as the whole:

* sentencepiece: at one space between two ASCII letters or digits.  The right
  part loses that space and gets it back as the model's dummy prefix.  Holds
  when the model adds a dummy prefix and no piece of its vocabulary has a
  word-start mark after another character; both are checked when the model is
  opened, and the model is used on whole texts if either fails.
* tokenizers (byte-level BPE, no prefix space): before one space between two
  ASCII letters; pre-tokens never span that point.

A long text without a safe boundary is encoded whole.

Edge cases: null text counts as empty (0 bytes, 0 tokens); other columns pass
through untouched, whatever their names; repeated rows stay repeated; an empty
table gives an empty result.  Lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

BATCH_BYTES = 1 << 20
SPLIT_BYTES = 1 << 16
_SAFE = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
_SAFE_LETTERS = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_OPEN: dict[str, object] = {}


class PieceCounter:
    """Counts with a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
        self.splits = not any(re.search("[^▁]▁", p) for p in pieces) and sp.encode("a", out_type=str) == sp.encode(
            "▁a", out_type=str)[-1:] and len(sp.encode("a a")) == 2 * len(sp.encode("a"))
        self.safe, self.drop = _SAFE, 1

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.sp.encode(texts, num_threads=1)]


class BpeCounter:
    """Counts with a tokenizers file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        kind = repr(self.tok.pre_tokenizer)
        special = any(" " in t.content for t in self.tok.get_added_tokens_decoder().values())
        self.splits = kind.startswith("ByteLevel(add_prefix_space=False") and self.tok.normalizer is None and not special
        self.safe, self.drop = _SAFE_LETTERS, 0

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]


def open_counter(path: str):
    """The counter for a tokenizer file, opened once per worker."""
    if path not in _OPEN:
        _OPEN[path] = PieceCounter(path) if path.endswith(".model") else BpeCounter(path)
    return _OPEN[path]


def parts(text: str, counter, split_bytes: int):
    """The text in pieces of about split_bytes characters, cut only at safe boundaries."""
    at = 0
    while counter.splits and len(text) - at > split_bytes:
        m = counter.safe.search(text, at + split_bytes)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start() + counter.drop
    yield text[at:] if at else text


def lengths_of(texts: list, counter, batch_bytes: int, split_bytes: int) -> list[int]:
    out = [0] * len(texts)
    batch, owners, size = [], [], 0

    def flush():
        for i, n in zip(owners, counter.lengths(batch)):
            out[i] += n
        batch.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for part in parts(text, counter, split_bytes) if text else ():
            if batch and size + len(part) > batch_bytes:
                flush()
                size = 0
            batch.append(part)
            owners.append(i)
            size += len(part)
    if batch:
        flush()
    return out


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", n_tokens: str = "n_tokens",
                 batch_bytes: int = BATCH_BYTES, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``docs`` without ``text``, with the token count of each whole text as ``n_tokens``."""
    kept = [f for f in docs.schema.fields if f.name not in (text, n_tokens)]
    schema = T.StructType([*kept, T.StructField(n_tokens, T.LongType())])
    src = docs.select(F.col(f"`{text}`"), *[F.col(f"`{f.name}`") for f in kept])

    def count(batches):
        counter = open_counter(tokenizer)
        for b in batches:
            n = lengths_of(b.column(0).to_pylist(), counter, batch_bytes, split_bytes)
            yield [*b.columns[1:], pa.array(n, pa.int64())]

    return map_arrow(src, count, schema)
