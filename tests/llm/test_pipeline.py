"""Each stage of the pipeline against a plain version of it on the table it is given, and the whole run."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pyspark.sql import functions as F

import corpus_pipeline as P
from hangscope.llm import mixing
from hangscope.llm.common import table, written
from test_decontaminate import by_hand as contaminated_by_hand
from test_ngram_join import by_hand as groups_by_hand


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    # every stage once, on part of the smallest table; the queries themselves read whole tables
    docs, out = written(table(spark, sf_dir, "documents").limit(120), "test-docs"), []
    for name, stage in P.STAGES:
        got = written(stage(spark, docs, sf_dir), f"test-{name}")
        out.append((docs, got))
        docs = got
    return out


def key(r):
    return (r.doc_id is not None, r.doc_id, r.text or "")


def test_columns(spark, sf_dir, steps):
    docs = table(spark, sf_dir, "documents")
    assert [n for n, _ in P.STAGES] == ["language_id", "ngram_jaccard", "decontaminate", "mixing", "token_ids"]
    assert all(got.columns == docs.columns for _, got in steps[:-1])


def test_language_stage_keeps_texts_with_letters(steps):
    before, after = (x.collect() for x in steps[0])
    assert {r.doc_id for r in before if any(map(str.isalpha, r.text or ""))} == {r.doc_id for r in after}


def test_jaccard_stage_keeps_the_smallest_of_each_group(steps):
    before, after = (x.collect() for x in steps[1])
    assert sorted(map(key, after)) == sorted(key(r) for r in before if r.doc_id in {c for _, c, _ in groups_by_hand(before)})


def test_decontaminate_stage_drops_hits(spark, sf_dir, steps):
    before, after = (x.collect() for x in steps[2])
    items = table(spark, sf_dir, "benchmark").collect()
    clean = {d for d, _, hit, _, _ in contaminated_by_hand(before, items) if not hit}
    assert sorted(map(key, after)) == sorted(key(r) for r in before if r.doc_id in clean)


def test_mixing_stage_repeats_rows_by_rate(spark, sf_dir, steps):
    before, after = steps[3]
    rates = {r.doc: r.rate for r in mixing.mix(before, table(spark, sf_dir, "labels")).collect()}
    copies = Counter(r.doc_id for r in after.collect())
    assert set(copies) <= set(rates)
    assert all(np.floor(rates[d]) <= copies[d] <= np.ceil(rates[d]) for d in rates)


def test_token_stage(spark, sf_dir, steps):
    before, after = (x.collect() for x in steps[4])
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    for r in sorted(before, key=key):
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [P.END_ID]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in after) == sorted(want)


def test_clashing_columns_pass_through(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(40).withColumns({"Score": F.col("doc_id") * 2, "lang_pred": F.lit("user's"), "own_0": F.lit("o"), "__t": F.lit(5)})
    for stage in (P.language_stage, P.decontaminate_stage):
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns
        assert all((r["Score"], r["lang_pred"], r["own_0"], r["__t"]) == (r.doc_id * 2, "user's", "o", 5) for r in got.collect())


def test_run_applies_the_stages_in_order(spark, sf_dir, monkeypatch):
    """``run`` on the whole table, with plain stages: each works on all that its predecessor kept."""
    seen = []

    def stage(k):
        def apply(spark, docs, sf):
            seen.append((k, docs.count(), sf))
            return docs.filter(F.col("doc_id") % k != 0)
        return apply

    monkeypatch.setattr(P, "STAGES", [(f"s{k}", stage(k)) for k in (2, 3, 5)])
    ids = [r.doc_id for r in table(spark, sf_dir, "documents").collect()]
    got = P.run(spark, sf_dir)
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i in ids if i % 2 and i % 3 and i % 5)
    assert seen == [(2, len(ids), sf_dir), (3, sum(i % 2 != 0 for i in ids), sf_dir), (5, sum(i % 2 != 0 and i % 3 != 0 for i in ids), sf_dir)]


def test_empty_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("false")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
        docs = docs if docs.columns[:2] == ["doc_id", "text"] else table(spark, sf_dir, "documents").filter("false")
