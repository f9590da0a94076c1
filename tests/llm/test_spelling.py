import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from hangscope.llm import spelling as S


def counted(rows, slip=S.SLIP, length=S.LENGTH, count=S.COUNT):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % slip == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= length:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_hand(n, ratio=S.RATIO):
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    best = {w: min(o, key=lambda x: (-n[x], x)) for w, o in near.items() if o}
    form = {w: f for w, f in best.items() if n[f] >= ratio * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def table_of(spark, n):
    return spark.createDataFrame(list(n.items()), "word string, n long")


@pytest.fixture(scope="module")
def hard():
    """Many words with common halves, both lengths, accents, chains of forms and ties."""
    rng = random.Random(5)
    words = {"prefix" + "".join(rng.choices("abé", k=rng.randint(3, 6))) for _ in range(250)}
    words |= {"".join(rng.choices("abé", k=rng.randint(3, 6))) + "suffix" for _ in range(250)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "ababab", "bababa", "abababa", "x" * 3000, "x" * 2999 + "y", "x" * 3001}
    return {w: rng.choice([5, 5, 6, 24, 25, 130, 700, 4000]) for w in words}


@pytest.mark.parametrize("pairs", [S.PAIRS, 0, 40])
def test_variants_equal_brute_force(spark, hard, pairs):
    assert rows_of(S.variants(table_of(spark, hard), pairs=pairs)) == by_hand(hard)


def test_every_pair_once(spark, hard):
    got = [(r.a, r.b) for r in S.near_pairs(table_of(spark, hard), 0).collect()]
    assert len(got) == len({frozenset(p) for p in got}) and all(one_edit(a, b) for a, b in got)


def test_chains_of_forms(spark):
    n = {"abcdef" + "x" * i: 5 ** (i + 1) for i in range(9)}
    got = rows_of(S.variants(table_of(spark, n)))
    assert got == by_hand(n) and {r[2] for r in got} == {"abcdefxxxxxxxx"}


def test_whole_texts(spark):
    rows = [(i, t) for i in range(6) for t in ("Straße STRASSE strasse; naïve Naïve", "word_word wordword99wordword", "a" * 300, "", None)]
    rows += [(None, "Strasse nullkey")] * 5 + [(7, "repeat repeat repeat repeats repeats")] * 2 + [(8, "lettér " * 20000)]
    df = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], "doc_id long, text string, word string, n int").repartition(4)
    for slip in (S.SLIP, 3):
        n = counted(rows, slip)
        got = S.word_counts(df, slip=slip)
        assert {r.word: r.n for r in got.collect()} == n
        assert rows_of(S.variants(got)) == by_hand(n)


def test_table_and_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = rows_of(S.spelling_variants(docs))
    n = counted([(r.doc_id, r.text) for r in docs.collect()])
    assert {r[0]: r[3] for r in got} == n and got == by_hand(n)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    assert sorted(con.execute(S.ORACLE).fetchall(), key=repr) == got


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.spelling_variants(df).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert S.spelling_variants(df).count() == 0
