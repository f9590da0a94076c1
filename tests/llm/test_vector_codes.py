import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from hangscope.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code string, `odd.name` int"


def by_hand(rows, parts=V.PARTS, entries=V.ENTRIES, rounds=V.ROUNDS):
    """Full rescans in Python integers."""
    kept = [(r.vec_id, [math.floor(256 * x) for x in r.embedding], r.label) for r in rows
            if r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)]
    if not kept:
        return []
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(order[0][1])]
    first = []
    for r in order:
        if len(r[1]) == len(order[0][1]) and (not first or first[-1][0] != r[0]):
            first.append(r)
    width = len(order[0][1]) // parts
    cut = lambda v: [v[p * width:(p + 1) * width] for p in range(parts)]
    books = [[cut(r[1])[p] for r in first[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for k in range(rounds + 1):
        codes = [[nearest(p, x) for p, x in enumerate(cut(r[1]))] for r in kept]
        if k < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    mine = [cut(r[1])[p] for r, c in zip(kept, codes) if c[p][1] == e]
                    if mine:
                        books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    text = ",".join(str(x) for p in range(parts) for e in books[p] for x in e)
    error = [sum(d for d, _ in c) for c in codes]
    by_label = {}
    for r, e in zip(kept, error):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in c), e, by_label[r[2]], hashlib.sha256(text.encode()).hexdigest())
                   for r, c, e in zip(kept, codes, error)), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", 1) for i, v, label in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def hard():
    """Coarse values, so that distances tie; repeated rows and ids; null ids, labels, vectors and components; other lengths."""
    rng = random.Random(2)
    values = [-2.0, -0.5, -0.001, 0.0, 0.004, 0.25, 1.0]
    rows = [(i // 2 if i % 7 == 0 else i, rng.choices(values, k=32), rng.choice([None, 1, 1, 1, 2])) for i in range(300)]
    rows += rows[:20] + [(None, [0.5] * 32, 3), (None, [0.25] * 32, None)]
    return rows + [(-9, None, 1), (-8, [], 1), (-7, [None] * 32, 1), (-6, [math.nan] + [0.0] * 31, 1), (-5, [math.inf] * 32, 1), (400, [1.0] * 16, 1)]


def test_codes_equal_brute_force(spark, hard):
    df = vectors(spark, hard)
    got = V.code_digests(df)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert rows_of(got) == by_hand(df.collect())


def test_table_equals_brute_force_and_sql(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = rows_of(V.code_digests(df))
    assert got == by_hand(df.collect())
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    assert sorted(con.execute(V.ORACLE).fetchall(), key=repr) == got


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(None, [0.5] * 16, None)], [(3, [0.5] * 16, 1), (3, [0.25] * 16, 1)]])
def test_few_vectors(spark, rows):
    df = vectors(spark, rows)
    assert rows_of(V.code_digests(df)) == by_hand(df.collect())


def test_other_shapes(spark, hard):
    df = vectors(spark, hard)
    coded = V.compress(df, parts=4, entries=5, rounds=4)
    want = by_hand(df.collect(), 4, 5, 4)
    got = sorted((r.id, "".join(f"{k:02x}" for k in r.codes), r.error) for r in coded.rows.filter("id is not null").collect())
    assert got == sorted(w[:3] for w in want if w[0] is not None)
    with pytest.raises(ValueError, match="equal parts"):
        V.compress(df, parts=5)


def test_active_rescan_equals_full():
    rng = np.random.default_rng(4)
    for k in range(60):
        part, book = rng.integers(-3, 4, (200, 2)), rng.integers(-3, 4, (12, 2))
        code, dist = V.assign(part, book)
        new = book.copy()
        shift = rng.random(len(book)) < k / 60
        new[shift] += rng.integers(-2, 3, (int(shift.sum()), 2))
        moved = (new != book).any(1)
        again, full = V.assign(part, new, code, dist, moved), V.assign(part, new)
        assert (again[0] == full[0]).all() and (again[1] == full[1]).all()


def test_large_components_stay_exact():
    part, book = np.array([[1 << 29, -(1 << 29)], [1 << 29, 3 - (1 << 29)]]), np.array([[(1 << 29) - 1, -(1 << 29)], [0, 0]])
    assert V.distances(part, book).tolist() == [[1, 1 << 59], [10, (1 << 58) + ((1 << 29) - 3) ** 2]]
    with pytest.raises(ValueError, match="64 bits"):
        V.distances(part * 4, book)
