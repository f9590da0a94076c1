import re

import numpy as np
from pyspark.sql import functions as F

from hangscope.llm import licenses as L
from hangscope.llm.queries import op2_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def base_by_hand(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in L.BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def suppressed_by_hand(first, last, priority):
    order = sorted(range(len(first)), key=lambda i: (-priority[i], first[i] - last[i], i))
    kept = []
    for i in order:
        if not any(first[k] <= first[i] and last[i] <= last[k] for k in kept):
            kept.append(i)
    return sorted(kept)


def test_tables_equal_brute_force(spark, sf_dir):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op2_license_scan(spark, sf_dir).collect()
    assert len(rows) == len(text)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_by_hand(text[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_edges(spark):
    texts = [None, "", "!!!", "MIT  License", "mit-license mit license", "Éa GNU\nGeneral*Public—License", "word " * 50000 + "cc by 4.0 " * 500,
             "admit license", "GNU General Public License GNU general public license v2"]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, texts[3], "x", 1)], "doc_id long, text string, detections string, `a.b` int")
    rows = L.license_columns(L.scan_licenses(df)).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_by_hand(texts[r.doc_id])
    assert L.scan_licenses(df.filter("false")).count() == 0


def test_suppression_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(0, 25))
        first = rng.integers(0, 30, n)
        last, priority = first + rng.integers(0, 12, n), rng.integers(1, 4, n)
        assert np.flatnonzero(L.suppress(first, last, priority)).tolist() == suppressed_by_hand(first, last, priority)


def test_rules_hundreds_and_all_compile():
    assert len(L.RULES) >= 300
    s = L.Scanner(L.RULES, L.BASE)
    for i in range(len(L.RULES)):
        list(s._find(i, b" x "))


def test_detections():
    s = L.Scanner(L.RULES, L.BASE)
    kept = lambda t: {d["label"] for d in s.scan(t)[1] if d["kept"]}
    assert kept("This work is licensed under the GNU General Public License, version 3.") == {"gpl-3.0"}
    assert kept("Licensed under CC BY-NC 4.0.") == {"cc-by-nc-4.0"}
    assert kept("SPDX-License-Identifier: Apache-2.0") == {"apache-2.0"}
    assert kept("Permission is hereby granted, free of charge, to any person obtaining a copy") == {"mit"}
    assert kept("nothing to see") == set()


def alternatives(pattern):
    """The alternatives of a pattern outside of groups."""
    out, depth = [""], 0
    for c in pattern:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def test_keywords_reach_every_alternative():
    names = {r.name.removeprefix("name-"): r for r in L.RULES if r.name.startswith("name-")}
    for r in L.RULES:
        if r.name.startswith("notice-"):    # a name within a template
            r = names[r.name.removeprefix("notice-")]
        assert all(r.keyword in a for a in alternatives(r.pattern)), r
    s = L.Scanner(L.RULES, L.BASE)
    for text in ("AGPLv3", "licensed under AGPL-3.0", "released under the terms of the AGPL v3", "GNU Affero General Public License version 3"):
        assert {d["label"] for d in s.scan(text)[1] if d["kept"]} == {"agpl-3.0"}
