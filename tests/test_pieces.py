"""Packed profiles in pieces."""

import json

from pyspark.sql import functions as F

from hangscope.config import DEFAULT
from hangscope.functions.frames import stack_id
from hangscope.operators import reingest
from hangscope.operators import stacktree as ST
from hangscope.operators.profile import pack_profile, usage_hours_json
from hangscope.plans import pipelines as PL
from hangscope.sources.profiles import read_profile, scratch_path, write_profile


def _tables(spark):
    frame = lambda f: {"func": f, "lib": f"lib{f[-1]}.pdb"}
    data = []
    for k in range(23):
        day = "19950101" if k % 3 else "19950201"
        data.append(("Gecko" if k < 20 else "Compositor", day, [frame("main0"), frame(f"f{k}")], f"run{k % 4}", k % 2 == 0, "Linux:8:x86", 100 + k, 1, 2.0, 50.0 + k))
    df = spark.createDataFrame(data, "thread string, build_date string, sym_stack array<struct<func:string,lib:string>>, runnable string, "
                                     "pending_input boolean, platform string, hang_ms long, hang_count long, usage_h double, ms_per_hour double")
    return PL.tables_of(ST.prune(df.withColumn("ssid", stack_id(F.col("sym_stack"))), DEFAULT), DEFAULT)


def test_a_large_thread_is_packed_in_pieces(spark):
    t = _tables(spark)
    usage = spark.createDataFrame([("19950101", 2.0), ("19950201", 2.0)], "build_date string, usage_h double")
    rows = {}
    for size in (1000, 6):
        path = scratch_path(spark, "pieces")
        write_profile(pack_profile(t, usage, "run", piece_rows=size), usage_hours_json(usage), path, "run")
        docs = read_profile(spark, path)
        rows[size] = sorted(map(str, reingest.profile_rows(reingest.decode_documents(docs)).collect()))
        got = {}
        for r in sorted(docs.collect(), key=lambda r: r["first"]):
            got.setdefault(r["name"], []).append(json.loads(r.profile))
        rows[size, "docs"] = got
    assert len(rows[1000]) == 23 and rows[1000] == rows[6]
    whole, cut = rows[1000, "docs"], rows[6, "docs"]
    assert {k: len(v) for k, v in whole.items()} == {"Gecko": 1, "Compositor": 1}
    assert len(cut["Gecko"]) > 3
    for pieces in cut.values():
        for p in pieces:
            assert all(len(p[s] or []) <= 6 for s in ("libs", "stringArray")) and len((p["stackTable"] or {"func": []})["func"]) <= 6
            assert all(len(d["sampleHangMs"]) <= 6 for d in p["dates"] or [])
    for name, [w] in whole.items():
        for section in ("libs", "stringArray"):
            assert [x for p in cut[name] for x in p[section] or []] == w[section]
        for section in ("funcTable", "stackTable", "sampleTable"):
            assert sum((p[section] or {"length": 0})["length"] for p in cut[name]) == w[section]["length"]
        for d in w["dates"]:
            last = max(k for k, x in enumerate(d["sampleHangCount"]) if x is not None)
            assert len(d["sampleHangCount"]) == len(d["sampleHangMs"]) == last + 1
