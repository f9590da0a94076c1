"""What packed documents hold, and how often they are parsed."""

import json

from pyspark.sql import functions as F

from hangscope.config import DEFAULT
from hangscope.functions.frames import stack_id
from hangscope.operators import reingest
from hangscope.operators import stacktree as ST
from hangscope.operators.profile import pack_profile
from hangscope.plans import pipelines as PL

STACK = "array<struct<func:string,lib:string>>"


def _tables(spark, days, each):
    data = [("Gecko", f"1995{1 + d // 28:02d}{1 + d % 28:02d}", [{"func": f"f{d}_{k}", "lib": None}], "run", False, "Linux:8:x86", 100, 1, 2.0, 50.0)
            for d in range(days) for k in range(each)]
    df = spark.createDataFrame(data, f"thread string, build_date string, sym_stack {STACK}, runnable string, pending_input boolean, platform string, "
                                     "hang_ms long, hang_count long, usage_h double, ms_per_hour double")
    cfg = DEFAULT.with_(stack_acceptance_threshold=0.0)
    return PL.tables_of(ST.prune(df.withColumn("ssid", stack_id(F.col("sym_stack"))), cfg), cfg)


def test_dates_of_a_piece_are_not_mostly_gaps(spark):
    t = _tables(spark, 20, 6)
    usage = spark.createDataFrame([], "build_date string, usage_h double")
    docs = pack_profile(t, usage, "run", piece_rows=12).cache()
    dates = [d for r in docs.collect() for d in json.loads(r.profile).get("dates") or []]
    counts = [x for d in dates for x in d["sampleHangCount"]]
    # each piece of 12 samples has those of two dates: 6 entries and 6 gaps before 6 entries
    assert sum(x is not None for x in counts) == 120 and len(counts) == 180
    # and all come back
    got = {(r.build_date, r.sym_stack[0].func) for r in reingest.profile_rows(reingest.decode_documents(docs)).collect()}
    assert got == {(f"1995{1 + d // 28:02d}{1 + d % 28:02d}", f"f{d}_{k}") for d in range(20) for k in range(6)}


def test_documents_are_parsed_once_per_section(spark):
    doc = {"stringArray": ["a", None, "b"], "libs": None, "funcTable": {"name": [0], "lib": [None]}, "stackTable": None, "sampleTable": None,
           "dates": [{"date": "d", "sampleHangMs": [None, None, 3.0], "sampleHangCount": [None, None, 1.0]},
                     {"date": "e", "sampleHangMs": [2.0, 4.0], "sampleHangCount": [None, 5.0]}, {"date": "f", "sampleHangMs": None, "sampleHangCount": None}]}
    docs = spark.createDataFrame([("t", 10, json.dumps(doc)), ("u", None, "{}"), ("v", 0, None)], "name string, first long, profile string")
    d = reingest.decode_documents(docs)
    assert sorted(map(tuple, d["dates"].collect())) == [("", "t", "d", 12, 3.0, 1.0), ("", "t", "e", 11, 4.0, 5.0)]
    assert sorted(map(tuple, d["stringArray"].collect()), key=str) == [("", "t", 10, "a"), ("", "t", 11, None), ("", "t", 12, "b")]
    assert [tuple(r) for r in d["funcTable"].collect()] == [("", "t", 10, 0, None)]
    for name in d:
        plan = d[name]._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1, name
