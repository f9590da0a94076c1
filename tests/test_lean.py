"""What hangs, sums and profiles no longer do more often than needed."""

from pyspark.sql import functions as F

from hangscope.config import DEFAULT
from hangscope.functions.frames import raw_stack_id, stack_id
from hangscope.functions.rules import CATEGORY_RULES_1, CATEGORY_RULES_2, first_rule
from hangscope.operators import stacktree as ST
from hangscope.operators import symbolicate as S
from hangscope.operators.profile import stack_category
from hangscope.plans import pipelines as PL

STACK = "array<struct<func:string,lib:string>>"
FRAME = "struct<pseudo:boolean,debug_name:string,breakpad_id:string,offset:string>"


def test_dates_that_are_no_numbers_are_kept(spark):
    data = [("Gecko", d, [{"func": f"f{d}", "lib": "l"}], "run", False, "p", 100, 1, 2.0, 50.0) for d in ("x", "1995", "19950101", "")]
    df = spark.createDataFrame(data, f"thread string, build_date string, sym_stack {STACK}, runnable string, pending_input boolean, platform string, "
                                     "hang_ms long, hang_count long, usage_h double, ms_per_hour double")
    t = PL.tables_of(ST.prune(df.withColumn("ssid", stack_id(F.col("sym_stack"))), DEFAULT), DEFAULT)
    assert sorted(r.date for r in t.dates.collect()) == ["", "1995", "19950101", "x"]
    assert sorted(r.idx for r in t.samples.collect()) == [0, 1, 2, 3]


def test_sums_over_a_parents_rows_share_a_sort(spark):
    placed = spark.createDataFrame([("t", "20200101", 5, 2.0, [(1, 2), (3, 4)])], "thread string, build_date string, ms long, usage_h double, "
                                                                                  "ids array<struct<h1:bigint,h2:bigint>>")
    plan = ST.failing_children(placed, 0.01, True)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Sort [") == 2


def test_frames_meet_their_names_by_id(spark):
    frames = [(True, None, None, "x"), (True, None, None, None), (False, "lib0.pdb", "ID0", "1f"), (False, "lib0.pdb", None, "1f"), (False, None, None, "1f"),
              (False, None, None, None)]
    stacks = spark.createDataFrame([((k, k), frames[k:] + frames[:k]) for k in range(6)], f"sid struct<h1:bigint,h2:bigint>, stack array<{FRAME}>")
    symbols = spark.createDataFrame([("lib0.pdb", "ID0", 16, "named")], "debug_name string, breakpad_id string, address long, symbol string")
    want = [("x", ""), ("<unsymbolicated>", "pseudo"), ("named", "lib0.pdb"), ("<unsymbolicated>", "lib0.pdb"), ("<unsymbolicated>", "unknown"),
            ("<unsymbolicated>", "unknown")]
    out = S.symbolicate_stacks(stacks, symbols, DEFAULT)
    assert {r.sid.h1: [tuple(f) for f in r.sym_stack] for r in out.collect()} == {k: want[k:] + want[:k] for k in range(6)}
    # no join on the frame's texts
    plan = out.select("sid", "sym_stack")._jdf.queryExecution().optimizedPlan().toString()
    assert "<=>" not in plan


def test_raw_stack_ids_tell_nulls_apart(spark):
    fields = ("pseudo", "debug_name", "breakpad_id", "offset")
    f = [(True, None, None, "a"), (True, "a", None, None), (True, None, "a", None), (True, None, None, None), (None, None, None, "a"), (False, None, None, "a")]
    stacks = [[x] for x in f] + [[f[0], f[3]], [f[3], f[0]], [f[3], f[3]], [f[3], f[3], f[3]], [], [(True, "ab", None, None)], [(True, "a", "b", None)]]
    df = spark.createDataFrame([(s,) for s in stacks], f"stack array<{FRAME}>")
    ids = [(r.id.h1, r.id.h2) for r in df.select(raw_stack_id(F.col("stack"), fields).alias("id")).collect()]
    assert len(set(ids)) == len(stacks) == len({a for a, _ in ids}) == len({b for _, b in ids})


def test_leaf_and_category_of_a_stack(spark):
    names = [p for kind, p, _ in CATEGORY_RULES_1 + CATEGORY_RULES_2] + ["nothing", "js::RunScript(JSContext*)", None]
    stacks = [[names[(k * 7 + i * 11) % len(names)] for i in range(k % 6)] for k in range(120)]
    df = spark.createDataFrame([([{"func": n, "lib": None} for n in s],) for s in stacks] + [(None,)], f"s {STACK}")

    def last_hit(rules):
        hits = F.filter(F.transform("s", lambda f: first_rule(f["func"], rules)), lambda c: c.isNotNull())
        return F.try_element_at(hits, F.lit(-1))

    out = df.select(stack_category(F.col("s")).alias("c"), F.coalesce(last_hit(CATEGORY_RULES_1), last_hit(CATEGORY_RULES_2)).alias("want_c"),
                    ST.leaf_id(F.col("s")).alias("l"), F.try_element_at(ST.prefix_ids(F.col("s")), F.lit(-1)).alias("want_l")).collect()
    assert all(r.c == r.want_c and r.l == r.want_l for r in out) and len({r.c for r in out}) > 2
