"""Samples meet their names and stacks without moving more than needed."""

from pyspark.sql import functions as F

from hangscope.config import DEFAULT
from hangscope.functions.frames import stack_id
from hangscope.operators import reingest
from hangscope.operators import stacktree as ST
from hangscope.operators.profile import pack_chunks
from hangscope.plans import pipelines as PL

STACK = "array<struct<func:string,lib:string>>"
CFG = DEFAULT.with_(stack_acceptance_threshold=0.1)


def _tables(spark):
    data = [(thread, day, [{"func": f"f{k}_{d}", "lib": "l" if k % 2 else None} for d in range(1 + k % 4)], "run" if k % 3 else None, k % 2 == 0,
             f"p{k % 2}", 100 + k, 1, 2.0, 50.0 + k) for thread in ("Gecko", "Gecko_Child") for day in ("19950101", "19950102") for k in range(8)]
    df = spark.createDataFrame(data, f"thread string, build_date string, sym_stack {STACK}, runnable string, pending_input boolean, platform string, "
                                     "hang_ms long, hang_count long, usage_h double, ms_per_hour double")
    return PL.tables_of(ST.prune(df.withColumn("ssid", stack_id(F.col("sym_stack"))), CFG), CFG)


def _decoded(spark):
    t, chunks = _tables(spark), None
    for name in ("first", "second"):
        part = pack_chunks(t, 3).withColumn("profile_of", F.lit(name))
        chunks = part if chunks is None else chunks.unionByName(part)
    return reingest.decode_chunks(chunks.cache())


def _joins(plan):
    below = [j for i in range(plan.children().size()) for j in _joins(plan.children().apply(i))]
    return below + ([plan] if plan.nodeName() == "Join" else [])


def test_samples_meet_their_names_before_their_stacks(spark):
    rows = reingest.profile_rows(_decoded(spark))
    named = [j for j in _joins(rows._jdf.queryExecution().optimizedPlan()) if "runnable#" in j.condition().toString() or "platform#" in j.condition().toString()]
    assert len(named) == 2
    for j in named:
        assert "path#" not in j.output().toString() and "sym_stack#" not in j.output().toString()


def test_rows_by_id_are_the_rows(spark):
    sections = _decoded(spark)
    rows, stacks = reingest.profile_rows_by_id(sections)
    assert "sym_stack" not in rows.columns
    assert stacks.count() == stacks.select("ssid").distinct().count()
    whole = reingest.profile_rows(sections)
    assert sorted(map(str, rows.join(stacks, "ssid").select(whole.columns).collect())) == sorted(map(str, whole.collect())) != []
    a, b = (reingest.repruned(*x).joined() for x in ((rows, CFG, stacks), (whole, CFG)))
    assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(a.columns)).collect())) != []


def test_samples_look_up_only_the_strings_that_they_name(spark):
    t = _tables(spark)
    used = {(r.thread, r.string) for r in t._sample_strings.collect()}
    want = {(r.thread, v) for r in t.samples.collect() for v in (r.runnable, r.platform, r.category) if v is not None}
    assert used >= want and not any(s.startswith("f") for _, s in used)
    at = {(r.thread, r.idx): r.string for r in t.strings.collect()}
    assert all(at[r.thread, r.runnable_idx] == r.runnable and at[r.thread, r.platform_idx] == r.platform for r in t.samples.collect())


def test_prefix_ids_carry_the_node_in_the_array_only(spark):
    df = spark.createDataFrame([([{"func": "a", "lib": None}, {"func": None, "lib": "b"}, {"func": "a", "lib": "b"}],), ([],), (None,)], f"s {STACK}")

    def by_hand(n):
        h1, h2 = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
        for k in range(n):
            h1, h2 = ST._next_id({"h1": h1, "h2": h2}, F.get("s", F.lit(k)))
        return F.struct(h1.alias("h1"), h2.alias("h2"))

    out = df.select(ST.prefix_ids(F.col("s")).alias("ids"), *[by_hand(n).alias(f"n{n}") for n in (1, 2, 3)]).collect()
    assert [tuple(x) for x in out[0].ids] == [tuple(out[0][f"n{n}"]) for n in (1, 2, 3)] and out[1].ids == [] and out[2].ids is None
    # no struct beside it
    assert ", ids, " not in df.select(ST.prefix_ids(F.col("s")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
