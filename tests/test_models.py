"""Stack pruning and profile indexes against direct models on random stacks."""

import random

from pyspark.sql import functions as F

from hangscope.config import DEFAULT


def _model_prune(rows, thr):
    """Direct walk: per (thread, date) node totals, keep while ratio > thr."""
    totals, roots = {}, {}
    for th, d, stack, ms in rows:
        roots[(th, d)] = roots.get((th, d), 0) + ms
        for i in range(len(stack)):
            k = (th, d, tuple(stack[: i + 1]))
            totals[k] = totals.get(k, 0) + ms
    out = {}
    for th, d, stack, ms in rows:
        parent = roots[(th, d)]
        res = []
        for i, f in enumerate(stack):
            t = totals[(th, d, tuple(stack[: i + 1]))]
            if t / parent > thr:
                res.append(f)
                parent = t
            else:
                res.append(("(other)", f[1]))
                break
        key = (th, d, tuple(res))
        out[key] = out.get(key, 0) + ms
    return out


def test_daily_pruning_matches_model(spark):
    from hangscope.functions.frames import stack_id
    from hangscope.operators.stacktree import prune, sample_table_by_date
    rnd = random.Random(3)
    funcs = [(f"f{i}", f"l{i % 3}") for i in range(6)]
    rows = []
    for _ in range(400):
        depth = rnd.randint(1, 6)
        stack = [funcs[rnd.randrange(6)] for _ in range(depth)]
        rows.append((rnd.choice(["A", "B"]), rnd.choice(["20200101", "20200102"]), stack, rnd.choice([1, 5, 50, 500])))
    sdf = spark.createDataFrame(
        [(t, d, [{"func": f, "lib": l} for f, l in s], ms) for t, d, s, ms in rows],
        "thread string, build_date string, sym_stack array<struct<func:string,lib:string>>, hang_ms long")
    r = (sdf.groupBy("thread", "build_date", "sym_stack").agg(F.sum("hang_ms").alias("hang_ms"))
         .withColumn("ssid", stack_id(F.col("sym_stack")))
         .withColumn("runnable", F.lit("r")).withColumn("pending_input", F.lit(False)).withColumn("platform", F.lit("p"))
         .withColumn("hang_count", F.lit(1).cast("long")).withColumn("usage_h", F.lit(2.0))
         .withColumn("ms_per_hour", F.col("hang_ms") / 2.0))
    thr = 0.05
    s = sample_table_by_date(prune(r, DEFAULT.with_(stack_acceptance_threshold=thr)), DEFAULT)
    got = {(x.thread, x.build_date, tuple((f.func, f.lib) for f in x.pruned)): x.hang_ms for x in s.collect()}
    assert got == _model_prune(rows, thr)
    # pruning twice changes nothing
    again = (s.select("thread", "build_date", F.col("pruned").alias("sym_stack"), "runnable", "pending_input",
                      "platform", "hang_ms", "hang_count", "usage_h", F.col("sample_ms").alias("ms_per_hour"))
             .withColumn("ssid", stack_id(F.col("sym_stack"))))
    s2 = sample_table_by_date(prune(again, DEFAULT.with_(stack_acceptance_threshold=thr)), DEFAULT)
    got2 = {(x.thread, x.build_date, tuple((f.func, f.lib) for f in x.pruned)): x.hang_ms for x in s2.collect()}
    assert got2 == got


def test_dense_index_is_dense(spark):
    from hangscope.operators.profile import dense_index
    df = spark.createDataFrame([(t, f"k{i}") for t in ("a", "b") for i in range(37 if t == "a" else 5)],
                               "thread string, key string")
    got = dense_index(df, ["thread"], ["key"]).collect()
    for t, n in (("a", 37), ("b", 5)):
        assert sorted(r.idx for r in got if r.thread == t) == list(range(n))


def test_reconstruct_paths(spark):
    from hangscope.operators.profile import reconstruct_paths
    # chain 0 <- 1 <- 2 <- ... <- 20 plus a branch 21 under 3
    rows = [("t", 0, None, "(root)", None)] + [("t", i, i - 1, f"f{i}", "l") for i in range(1, 21)] + [("t", 21, 3, "g", "l")]
    df = spark.createDataFrame(rows, "thread string, idx long, prefix_idx long, func string, lib string")
    got = {r.idx: [f.func for f in r.path] for r in reconstruct_paths(df).collect()}
    assert got[0] == [] and got[20] == [f"f{i}" for i in range(1, 21)] and got[21] == ["f1", "f2", "f3", "g"]
