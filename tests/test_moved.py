"""What pruning, sums and path rebuilding shuffle and write."""

from pyspark.sql import functions as F

from hangscope.config import DEFAULT
from hangscope.functions.frames import stack_id
from hangscope.operators import profile as P
from hangscope.operators import stacktree as ST

ROWS = "thread string, build_date string, sym_stack array<struct<func:string,lib:string>>, hang_ms long"


def _rates(spark, rows):
    sdf = spark.createDataFrame([(t, d, [{"func": f, "lib": "l"} for f in s], ms) for t, d, s, ms in rows], ROWS)
    return (sdf.withColumn("ssid", stack_id(F.col("sym_stack"))).withColumn("runnable", F.lit("r")).withColumn("pending_input", F.lit(False))
            .withColumn("platform", F.lit("p")).withColumn("hang_count", F.lit(1).cast("long")).withColumn("usage_h", F.lit(2.0))
            .withColumn("ms_per_hour", F.col("hang_ms") / 2.0))


def test_cuts_are_worked_out_once_and_stacks_stay_distinct(spark):
    # the cut of a>b is what the third stack is already; the stack that ends at a counts for a alone
    rows = [("t", "20200101", ["a", "b"], 1), ("t", "20200101", ["a"], 1000), ("t", "20200101", ["a", "(other)"], 500), ("u", "20200102", ["a", "b"], 7)]
    for cumulative in (False, True):
        pr = ST.prune(_rates(spark, rows), DEFAULT, cumulative)
        got = {(r.thread, tuple(f.func for f in r.pruned)): r.hang_ms for r in ST.sample_table_by_date(pr, DEFAULT).collect()}
        assert got == {("t", ("a",)): 1000, ("t", ("a", "(other)")): 501, ("u", ("a", "b")): 7}
        assert pr.stacks.count() == pr.stacks.select("pssid").distinct().count()
        for df in (pr.rows, pr.stacks):
            assert "min(pos" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_rebuilt_paths_are_written_while_pending_only(spark, monkeypatch):
    rows = [("t", 0, None, "(root)", None)] + [("t", i, 0, f"f{i}", "l") for i in range(1, 50)] + [("t", i, i - 1, f"f{i}", "l") for i in range(50, 54)]
    df = spark.createDataFrame(rows, "thread string, idx long, prefix_idx long, func string, lib string")
    written, keep = [], P.materialize

    def counted(x):
        out = keep(x)
        written.append(out.count())
        return out

    monkeypatch.setattr(P, "materialize", counted)
    got = {r.idx: [f.func for f in r.path] for r in P.reconstruct_paths(df).collect()}
    assert len(got) == 54 and got[53] == ["f49", "f50", "f51", "f52", "f53"] and got[0] == []
    assert written[0] == 54 and all(n <= 4 for n in written[1:])
