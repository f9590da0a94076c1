"""Expressions that name a value more than once work it out once."""

from pyspark.sql import functions as F

from hangscope.functions.frames import hex_to_bigint, hex_to_decimal, stack_id
from hangscope.sources.crashes import rebase_frame


def test_hex_values_are_worked_out_once(spark):
    df = spark.createDataFrame([("0x1F", 0, "0x0f"), ("0xfffff80300000010", 0, "0xfffff80300000020"), ("zz", 0, "0x1"), ("0x5", 3, "0x1"), (None, 0, "0x1"),
                                ("0x5", 0, None), ("0x5", None, "0x1")], "ip string, module_index int, base string")
    out = df.select(rebase_frame(F.struct("ip", "module_index"), F.array(F.struct(F.col("base").alias("base_addr"))))["offset"].alias("o"))
    assert [r.o for r in out.collect()] == ["0x10", "-0x10", None, "0x5", None, "0x5", None]
    for c, most in ((out, 2), (df.select(hex_to_bigint(F.col("ip")).alias("v")), 1), (df.select(hex_to_decimal(F.col("ip")).alias("v")), 1)):
        plan = c._jdf.queryExecution().optimizedPlan().toString()
        assert 1 <= plan.count("regexp_extract(") <= most


def test_a_stack_id_flags_its_fields_once(spark):
    df = spark.createDataFrame([([{"func": "f", "lib": None}],), ([],), (None,)], "stack array<struct<func:string,lib:string>>")
    out = df.select(stack_id(F.col("stack")).alias("id"))
    flagged = F.transform("stack", lambda f: F.array(*[F.concat(F.when(f[c].isNull(), "n").otherwise("v"), F.coalesce(f[c], F.lit(""))) for c in ("func", "lib")]))
    want = df.select(F.struct(F.xxhash64(flagged).alias("h1"), F.xxhash64(F.lit("hangscope"), flagged).alias("h2")).alias("id"))
    assert out.collect() == want.collect()
    assert out._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN isnull(") == 2
