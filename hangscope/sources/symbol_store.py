"""Symbols kept as a table partitioned by module, read by need.

Parsing symbol text again for every window is the costly part of a daily job,
and a window meets few of all modules.  ``write_symbol_store`` keeps resolved
symbols (after S9) in a folder per module; ``needed_symbols`` joins the table
with the modules that occur in the frames, so that the scan prunes to their
folders at run time (dynamic partition pruning): other modules' files are never
opened.  The module list is written and counted first; only a list within
``MODULE_ROWS`` is broadcast, which is what pruning at run time takes, and a
longer one is joined by shuffle.

A module's symbols are sorted by address and split into files by address
range, so neither a task nor a file grows with a module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hangscope.functions.frames import hex_to_bigint
from hangscope.session import materialize

MOD = ["debug_name", "breakpad_id"]
MODULE_ROWS = 200_000        # of a module list that may be broadcast: two short texts a row
SCHEMA = T.StructType([T.StructField("address", T.LongType()), T.StructField("symbol", T.StringType()),
                       T.StructField("debug_name", T.StringType()), T.StructField("breakpad_id", T.StringType())])


def write_symbol_store(symbols: DataFrame, path: str, bits: int = 24) -> None:
    """Symbols (``debug_name, breakpad_id, address, symbol``) in a folder per module; modules written before are replaced, others stay.

    Empty names and ids have no folder of their own that could be read back, so
    such symbols raise."""
    told = F.when((F.col("debug_name") != "") & (F.col("breakpad_id") != ""), F.lit(True)).otherwise(
        F.raise_error(F.lit("a symbol's module has no name or id")).cast("boolean"))
    rows = symbols.where(told).select("address", "symbol", *MOD).withColumn("range", F.shiftright("address", bits))
    dealt = rows.repartition(*MOD, "range").sortWithinPartitions(*MOD, "address").drop("range")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MOD).parquet(path)


def read_symbol_store(spark: SparkSession, path: str) -> DataFrame:
    """All symbols of the store; names and ids stay text."""
    return spark.read.schema(SCHEMA).parquet(path)


def modules_of(frames: DataFrame) -> DataFrame:
    """The modules that frames (``debug_name, breakpad_id, offset``) can have symbols of: those with a name, an id and a hex offset."""
    hexed = (F.col("offset") != "") & hex_to_bigint(F.col("offset")).isNotNull()
    return frames.where(F.col("debug_name").isNotNull() & F.col("breakpad_id").isNotNull() & hexed).select(*MOD).distinct()


def needed_symbols(store: DataFrame, frames: DataFrame, limit: int = MODULE_ROWS) -> DataFrame:
    """The symbols of the modules that occur in ``frames``, from a table of :func:`read_symbol_store`."""
    modules = materialize(modules_of(frames))
    # the predicate is true of every module; it tells the planner that the list prunes
    few = modules.where(F.col("debug_name") != "")
    return store.join(F.broadcast(few) if modules.count() <= limit else few, MOD, "left_semi").select(*MOD, "address", "symbol")
