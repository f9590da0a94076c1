"""Frames to function names: A1, A2, J1-J3, M7.

Plan shape, chosen for skewed production data (one library owning a large
share of frames, the same root frames in every stack):

* hangs are first reduced to **distinct stacks** (``sid`` = 128-bit content id),
  so frame work scales with distinct stacks, not with hangs;
* distinct stacks are exploded once and reduced to the **distinct frame
  dictionary** (A1), the only rows the symbol lookup sees;
* the as-of lookup (J1) partitions by (module, address range), so a hot
  module is spread over many tasks and no task sorts more than two address
  ranges' worth of rows;
* frames go back to their stacks through an equi-join on the frame key and
  one ``groupBy(sid)`` (J2/J3) that also derives category and component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hangscope.config import UNCATEGORIZED, HangConfig
from hangscope.session import materialize
from hangscope.functions.frames import hex_to_bigint, stack_id, symbolic_frame
from hangscope.functions.rules import (CATEGORY_RULES_1, CATEGORY_RULES_2, COMPONENT_RULES, component_flags,
                                       component_of, first_rule)

MOD = ["debug_name", "breakpad_id"]
FRAME_KEY = ["pseudo", "debug_name", "breakpad_id", "offset"]


def frame_id() -> list[Column]:
    """``k1, k2``: 128-bit content id of the columns ``FRAME_KEY``, by which frames are joined.  The hash skips nulls, so each column goes in with a
    flag that tells whether it is one."""
    flagged = [v for c in FRAME_KEY for v in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*flagged).alias("k1"), F.xxhash64(F.lit("hangscope"), *flagged).alias("k2")]


def distinct_frames(stacks: DataFrame) -> DataFrame:
    """A1: distinct decoded frames of a set of stacks (column ``stack``)."""
    return stacks.select(F.explode("stack").alias("f")).select("f.*").distinct()


def offsets_by_module(frames: DataFrame) -> DataFrame:
    """A2: per module, how many distinct offsets it was hit at, and their range.

    The original grouped the offsets themselves into one tuple per module to
    feed a per-module loop; the as-of join below needs no such list, so only
    its summary is reported (a hot module would otherwise be one huge row).
    """
    native = frames.where(~F.col("pseudo") & F.col("debug_name").isNotNull())
    v = hex_to_bigint(F.col("offset"))
    return native.groupBy(*MOD).agg(F.count_distinct("offset").alias("n_offsets"),
                                     F.min(v).alias("min_offset"), F.max(v).alias("max_offset"))


def offset_sets(frames: DataFrame) -> DataFrame:
    """A2: the offsets at which each module was hit, as bitmaps:
    ``debug_name, breakpad_id, bucket, offsets`` with a bit per address in
    buckets of 32,768.  Exact, and no row grows with a module: a hot module has
    more buckets, not a longer list.  Offsets that aren't hex are in no set."""
    v = hex_to_bigint(F.col("offset"))
    native = frames.where(~F.col("pseudo") & F.col("debug_name").isNotNull() & v.isNotNull()).select(*MOD, v.alias("v"))
    return native.groupBy(*MOD, F.bitmap_bucket_number("v").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("offsets"))


def decode_offset_sets(sets: DataFrame) -> DataFrame:
    """``debug_name, breakpad_id, value`` for each offset of :func:`offset_sets`."""
    text = sets.select(*MOD, "bucket", F.hex("offsets").alias("hex"))
    filled = F.filter(F.sequence(F.lit(0), (F.length("hex") / 2 - 1).cast("int")), lambda i: F.substr(F.col("hex"), 2 * i + 1, F.lit(2)) != "00")
    bytes_ = text.select(*MOD, "bucket", "hex", F.explode(filled).alias("i"))
    byte = F.conv(F.substr(F.col("hex"), 2 * F.col("i") + 1, F.lit(2)), 16, 10).cast("int")
    bits = bytes_.select(*MOD, "bucket", "i", byte.alias("byte"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit")).where(
        F.expr("byte >> bit & 1") == 1)
    place = F.col("i") * 8 + F.col("bit")
    # bucket 0 holds offset 0; bucket k holds the 32,768 offsets from (k - 1) * 32,768 + 1 on
    value = F.when(F.col("bucket") == 0, place.cast("long")).otherwise((F.col("bucket") - 1) * 32768 + 1 + place)
    return bits.select(*MOD, value.alias("value"))


def symbol_asof(frames: DataFrame, symbols: DataFrame, bits: int = 16) -> DataFrame:
    """For each (module, hex offset), the symbol at the greatest address
    <= offset in that module's table; null when there is none, the offset is
    not hex, or the module has no symbols.

    Two window passes, no range join:

    1. rows are keyed by (module, address >> bits); symbols and frames of one
       address range are sorted together and each frame takes the last symbol
       before it (``last(..., ignorenulls)``);
    2. frames whose range holds no earlier symbol take the last symbol of the
       nearest lower range, found by a second window over per-range summaries
       (one row per non-empty range, so a module's partition stays small).
    """
    f = (frames.where(F.col("breakpad_id").isNotNull() & F.col("debug_name").isNotNull())
               .select(*MOD, "offset", hex_to_bigint(F.col("offset")).alias("v")))
    fv = f.where(F.col("v").isNotNull())
    s = symbols.select(*MOD, "address", "symbol").join(fv.select(*MOD).distinct(), MOD, "left_semi")

    def rng(c):
        return F.shiftright(c, bits)

    level1 = (s.select(*MOD, rng(F.col("address")).alias("b"), F.col("address").alias("k"), F.lit(0).alias("tag"),
                       "symbol", F.lit(None).cast("string").alias("offset"))
               .unionByName(fv.select(*MOD, rng(F.col("v")).alias("b"), F.col("v").alias("k"), F.lit(1).alias("tag"),
                                      F.lit(None).cast("string").alias("symbol"), "offset")))
    w1 = Window.partitionBy(*MOD, "b").orderBy("k", "tag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = (level1.withColumn("near", F.last("symbol", ignorenulls=True).over(w1))
                  .where(F.col("tag") == 1).select(*MOD, "b", "offset", "near"))

    summary = s.groupBy(*MOD, rng(F.col("address")).alias("b")).agg(F.max_by("symbol", "address").alias("last_sym"))
    level2 = (summary.select(*MOD, "b", F.lit(1).alias("tag"), "last_sym")
                     .unionByName(fv.select(*MOD, rng(F.col("v")).alias("b")).distinct()
                                    .select(*MOD, "b", F.lit(0).alias("tag"), F.lit(None).cast("string").alias("last_sym"))))
    w2 = Window.partitionBy(*MOD).orderBy("b", "tag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = (level2.withColumn("carry", F.last("last_sym", ignorenulls=True).over(w2))
                   .where(F.col("tag") == 0).select(*MOD, "b", "carry"))

    found = (near.join(carry, MOD + ["b"], "left")
                 .select(*MOD, "offset", F.coalesce("near", "carry").alias("symbol")))
    not_hex = f.where(F.col("v").isNull()).select(*MOD, "offset", F.lit(None).cast("string").alias("symbol"))
    # a module without a name or id has no symbol file
    no_file = frames.where(F.col("breakpad_id").isNull() | F.col("debug_name").isNull()).select(
        *MOD, "offset", F.lit(None).cast("string").alias("symbol"))
    return found.unionByName(not_hex).unionByName(no_file)


def frame_dictionary(frames: DataFrame, symbols: DataFrame, cfg: HangConfig) -> DataFrame:
    """Distinct decoded frames -> (frame key, func, lib, rule hits).

    J1 resolves native frames with a module; M7 names every frame; the
    category rules (both sets) and component substrings are evaluated here,
    once per distinct frame rather than once per stack position.
    """
    lookup = frames.where(~F.col("pseudo") & F.col("debug_name").isNotNull())
    # distinct frames in, one row per frame out
    resolved = symbol_asof(lookup.select(*MOD, "offset"), symbols, cfg.symbol_bucket_bits)
    with_sym = resolved.select(F.lit(False).alias("pseudo"), *MOD, "offset", "symbol")
    rest = frames.where(F.col("pseudo") | F.col("debug_name").isNull()).select(
        *FRAME_KEY, F.lit(None).cast("string").alias("symbol"))
    d = with_sym.unionByName(rest)
    sf = symbolic_frame(F.struct(*FRAME_KEY), F.col("symbol"))
    return (d.select(*FRAME_KEY, sf["func"].alias("func"), sf["lib"].alias("lib"))
             .select(*FRAME_KEY, "func", "lib",
                     first_rule(F.col("func"), CATEGORY_RULES_1).alias("cat1"),
                     first_rule(F.col("func"), CATEGORY_RULES_2).alias("cat2"),
                     component_flags(F.col("func")).alias("comp")))


def distinct_stacks(df: DataFrame) -> DataFrame:
    """Distinct (sid, stack) pairs.  The array is a key of the hash
    aggregation: as a value it would force a sort-based one."""
    return df.select("sid", "stack").distinct()


def symbolicate_stacks(stacks: DataFrame, symbols: DataFrame, cfg: HangConfig) -> DataFrame:
    """J2+J3 (+M2, M6): distinct (sid, stack) -> symbolic stack and its labels.

    Output: ``sid, sym_stack array<struct<func,lib>>, ssid, category,
    component``.  A stack with no frames has no row (inner semantics).
    """
    # the id as two numbers: rows are sorted by their bytes
    exploded = stacks.select(F.col("sid.h1").alias("s1"), F.col("sid.h2").alias("s2"), F.posexplode("stack").alias("pos", "f")).select("s1", "s2", "pos", "f.*")
    fkeys = materialize(exploded.select(*FRAME_KEY).distinct())
    fdict = frame_dictionary(fkeys, symbols, cfg).select(*frame_id(), "func", "lib", "cat1", "cat2", "comp")
    # dealt by stack before they are collected: after the join a task has few frames of any one stack
    joined = exploded.select("s1", "s2", "pos", *frame_id()).join(fdict, ["k1", "k2"]).select(
        "s1", "s2", "pos", "func", "lib", "cat1", "cat2", "comp").repartition("s1", "s2")
    pos_if = lambda c: F.when(F.col(c).isNotNull(), F.col("pos"))
    agg = joined.groupBy("s1", "s2").agg(
        F.sort_array(F.collect_list(F.struct("pos", "func", "lib"))).alias("frames"),
        F.max_by("cat1", pos_if("cat1")).alias("cat1"),
        F.max_by("cat2", pos_if("cat2")).alias("cat2"),
        *[F.bool_or(F.col("comp")[i]).alias(f"c{i}") for i in range(len(COMPONENT_RULES))],
    )
    sym_stack = F.transform("frames", lambda x: F.struct(x["func"].alias("func"), x["lib"].alias("lib")))
    return agg.select(
        F.struct(F.col("s1").alias("h1"), F.col("s2").alias("h2")).alias("sid"), sym_stack.alias("sym_stack"),
        F.coalesce("cat1", "cat2", F.lit(UNCATEGORIZED)).alias("category"),
        component_of(F.array(*[F.col(f"c{i}") for i in range(len(COMPONENT_RULES))])).alias("component"),
    ).withColumn("ssid", stack_id(F.col("sym_stack")))
