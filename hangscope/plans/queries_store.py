"""Registered queries of what is written and read again: profiles (S11, A12), the symbol store, kept totals, offset sets, raw JSON pings and the
jobs' counters."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangscope.config import DEFAULT
from hangscope.functions.frames import build_date, stack_text
from hangscope.operators import reingest
from hangscope.operators import stacktree as ST
from hangscope.operators.profile import pack_chunks, pack_profile, usage_hours_json
from hangscope.operators.rates import usage_hours_by_date
from hangscope.operators.symbolicate import decode_offset_sets, distinct_frames, distinct_stacks, offset_sets, symbol_asof
from hangscope.plans import jobs
from hangscope.plans import pipelines as PL
from hangscope.plans.jobs import derived_inputs
from hangscope.plans.queries import query
from hangscope.session import materialize
from hangscope.sources import derived
from hangscope.sources.json_pings import json_pings
from hangscope.sources.profiles import (read_chunks, read_profile, read_split, scratch_path, write_chunks, write_profile,
                                        write_split)
from hangscope.sources.snapshots import read_days, read_text
from hangscope.sources.symbol_store import needed_symbols, read_symbol_store, write_symbol_store


def _tables(spark, sf):
    i = derived_inputs(spark, sf, DEFAULT)
    return PL.profile_tables(i, DEFAULT), usage_hours_by_date(i.pings)


def _report(rows: DataFrame) -> DataFrame:
    return rows.select(stack_text(F.col("sym_stack")).alias("stack"), "thread", "build_date", "runnable", "pending_input", "platform",
                       "sample_ms", "sample_count")


@query("reingest_documents")
def q_reingest_documents(spark: SparkSession, sf: str) -> DataFrame:
    """A document per thread written, read back and decoded to rows."""
    t, usage = _tables(spark, sf)
    path = scratch_path(spark, "documents")
    write_profile(pack_profile(t, usage, DEFAULT.run_id), usage_hours_json(usage), path, DEFAULT.run_id)
    return _report(reingest.profile_rows(reingest.decode_documents(read_profile(spark, path))))


@query("reingest_chunks")
def q_reingest_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The default output (chunks, here of 500 entries) written, read back and decoded to rows."""
    t, usage = _tables(spark, sf)
    path = scratch_path(spark, "chunks")
    write_chunks(pack_chunks(t, 500), usage_hours_json(usage), path, DEFAULT.run_id)
    return _report(reingest.profile_rows(reingest.decode_chunks(read_chunks(spark, path))))


@query("reingest_split")
def q_reingest_split(spark: SparkSession, sf: str) -> DataFrame:
    """Split section tables written, read back and decoded to rows."""
    t, _ = _tables(spark, sf)
    path = scratch_path(spark, "split")
    write_split(t, path)
    return _report(reingest.profile_rows(read_split(spark, path)))


@query("finalize_written")
def q_finalize_written(spark: SparkSession, sf: str) -> DataFrame:
    """A12 on written profiles: two profiles (build dates up to and after 1995) in chunks, read back together, each pruned by its own totals,
    added up."""
    pr = PL.pruned(derived_inputs(spark, sf, DEFAULT), DEFAULT).written()
    root, runs = scratch_path(spark, "profiles"), []
    for name, inside in (("first", F.col("build_date") <= "19951231"), ("second", F.col("build_date") > "19951231")):
        t = PL.tables_of(ST.Pruned(pr.rows.where(inside), pr.stacks, pr.sources), DEFAULT)
        usage = pr.rows.where(inside).select("build_date", "usage_h").distinct()
        write_chunks(pack_chunks(t, 5_000), usage_hours_json(usage), f"{root}/{name}", name)
        runs.append(f"{root}/{name}")
    rows, stacks = reingest.profile_rows_by_id(reingest.decode_chunks(read_chunks(spark, runs)))
    t = reingest.finalize(rows, DEFAULT, stacks)
    keys = t.with_stacks(t.samples).select("thread", F.col("idx").alias("sample_idx"), stack_text(F.col("pruned")).alias("stack"), "runnable",
                                           F.col("userInteracting").alias("pending_input"), "platform")
    return t.dates.join(keys, ["thread", "sample_idx"]).select(
        "stack", "thread", F.col("date").alias("build_date"), "runnable", "pending_input", "platform", "sample_ms", "sample_count")


@query("prune_stacks_stepwise")
def q_prune_stepwise(spark: SparkSession, sf: str) -> DataFrame:
    """T2 kept up: three windows pruned one after the other, each from its own pings and the node totals kept by the one before."""
    out, state = None, None
    for k, (start, end) in enumerate((("19000101", "19931231"), ("19940101", "19951231"), ("19960101", "29991231"))):
        r, stacks = PL.rates_by_id(derived_inputs(spark, sf, DEFAULT.with_(start_date=start, end_date=end)), DEFAULT)
        pr, state = ST.prune_step(r, DEFAULT, state, materialize(stacks))
        path = f"{scratch_path(spark, 'state')}/{k}"
        state.write.parquet(path)
        state = spark.read.schema(ST.STATE).parquet(path)
        s = ST.sample_table_by_date(pr, DEFAULT)
        out = s if out is None else out.unionByName(s)
    return out.select(stack_text(F.col("pruned")).alias("stack"), "thread", "build_date", "runnable", "pending_input", "platform", "sample_ms", "sample_count")


# ---- symbols ----

def _frames(spark, sf):
    return materialize(distinct_frames(distinct_stacks(derived_inputs(spark, sf, DEFAULT).hangs)))


def _store(spark, sf):
    symbols, _ = jobs.symbols_from_lines(derived.symbol_lines(spark, sf))
    path = scratch_path(spark, "symbols")
    write_symbol_store(symbols, path)
    return read_symbol_store(spark, path)


@query("symbol_store")
def q_symbol_store(spark: SparkSession, sf: str) -> DataFrame:
    """Resolved symbols written by module; those of the modules that frames of module indexes below 5 meet, read by need."""
    frames = _frames(spark, sf).where(F.col("debug_name").isin("lib0.pdb", "lib1.so", "lib2.pdb", "lib3.so", "lib4.pdb"))
    return needed_symbols(_store(spark, sf), frames)


@query("symbol_store_asof")
def q_symbol_store_asof(spark: SparkSession, sf: str) -> DataFrame:
    """J1 on the store: native frames against the symbols of the modules that occur."""
    frames = _frames(spark, sf)
    native = frames.where(~F.col("pseudo") & F.col("debug_name").isNotNull())
    return symbol_asof(native.select("debug_name", "breakpad_id", "offset"), needed_symbols(_store(spark, sf), native))


@query("offset_sets")
def q_offset_sets(spark: SparkSession, sf: str) -> DataFrame:
    """A2: the exact offset sets of the modules, from their bitmaps."""
    return decode_offset_sets(offset_sets(_frames(spark, sf)))


# ---- raw JSON pings ----

@query("json_pings")
def q_json_pings(spark: SparkSession, sf: str) -> DataFrame:
    """S1/S4/P1 on JSON text: valid pings, their hang and the frames kept in it."""
    pings, _ = json_pings(derived.json_pings(spark, sf), DEFAULT.with_(start_date="19930101", end_date="19971231"))
    hang = F.col("hangs")[0]
    kept = F.filter(hang["stack"], lambda f: f["kind"] != "malformed")
    return pings.select("ping_id", "os_name", "os_version", "arch", build_date(F.col("build_id")).alias("build_date"), "since_ms",
                        F.size("modules").alias("n_modules"), hang["duration"].alias("duration"), hang["thread"].alias("thread"),
                        hang["runnableName"].alias("runnable"), F.size(hang["annotations"]).alias("n_annotations"), F.size(kept).alias("n_frames"),
                        F.concat_ws(",", F.transform(kept, lambda f: F.coalesce(f["label"], F.concat(f["module_index"].cast("string"), F.lit(":"), f["offset"]))))
                        .alias("frames"))


@query("json_ping_rejects")
def q_json_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, rejects = json_pings(derived.json_pings(spark, sf), DEFAULT)
    return rejects


# ---- jobs ----

@query("job_counters")
def q_job_counters(spark: SparkSession, sf: str) -> DataFrame:
    """What an increment job counts while it runs; symbol lines of every third address lack their fields."""
    a = F.col("line_no") / 2
    lines = derived.symbol_lines(spark, sf).withColumn("line", F.when((F.col("line_no") % 2 == 0) & ((a / 16) % 3 == 1), "FUNC zz").otherwise(F.col("line")))
    pings = derived.raw_pings(spark, sf)
    late = F.col("application.buildId") >= "19980101"
    # a build date whose pings report no usage time
    pings = pings.withColumn("payload", F.when(late, F.col("payload").withField("timeSinceLastPing", F.lit(0).cast("long"))).otherwise(F.col("payload")))
    path = scratch_path(spark, "counted")
    jobs.etl_incremental_write(pings, lines, DEFAULT, path)
    told = json.loads(read_text(spark, f"{path}/counters.json"))
    return spark.createDataFrame([(k, m, v) for k, ms in told.items() for m, v in ms.items()], "counted string, metric string, value long")


@query("tracked_stats_store")
def q_tracked_stats(spark: SparkSession, sf: str) -> DataFrame:
    """J6 as a job: two overlapping windows merged into one store, read back."""
    path = scratch_path(spark, "tracked")
    for start, end in (("19000101", "19951231"), ("19950101", "29991231")):
        jobs.etl_tracked_stats(derived.raw_pings(spark, sf), derived.symbol_lines(spark, sf), DEFAULT.with_(start_date=start, end_date=end), path)
    return read_days(spark, path)
