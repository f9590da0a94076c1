"""Registered queries for the profile tables (decoded through their indexes,
so each check also verifies that every index resolves)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangscope.config import DEFAULT
from hangscope.functions.frames import stack_text
from hangscope.operators.profile import reconstruct_paths, stack_category
from hangscope.plans import pipelines as PL
from hangscope.plans.jobs import derived_inputs
from hangscope.plans.queries import query
from hangscope.session import materialize
from hangscope.sources import derived


def _tables(spark, sf, cfg=DEFAULT):
    return PL.profile_tables(derived_inputs(spark, sf, cfg), cfg)


def _paths(t):
    return reconstruct_paths(materialize(t.stacks.select("thread", "idx", "prefix_idx", "func", "lib")))


def _decoded_samples(t, paths):
    s = materialize(t.samples)
    p = paths.select("thread", F.col("idx").alias("stack_idx"), stack_text(F.col("path")).alias("stack"))
    st = t.strings.select("thread", F.col("idx").alias("runnable_idx"), F.col("string").alias("runnable_s"))
    pl = t.strings.select("thread", F.col("idx").alias("platform_idx"), F.col("string").alias("platform_s"))
    return (s.join(p, ["thread", "stack_idx"]).join(st, ["thread", "runnable_idx"]).join(pl, ["thread", "platform_idx"])
             .select("thread", F.col("idx").alias("sample_idx"), "stack", F.col("runnable_s").alias("runnable"),
                     "userInteracting", F.col("platform_s").alias("platform"), "category"))


@query("string_table")
def q_strings(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf).strings.select("thread", "string")


@query("lib_table")
def q_libs(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf).libs.select("thread", "name", "debugName")


@query("func_table")
def q_funcs(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf)
    names = t.strings.select("thread", F.col("idx").alias("name_idx"), F.col("string").alias("func_name"))
    libs = t.libs.select("thread", F.col("idx").alias("lib_idx"), F.col("debugName").alias("lib_name"))
    return (t.funcs.join(names, ["thread", "name_idx"]).join(libs, ["thread", "lib_idx"], "left")
            .select("thread", F.col("func_name").alias("func"), F.col("lib_name").alias("lib")))


@query("stack_table")
def q_stack_table(spark: SparkSession, sf: str) -> DataFrame:
    """Each stack row decoded: its function (through the func table) and the
    path of its prefix (through the prefix index)."""
    t = _tables(spark, sf)
    paths = _paths(t)
    f = t.funcs.select("thread", F.col("idx").alias("func_idx"), F.col("func").alias("f_func"), F.col("lib").alias("f_lib"))
    pp = paths.select("thread", F.col("idx").alias("prefix_idx"), stack_text(F.col("path")).alias("prefix"))
    return (t.stacks.where(F.col("idx") > 0).join(f, ["thread", "func_idx"]).join(pp, ["thread", "prefix_idx"])
            .select("thread", F.col("f_func").alias("func"), F.col("f_lib").alias("lib"), "prefix"))


@query("reconstruct_stacks")
def q_reconstruct(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(_tables(spark, sf)).select("thread", stack_text(F.col("path")).alias("stack"))


@query("sample_table")
def q_sample_table(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf)
    return _decoded_samples(t, _paths(t)).drop("sample_idx")


@query("sample_category")
def q_sample_category(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf)
    return t.with_stacks(t.samples).select("thread", stack_text(F.col("pruned")).alias("stack"),
                                           stack_category(F.col("pruned")).alias("category")).distinct()


def _sample_keys(t):
    """Sample rows with their own key columns (stack text from the sample's
    pruned stack); index integrity is checked by ``sample_table``."""
    return t.with_stacks(t.samples).select("thread", F.col("idx").alias("sample_idx"), stack_text(F.col("pruned")).alias("stack"),
                                           "runnable", "userInteracting", "platform")


@query("dates_table")
def q_dates(spark: SparkSession, sf: str) -> DataFrame:
    t = _tables(spark, sf)
    return (t.dates.join(_sample_keys(t), ["thread", "sample_idx"])
            .select("thread", "date", "stack", "runnable", "userInteracting", "platform", "sample_ms", "sample_count"))


@query("minimal_profile")
def q_minimal(spark: SparkSession, sf: str) -> DataFrame:
    cfg = DEFAULT.with_(use_minimal_sample_table=True)
    t = _tables(spark, sf, cfg)
    return t.dates.join(_sample_keys(t), ["thread", "sample_idx"]).select("thread", "date", "stack", "sample_count")


@query("pack_profile")
def q_pack(spark: SparkSession, sf: str) -> DataFrame:
    from hangscope.operators.profile import pack_profile
    from hangscope.operators.rates import usage_hours_by_date
    i = derived_inputs(spark, sf, DEFAULT)
    t = PL.profile_tables(i, DEFAULT)
    doc = pack_profile(t, usage_hours_by_date(i.pings), DEFAULT.run_id)
    n = lambda path: F.json_array_length(F.get_json_object("profile", path)).cast("long")
    j = lambda path: F.get_json_object("profile", path).cast("long")
    pieces = materialize(doc.select(
        "name", F.get_json_object("profile", "$.processType").alias("process_type"), n("$.libs").alias("n_libs"), j("$.funcTable.length").alias("n_funcs"),
        j("$.stackTable.length").alias("n_stacks"), j("$.sampleTable.length").alias("n_samples"), n("$.stringArray").alias("n_strings"),
        F.from_json("profile", "dates array<struct<date:string>>")["dates"]["date"].alias("dates")))
    counts = ["n_libs", "n_funcs", "n_stacks", "n_samples", "n_strings"]
    sums = pieces.groupBy("name", "process_type").agg(*[F.sum(c).alias(c) for c in counts])
    # a date that several pieces have is one date of the thread
    dates = pieces.select("name", F.explode("dates").alias("date")).groupBy("name").agg(F.count_distinct("date").alias("n_dates"))
    return sums.join(dates, "name", "left").select("name", "process_type", *counts, "n_dates")


# ---- sinks, increments, merges (S11-S13, A9, A12, J6, P14) ----

@query("finalize_profiles")
def q_finalize(spark: SparkSession, sf: str) -> DataFrame:
    """Incremental write (daily pruned samples, one partition per build date)
    then finalize: read back, re-prune per day, add up."""
    from hangscope.plans.jobs import finalize_daily
    from hangscope.sources.profiles import scratch_path
    from hangscope.sources.snapshots import write_days
    i = derived_inputs(spark, sf, DEFAULT)
    path = scratch_path(spark, "daily")
    write_days(PL.samples(i, DEFAULT, cumulative=False), path)
    s = finalize_daily(spark, path, DEFAULT)
    return s.select(stack_text(F.col("pruned")).alias("stack"), "thread", "build_date", "runnable",
                    "pending_input", "platform", "sample_ms", "sample_count")


@query("post_sample")
def q_post_sample(spark: SparkSession, sf: str) -> DataFrame:
    from hangscope.plans.jobs import finalize_daily
    from hangscope.sources.profiles import scratch_path
    from hangscope.sources.snapshots import write_days
    i = derived_inputs(spark, sf, DEFAULT)
    path = scratch_path(spark, "daily")
    write_days(PL.samples(i, DEFAULT, cumulative=False), path)
    s = finalize_daily(spark, path, DEFAULT.with_(post_sample_size=0.5))
    return s.select(stack_text(F.col("pruned")).alias("stack"), "thread", "build_date", "runnable",
                    "pending_input", "platform", "sample_ms", "sample_count")


@query("write_profile")
def q_write_profile(spark: SparkSession, sf: str) -> DataFrame:
    from hangscope.operators.profile import pack_profile, usage_hours_json
    from hangscope.operators.rates import usage_hours_by_date
    from hangscope.sources.profiles import read_profile, scratch_path, write_profile
    i = derived_inputs(spark, sf, DEFAULT)
    t = PL.profile_tables(i, DEFAULT)
    usage = usage_hours_by_date(i.pings)
    path = scratch_path(spark, "profile")
    write_profile(pack_profile(t, usage, DEFAULT.run_id), usage_hours_json(usage), path, DEFAULT.run_id)
    doc = read_profile(spark, path)
    j = lambda p: F.get_json_object("profile", p).cast("long")
    pieces = doc.select("name", j("$.funcTable.length").alias("n_funcs"), j("$.stackTable.length").alias("n_stacks"),
                        j("$.sampleTable.length").alias("n_samples"))
    return pieces.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("n_funcs", "n_stacks", "n_samples")])


@query("write_split")
def q_write_split(spark: SparkSession, sf: str) -> DataFrame:
    from hangscope.sources.profiles import scratch_path, write_split
    t = PL.profile_tables(derived_inputs(spark, sf, DEFAULT), DEFAULT)
    return write_split(t, scratch_path(spark, "split"))


def _window_inputs(spark, sf, start, end):
    return derived_inputs(spark, sf, DEFAULT.with_(start_date=start, end_date=end))


@query("merge_histograms")
def q_merge_hist(spark: SparkSession, sf: str) -> DataFrame:
    """An earlier result (build dates up to 1995-12) merged with a new one
    (from 1995-01): new keys win, earlier-only keys stay."""
    from hangscope.operators.histograms import merge_histograms
    old = PL.histogram_rates(_window_inputs(spark, sf, "19000101", "19951231"), DEFAULT)
    new = PL.histogram_rates(_window_inputs(spark, sf, "19950101", "29991231"), DEFAULT)
    return merge_histograms(old, new)


@query("merge_usage_hours")
def q_merge_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Usage hours of two windows added per date (overlap counted twice)."""
    from hangscope.operators.rates import merge_usage_hours, usage_hours_by_date
    a = usage_hours_by_date(_window_inputs(spark, sf, "19000101", "19951231").pings)
    b = usage_hours_by_date(_window_inputs(spark, sf, "19950101", "29991231").pings)
    return merge_usage_hours(a, b)


@query("stack_node_totals")
def q_node_totals(spark: SparkSession, sf: str) -> DataFrame:
    """A10: inclusive hang ms of every stack prefix per (thread, build date),
    and the thread's total.  A node is shown by its leaf frame and its parent's
    totals: depth, func, lib of the frame, then the sums."""
    from hangscope.operators.stacktree import prefix_ids, stack_node_totals
    r = materialize(PL.rates(derived_inputs(spark, sf, DEFAULT), DEFAULT))
    names = (r.select("sym_stack").distinct()
              .select(F.explode(F.arrays_zip(prefix_ids(F.col("sym_stack")).alias("node"), F.col("sym_stack").alias("f"))).alias("z"))
              .select("z.node", F.col("z.f.func").alias("func"), F.col("z.f.lib").alias("lib")).distinct())
    return stack_node_totals(r).join(names, "node").select("thread", "build_date", "depth", "func", "lib", "node_ms", "root_ms")


@query("profile_post_sample_ignored")
def q_post_sample_ignored(spark: SparkSession, sf: str) -> DataFrame:
    """P14 belongs to finalize: the windowed samples are whole whatever ``post_sample_size`` says."""
    cfg = DEFAULT.with_(post_sample_size=0.5)
    s = PL.samples(derived_inputs(spark, sf, cfg), cfg, cumulative=False)
    return s.select(stack_text(F.col("pruned")).alias("stack"), "thread", "build_date", "runnable",
                    "pending_input", "platform", "hang_ms", "hang_count")


@query("sample_table_by_date")
def q_samples_daily(spark: SparkSession, sf: str) -> DataFrame:
    s = PL.samples(derived_inputs(spark, sf, DEFAULT), DEFAULT, cumulative=False)
    return s.select(stack_text(F.col("pruned")).alias("stack"), "thread", "build_date", "runnable",
                    "pending_input", "platform", "hang_ms", "hang_count")


@query("minimal_sample_filter")
def q_minimal_filter(spark: SparkSession, sf: str) -> DataFrame:
    cfg = DEFAULT.with_(use_minimal_sample_table=True)
    s = PL.samples(derived_inputs(spark, sf, cfg), cfg, cumulative=False)
    return s.select(stack_text(F.col("pruned")).alias("stack"), "thread", "build_date", "runnable",
                    "pending_input", "platform", "sample_count")


@query("histogram_add")
def q_hist_add(spark: SparkSession, sf: str) -> DataFrame:
    """Bucket arrays of two windows added element-wise per key."""
    from hangscope.operators import histograms as HG
    a = HG.as_array(PL.histogram_counts(_window_inputs(spark, sf, "19000101", "19951231"), DEFAULT))
    b = HG.as_array(PL.histogram_counts(_window_inputs(spark, sf, "19950101", "29991231"), DEFAULT))
    zeros = F.array_repeat(F.lit(0).cast("bigint"), 8)
    j = a.withColumnRenamed("hist", "ha").join(b.withColumnRenamed("hist", "hb"), HG.KEY, "full_outer")
    s = j.select(*HG.KEY, HG.histogram_add(F.coalesce("ha", zeros), F.coalesce("hb", zeros)).alias("hist"))
    return s.select(*HG.KEY, *[F.col("hist")[i].alias(f"h{i}") for i in range(8)])


@query("read_profile")
def q_read_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Daily increments written by build date, read back for a window
    (only the window's partitions are listed and read)."""
    from hangscope.sources.profiles import scratch_path
    from hangscope.sources.snapshots import read_days, write_days
    path = scratch_path(spark, "daily")
    write_days(PL.samples(derived_inputs(spark, sf, DEFAULT), DEFAULT, cumulative=False), path)
    d = read_days(spark, path, "19950101", "19961231")
    return d.select(stack_text(F.col("pruned")).alias("stack"), "thread", "build_date", "runnable",
                    "pending_input", "platform", "hang_ms", "hang_count")


@query("module_key")
def q_module_key(spark: SparkSession, sf: str) -> DataFrame:
    """M9: the text key ``name\\id`` of a module (``None`` for a missing id);
    joins use the two columns, this is the printable form only."""
    return derived.part_modules(spark, sf).distinct().select("debug_name", "breakpad_id",
                       F.concat(F.col("debug_name"), F.lit("\\"), F.coalesce(F.col("breakpad_id"), F.lit("None"))).alias("module_key"))
