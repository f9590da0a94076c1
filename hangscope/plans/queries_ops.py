"""Registered queries for the single operators (scans, predicates, joins,
scalar functions).  Each reads the given tables through ``sources.derived``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangscope.config import DEFAULT
from hangscope.functions.frames import build_date, hex_to_bigint, stack_text, duration_bucket
from hangscope.functions.rules import CATEGORY_RULES_1, CATEGORY_RULES_2, first_rule
from hangscope.operators import hangs as H
from hangscope.operators.histograms import category_root
from hangscope.operators.rates import usage_hours_by_date
from hangscope.operators.symbolicate import (distinct_frames, distinct_stacks, frame_dictionary, offsets_by_module,
                                             symbol_asof, symbolicate_stacks)
from hangscope.plans import pipelines as PL
from hangscope.plans.jobs import derived_inputs, symbols_from_lines
from hangscope.plans.queries import query
from hangscope.sources import derived
from hangscope.sources.pings import hang_pings, project_properties, scan_hang_pings, stack_from_json, valid_pings
from hangscope.sources.symbols import parse_symbol_lines, symbol_path
from hangscope.session import materialize


def _raw(spark, sf):
    return derived.raw_pings(spark, sf)


def _pings(spark, sf, cfg=DEFAULT):
    return hang_pings(_raw(spark, sf), cfg)


def _decoded(spark, sf):
    """Hangs through P4-P7 (before the ForcePaint copies)."""
    return H.decode_frames(H.frame_shape_filter(H.stack_length_filter(H.explode_hangs(_pings(spark, sf)))))


# ---- scans (S1-S4) ----

@query("scan_hang_pings")
def q_scan(spark: SparkSession, sf: str) -> DataFrame:
    cfg = DEFAULT.with_(start_date="19940101", end_date="19961231")
    return scan_hang_pings(_raw(spark, sf), cfg).select(
        "ping_id", build_date(F.col("application.buildId")).alias("build_date"))


@query("scan_cutover_union")
def q_cutover(spark: SparkSession, sf: str) -> DataFrame:
    cfg = DEFAULT.with_(start_date="19920101", end_date="20200101")
    return scan_hang_pings(_raw(spark, sf), cfg).groupBy("doc_type").agg(F.count(F.lit(1)).alias("n_pings"))


@query("sample_pings")
def q_sample(spark: SparkSession, sf: str) -> DataFrame:
    return scan_hang_pings(_raw(spark, sf), DEFAULT.with_(sample_size=0.5)).select("ping_id")


@query("project_properties")
def q_project(spark: SparkSession, sf: str) -> DataFrame:
    p = project_properties(_raw(spark, sf), DEFAULT)
    return p.select("ping_id", "os_name", "os_version", "arch", "build_id", "since_ms",
                    F.size("modules").alias("n_modules"), F.size("hangs").alias("n_hangs"))


# ---- symbols (S8-S10, M10) ----

@query("parse_symbol_records")
def q_parse_symbols(spark: SparkSession, sf: str) -> DataFrame:
    parsed, _ = parse_symbol_lines(derived.symbol_lines(spark, sf))
    return parsed.select("debug_name", "breakpad_id", "kind", "address", "symbol")


@query("symbol_precedence")
def q_symbol_precedence(spark: SparkSession, sf: str) -> DataFrame:
    symbols, _ = symbols_from_lines(derived.symbol_lines(spark, sf))
    return symbols.select("debug_name", "breakpad_id", "address", "symbol")


@query("truncate_symbol")
def q_truncate(spark: SparkSession, sf: str) -> DataFrame:
    symbols, _ = symbols_from_lines(derived.symbol_lines(spark, sf))
    return symbols.select("debug_name", "address", F.length("symbol").alias("symbol_length"))


@query("symbol_path")
def q_symbol_path(spark: SparkSession, sf: str) -> DataFrame:
    return derived.part_modules(spark, sf).distinct().select("debug_name", "breakpad_id",
                       symbol_path(F.col("debug_name"), F.col("breakpad_id")).alias("path"))


# ---- predicates and projections (P1-P11, P15) ----

@query("valid_pings")
def q_valid(spark: SparkSession, sf: str) -> DataFrame:
    return _pings(spark, sf).select("ping_id", "build_id")


@query("build_date")
def q_build_date(spark: SparkSession, sf: str) -> DataFrame:
    return H.explode_hangs(_pings(spark, sf)).select("ping_id", "build_date")


@query("platform")
def q_platform(spark: SparkSession, sf: str) -> DataFrame:
    return H.explode_hangs(_pings(spark, sf)).select("ping_id", "platform")


@query("explode_hangs")
def q_explode(spark: SparkSession, sf: str) -> DataFrame:
    return H.explode_hangs(_pings(spark, sf)).select(
        "ping_id", "hang_idx", "duration", "thread", "runnable", F.size("raw_stack").alias("n_frames"))


@query("stack_length_filter")
def q_stack_length(spark: SparkSession, sf: str) -> DataFrame:
    return H.stack_length_filter(H.explode_hangs(_pings(spark, sf))).select(
        "ping_id", F.size("raw_stack").alias("n_frames"))


def _json_frame(li):
    """JSON text of one line item's frame; frames of line items with quantity
    above 45 are written as 3-element lists (malformed)."""
    supp, part, line = li["l_suppkey"], li["l_partkey"], li["l_linenumber"]
    idx = (part % 12).cast("string")
    off = F.lower(F.hex(part * 16 + line))
    label = F.when(supp % 20 == 0, F.lit("resource://devtools/x.js")).otherwise(F.lit("(content script)"))
    return (F.when(supp % 10 == 0, F.concat(F.lit('"'), label, F.lit('"')))
             .when(li["l_quantity"] > 45, F.concat(F.lit("["), idx, F.lit(',"'), off, F.lit('",0]')))
             .otherwise(F.concat(F.lit("["), idx, F.lit(',"'), off, F.lit('"]'))))


@query("frame_shape_filter")
def q_frame_shape(spark: SparkSession, sf: str) -> DataFrame:
    """JSON stacks (VARIANT path) with malformed frames, through P5 and P6."""
    li = derived.table(spark, sf, "lineitem")
    items = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                                                 "l_quantity")))
    stacks = li.groupBy(F.col("l_orderkey").alias("ping_id")).agg(items.alias("items")).select(
        "ping_id", F.concat(F.lit("["), F.array_join(F.transform("items", _json_frame), ","), F.lit("]"))
        .alias("json"))
    h = stacks.select("ping_id", stack_from_json(F.col("json")).alias("raw_stack"))
    h = H.frame_shape_filter(H.stack_length_filter(h))
    return h.select("ping_id", F.posexplode("raw_stack").alias("pos", "f")).select(
        "ping_id", "pos", "f.kind", "f.label", "f.module_index", "f.offset")


@query("decode_frames")
def q_decode(spark: SparkSession, sf: str) -> DataFrame:
    return _decoded(spark, sf).select("ping_id", F.posexplode("stack").alias("pos", "f")).select(
        "ping_id", "pos", "f.pseudo", "f.debug_name", "f.breakpad_id", "f.offset")


@query("module_index_lookup")
def q_module_lookup(spark: SparkSession, sf: str) -> DataFrame:
    h = H.explode_hangs(_pings(spark, sf))
    f = h.select("ping_id", "modules", F.posexplode("raw_stack").alias("pos", "f")).where(F.col("f.kind") == "native")
    m = F.get(F.col("modules"), F.col("f.module_index"))
    return f.select("ping_id", "pos", F.col("f.module_index").alias("module_index"),
                    m["debug_name"].alias("debug_name"), m["breakpad_id"].alias("breakpad_id"))


def _hangs(spark, sf):
    return derived_inputs(spark, sf, DEFAULT).hangs


@query("force_paint_duplicate")
def q_force_paint(spark: SparkSession, sf: str) -> DataFrame:
    return _hangs(spark, sf).select("ping_id", "thread")


@query("duration_bounds")
def q_duration_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return H.duration_bounds(_hangs(spark, sf), DEFAULT).select("ping_id", "thread", "duration")


@query("exclude_cpu_high")
def q_cpu_high(spark: SparkSession, sf: str) -> DataFrame:
    return H.exclude_cpu_high(_hangs(spark, sf)).select("ping_id", "thread")


@query("pending_input")
def q_pending(spark: SparkSession, sf: str) -> DataFrame:
    return _hangs(spark, sf).select("ping_id", "thread", "pending_input")


@query("process_type")
def q_process_type(spark: SparkSession, sf: str) -> DataFrame:
    from hangscope.operators.profile import process_type
    return _hangs(spark, sf).select("thread").distinct().select("thread", process_type(F.col("thread")).alias("process_type"))


# ---- frames, symbols, stacks (A1-A3, J1-J5, M1-M8) ----

def _stack_dict(spark, sf):
    i = derived_inputs(spark, sf, DEFAULT)
    ds = materialize(distinct_stacks(i.hangs))
    return i, ds, symbolicate_stacks(ds, i.symbols, DEFAULT)


@query("distinct_frames")
def q_distinct_frames(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_frames(_decoded(spark, sf))


@query("offsets_by_module")
def q_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return offsets_by_module(distinct_frames(_decoded(spark, sf)))


@query("usage_hours_by_date")
def q_usage(spark: SparkSession, sf: str) -> DataFrame:
    return usage_hours_by_date(_pings(spark, sf))


@query("symbol_asof_join")
def q_asof(spark: SparkSession, sf: str) -> DataFrame:
    i = derived_inputs(spark, sf, DEFAULT)
    fr = distinct_frames(_decoded(spark, sf)).where(~F.col("pseudo") & F.col("debug_name").isNotNull())
    return symbol_asof(fr.select("debug_name", "breakpad_id", "offset").distinct(), i.symbols)


@query("symbolicate_special")
def q_special(spark: SparkSession, sf: str) -> DataFrame:
    i = derived_inputs(spark, sf, DEFAULT)
    d = frame_dictionary(materialize(distinct_frames(_decoded(spark, sf))), i.symbols, DEFAULT)
    return d.select("pseudo", "debug_name", "offset", "func", "lib")


@query("hex_offset")
def q_hex(spark: SparkSession, sf: str) -> DataFrame:
    fr = distinct_frames(_decoded(spark, sf)).where(~F.col("pseudo"))
    return fr.select("offset").distinct().select("offset", hex_to_bigint(F.col("offset")).alias("value"))


def _hang_stacks(spark, sf):
    i, ds, sd = _stack_dict(spark, sf)
    h = i.hangs.where(F.col("thread") != "Gecko_Child_ForcePaint").select("ping_id", "sid")
    return h.join(sd, "sid")


@query("frame_symbol_left_join")
def q_frame_symbols(spark: SparkSession, sf: str) -> DataFrame:
    return _hang_stacks(spark, sf).select("ping_id", F.posexplode("sym_stack").alias("pos", "f")).select(
        "ping_id", "pos", "f.func", "f.lib")


@query("reassemble_stacks")
def q_reassemble(spark: SparkSession, sf: str) -> DataFrame:
    return _hang_stacks(spark, sf).select("ping_id", stack_text(F.col("sym_stack")).alias("stack"))


@query("categorize_stack")
def q_categorize(spark: SparkSession, sf: str) -> DataFrame:
    return _hang_stacks(spark, sf).select("ping_id", "category")


@query("category_root")
def q_category_root(spark: SparkSession, sf: str) -> DataFrame:
    return _hang_stacks(spark, sf).select("ping_id", category_root(F.col("category")).alias("category_root"))


@query("tracking_component")
def q_component(spark: SparkSession, sf: str) -> DataFrame:
    return _hang_stacks(spark, sf).select("ping_id", "component")


@query("match_kinds")
def q_match_kinds(spark: SparkSession, sf: str) -> DataFrame:
    funcs = _hang_stacks(spark, sf).select(F.explode("sym_stack").alias("f")).select("f.func").distinct()
    return funcs.select("func", first_rule(F.col("func"), CATEGORY_RULES_1).alias("rule_set_1"),
                        first_rule(F.col("func"), CATEGORY_RULES_2).alias("rule_set_2"))


@query("duration_bucket")
def q_bucket(spark: SparkSession, sf: str) -> DataFrame:
    h = H.explode_hangs(_pings(spark, sf))
    return h.select("ping_id", "duration", duration_bucket(F.col("duration")).alias("bucket"))


@query("usage_hours_join")
def q_usage_join(spark: SparkSession, sf: str) -> DataFrame:
    r = PL.rates(derived_inputs(spark, sf, DEFAULT), DEFAULT)
    g = r.groupBy("thread", "build_date").agg(F.sum("hang_ms").alias("hang_ms"), F.max("usage_h").alias("usage_h"))
    return g.select("thread", "build_date", "hang_ms", (F.col("hang_ms") / F.col("usage_h")).alias("ms_per_hour"))


@query("positive_ms")
def q_positive(spark: SparkSession, sf: str) -> DataFrame:
    from hangscope.operators.stacktree import positive_ms
    r = positive_ms(PL.rates(derived_inputs(spark, sf, DEFAULT), DEFAULT))
    return r.select(stack_text(F.col("sym_stack")).alias("stack"), "runnable", "thread", "build_date",
                    "pending_input", "platform", "ms_per_hour")


# ---- crash source (S5-S7) ----

def _crash_hang_pings(spark, sf, cfg):
    from hangscope.sources.crashes import crash_to_hang, scan_crash_pings
    return crash_to_hang(scan_crash_pings(derived.raw_crash_pings(spark, sf), cfg))


@query("scan_crash_pings")
def q_scan_crash(spark: SparkSession, sf: str) -> DataFrame:
    from hangscope.sources.crashes import scan_crash_pings
    return scan_crash_pings(derived.raw_crash_pings(spark, sf), DEFAULT).select(
        "ping_id", "submissionDate", F.col("payload.processType").alias("process_type"))


@query("crash_frame_rebase")
def q_crash_frames(spark: SparkSession, sf: str) -> DataFrame:
    h = H.explode_hangs(hang_pings(_crash_hang_pings(spark, sf, DEFAULT), DEFAULT))
    return h.select("ping_id", F.posexplode("raw_stack").alias("pos", "f")).select(
        "ping_id", "pos", "f.module_index", "f.offset")


@query("crash_to_hang")
def q_crash_to_hang(spark: SparkSession, sf: str) -> DataFrame:
    p = hang_pings(_crash_hang_pings(spark, sf, DEFAULT), DEFAULT)
    return H.explode_hangs(p).select("ping_id", "thread", "duration", "runnable", "process",
                                     F.size("raw_stack").alias("n_frames"))


@query("crash_window_rates")
def q_crash_window(spark: SparkSession, sf: str) -> DataFrame:
    """The rate job on crash pings of every day of a window, sampled."""
    from hangscope.plans.jobs import inputs_for
    cfg = DEFAULT.with_(hang_lower_bound=0, use_crashes=True, start_date="19950101", end_date="19951130", sample_size=0.5)
    i = inputs_for(derived.raw_crash_pings(spark, sf), derived.symbol_lines(spark, sf), cfg)
    r = PL.rates(i, cfg)
    return r.select(stack_text(F.col("sym_stack")).alias("stack"), "runnable", "thread", "build_date", "pending_input",
                    "platform", "ms_per_hour", "count_per_hour")


@query("crash_rebase_high")
def q_crash_rebase_high(spark: SparkSession, sf: str) -> DataFrame:
    """S7 in the upper half of the address space: modules at 0xfffff803...;
    every third module's ip lies as far below its base."""
    from hangscope.sources.crashes import rebase_frame
    fr = derived.frame_rows(spark, sf).where(F.col("label").isNull() & (F.col("module_index") < 10))
    v = F.conv("offset", 16, 10).cast("bigint")
    base = F.lit(-8778901028864) + F.col("module_index").cast("bigint") * (1 << 32)      # 0xfffff803... as signed 64 bits
    ip = base + F.when(F.col("module_index") % 3 == 2, -2 * v).otherwise(v)
    text = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    frame = F.struct(text(ip).alias("ip"), F.col("module_index"))
    mods = F.array_repeat(F.struct(text(base).alias("base_addr")), 10)
    return fr.where(v > 0).select("ping_id", "pos", "module_index", rebase_frame(frame, mods)["offset"].alias("offset"))


@query("crash_hang_rates")
def q_crash_rates(spark: SparkSession, sf: str) -> DataFrame:
    """The rate job on crash pings (lower bound 0 so crash hangs count)."""
    from hangscope.plans.jobs import prepare
    cfg = DEFAULT.with_(hang_lower_bound=0, use_crashes=True)
    i = prepare(_crash_hang_pings(spark, sf, cfg), derived.symbol_lines(spark, sf), cfg, scanned=True)
    r = PL.rates(i, cfg)
    return r.select(stack_text(F.col("sym_stack")).alias("stack"), "runnable", "thread", "build_date",
                    "pending_input", "platform", "ms_per_hour", "count_per_hour")
