"""Crash pings as a second hang source.

A crash ping becomes one hang: the crashing thread's frames, innermost last
(the frames are reversed), each rebased to its module (``ip - base_addr``),
with duration 1, thread = process = the process type, runnable
``dummy_runnable`` and no annotations.  Usage is a fixed 86400 ms per ping.
Downstream the hangs go through the same operators as hang pings; rate jobs
on crash data pass ``hang_lower_bound=0`` (the default bound 128 would drop
every crash hang).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangscope.config import CRASH_RUNNABLE, CRASH_USAGE_MS, HangConfig
from hangscope.functions.frames import hex_to_decimal, once, sample_keep
from hangscope.schemas import RAW_FRAME
from hangscope.sources.pings import next_day


def python_hex(v: Column) -> Column:
    """``hex()`` text of a signed integer of up to 64 bits and a sign (a
    decimal): ``0x1f`` / ``-0x1f``."""
    digits = F.lower(F.conv(F.abs(v).cast("string"), 10, 16))
    return F.concat(F.when(v < 0, "-0x").otherwise("0x"), digits)


def scan_crash_pings(raw: DataFrame, cfg: HangConfig) -> DataFrame:
    """Crash pings of the channel submitted from ``start_date`` to
    ``end_date`` (that one day when there is no end date, all days when neither
    is set), then the deterministic ping sample.  The range is a plain
    predicate on ``submissionDate``, which stores partition by."""
    out = raw.where((F.col("doc_type") == "crash") & (F.col("channel") == cfg.channel))
    day = F.col("submissionDate")
    if cfg.start_date is not None:
        out = out.where(day >= cfg.start_date)
    if cfg.start_date is not None or cfg.end_date is not None:
        out = out.where(day < next_day(cfg.end_date or cfg.start_date))
    if cfg.sample_size < 1.0:
        out = out.where(sample_keep(F.col("ping_id"), cfg.sample_size))
    return out


def rebase_frame(frame: Column, modules: Column) -> Column:
    """Crash frame -> raw native frame ``[module_index, hex(ip - base)]``.

    Null when the ip or the module index is missing; no subtraction when the
    index is outside the module list or the module has no base address."""
    base = hex_to_decimal(F.get(modules, frame["module_index"])["base_addr"])
    off = once(hex_to_decimal(frame["ip"]), lambda ip: F.coalesce(ip - base, ip))
    ok = frame["ip"].isNotNull() & frame["module_index"].isNotNull()
    return F.when(ok, F.struct(F.lit("native").alias("kind"), F.lit(None).cast("string").alias("label"),
                               frame["module_index"].alias("module_index"), once(off, python_hex).alias("offset")))


def crash_to_hang(crash: DataFrame) -> DataFrame:
    """Crash pings -> pings in the hang-ping schema (``schemas.PING``)."""
    st = F.col("payload.stackTraces")
    mods = st["modules"]
    thread = F.get(st["threads"], st["crash_info"]["crashing_thread"])
    frames = F.filter(F.reverse(F.transform(thread["frames"], lambda f: rebase_frame(f, mods))), lambda f: f.isNotNull())
    has = st["threads"].isNotNull() & st["crash_info"]["crashing_thread"].isNotNull() & thread.isNotNull()
    hang = F.struct(
        frames.cast(f"array<{RAW_FRAME.simpleString()}>").alias("stack"), F.lit(1).cast("bigint").alias("duration"),
        F.col("payload.processType").alias("thread"), F.lit(CRASH_RUNNABLE).alias("runnableName"),
        F.col("payload.processType").alias("process"),
        F.create_map().cast("map<string,string>").alias("annotations"))
    modules = F.coalesce(F.transform(mods, lambda m: F.struct(m["debug_file"].alias("debug_name"),
                                                              m["debug_id"].alias("breakpad_id"))),
                         F.array().cast("array<struct<debug_name:string,breakpad_id:string>>"))
    return crash.select(
        "ping_id", F.lit("bhr").alias("doc_type"), "channel", F.struct(F.lit("bhr").alias("docType")).alias("meta"),
        "environment", "application",
        F.struct(F.lit(CRASH_USAGE_MS).cast("bigint").alias("timeSinceLastPing"), modules.alias("modules"),
                 F.when(has, F.array(hang)).otherwise(F.array().cast(f"array<{_hang_type()}>")).alias("hangs"))
        .alias("payload"))


def _hang_type() -> str:
    from hangscope.schemas import RAW_HANG
    return RAW_HANG.simpleString()
