"""Pings to hangs: P2-P11.

All narrow: one ``posexplode`` of the hang list and array lambdas per row;
no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangscope.config import (ANNOTATION_CPU_HIGH, ANNOTATION_FORCE_PAINT, ANNOTATION_PENDING_INPUT,
                              FORCE_PAINT_THREAD, MAX_STACK_FRAMES, HangConfig)
from hangscope.functions.frames import build_date, decode_frame, platform, raw_stack_id


def _has(annotation: str):
    return F.coalesce(F.map_contains_key(F.col("annotations"), F.lit(annotation)), F.lit(False))


def explode_hangs(pings: DataFrame) -> DataFrame:
    """P4 (+P2, P3): one row per hang; a null or empty hang list gives none."""
    return (pings
            .select("ping_id", build_date(F.col("build_id")).alias("build_date"),
                    platform(F.col("os_name"), F.col("os_version"), F.col("arch")).alias("platform"),
                    "modules", F.posexplode("hangs").alias("hang_idx", "h"))
            .select("ping_id", "hang_idx", "build_date", "platform", "modules",
                    F.col("h.stack").alias("raw_stack"), F.col("h.duration").alias("duration"),
                    F.col("h.thread").alias("thread"), F.col("h.runnableName").alias("runnable"),
                    F.col("h.process").alias("process"), F.col("h.annotations").alias("annotations")))


def stack_length_filter(hangs: DataFrame) -> DataFrame:
    """P5: 0 < raw frames < 300, counted before malformed frames are dropped."""
    return hangs.where(F.size("raw_stack").between(1, MAX_STACK_FRAMES - 1))


def frame_shape_filter(hangs: DataFrame) -> DataFrame:
    """Drop list frames whose length is not 2 (labels are kept)."""
    return hangs.withColumn("raw_stack", F.filter("raw_stack", lambda f: f["kind"] != "malformed"))


def decode_frames(hangs: DataFrame) -> DataFrame:
    """Raw frames -> decoded frames through the ping's module list."""
    return (hangs.withColumn("stack", F.transform("raw_stack", lambda f: decode_frame(f, F.col("modules"))))
                 .drop("raw_stack", "modules"))


def force_paint_duplicate(hangs: DataFrame) -> DataFrame:
    """A hang annotated PaintWhileInterruptingJS is emitted again under the
    thread ``Gecko_Child_ForcePaint`` (whatever its own thread)."""
    threads = F.when(_has(ANNOTATION_FORCE_PAINT), F.array(F.col("thread"), F.lit(FORCE_PAINT_THREAD))) \
               .otherwise(F.array(F.col("thread")))
    return hangs.withColumn("thread", F.explode(threads))


def annotate_flags(hangs: DataFrame) -> DataFrame:
    """P10/P11 flags: ExternalCPUHigh and PendingInput membership."""
    return (hangs.withColumn("pending_input", _has(ANNOTATION_PENDING_INPUT))
                 .withColumn("cpu_high", _has(ANNOTATION_CPU_HIGH)))


def duration_bounds(hangs: DataFrame, cfg: HangConfig) -> DataFrame:
    """Lower <= duration < upper."""
    return hangs.where((F.col("duration") >= cfg.hang_lower_bound) & (F.col("duration") < cfg.hang_upper_bound))


def exclude_cpu_high(hangs: DataFrame) -> DataFrame:
    """P10: drop hangs annotated ExternalCPUHigh (rates only)."""
    return hangs.where(~F.col("cpu_high"))


def hangs_of(pings: DataFrame) -> DataFrame:
    """Valid pings -> decoded hangs with flags and a 128-bit stack id ``sid``.

    A hang whose frames were all malformed keeps an empty stack here and is
    dropped where stacks are joined to their symbols (as the original's inner
    join did).
    """
    h = annotate_flags(force_paint_duplicate(decode_frames(frame_shape_filter(stack_length_filter(
        explode_hangs(pings))))))
    return h.withColumn("sid", raw_stack_id(F.col("stack"), ("pseudo", "debug_name", "breakpad_id", "offset"))).drop("annotations")


def rate_hangs(hangs: DataFrame, cfg: HangConfig) -> DataFrame:
    """Hangs that count towards rates: P9 and P10."""
    return exclude_cpu_high(duration_bounds(hangs, cfg))
