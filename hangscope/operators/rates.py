"""Usage hours and hang rates: A3-A5, J5.

Hang time and counts are summed as integers and divided by usage hours once,
so results do not depend on the order rows arrive in.  The usage-hours side
has one row per build date; the join is left to AQE, which broadcasts it when
its measured size is under the broadcast threshold and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangscope.config import HangConfig
from hangscope.functions.frames import build_date, join_by_id
from hangscope.operators.hangs import rate_hangs

KEYS = ["runnable", "thread", "build_date", "pending_input", "platform"]
MS_PER_HOUR = 3600000.0


def usage_hours_by_date(pings: DataFrame) -> DataFrame:
    """A3: over all valid pings (with or without hangs): usage ms and hours
    per build date."""
    return (pings.groupBy(build_date(F.col("build_id")).alias("build_date"))
                 .agg(F.sum("since_ms").alias("usage_ms"))
                 .withColumn("usage_h", F.col("usage_ms") / F.lit(MS_PER_HOUR)))


def merge_usage_hours(*parts: DataFrame) -> DataFrame:
    """Usage hours added per build date over several inputs."""
    every = parts[0].select("build_date", "usage_h")
    for p in parts[1:]:
        every = every.unionByName(p.select("build_date", "usage_h"))
    return every.groupBy("build_date").agg(F.sum("usage_h").alias("usage_h"))


def per_hour(total, usage_h):
    """J5 division; zero usage hours give null instead of failing."""
    return F.try_divide(total, usage_h)


def rate_rows(hangs: DataFrame, cfg: HangConfig) -> DataFrame:
    """Hangs after P9/P10 with their stack, keys and duration: written as they
    come, one scan and one decoding of the hangs serve the sums
    (``hang_sums_raw``) and the distinct stacks (``distinct_stacks``)."""
    return rate_hangs(hangs, cfg).select("sid", "stack", *KEYS, "duration")


def hang_sums_raw(rows: DataFrame) -> DataFrame:
    """A4 on raw stacks, by id: Σ duration and count per (stack, runnable,
    thread, build date, pending input, platform) of :func:`rate_rows`.
    Partial aggregation happens before the shuffle, so repeated stacks collapse
    map-side; the arrays aren't shuffled."""
    return rows.groupBy("sid", *KEYS).agg(F.sum("duration").alias("hang_ms"), F.count(F.lit(1)).alias("hang_count"))


def hang_sums(raw_sums: DataFrame, stack_dict: DataFrame) -> DataFrame:
    """A4 on symbolic stacks (by id): raw-stack sums re-added per symbolic stack."""
    j = join_by_id(raw_sums.select("sid", *KEYS, "hang_ms", "hang_count"), stack_dict.select("sid", "ssid"), "sid")
    return j.groupBy("ssid", *KEYS).agg(F.sum("hang_ms").alias("hang_ms"), F.sum("hang_count").alias("hang_count"))


def hang_rates_from(sums: DataFrame, usage: DataFrame) -> DataFrame:
    """Per-hour rates."""
    return (sums.join(usage.select("build_date", "usage_ms", "usage_h"), "build_date")
                .withColumn("ms_per_hour", per_hour(F.col("hang_ms"), F.col("usage_h")))
                .withColumn("count_per_hour", per_hour(F.col("hang_count"), F.col("usage_h"))))
