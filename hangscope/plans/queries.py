"""Registered queries: one per operator of the inventory, each reading the
given tables through ``sources.derived`` and returning flat columns that the
oracle in ``plans.oracle_queries`` reproduces in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangscope.config import DEFAULT
from hangscope.functions.frames import stack_text
from hangscope.operators import histograms as HG
from hangscope.plans import pipelines as PL
from hangscope.plans.jobs import derived_inputs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _inputs(spark, sf_dir, cfg=DEFAULT):
    return derived_inputs(spark, sf_dir, cfg)


RATE_COLS = ["runnable", "thread", "build_date", "pending_input", "platform"]
HIST_COLS = ["component", "thread", "category", "build_date"] + HG.BUCKETS


@query("hang_rates")
def q_hang_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = PL.rates(_inputs(spark, sf_dir), DEFAULT)
    return r.select(stack_text(F.col("sym_stack")).alias("stack"), *RATE_COLS, "ms_per_hour", "count_per_hour")


@query("hang_sums")
def q_hang_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = PL.rates(_inputs(spark, sf_dir), DEFAULT)
    return r.select(stack_text(F.col("sym_stack")).alias("stack"), *RATE_COLS, "hang_ms", "hang_count")


@query("duration_histogram")
def q_duration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PL.histogram_counts(_inputs(spark, sf_dir), DEFAULT, all_hangs=False).select(*HIST_COLS)


@query("histogram_all_hangs")
def q_histogram_all_hangs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PL.histogram_counts(_inputs(spark, sf_dir), DEFAULT).select(*HIST_COLS)


@query("histogram_rates")
def q_histogram_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PL.histogram_rates(_inputs(spark, sf_dir), DEFAULT).select(*HIST_COLS)


SAMPLE_COLS = ["thread", "build_date", "runnable", "pending_input", "platform", "sample_ms", "sample_count"]


@query("prune_stacks_daily")
def q_prune_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = PL.samples(_inputs(spark, sf_dir), DEFAULT, cumulative=False)
    return s.select(stack_text(F.col("pruned")).alias("stack"), *SAMPLE_COLS)


@query("prune_stacks_cumulative")
def q_prune_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = PL.samples(_inputs(spark, sf_dir), DEFAULT, cumulative=True)
    return s.select(stack_text(F.col("pruned")).alias("stack"), *SAMPLE_COLS)
