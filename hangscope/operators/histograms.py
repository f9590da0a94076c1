"""Duration histograms by component / thread / category / build date (A6-A8,
M3, M4, M11) and the merge with an earlier result (J6).

Histograms count every hang (no duration bounds, ExternalCPUHigh included).
Hangs are first counted per (raw stack, thread, build date, bucket) - a
partial aggregation that collapses repeated stacks before any shuffle - and
only then joined to the per-stack category and component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangscope.config import ALL_HANGS, HISTOGRAM_BUCKETS
from hangscope.functions.frames import duration_bucket
from hangscope.operators.rates import per_hour

KEY = ["component", "thread", "category", "build_date"]
BUCKETS = [f"h{i}" for i in range(HISTOGRAM_BUCKETS)]


def category_root(category):
    """M3: the category before its first '.'."""
    return F.split_part(category, F.lit("."), F.lit(1))


def bucket_counts_raw(hangs: DataFrame) -> DataFrame:
    """Per raw stack: hang counts by (thread, build date, M4 bucket), with the stack itself (written, it also gives the distinct stacks)."""
    return (hangs.select("sid", "stack", "thread", "build_date", duration_bucket(F.col("duration")).alias("bucket"))
                 .groupBy("sid", "stack", "thread", "build_date", "bucket").agg(F.count(F.lit(1)).alias("n")))


def _pivot(df: DataFrame) -> DataFrame:
    # bucket null (< 128 ms) still creates the key with zero counts
    return df.groupBy(*KEY).agg(*[F.sum(F.when(F.col("bucket") == i, F.col("n")).otherwise(F.lit(0))).alias(b)
                                  for i, b in enumerate(BUCKETS)])


def labelled_counts(raw_counts: DataFrame, stack_dict: DataFrame) -> DataFrame:
    return raw_counts.drop("stack").join(stack_dict.select("sid", "component", category_root(F.col("category")).alias("category")),
                           "sid")


def duration_histogram(raw_counts: DataFrame, stack_dict: DataFrame) -> DataFrame:
    """8 bucket counts per (component, thread, category root, build date)."""
    return _pivot(labelled_counts(raw_counts, stack_dict))


def histogram_all_hangs(raw_counts: DataFrame, stack_dict: DataFrame) -> DataFrame:
    """A6 plus the component ``All Hangs`` summing over components
    (the row is emitted twice before grouping: a two-set grouping)."""
    j = labelled_counts(raw_counts, stack_dict)
    return _pivot(j.withColumn("component", F.explode(F.array(F.col("component"), F.lit(ALL_HANGS)))))


def histogram_rates(counts: DataFrame, usage: DataFrame) -> DataFrame:
    """Bucket counts per usage hour of the build date."""
    j = counts.join(usage.select("build_date", "usage_h"), "build_date")
    return j.select(*KEY, *[per_hour(F.col(b), F.col("usage_h")).alias(b) for b in BUCKETS])


def histogram_add(a, b):
    """Element-wise sum of two bucket arrays."""
    return F.zip_with(a, b, lambda x, y: x + y)


def as_array(df: DataFrame) -> DataFrame:
    """Bucket columns -> one ``hist`` array column (sink format)."""
    return df.select(*KEY, F.array(*[F.col(b) for b in BUCKETS]).alias("hist"))


def merge_histograms(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Recursive merge of an earlier result with a new one: a key present
    in the new result takes the new buckets, every other earlier key stays.
    (Keys are (component, thread, category, build date); the original's nested
    dictionaries merged at the leaves, which is this anti-join + union.)"""
    kept = existing.join(new.select(*KEY), KEY, "left_anti")
    return new.unionByName(kept)
