"""Profile and histogram sinks and their readers.

Outputs are directories Spark writes in parallel; the original's local file
plus object-store upload becomes a path (any Hadoop filesystem).

* daily increments: long tables by build date (``sources.snapshots``);
* profiles: chunks of each section (``write_chunks``, the default), or gzip
  JSON documents per thread (``write_profile``), one for a small thread;
* split profiles: each section as its own table partitioned by ``thread``
  plus a manifest of what was written (``write_split``) and the main file
  (``write_split_main``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangscope.config import HangConfig
from hangscope.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/hangscope-out/{name}-{uuid.uuid4().hex}"


def output_name(name: str, cfg: HangConfig) -> str:
    """File naming of the original: ``name[-YYYYMMDD]``, the date being the run's (``append_date``)."""
    return f"{name}-{cfg.run_date}" if cfg.append_date else name


def write_profile(packed: DataFrame, usage_json: DataFrame, path: str, run_id: str) -> None:
    """The gzip JSON documents of each thread (one, or the pieces of a
    large one), with the usage hours and the run id."""
    packed.write.mode("overwrite").option("compression", "gzip").json(f"{path}/threads")
    usage_json.withColumn("uuid", F.lit(run_id)).write.mode("overwrite").option("compression", "gzip").json(
        f"{path}/meta")


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """Packed per-thread documents written by :func:`write_profile`."""
    return spark.read.schema("name string, first long, profile string, uuid string").json(f"{path}/threads")


def write_chunks(chunks: DataFrame, usage_json: DataFrame, path: str, run_id: str) -> None:
    """S12, default form: the profile's sections in chunks (``operators.profile.pack_chunks``), and the meta document."""
    chunks.write.mode("overwrite").partitionBy("section").option("compression", "gzip").json(f"{path}/chunks")
    usage_json.withColumn("uuid", F.lit(run_id)).write.mode("overwrite").option("compression", "gzip").json(f"{path}/meta")


def read_chunks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The chunks written by :func:`write_chunks` at a path, or at several; ``profile_of`` is the path's last name."""
    paths = [path] if isinstance(path, str) else path
    # paths are read as plain folders: each has its own partition folders
    df = (spark.read.schema("thread string, date string, chunk long, rows long, entries string")
          .option("recursiveFileLookup", True).json([f"{p.rstrip('/')}/chunks" for p in paths]))
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.select("*", F.regexp_extract(file, "/section=([^/]+)/", 1).alias("section"),
                     F.regexp_extract(file, "/([^/]+)/chunks/", 1).alias("profile_of"))


def read_usage(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``build_date, usage_h`` of the meta documents at a path or several."""
    paths = [path] if isinstance(path, str) else path
    meta = spark.read.schema("usageHoursByDate string").json([f"{p.rstrip('/')}/meta" for p in paths])
    return meta.select(F.explode(F.from_json("usageHoursByDate", "map<string,double>")).alias("build_date", "usage_h"))


def write_split(tables, path: str, minimal: bool = False) -> DataFrame:
    """Each profile section as a table partitioned by thread; returns the
    manifest (thread, section, rows) of what was written."""
    from hangscope.operators.profile import sections
    spark = tables.strings.sparkSession
    manifest = None
    for name, df in sections(tables, minimal).items():
        df.repartition("thread", F.floor(F.col("idx") / 1_000_000)).write.mode("overwrite").partitionBy("thread").parquet(f"{path}/{name}")
        m = (spark.read.parquet(f"{path}/{name}").groupBy("thread").agg(F.count(F.lit(1)).alias("rows"))
             .withColumn("section", F.lit(name)))
        manifest = m if manifest is None else manifest.unionByName(m)
    return manifest


def read_split(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The sections written by :func:`write_split`, as ``operators.reingest`` decodes other forms."""
    from hangscope.operators.reingest import FIELDS
    out = {}
    for section, fields in FIELDS.items():
        dated = "date string, " if section == "dates" else ""
        rows = spark.read.schema(f"{dated}idx long, {fields}, thread string").parquet(f"{path}/{section}")
        out[section] = rows.withColumn("profile", F.lit(""))
    return out


def write_split_main(manifest: DataFrame, usage_json: DataFrame, path: str, run_id: str) -> None:
    """The main file of a split profile: usage hours, run id and the split
    mark in ``main/meta``, and a row per thread in ``main/splitFiles`` with its
    process type and the sections written for it."""
    from hangscope.operators.profile import process_type
    (usage_json.withColumn("uuid", F.lit(run_id)).withColumn("isSplit", F.lit(True))
     .write.mode("overwrite").json(f"{path}/main/meta"))
    # at most one entry per section
    files = manifest.groupBy(F.col("thread").alias("name")).agg(F.sort_array(F.collect_list("section")).alias("files"))
    files.withColumn("processType", process_type(F.col("name"))).write.mode("overwrite").json(f"{path}/main/splitFiles")
