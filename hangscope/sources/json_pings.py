"""Hang pings from raw JSON text (S1, S4, P1 on untyped pings).

A ping store may hold a JSON document per line.  The text is parsed once into a
VARIANT, and the paths that the jobs read are taken from it, each with the type
that it must have: P1 asks for text and integers, so a build id written as a
number makes a ping invalid instead of being cast.  Nothing fails on a bad line:
text that isn't JSON and pings without a required value go to ``rejects`` with a
reason, so a day whose pings lack a path is an empty day.

Frames keep their two shapes (a label, or a list of module index and offset),
see ``pings.variant_frame``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangscope.config import HangConfig
from hangscope.schemas import RAW_FRAME, RAW_HANG
from hangscope.sources.pings import doc_types_for, next_day, variant_frame
from hangscope.functions.frames import sample_keep

# path in the document -> flat column of ``pings.project_properties``
OS_NAME, OS_VERSION = "$.environment.system.os.name", "$.environment.system.os.version"
ARCH, BUILD_ID, SINCE = "$.application.architecture", "$.application.buildId", "$.payload.timeSinceLastPing"
MODULES, HANGS, DOC_TYPE = "$.payload.modules", "$.payload.hangs", "$.meta.docType"


def _kind(v: Column, path: str) -> Column:
    """Type of the value at a path, as VARIANT names it (null where there is none)."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def text_at(v: Column, path: str) -> Column:
    """The text at a path; null for a value of any other type."""
    return F.when(_kind(v, path) == "STRING", F.try_variant_get(v, path, "string"))


def integer_at(v: Column, path: str) -> Column:
    """The integer at a path; null for other numbers and types."""
    return F.when(_kind(v, path) == "BIGINT", F.try_variant_get(v, path, "bigint"))


def list_at(v: Column, path: str) -> Column:
    """The elements of the list at a path; null for any other type."""
    return F.when(F.startswith(_kind(v, path), F.lit("ARRAY")), F.try_variant_get(v, path, "array<variant>"))


def module_of(m: Column) -> Column:
    """A module written as ``[name, id]``."""
    return F.struct(F.try_variant_get(m, "$[0]", "string").alias("debug_name"), F.try_variant_get(m, "$[1]", "string").alias("breakpad_id"))


def hang_of(h: Column) -> Column:
    """A hang with its stack's frames in their canonical form; annotations that aren't an object are none."""
    return F.struct(
        F.transform(list_at(h, "$.stack"), variant_frame).cast(f"array<{RAW_FRAME.simpleString()}>").alias("stack"),
        F.try_variant_get(h, "$.duration", "bigint").alias("duration"), F.try_variant_get(h, "$.thread", "string").alias("thread"),
        F.try_variant_get(h, "$.runnableName", "string").alias("runnableName"), F.try_variant_get(h, "$.process", "string").alias("process"),
        F.try_variant_get(h, "$.annotations", "map<string,string>").alias("annotations"))


def scan_json_pings(lines: DataFrame, cfg: HangConfig) -> DataFrame:
    """S1-S3 on ``ping_id, doc_type, channel, value``: lines of the storage doc types and the channel, sampled by ping id, with the parsed
    document (``ping``, null where the text isn't JSON) in place of the text.

    The window is one of build ids, which are in the text: it is applied to
    what can be parsed, and lines that can't be placed in time stay (as
    rejects)."""
    out = lines.where(F.col("doc_type").isin(doc_types_for(cfg.start_date, cfg.end_date)) & (F.col("channel") == cfg.channel))
    if cfg.sample_size < 1.0:
        out = out.where(sample_keep(F.col("ping_id"), cfg.sample_size))
    # taken from a list of one: predicates stay above the generator, so the text is parsed once and not once per predicate
    out = out.select("ping_id", F.explode(F.array(F.try_parse_json("value"))).alias("ping"))
    build = text_at(F.col("ping"), BUILD_ID)
    inside = F.lit(True)
    if cfg.start_date is not None:
        inside = inside & (build >= cfg.start_date)
    if cfg.start_date is not None or cfg.end_date is not None:
        inside = inside & (build < next_day(cfg.end_date or cfg.start_date))
    return out.where(F.coalesce(inside, F.lit(True)))


def json_pings(lines: DataFrame, cfg: HangConfig) -> tuple[DataFrame, DataFrame]:
    """Valid pings (columns of ``pings.project_properties``) and rejects (``ping_id, reason``).

    Documents of another kind (``meta.docType``) are neither."""
    v = F.col("ping")
    flat = scan_json_pings(lines, cfg).where(v.isNull() | F.coalesce(text_at(v, DOC_TYPE) == "bhr", F.lit(False))).select(
        "ping_id", v.isNotNull().alias("parsed"), text_at(v, OS_NAME).alias("os_name"), text_at(v, OS_VERSION).alias("os_version"),
        F.try_variant_get(v, ARCH, "string").alias("arch"), text_at(v, BUILD_ID).alias("build_id"), integer_at(v, SINCE).alias("since_ms"),
        (F.array().cast("array<struct<debug_name:string,breakpad_id:string>>") if cfg.exclude_modules else
         F.coalesce(F.transform(list_at(v, MODULES), module_of), F.array().cast("array<struct<debug_name:string,breakpad_id:string>>"))).alias("modules"),
        F.transform(list_at(v, HANGS), hang_of).cast(f"array<{RAW_HANG.simpleString()}>").alias("hangs"))
    reason = (F.when(~F.col("parsed"), "not JSON").when(F.col("os_version").isNull(), "os version is not text")
              .when(F.col("os_name").isNull(), "os name is not text").when(F.col("build_id").isNull(), "build id is not text")
              .when(F.col("since_ms").isNull(), "time since last ping is not an integer"))
    told = flat.withColumn("reason", reason)
    return told.where(F.col("reason").isNull()).drop("parsed", "reason"), told.where(F.col("reason").isNotNull()).select("ping_id", "reason")
