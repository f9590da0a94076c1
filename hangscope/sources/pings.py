"""Hang-ping scans (S1-S4) and ping validity.

At scale the ping store is partitioned by ``doc_type`` / ``channel`` (and by
submission or build date); the predicates below are plain column predicates
on those columns, so Spark prunes partitions and pushes the rest into the
Parquet scan.  Nested schema pruning keeps the scan to the paths projected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hangscope.config import DOC_TYPE_CUTOVER, HangConfig
from hangscope.functions.frames import sample_keep
from hangscope.schemas import PING, RAW_FRAME


def next_day(yyyymmdd: str) -> str:
    import datetime as _dt
    d = _dt.datetime.strptime(yyyymmdd, "%Y%m%d").date() + _dt.timedelta(days=1)
    return d.strftime("%Y%m%d")


def doc_types_for(start: str | None, end: str | None) -> list[str]:
    """Storage doc type(s) a build-date window has to read.

    Up to the cutover pings were stored as ``OTHER``; a window reaching past
    the cutover reads both.
    """
    if start is None:
        return ["OTHER", "bhr"] if end is None or end > DOC_TYPE_CUTOVER else ["OTHER"]
    end = end or start
    types = ["OTHER" if start <= DOC_TYPE_CUTOVER else "bhr"]
    if start <= DOC_TYPE_CUTOVER and end >= next_day(DOC_TYPE_CUTOVER):
        types.append("bhr")
    return types


def scan_hang_pings(raw: DataFrame, cfg: HangConfig) -> DataFrame:
    """S1+S2+S3: pings of the channel with start <= left(buildId, 8) <= end
    (``end`` defaults to ``start``; no ``start`` means all dates up to ``end``),
    from the storage doc types the window needs, then only
    ``meta.docType == 'bhr'``, then the deterministic ping sample.

    As a build id starts with its date, the window is a range of build ids; in
    that form it is pushed into the scan."""
    build = F.col("application.buildId")
    cond = F.col("doc_type").isin(doc_types_for(cfg.start_date, cfg.end_date)) & (F.col("channel") == cfg.channel)
    if cfg.start_date is not None:
        cond = cond & (build >= cfg.start_date)
    if cfg.start_date is not None or cfg.end_date is not None:
        cond = cond & (build < next_day(cfg.end_date or cfg.start_date))
    out = raw.where(cond).where(F.col("meta.docType") == "bhr")
    if cfg.sample_size < 1.0:
        out = out.where(sample_keep(F.col("ping_id"), cfg.sample_size))
    return out


def at_path(pings: DataFrame, path: str) -> Column:
    """The column at a nested path, or nulls of the type of ``schemas.PING`` where the store's schema lacks it."""
    held, wanted = pings.schema, PING
    there = True
    for name in path.split("."):
        there = there and isinstance(held, T.StructType) and name in held.names
        held, wanted = held[name].dataType if there else None, wanted[name].dataType
    return F.col(path) if there else F.lit(None).cast(wanted)


def project_properties(pings: DataFrame, cfg: HangConfig) -> DataFrame:
    """The nested paths the job reads, as flat columns.

    A path that the store lacks is null in every ping; if P1 needs it, the day
    is empty.  With ``exclude_modules`` the module list is not read and every
    native frame decodes to "no module".
    """
    none = F.array().cast("array<struct<debug_name:string,breakpad_id:string>>")
    return pings.select(
        F.col("ping_id"),
        at_path(pings, "environment.system.os.name").alias("os_name"),
        at_path(pings, "environment.system.os.version").alias("os_version"),
        at_path(pings, "application.architecture").alias("arch"),
        at_path(pings, "application.buildId").alias("build_id"),
        at_path(pings, "payload.timeSinceLastPing").alias("since_ms"),
        (none if cfg.exclude_modules else F.coalesce(at_path(pings, "payload.modules"), none)).alias("modules"),
        at_path(pings, "payload.hangs").alias("hangs"),
    )


def valid_pings(pings: DataFrame) -> DataFrame:
    """Os name, os version and build id are text and timeSinceLastPing an
    integer.  With typed columns that is "not null"; the architecture is not
    checked."""
    return pings.where(F.col("os_name").isNotNull() & F.col("os_version").isNotNull()
                       & F.col("build_id").isNotNull() & F.col("since_ms").isNotNull())


def hang_pings(raw: DataFrame, cfg: HangConfig) -> DataFrame:
    """S1-S4 + P1: valid, projected hang pings."""
    return valid_pings(project_properties(scan_hang_pings(raw, cfg), cfg))


# ---- raw JSON stacks (heterogeneous frames) ----

def variant_frame(v):
    """Canonical raw frame from a VARIANT frame: a JSON list ``[index, offset]``
    is native (``malformed`` when its length is not 2), anything else is a
    label (JSON null gives a null label)."""
    as_list = F.try_variant_get(v, "$", "array<variant>")
    is_list = F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))
    n = F.size(as_list)
    native = is_list & (n == 2)
    return F.struct(
        F.when(native, F.lit("native")).when(is_list, F.lit("malformed")).otherwise(F.lit("label")).alias("kind"),
        F.when(~is_list, F.try_variant_get(v, "$", "string")).alias("label"),
        F.when(native, F.try_variant_get(v, "$[0]", "int")).alias("module_index"),
        F.when(native, F.try_variant_get(v, "$[1]", "string")).alias("offset"),
    )


def stack_from_json(text):
    """Raw stack from JSON text such as ``["label", [0, "1f"], [1]]``.

    Parsed as VARIANT so a label that itself looks like a list stays a label.
    """
    frames = F.try_variant_get(F.parse_json(text), "$", "array<variant>")
    return F.transform(frames, variant_frame).cast(f"array<{RAW_FRAME.simpleString()}>")
