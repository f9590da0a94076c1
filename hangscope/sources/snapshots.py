"""A table by build date whose readers see whole states.

Each write goes to a folder of its own (a generation) and becomes visible by
one small file, the snapshot: it tells for every build date which generation
holds it.  Readers take the newest snapshot, so they see the state before a
write or the state after it; a write that fails half way leaves an unreferenced
folder and no change.  Earlier generations stay until ``vacuum``, so a state
can be read again after later writes.

A snapshot has an entry per build date (some thousands at most); rows never
pass through the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "build_date"


def hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    p, fs = hadoop(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    p, fs = hadoop(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """A small file that appears whole: written beside its place and renamed.  Without ``replace`` an existing file is an error."""
    jvm = spark._jvm
    target, fs = hadoop(spark, path)
    beside, _ = hadoop(spark, f"{target.getParent()}/.{target.getName()}-{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if replace else kind.NONE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(
        beside.makeQualified(fs.getUri(), fs.getWorkingDirectory()), target.makeQualified(fs.getUri(), fs.getWorkingDirectory()), how)


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in list_names(spark, f"{path}/snapshots") if n.endswith(".json") and not n.startswith("."))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """``{"schema", "days": {build date: generation}}`` of a version, the newest by default."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no snapshot in {path}")
    return json.loads(read_text(spark, f"{path}/snapshots/{known[-1] if version is None else version}.json"))


def write_days(df: DataFrame, path: str, start: str | None = None, end: str | None = None) -> int:
    """Replace the build dates present in ``df``; with a window, dates of it that ``df`` has no rows for go too.  Returns the new version.

    Rows are dealt by build date and rebalanced: adaptive execution splits a
    date into as many tasks, and files, as its bytes need."""
    spark = df.sparkSession
    path = path.rstrip("/")
    known = versions(spark, path)
    days = snapshot(spark, path, known[-1])["days"] if known else {}
    generation = uuid.uuid4().hex
    root = f"{path}/data/{generation}"
    df.withColumn("day", F.col(DAY)).hint("rebalance", "day").write.partitionBy("day").parquet(root)
    written = {n.removeprefix("day=") for n in list_names(spark, root) if n.startswith("day=")}
    if start is not None or end is not None:
        days = {d: g for d, g in days.items() if not ((start is None or d >= start) and (end is None or d <= end))}
    days = days | dict.fromkeys(written, generation)
    version = (known[-1] if known else 0) + 1
    put_text(spark, f"{path}/snapshots/{version}.json", json.dumps({"schema": df.schema.jsonValue(), "days": days}))
    return version


def read_days(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, version: int | None = None) -> DataFrame:
    """The rows of a build-date range; only that range's folders are listed and read."""
    path = path.rstrip("/")
    state = snapshot(spark, path, version)
    schema = T.StructType.fromJson(state["schema"])
    inside = [f"{path}/data/{g}/day={d}" for d, g in sorted(state["days"].items()) if (start is None or d >= start) and (end is None or d <= end)]
    return spark.read.schema(schema).parquet(*inside) if inside else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete all but the last ``keep`` snapshots, and the generations that none of those names (no writer may be at work)."""
    path = path.rstrip("/")
    known = versions(spark, path)
    kept = known[-keep:]
    named = {g for v in kept for g in snapshot(spark, path, v)["days"].values()}
    for v in known[:-keep]:
        p, fs = hadoop(spark, f"{path}/snapshots/{v}.json")
        fs.delete(p, False)
    for g in list_names(spark, f"{path}/data"):
        if g not in named:
            p, fs = hadoop(spark, f"{path}/data/{g}")
            fs.delete(p, True)
