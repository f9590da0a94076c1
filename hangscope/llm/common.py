"""Shared helpers of the operators: tables, words, scratch folders, files."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hangscope.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# complement of the word class [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z
GAP_RE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_SCRATCH: dict[int, list[str]] = {}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for the Python functions that run there."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        zipped = shutil.make_archive(f"{tempfile.mkdtemp(prefix='ship-')}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(zipped)
        _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the session."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(id(spark.sparkContext), []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete the folders that operators of this session wrote, once no result needs them."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _SCRATCH.pop(id(spark.sparkContext), []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def own_names(df: DataFrame, count: int) -> list[str]:
    """Column names that ``df`` doesn't have (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    return [n for n in (f"own_{i}" for i in range(count + len(taken))) if n not in taken][:count]


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, everything else untouched.  ``lower`` does the same on pure ASCII text and is faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.filter(F.split(F.coalesce(lower_ascii(text), F.lit("")), GAP_RE), lambda w: w != "")


def map_arrow(df: DataFrame, fn, schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for any column names (``fn`` sees and yields columns by position)."""
    ship(df.sparkSession)
    inner = T.StructType([T.StructField(f"o{i}", f.dataType) for i, f in enumerate(schema.fields)])

    def run(batches):
        for arrays in fn(batches):
            yield pa.RecordBatch.from_arrays(arrays, names=inner.names)

    return df.toDF(*(f"i{i}" for i in range(len(df.columns)))).mapInArrow(run, inner).toDF(*schema.names)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Python functions that run meanwhile get at most ``rows`` rows at a time: for rows that hold large values."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def open_shared(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI in the shared folder, usable in any task."""
    return pafs.FileSystem.from_uri(uri)


# bytes of words stay (A-Z lower-cased), all other ASCII bytes become spaces;
# UTF-8 bytes from 0x80 up belong to words
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def word_list(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
