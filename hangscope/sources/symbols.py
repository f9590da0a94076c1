"""Breakpad symbol text.

Symbol files are read by Spark as text, one job for all modules; the module
identity comes from the file's directory (``<lib>/<id>/<file>.sym``) and the
position in the file orders lines for the "last line wins" rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hangscope.functions.frames import LONG_MAX, hex_to_bigint, truncate_symbol

# Python's str.rstrip() set of blanks
_TRAILING_BLANKS = r"[ \t\n\r\x0b\x0c]+$"


def parse_symbol_lines(lines: DataFrame, failfast: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(debug_name, breakpad_id, line_no, line)`` -> (symbols, rejects).

    ``PUBLIC [m] addr param name...`` and ``FUNC [m] addr size param name...``
    are kept; other lines are ignored.  The name is the rest of the line cut to
    200 characters.  A line with too few fields or an address that is not hex
    goes to ``rejects`` with its reason; with ``failfast`` it fails the job that
    reads the symbols instead.
    """
    is_public, is_func = F.col("line").startswith("PUBLIC "), F.col("line").startswith("FUNC ")
    # one pattern per kind; an optional "m " second field shifts the others.
    # (When the "m" reading fails the plain reading takes "m" as the address,
    # which is not hex, so both readings reject the same lines.)
    pub = r"(?s)^PUBLIC (?:m )?([^ ]*) [^ ]* (.*)$"
    fun = r"(?s)^FUNC (?:m )?([^ ]*) [^ ]* [^ ]* (.*)$"
    t = F.col("t")
    pieces = (lines.where(is_public | is_func)
                   .select("debug_name", "breakpad_id", "line_no", "line",
                           F.when(is_public, "PUBLIC").otherwise("FUNC").alias("kind"),
                           F.regexp_replace("line", _TRAILING_BLANKS, "").alias("t"))
                   .select("debug_name", "breakpad_id", "line_no", "line", "kind",
                           F.when(F.col("kind") == "PUBLIC", t.rlike(pub)).otherwise(t.rlike(fun)).alias("ok"),
                           F.when(F.col("kind") == "PUBLIC", F.regexp_extract(t, pub, 1))
                            .otherwise(F.regexp_extract(t, fun, 1)).alias("addr_text"),
                           F.when(F.col("kind") == "PUBLIC", F.regexp_extract(t, pub, 2))
                            .otherwise(F.regexp_extract(t, fun, 2)).alias("name")))
    parsed = pieces.select("debug_name", "breakpad_id", "line_no", "line", "kind",
                           F.when(F.col("ok"), F.col("name")).alias("name"),
                           F.when(F.col("ok"), hex_to_bigint(F.col("addr_text"))).alias("address"))
    ok = F.col("name").isNotNull() & F.col("address").isNotNull() & (F.col("address") != LONG_MAX)
    bad = F.raise_error(F.concat(F.lit("symbol line can't be parsed: "), F.col("line"))).cast("boolean")
    symbols = parsed.where(F.when(ok, F.lit(True)).otherwise(bad) if failfast else ok).select("debug_name", "breakpad_id", "kind", "address",
                                      truncate_symbol(F.col("name")).alias("symbol"), "line_no")
    rejects = parsed.where(~ok).select(
        "debug_name", "breakpad_id", "line_no", "line",
        F.when(F.col("name").isNull(), "too few fields").when(F.col("address").isNull(), "address is not hex")
         .otherwise("address past 2^63 - 1").alias("reason"))
    return symbols, rejects


def symbol_precedence(symbols: DataFrame) -> DataFrame:
    """One symbol per (module, address): PUBLIC beats FUNC, and within a
    kind the last line wins."""
    rank = F.struct((F.col("kind") == "PUBLIC").alias("pub"), F.col("line_no"))
    return (symbols.groupBy("debug_name", "breakpad_id", "address")
                   .agg(F.max_by("symbol", rank).alias("symbol")))


def symbol_file_name(debug_name: Column) -> Column:
    """``xul.pdb`` -> ``xul.sym``; any other name gets ``.sym`` appended."""
    return F.concat(F.regexp_replace(debug_name, r"\.pdb$", ""), F.lit(".sym"))


def _quote_plus(c: Column) -> Column:
    # form encoding; '*' is escaped as the original's encoder did
    return F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A"))


def symbol_path(debug_name: Column, breakpad_id: Column, base: str = "") -> Column:
    """``base + quote(lib)/quote(id)/quote(file)``; null when the name or
    the id is null."""
    path = F.concat(F.lit(base), _quote_plus(debug_name), F.lit("/"), _quote_plus(breakpad_id), F.lit("/"),
                    _quote_plus(symbol_file_name(debug_name)))
    return F.when(debug_name.isNotNull() & breakpad_id.isNotNull(), path)


def read_symbol_files(spark: SparkSession, root: str) -> DataFrame:
    """Symbol text under ``root/<lib>/<id>/<file>.sym`` -> symbol lines.

    Module names are decoded from the directory names written by
    :func:`symbol_path`: ``_metadata.file_path`` is itself URL-encoded, so the
    names are decoded twice.  ``line_no`` orders the lines of a file, which is
    all "last line wins" needs: the start of the line's split in the file,
    then its place among the rows of the split's task.
    """
    df = spark.read.text(f"{root.rstrip('/')}/*/*/*.sym").select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    parts = F.split(F.col("path"), "/")
    n = F.size(parts)
    return df.select(
        F.url_decode(F.replace(F.url_decode(F.replace(F.element_at(parts, n - 2), F.lit("+"), F.lit("%2B"))), F.lit(" "), F.lit("+"))).alias("debug_name"),
        F.url_decode(F.replace(F.url_decode(F.replace(F.element_at(parts, n - 1), F.lit("+"), F.lit("%2B"))), F.lit(" "), F.lit("+"))).alias("breakpad_id"),
        F.struct("at", F.monotonically_increasing_id().alias("row")).alias("line_no"),
        F.col("value").alias("line"))
