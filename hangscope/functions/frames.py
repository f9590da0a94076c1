"""Scalar expressions over pings, frames and symbols."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangscope.config import SYMBOL_TRUNCATE_LENGTH, UNKNOWN_LIB, UNSYMBOLICATED

LONG_MAX = 9223372036854775807


def build_date(build_id: Column) -> Column:
    """The first 8 characters of the build id (a YYYYMMDD string)."""
    return F.substring(build_id, 1, 8)


def platform(os_name: Column, os_version: Column, arch: Column) -> Column:
    """``name:major:arch``; a missing architecture prints as ``None``."""
    return F.concat(os_name, F.lit(":"), F.split_part(os_version, F.lit("."), F.lit(1)),
                    F.lit(":"), F.coalesce(arch, F.lit("None")))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it: it's bound to a lambda's argument."""
    return F.transform(F.array(value), use)[0]


_HEX = r"^\s*\+?(?:0[xX])?0*([0-9a-fA-F]+)\s*$"


def hex_to_bigint(text: Column) -> Column:
    """M8: base-16 text (optional ``0x``/``+``, surrounding blanks) to BIGINT.

    Text that is not hex gives null.  Values past the BIGINT range saturate to
    its maximum, which is above every symbol address, so the as-of lookup
    resolves them exactly as an unbounded integer would.
    """
    def value(digits: Column) -> Column:
        n = F.length(digits)
        too_big = (n > 16) | ((n == 16) & (F.lower(digits) > F.lit("7fffffffffffffff")))
        return (F.when(n == 0, F.lit(None).cast("bigint"))
                 .when(too_big, F.lit(LONG_MAX))
                 .otherwise(F.conv(digits, 16, 10).cast("bigint")))

    return once(F.regexp_extract(text, _HEX, 1), value)


def hex_to_decimal(text: Column) -> Column:
    """Base-16 text (as for :func:`hex_to_bigint`) to DECIMAL(20,0): exact for
    every 64-bit address; beyond 64 bits null."""
    return once(F.regexp_extract(text, _HEX, 1), lambda digits: F.when(
        F.length(digits).between(1, 16), F.conv(digits, 16, 10).cast("decimal(20,0)")))


def decode_frame(frame: Column, modules: Column) -> Column:
    """Raw frame -> (pseudo, debug_name, breakpad_id, offset).

    A label becomes a pseudo frame carrying the label; a module index that is
    negative, too large or null, or a module without a name, gives a native
    frame with no module.
    """
    mod = F.get(modules, frame["module_index"])
    has_name = mod.isNotNull() & mod["debug_name"].isNotNull()
    native = frame["kind"] == "native"
    return F.struct(
        (~native).alias("pseudo"),
        F.when(native & has_name, mod["debug_name"]).alias("debug_name"),
        F.when(native & has_name, mod["breakpad_id"]).alias("breakpad_id"),
        F.when(native, frame["offset"]).otherwise(frame["label"]).alias("offset"),
    )


def symbolic_frame(frame: Column, symbol: Column) -> Column:
    """M7: decoded frame plus its as-of symbol (or null) -> (func, lib).

    A pseudo frame names itself with an empty lib; a null label never matches
    the mapping, so it reads as unsymbolicated in the ``pseudo`` lib.  No module
    gives the ``unknown`` lib; no symbol keeps the module's name.
    """
    pseudo = frame["pseudo"]
    func = (F.when(pseudo & frame["offset"].isNotNull(), frame["offset"])
             .when(pseudo, F.lit(UNSYMBOLICATED))
             .otherwise(F.coalesce(symbol, F.lit(UNSYMBOLICATED))))
    lib = (F.when(pseudo & frame["offset"].isNotNull(), F.lit(""))
            .when(pseudo, F.lit("pseudo"))
            .otherwise(F.coalesce(frame["debug_name"], F.lit(UNKNOWN_LIB))))
    return F.struct(func.alias("func"), lib.alias("lib"))


def truncate_symbol(name: Column) -> Column:
    """Symbol names are cut to 200 characters."""
    return F.substring(name, 1, SYMBOL_TRUNCATE_LENGTH)


def stack_text(stack: Column) -> Column:
    """Flat text of a symbolic stack, ``func@lib>func@lib`` (for reports and checks)."""
    return F.concat_ws(">", F.transform(stack, lambda f: F.concat(f["func"], F.lit("@"), f["lib"])))


def stack_id(stack: Column, fields: tuple[str, ...] = ("func", "lib")) -> Column:
    """128-bit content id of an array of structs with these ``fields``, as a
    struct of two 64-bit hashes.  The hash skips nulls, so each field goes in
    with a flag that tells whether it is one."""
    flagged = F.transform(stack, lambda f: F.array(*[
        F.concat(F.when(f[c].isNull(), "n").otherwise("v"), F.coalesce(f[c].cast("string"), F.lit(""))) for c in fields]))
    return once(flagged, lambda t: F.struct(F.xxhash64(t).alias("h1"), F.xxhash64(F.lit("hangscope"), t).alias("h2")))


def join_by_id(left: DataFrame, right: DataFrame, name: str, on: tuple[str, ...] = (), how: str = "inner") -> DataFrame:
    """Inner or left join on a 128-bit id that is never null (and more columns ``on``, which follow it), by its two numbers: those are sorted by their
    bytes, structs are not."""
    def apart(df: DataFrame) -> DataFrame:
        return df.select(F.col(name)["h1"].alias("_h1"), F.col(name)["h2"].alias("_h2"), *[c for c in df.columns if c != name])

    j = apart(left).join(apart(right), ["_h1", "_h2", *on], how)
    return j.select(F.struct(F.col("_h1").alias("h1"), F.col("_h2").alias("h2")).alias(name), *[c for c in j.columns if c not in ("_h1", "_h2")])


def raw_stack_id(stack: Column, fields: tuple[str, ...]) -> Column:
    """128-bit content id of an array of structs that have only these ``fields``, for arrays that go with no id of :func:`stack_id`.  The structs
    are hashed as they are; a number per struct tells which of its fields are null, as the hash skips those."""
    nulls = F.transform(stack, lambda f: sum((F.when(f[c].isNull(), 1 << k).otherwise(0) for k, c in enumerate(fields)), F.lit(0)))
    return F.struct(F.xxhash64(stack, nulls).alias("h1"), F.xxhash64(F.lit("hangscope"), stack, nulls).alias("h2"))


def duration_bucket(duration: Column) -> Column:
    """M4: 128-255 -> 0, 256-511 -> 1, ... 8192-16383 -> 6, >= 16384 -> 7; < 128 -> null."""
    d = duration.cast("bigint")
    return F.when(d >= 128, F.least(F.lit(7), F.length(F.bin(d)) - 8))


def sample_keep(key: Column, fraction: float) -> Column:
    """Deterministic Bernoulli sample on a key: the first 8 hex digits
    of md5(key), a 32-bit number, below ``fraction * 2^32``."""
    if fraction >= 1.0:
        return F.lit(True)
    bucket = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return bucket < F.lit(int(fraction * (1 << 32)))
