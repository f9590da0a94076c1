"""Explicit schemas of the raw inputs and of the canonical intermediate rows."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, B, D = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.DoubleType()

# A raw stack frame: a label (pseudo frame) or a [module_index, hex offset] pair.
# ``kind`` is 'label', 'native' or 'malformed' (a list whose length is not 2).
RAW_FRAME = T.StructType([
    T.StructField("kind", S), T.StructField("label", S),
    T.StructField("module_index", I), T.StructField("offset", S),
])

MODULE = T.StructType([T.StructField("debug_name", S), T.StructField("breakpad_id", S)])

RAW_HANG = T.StructType([
    T.StructField("stack", T.ArrayType(RAW_FRAME)),
    T.StructField("duration", L),
    T.StructField("thread", S),
    T.StructField("runnableName", S),
    T.StructField("process", S),
    T.StructField("annotations", T.MapType(S, S)),
])

PING = T.StructType([
    T.StructField("ping_id", L),
    T.StructField("doc_type", S),
    T.StructField("channel", S),
    T.StructField("meta", T.StructType([T.StructField("docType", S)])),
    T.StructField("environment", T.StructType([T.StructField("system", T.StructType([
        T.StructField("os", T.StructType([T.StructField("name", S), T.StructField("version", S)]))]))])),
    T.StructField("application", T.StructType([
        T.StructField("architecture", S), T.StructField("buildId", S)])),
    T.StructField("payload", T.StructType([
        T.StructField("timeSinceLastPing", L),
        T.StructField("modules", T.ArrayType(MODULE)),
        T.StructField("hangs", T.ArrayType(RAW_HANG)),
    ])),
])

# A decoded frame: pseudo frames carry their label in ``offset``.
DECODED_FRAME = T.StructType([
    T.StructField("pseudo", B), T.StructField("debug_name", S),
    T.StructField("breakpad_id", S), T.StructField("offset", S),
])

SYMBOLIC_FRAME = T.StructType([T.StructField("func", S), T.StructField("lib", S)])

SYMBOL = T.StructType([
    T.StructField("debug_name", S), T.StructField("breakpad_id", S),
    T.StructField("address", L), T.StructField("symbol", S),
])
