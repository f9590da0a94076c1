"""Stack classification rules (M1-M6) as data plus column builders.

The same rule data also renders the DuckDB oracle's CASE expressions, so a
rule is written once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hangscope.config import UNKNOWN_COMPONENT

# Category rules, in order; the first match at a frame wins.
# Rule set 1 is tried over the whole stack before rule set 2.
CATEGORY_RULES_1 = [
    ("exact", "(content script)", "content_script"),
]
CATEGORY_RULES_2 = [
    ("stem", "mozilla::ipc::MessageChannel::WaitForSyncNotify", "sync_ipc"),
    ("stem", "mozilla::ipc::MessageChannel::WaitForInterruptNotify", "sync_ipc"),
    ("prefix", "mozilla::places::", "places"),
    ("prefix", "mozilla::plugins::", "plugins"),
    ("stem", "js::RunScript", "script"),
    ("stem", "js::Nursery::collect", "GC"),
    ("stem", "js::GCRuntime::collect", "GC"),
    ("stem", "nsJSContext::GarbageCollectNow", "GC"),
    ("prefix", "mozilla::RestyleManager::", "restyle"),
    ("substring", "RestyleManager", "restyle"),
    ("stem", "mozilla::PresShell::ProcessReflowCommands", "layout"),
    ("prefix", "nsCSSFrameConstructor::", "frameconstruction"),
    ("stem", "mozilla::PresShell::DoReflow", "layout"),
    ("substring", "::compileScript(", "script"),
    ("prefix", "nsCycleCollector", "CC"),
    ("prefix", "nsPurpleBuffer", "CC"),
    ("prefix", "nsRefreshDriver::IsWaitingForPaint", "paint"),
    ("stem", "mozilla::PresShell::Paint", "paint"),
    ("stem", "mozilla::PresShell::DoUpdateApproximateFrameVisibility", "layout"),
    ("substring", "mozilla::net::", "network"),
    ("stem", "nsInputStreamReadyEvent::Run", "network"),
    ("stem", "nsJSUtil::EvaluateString", "script"),
    ("prefix", "js::frontend::Parser", "script.parse"),
    ("prefix", "js::jit::IonCompile", "script.compile.ion"),
    ("prefix", "js::jit::BaselineCompiler::compile", "script.compile.baseline"),
    ("prefix", "CompositorBridgeParent::Composite", "paint"),
    ("prefix", "mozilla::layers::PLayerTransactionParent::Read(", "messageread"),
    ("prefix", "mozilla::dom::", "dom"),
    ("prefix", "nsDOMCSSDeclaration::", "restyle"),
    ("prefix", "nsHTMLDNS", "network"),
    ("substring", "IC::update(", "script.icupdate"),
    ("prefix", "js::jit::CodeGenerator::link(", "script.link"),
    ("exact", "base::WaitableEvent::Wait()", "idle"),
    ("prefix", "Interpret(", "script.execute.interpreter"),
    ("prefix", "mozilla::gfx", "gfx"),
    ("prefix", "D2DDevice", "os_gfx"),
    ("prefix", "mozJSComponentLoader::", "js_component_load"),
    ("exact", "nsBaseFilePicker::AsyncShowFilePicker::Run()", "filepicker"),
    ("exact", "mozilla::storage", "storage"),
]

# Tracked components, in order; a stack belongs to the first
# component any of whose substrings occurs in any of its function names.
COMPONENT_RULES = [
    ("Devtools Hangs", ("devtools/",)),
    ("Activity Stream Hangs", ("activity-stream/",)),
    ("Places Hangs", ("/places/", "/modules/Places")),
    ("Telemetry Hangs", ("/telemetry/", "/modules/Telemetry")),
]


def matches(kind: str, name: Column, pattern: str) -> Column:
    """M1: exact, prefix, substring, stem (equal, or pattern followed by '(')."""
    p = F.lit(pattern)
    if kind == "exact":
        return name == p
    if kind == "prefix":
        return name.startswith(pattern)
    if kind == "substring":
        return name.contains(pattern)
    if kind == "stem":
        return (name == p) | name.startswith(pattern + "(")
    raise ValueError(f"unknown match kind {kind}")


def first_rule(name: Column, rules) -> Column:
    """Category of the first rule matching one function name, else null
    (one flat CASE, evaluated top to bottom)."""
    out = None
    for kind, pattern, category in rules:
        cond = matches(kind, name, pattern)
        out = F.when(cond, F.lit(category)) if out is None else out.when(cond, F.lit(category))
    return out


def component_flags(name: Column) -> Column:
    """Per function name, which tracked components it hits (array of booleans)."""
    return F.array(*[reduce(lambda a, b: a | b, [name.contains(s) for s in subs])
                     for _, subs in COMPONENT_RULES])


def component_of(flags: Column) -> Column:
    """M6: first component whose flag is set, else ``unknown_component``."""
    out = None
    for i, (title, _) in enumerate(COMPONENT_RULES):
        cond = F.coalesce(flags[i], F.lit(False))
        out = F.when(cond, F.lit(title)) if out is None else out.when(cond, F.lit(title))
    return out.otherwise(F.lit(UNKNOWN_COMPONENT))


# ---- SQL renderings (for the DuckDB oracle) ----

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_matches(kind: str, name: str, pattern: str) -> str:
    if kind == "exact":
        return f"{name} = {_q(pattern)}"
    if kind == "prefix":
        return f"substr({name}, 1, {len(pattern)}) = {_q(pattern)}"
    if kind == "substring":
        return f"instr({name}, {_q(pattern)}) > 0"
    if kind == "stem":
        return f"({name} = {_q(pattern)} or substr({name}, 1, {len(pattern) + 1}) = {_q(pattern + '(')})"
    raise ValueError(kind)


def sql_first_rule(name: str, rules) -> str:
    whens = " ".join(f"when {sql_matches(k, name, p)} then {_q(c)}" for k, p, c in rules)
    return f"(case {whens} end)"


def sql_component_hit(name: str, i: int) -> str:
    return "(" + " or ".join(f"instr({name}, {_q(s)}) > 0" for s in COMPONENT_RULES[i][1]) + ")"
