"""Hand-made edge rows (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from hangscope.config import DEFAULT
from hangscope.functions.frames import LONG_MAX, duration_bucket, hex_to_bigint


def test_hex_parse(spark):
    vals = ["1f", "0x1F", " 1f ", "zz", "", None, "+1f", "7fffffffffffffff", "8000000000000000", "00001f", "1f1g"]
    got = spark.createDataFrame([(v,) for v in vals], "s string").select(hex_to_bigint(F.col("s")).alias("v")).collect()
    assert [r.v for r in got] == [31, 31, 31, None, None, None, 31, LONG_MAX, LONG_MAX, 31, None]


def test_duration_buckets(spark):
    ds = [0, 127, 128, 255, 256, 15999, 16000, 16383, 16384, 100000]
    got = spark.createDataFrame([(d,) for d in ds], "d bigint").select(duration_bucket(F.col("d")).alias("b")).collect()
    assert [r.b for r in got] == [None, None, 0, 0, 1, 6, 6, 6, 7, 7]
    assert spark.range(1).select(duration_bucket(F.lit(128.9)).alias("b")).first().b == 0


def test_symbol_parsing(spark):
    from hangscope.plans.jobs import symbols_from_lines
    from hangscope.sources.symbols import parse_symbol_lines
    long = "x" * 201
    lines = [
        (1, "MODULE windows x86 ABC xul.pdb"),
        (2, "FUNC 10 4 0 first"),
        (3, "FUNC 10 4 0 second"),            # repeated FUNC: last wins
        (4, "PUBLIC 20 0 pub wins"),
        (5, "FUNC 20 4 0 func loses"),        # PUBLIC beats FUNC at one address
        (6, "FUNC m 30 4 0 with m flag"),
        (7, "PUBLIC m 40 0 public m"),
        (8, "FUNC 50 4 0 " + long),
        (9, "FUNC 60 4 0 crlf\r"),
        (10, "FUNC 70 4"),                    # too few fields
        (11, "PUBLIC zz 0 not hex"),
        (12, "FUNC m 80 4 0"),               # m flag, too few fields
    ]
    df = spark.createDataFrame([("xul.pdb", "ABC", n, l) for n, l in lines],
                               "debug_name string, breakpad_id string, line_no long, line string")
    syms, rejects = symbols_from_lines(df)
    got = {r.address: r.symbol for r in syms.collect()}
    assert got == {0x10: "second", 0x20: "pub wins", 0x30: "with m flag", 0x40: "public m", 0x50: "x" * 200,
                   0x60: "crlf"}
    assert sorted(r.line_no for r in rejects.collect()) == [10, 11, 12]
    parsed, _ = parse_symbol_lines(df)
    assert parsed.where("line_no = 6").first().kind == "FUNC"


def _asof_model(frames, symbols):
    out = {}
    for (mod, off) in frames:
        cands = [(a, s) for (m, a, s) in symbols if m == mod and a <= off]
        out[(mod, off)] = max(cands)[1] if cands else None
    return out


def test_asof_join_matches_model_across_ranges(spark):
    """Small range width (16) so frames often sit in ranges with no symbol."""
    import random
    from hangscope.operators.symbolicate import symbol_asof
    rnd = random.Random(7)
    symbols = [(m, a, f"{m}:{a}") for m in ("a", "b") for a in sorted(rnd.sample(range(0, 4000), 40))]
    frames = [(m, rnd.randrange(0, 5000)) for m in ("a", "b", "c") for _ in range(200)]
    frames = sorted(set(frames))
    sdf = spark.createDataFrame([(m, "ID", a, s) for m, a, s in symbols],
                                "debug_name string, breakpad_id string, address long, symbol string")
    fdf = spark.createDataFrame([(m, "ID", format(o, "x")) for m, o in frames],
                                "debug_name string, breakpad_id string, offset string")
    got = {(r.debug_name, int(r.offset, 16)): r.symbol for r in symbol_asof(fdf, sdf, bits=4).collect()}
    assert got == _asof_model(frames, symbols)


def test_variant_frames(spark):
    from hangscope.sources.pings import stack_from_json
    js = '["label", "[not a list]", [1, "1f"], [2], [3, "a", 0], null, [-1, "2"]]'
    got = spark.range(1).select(F.explode(stack_from_json(F.lit(js))).alias("f")).select("f.*").collect()
    assert [(r.kind, r.label, r.module_index, r.offset) for r in got] == [
        ("label", "label", None, None), ("label", "[not a list]", None, None), ("native", None, 1, "1f"),
        ("malformed", None, None, None), ("malformed", None, None, None), ("label", None, None, None),
        ("native", None, -1, "2")]


def test_decode_and_symbolic_frames(spark):
    from hangscope.functions.frames import decode_frame, symbolic_frame
    mods = "array(named_struct('debug_name','a.pdb','breakpad_id','X'), named_struct('debug_name',cast(null as string),'breakpad_id','Y'))"
    rows = [("native", None, 0, "10"), ("native", None, -1, "10"), ("native", None, 2, "10"),
            ("native", None, None, "10"), ("native", None, 1, "10"), ("label", "lbl", None, None),
            ("label", None, None, None)]
    df = spark.createDataFrame(rows, "kind string, label string, module_index int, offset string")
    d = df.select(decode_frame(F.struct("kind", "label", "module_index", "offset"), F.expr(mods)).alias("d"))
    s = d.select(symbolic_frame(F.col("d"), F.lit(None).cast("string")).alias("s")).select("s.*").collect()
    assert [(r.func, r.lib) for r in s] == [
        ("<unsymbolicated>", "a.pdb"), ("<unsymbolicated>", "unknown"), ("<unsymbolicated>", "unknown"),
        ("<unsymbolicated>", "unknown"), ("<unsymbolicated>", "unknown"), ("lbl", ""),
        ("<unsymbolicated>", "pseudo")]


def test_categories_and_components(spark):
    from hangscope.functions.rules import CATEGORY_RULES_2, component_flags, component_of, first_rule
    from hangscope.operators.profile import stack_category
    names = ["js::RunScript", "js::RunScript(x)", "js::RunScriptX", "xRestyleManagery", "mozilla::RestyleManager::a",
             "base::WaitableEvent::Wait()", "base::WaitableEvent::Wait", "mozilla::storage", "mozilla::storagex", "a_b"]
    got = spark.createDataFrame([(n,) for n in names], "f string").select(
        first_rule(F.col("f"), CATEGORY_RULES_2).alias("c")).collect()
    assert [r.c for r in got] == ["script", "script", None, "restyle", "restyle", "idle", None, "storage", None, None]
    st = "array(named_struct('func','mozilla::dom::A','lib','l'), named_struct('func','js::RunScript','lib','l'))"
    assert spark.range(1).select(stack_category(F.expr(st)).alias("c")).first().c == "script"   # leaf first
    st2 = "array(named_struct('func','(content script)','lib',''), named_struct('func','js::RunScript','lib','l'))"
    assert spark.range(1).select(stack_category(F.expr(st2)).alias("c")).first().c == "content_script"
    comp = spark.createDataFrame([("x/places/y",), ("devtools/z",)], "f string").agg(
        F.array(*[F.bool_or(component_flags(F.col("f"))[i]) for i in range(4)]).alias("fl")).select(
        component_of(F.col("fl")).alias("c")).first().c
    assert comp == "Devtools Hangs"


def test_stack_length_and_force_paint(spark):
    from hangscope.operators import hangs as H
    frame = "named_struct('kind','label','label','x','module_index',cast(null as int),'offset',cast(null as string))"
    rows = []
    for n in [0, 1, 299, 300]:
        rows.append(f"named_struct('n',{n},'stack',array_repeat({frame},{n}))")
    df = spark.sql("select inline(array(" + ",".join(rows) + "))")
    kept = H.stack_length_filter(df.withColumnRenamed("stack", "raw_stack")).select("n").collect()
    assert sorted(r.n for r in kept) == [1, 299]
    h = spark.createDataFrame([("Gecko", {"PaintWhileInterruptingJS": "1"}), ("Compositor", {})],
                              "thread string, annotations map<string,string>")
    got = sorted(r.thread for r in H.force_paint_duplicate(h).collect())
    assert got == ["Compositor", "Gecko", "Gecko_Child_ForcePaint"]


def test_doc_types_for_windows():
    from hangscope.sources.pings import doc_types_for
    assert doc_types_for("20180301", "20180310") == ["OTHER"]
    assert doc_types_for("20180315", "20180316") == ["OTHER", "bhr"]
    assert doc_types_for("20180316", "20180320") == ["bhr"]
    assert doc_types_for("20180315", None) == ["OTHER"]


def test_crash_rebase(spark):
    from hangscope.sources.crashes import rebase_frame
    mods = "array(named_struct('base_addr','0x100','debug_file','a','debug_id','X'), named_struct('base_addr',cast(null as string),'debug_file','b','debug_id','Y'))"
    rows = [("0x110", 0), ("0x110", 1), ("0x110", 5), (None, 0), ("0x110", None), ("0x50", 0)]
    df = spark.createDataFrame(rows, "ip string, module_index int")
    got = df.select(rebase_frame(F.struct("ip", "module_index"), F.expr(mods)).alias("r")).collect()
    assert [None if r.r is None else r.r.offset for r in got] == ["0x10", "0x110", "0x110", None, None, "-0xb0"]


def test_config_default():
    assert DEFAULT.hang_lower_bound == 128 and DEFAULT.hang_upper_bound == 16000
