"""Telemetry inputs derived from the given TPC-H-style tables.

The mapping (one ping and one hang per order, the order's line items as the
hang's frames, symbols from parts) is the fixture recipe of FIXTURES.md.  It
is expressed with DataFrame operations so that every query reads the given
tables and its work grows with them.  The per-order nesting of line items is
the only shuffle here (one exchange on the order key, which the join with
``orders`` reuses).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hangscope.config import DOC_TYPE_CUTOVER

CRASH_BASE_STEP = 0x100000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _module_name(r: Column) -> Column:
    return F.concat(F.lit("lib"), r.cast("string"), F.when(r % 2 == 0, F.lit(".pdb")).otherwise(F.lit(".so")))


def ping_columns(spark: SparkSession, sf_dir: str, dealt: int | None = None) -> DataFrame:
    """The flat ``ping`` view: one ping per order; ``dealt`` to so many tasks by ping id, before its columns are made."""
    o = table(spark, sf_dir, "orders")
    if dealt:
        o = o.repartition(dealt, "o_orderkey")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    build = (F.year("o_orderdate") * 10000 + F.month("o_orderdate") * 100 + 1).cast("string")
    return o.select(
        k.alias("ping_id"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .when(k % 4 == 1, "Darwin").when(k % 4 == 2, "Linux").otherwise("Windows_NT").alias("os_name"),
        F.concat((c % 3 + 6).cast("string"), F.lit(".1.2")).alias("os_version"),
        F.when(c % 7 == 0, "x86").otherwise("x86-64").alias("arch"),
        F.concat(build, F.lit("100000")).alias("build_id"),
        (F.floor("o_totalprice").cast("bigint") * 10).alias("since_ms"),
        c.alias("o_custkey"), F.col("o_orderpriority"), F.col("o_orderstatus"),
    )


def hang_columns(pings: DataFrame) -> DataFrame:
    """The flat ``hang`` view (one hang per ping), next to the ping columns."""
    k, c = F.col("ping_id"), F.col("o_custkey")
    return pings.select(
        "*", ((k * 7919) % 20000).alias("duration"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "Gecko_Child")
         .when(F.col("o_orderpriority") == "3-MEDIUM", "Compositor").otherwise("Gecko").alias("thread"),
        F.when(F.col("o_orderstatus") == "F", "nsTimer")
         .when(F.col("o_orderstatus") == "O", "IdleRunnable").otherwise("").alias("runnable"),
        (c % 2 == 0).alias("pending_input"), (c % 11 == 0).alias("cpu_high"), (c % 5 == 0).alias("paint"),
    )


def _frame_of(li: Column) -> Column:
    """Raw frame of one line item (struct with l_* fields)."""
    supp, part, line = li["l_suppkey"], li["l_partkey"], li["l_linenumber"]
    label = (F.when(supp % 20 == 0, F.lit("resource://devtools/x.js"))
             .when(supp % 10 == 0, F.lit("(content script)")))
    native = supp % 10 != 0
    return F.struct(
        F.when(native, F.lit("native")).otherwise(F.lit("label")).alias("kind"),
        label.alias("label"),
        F.when(native, (part % 12).cast("int")).alias("module_index"),
        F.when(native, F.lower(F.hex(part * 16 + line))).alias("offset"),
    )


def stacks_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stack per order: line items in (linenumber, partkey, suppkey, price, qty) order.

    Frames are made of the first three fields, so items that are equal in those
    give equal frames and the last two needn't be shuffled."""
    # dealt by order before they are collected, to as many tasks as the pings are
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition(n, "l_orderkey")
    items = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    return (li.groupBy(F.col("l_orderkey").alias("ping_id"))
              .agg(items.alias("items"))
              .select("ping_id", F.transform("items", _frame_of).alias("stack")))


def frame_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat ``frame`` view: (ping_id, pos, label, module_index, offset)."""
    return (stacks_by_order(spark, sf_dir)
            .select("ping_id", F.posexplode("stack").alias("pos", "f"))
            .select("ping_id", "pos", "f.label", "f.module_index", "f.offset"))


def module_list() -> Column:
    """Module list carried by every derived ping: the ``module`` view's rule
    (indexes 0..9, ``.pdb`` for even indexes, index 9 without an id)."""
    mods = []
    for r in range(10):
        name = f"lib{r}" + (".pdb" if r % 2 == 0 else ".so")
        mods.append(F.struct(F.lit(name).alias("debug_name"),
                             (F.lit(None).cast("string") if r == 9 else F.lit(f"ID{r}")).alias("breakpad_id")))
    return F.array(*mods)


def raw_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested hang pings (schema ``schemas.PING``) derived from orders/lineitem."""
    # orders arrive as one file per table here; a ping store is many files.
    # Hash-partitioning by ping id gives the scan-level parallelism of such a
    # store and co-partitions pings with the per-order stacks for the join.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = hang_columns(ping_columns(spark, sf_dir, n)).join(
        stacks_by_order(spark, sf_dir), "ping_id", "left")
    ann_keys = F.filter(F.array(
        F.when(F.col("pending_input"), F.lit("PendingInput")),
        F.when(F.col("cpu_high"), F.lit("ExternalCPUHigh")),
        F.when(F.col("paint"), F.lit("PaintWhileInterruptingJS"))), lambda x: x.isNotNull())
    annotations = F.map_from_arrays(ann_keys, F.transform(ann_keys, lambda _: F.lit("true")))
    hang = F.struct(
        F.coalesce(F.col("stack"), F.array().cast("array<struct<kind:string,label:string,module_index:int,offset:string>>")).alias("stack"),
        F.col("duration").cast("bigint").alias("duration"),
        F.col("thread"), F.col("runnable").alias("runnableName"),
        F.when(F.col("thread") == "Gecko_Child", "tab").otherwise("default").alias("process"),
        annotations.alias("annotations"))
    build_date = F.substring("build_id", 1, 8)
    return p.select(
        F.col("ping_id"),
        F.when(build_date <= DOC_TYPE_CUTOVER, "OTHER").otherwise("bhr").alias("doc_type"),
        F.lit("nightly").alias("channel"),
        F.struct(F.lit("bhr").alias("docType")).alias("meta"),
        F.struct(F.struct(F.struct(F.col("os_name").alias("name"), F.col("os_version").alias("version"))
                          .alias("os")).alias("system")).alias("environment"),
        F.struct(F.col("arch").alias("architecture"), F.col("build_id").alias("buildId")).alias("application"),
        F.struct(F.col("since_ms").alias("timeSinceLastPing"), module_list().alias("modules"),
                 F.array(hang).alias("hangs")).alias("payload"),
    )


def symbol_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``sym`` view: resolved symbols of modules 0..7 from parts."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    names = ["js::RunScript(JSContext*)", "mozilla::dom::Node", "nsRefreshDriver::Tick",
             "mozilla::places::History", "NS_ProcessNextEvent", "js::frontend::Parser",
             "mozilla::PresShell::DoReflow(bool)", "a/modules/PlacesUtils.jsm"]
    names.append("base::WaitableEvent::Wait()")
    sym = F.element_at(F.array(*[F.lit(n) for n in names]), (k % 9 + 1).cast("int"))
    return (p.where((k % 12 < 8) & (F.floor(k / 12).cast("int") % 3 != 0))
             .select(_module_name(k % 12).alias("debug_name"),
                     F.concat(F.lit("ID"), (k % 12).cast("string")).alias("breakpad_id"),
                     (k * 16).alias("address"), sym.alias("symbol")))


def part_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modules named after parts: names with blanks, ids with a ``#``, every tenth without an id."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.col("p_name"), F.when(k % 2 == 0, F.lit(".pdb")).otherwise(F.lit(".so"))).alias("debug_name"),
        F.when(k % 10 != 9, F.concat(F.col("p_brand"), F.lit("*"), k.cast("string"))).alias("breakpad_id"))


def _json_frame(li: Column) -> Column:
    """JSON text of one line item's frame; frames of line items with quantity above 45 are lists of three (malformed)."""
    f = _frame_of(li)
    return (F.when(f["kind"] == "label", F.concat(F.lit('"'), f["label"], F.lit('"')))
             .otherwise(F.concat(F.lit("["), f["module_index"].cast("string"), F.lit(',"'), f["offset"], F.lit('"'),
                                 F.when(li["l_quantity"] > 45, ",0").otherwise(""), F.lit("]"))))


def json_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pings as JSON lines (``ping_id, doc_type, channel, value``), one per order.

    Every 11th has its build id as a number, every 13th a usage time that is no
    integer, every 17th is cut short; those of every 19th lack the payload."""
    li = table(spark, sf_dir, "lineitem")
    items = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")))
    stacks = (li.groupBy(F.col("l_orderkey").alias("ping_id")).agg(items.alias("items"))
                .select("ping_id", F.concat(F.lit("["), F.concat_ws(",", F.transform("items", _json_frame)), F.lit("]")).alias("stack")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = hang_columns(ping_columns(spark, sf_dir)).repartition(n, "ping_id").join(stacks, "ping_id", "left")
    k = F.col("ping_id")
    text = lambda c: F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))
    modules = ",".join(f'["lib{r}{".pdb" if r % 2 == 0 else ".so"}",{"null" if r == 9 else chr(34) + f"ID{r}" + chr(34)}]' for r in range(10))
    notes = F.concat_ws(",", F.when(F.col("pending_input"), F.lit('"PendingInput":"true"')), F.when(F.col("cpu_high"), F.lit('"ExternalCPUHigh":true')),
                        F.when(F.col("paint"), F.lit('"PaintWhileInterruptingJS":1')))
    hang = F.concat(F.lit('{"stack":'), F.coalesce(F.col("stack"), F.lit("[]")), F.lit(',"duration":'), F.col("duration").cast("string"),
                    F.lit(',"thread":'), text(F.col("thread")), F.lit(',"runnableName":'), text(F.col("runnable")),
                    F.lit(',"process":"default","annotations":{'), notes, F.lit("}}"))
    payload = F.concat(F.lit('{"timeSinceLastPing":'), F.col("since_ms").cast("string"), F.when(k % 13 == 0, ".5").otherwise(""),
                       F.lit(f',"modules":[{modules}],"hangs":['), hang, F.lit("]}"))
    build = F.when(k % 11 == 0, F.col("build_id")).otherwise(text(F.col("build_id")))
    line = F.concat(F.lit('{"meta":{"docType":"bhr"},"environment":{"system":{"os":{"name":'), text(F.col("os_name")), F.lit(',"version":'), text(F.col("os_version")),
                    F.lit('}}},"application":{"architecture":'), text(F.col("arch")), F.lit(',"buildId":'), build, F.lit("}"),
                    F.when(k % 19 == 0, F.lit("")).otherwise(F.concat(F.lit(',"payload":'), payload)), F.lit("}"))
    return p.select("ping_id", F.when(F.substring("build_id", 1, 8) <= DOC_TYPE_CUTOVER, "OTHER").otherwise("bhr").alias("doc_type"),
                    F.lit("nightly").alias("channel"), F.when(k % 17 == 0, F.substring(line, 1, 100)).otherwise(line).alias("value"))


def symbol_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``symbol_line`` view: Breakpad text lines (FUNC for every symbol,
    some with the ``m`` flag, and a PUBLIC line that shadows every 4th)."""
    s = symbol_rows(spark, sf_dir)
    a = F.col("address")
    func = s.select("debug_name", "breakpad_id", (a * 2).alias("line_no"),
                    F.concat(F.lit("FUNC "), F.when(a % 32 == 0, F.lit("m ")).otherwise(F.lit("")),
                             F.lower(F.hex(a)), F.lit(" 10 0 "),
                             F.when(a % 64 == 0, F.lit("shadowed by PUBLIC")).otherwise(F.col("symbol"))).alias("line"))
    public = s.where(a % 64 == 0).select(
        "debug_name", "breakpad_id", (a * 2 + 1).alias("line_no"),
        F.concat(F.lit("PUBLIC "), F.lower(F.hex(a)), F.lit(" 0 "), F.col("symbol")).alias("line"))
    return func.unionByName(public)


def raw_crash_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crash pings: one per order, the crashing thread's frames from its line
    items (label line items carry no module index and get dropped), modules
    0..9 loaded at base ``(r + 1) * 0x100000``; processType follows the
    thread rule; submitted on the build date."""
    p = hang_columns(ping_columns(spark, sf_dir))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    li = table(spark, sf_dir, "lineitem")
    items = F.sort_array(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")))

    def frame(x):
        native = x["l_suppkey"] % 10 != 0
        idx = (x["l_partkey"] % 12).cast("int")
        off = x["l_partkey"] * 16 + x["l_linenumber"]
        base = F.when(idx < 10, (idx + 1) * CRASH_BASE_STEP).otherwise(F.lit(0))
        return F.struct(F.concat(F.lit("0x"), F.lower(F.hex(off + base))).alias("ip"),
                        F.when(native, idx).alias("module_index"))

    frames = (li.groupBy(F.col("l_orderkey").alias("ping_id")).agg(items.alias("items"))
                .select("ping_id", F.transform("items", frame).alias("frames")))
    mods = []
    for r in range(10):
        mods.append(F.struct(F.lit(f"0x{(r + 1) * CRASH_BASE_STEP:x}").alias("base_addr"),
                             F.lit(f"lib{r}" + (".pdb" if r % 2 == 0 else ".so")).alias("debug_file"),
                             (F.lit(None).cast("string") if r == 9 else F.lit(f"ID{r}")).alias("debug_id")))
    j = p.repartition(n, "ping_id").join(frames, "ping_id", "left")
    threads = F.when(F.col("frames").isNotNull(), F.array(F.struct(F.col("frames").alias("frames"))))
    return j.select(
        "ping_id", F.lit("crash").alias("doc_type"), F.lit("nightly").alias("channel"),
        F.substring("build_id", 1, 8).alias("submissionDate"),
        F.struct(F.struct(F.struct(F.col("os_name").alias("name"), F.col("os_version").alias("version"))
                          .alias("os")).alias("system")).alias("environment"),
        F.struct(F.col("arch").alias("architecture"), F.col("build_id").alias("buildId")).alias("application"),
        F.struct(F.col("thread").alias("processType"),
                 F.struct(F.struct(F.when(threads.isNotNull(), F.lit(0)).alias("crashing_thread")).alias("crash_info"),
                          threads.alias("threads"), F.array(*mods).alias("modules")).alias("stackTraces"))
        .alias("payload"))
