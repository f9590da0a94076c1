"""Stack-tree statistics and pruning: A10, T1, T2, P12-P14.

Every stack prefix is a node; a node's total is the hang time of all stacks
through it.  Pruning walks each stack from the root and keeps a frame while
``total(node) / total(parent) > threshold`` (strictly); the first frame that
fails becomes ``(other)`` in that frame's lib and the rest is cut.

Relational form.  Rows name their stack by its content id; the frame arrays are
kept once per distinct stack.  The stack weights are joined once with the stacks
and keep each stack's prefix nodes (``placed_weights``: an array of 128-bit
rolling hashes), so that positions are exploded inside a task and only what is
summed is shuffled:

* node totals: a row per position with the node and its parent, summed per node;
* a node fails if its total is too small a share of its parent's.  A parent's
  total is that of its children and of the stacks that end at it, so the rows of
  one parent tell which of its children fail (``failing_children``); with kept
  totals (``prune_step``) it is a join of the totals with themselves;
* a stack's cut is the first position whose node fails: the positions joined
  with the failing nodes, minimum per stack.

Cumulative totals (T2) are running sums over build dates per node.  They can be
kept in a table (``NodeState``), so that a new day needs its own rows and the
totals up to the day before, not the days before.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hangscope.config import OTHER_FRAME, HangConfig
from hangscope.functions.frames import join_by_id, sample_keep, stack_id, stack_text
from hangscope.session import materialize

_NODE = "struct<h1:bigint,h2:bigint>"
STATE = "thread string, n1 long, n2 long, v double"
DAY = ["thread", "build_date"]
NODE = ["n1", "n2"]


@dataclass(frozen=True)
class Pruned:
    """Rate rows with the id of their pruned stack, and the stacks.

    * rows: the columns of the rate rows without their stack, and ``pssid``
    * stacks: pssid, pruned - each pruned stack once (and stacks that no row has any more)
    * sources: ssid, sym_stack - each stack before pruning once
    """

    rows: DataFrame
    stacks: DataFrame
    sources: DataFrame

    def written(self) -> Pruned:
        return replace(self, rows=materialize(self.rows))

    def joined(self) -> DataFrame:
        """The rows with their stacks before and after pruning."""
        return self.rows.join(self.stacks, "pssid").join(self.sources, "ssid")


def prefix_ids(stack: Column) -> Column:
    """Array of node ids, one per prefix of ``stack`` (rolling hashes)."""
    root = F.struct(F.lit(0).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2"))

    # the array holds all that the next step needs: its last entry
    def step(ids, f):
        h1, h2 = _next_id(F.coalesce(F.try_element_at(ids, F.lit(-1)), root), f)
        return F.array_append(ids, F.struct(h1.alias("h1"), h2.alias("h2")))

    return F.aggregate(stack, F.array().cast(f"array<{_NODE}>"), step)


def leaf_id(stack: Column) -> Column:
    """The last of :func:`prefix_ids`, without the others; null for an empty stack."""
    init = F.struct(F.lit(0).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2"))

    def step(acc, f):
        h1, h2 = _next_id(acc, f)
        return F.struct(h1.alias("h1"), h2.alias("h2"))

    return F.when(F.size(stack) > 0, F.aggregate(stack, init, step))


def _next_id(acc: Column, f: Column) -> tuple[Column, Column]:
    return F.xxhash64(acc["h1"], f["func"], f["lib"]), F.xxhash64(acc["h2"], f["lib"], f["func"], F.lit("~"))


def positive_ms(rates: DataFrame) -> DataFrame:
    """Rows with hang time > 0."""
    return rates.where(F.col("ms_per_hour") > 0)


def one_stack_each(rows: DataFrame, key: str, stack: str) -> DataFrame:
    """``key, stack`` once per ``key`` of a table that was written with row numbers (``rid``): the row with the smallest one, so that no array
    takes part in an aggregation."""
    first = rows.groupBy(key).agg(F.min("rid").alias("rid"))
    return rows.select("rid", key, stack).join(first.select("rid"), "rid", "left_semi").drop("rid")


def stack_weights(rates: DataFrame) -> DataFrame:
    """Per (thread, build date, symbolic stack): hang ms and usage hours."""
    return rates.groupBy(*DAY, "ssid").agg(F.sum("hang_ms").alias("ms"), F.max("usage_h").alias("usage_h"))


def placed_weights(weights: DataFrame, stacks: DataFrame) -> DataFrame:
    """The weights with the nodes of their stack's prefixes (``ids``); ``stacks`` are ``ssid, sym_stack``, each once."""
    return join_by_id(weights, stacks.select("ssid", "sym_stack"), "ssid").withColumn("ids", prefix_ids(F.col("sym_stack"))).drop("sym_stack")


def _positions(placed: DataFrame, ends: bool = False) -> DataFrame:
    """``thread, build_date, ms, usage_h, pos, n1, n2, p1, p2``: a row per prefix with its node and that node's parent (0, 0 is the root); with
    ``ends`` another one per stack, without a node, whose parent is the stack's last node."""
    ids = F.col("ids")
    before = F.concat(F.array(F.struct(F.lit(0).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2"))), ids)
    pairs = F.arrays_zip(ids.alias("n"), before.alias("p"))
    rows = placed.select(*DAY, "ms", "usage_h", F.posexplode(pairs if ends else F.slice(pairs, F.lit(1), F.size("ids"))).alias("pos", "z"))
    return rows.select(*DAY, "ms", "usage_h", "pos", F.col("z.n.h1").alias("n1"), F.col("z.n.h2").alias("n2"),
                       F.col("z.p.h1").alias("p1"), F.col("z.p.h2").alias("p2"))


def day_nodes(placed: DataFrame) -> DataFrame:
    """Per (thread, build date, node): its parent, depth and hang ms, and the date's usage hours."""
    return (_positions(placed).groupBy(*DAY, *NODE)
            .agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("pos").alias("depth"),
                 F.sum("ms").alias("node_ms"), F.max("usage_h").alias("usage_h")))


def day_roots(weights: DataFrame) -> DataFrame:
    return weights.groupBy(*DAY).agg(F.sum("ms").alias("root_ms"), F.max("usage_h").alias("usage_h"))


def stack_node_totals(rates: DataFrame) -> DataFrame:
    """A10: per (thread, build date, node): inclusive hang ms (``node_ms``),
    node depth, and the thread's total for that date (``root_ms``)."""
    r = positive_ms(rates)
    w = stack_weights(r)
    nodes = day_nodes(placed_weights(w, r.select("ssid", "sym_stack").dropDuplicates(["ssid"])))
    out = nodes.join(day_roots(w).drop("usage_h"), DAY)
    return out.select(*DAY, F.struct(F.col("n1").alias("h1"), F.col("n2").alias("h2")).alias("node"), "depth", "node_ms", "root_ms")


# ---- totals that decide: thread, build_date, n1, n2, p1, p2, v; the root is node (0, 0) ----

def _with_root(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return nodes.unionByName(roots.select(*DAY, zero.alias("n1"), zero.alias("n2"), F.lit(None).cast("bigint").alias("p1"),
                                          F.lit(None).cast("bigint").alias("p2"), *[c for c in nodes.columns if c not in (*DAY, *NODE, "p1", "p2")]))


def day_increments(placed: DataFrame) -> DataFrame:
    """What each build date adds to the cumulative totals: ms per hour of usage, per node and for the root."""
    inc = (F.col("node_ms") / F.col("usage_h")).alias("inc")
    return _with_root(day_nodes(placed).select(*DAY, *NODE, "p1", "p2", inc),
                      day_roots(placed).withColumnRenamed("root_ms", "node_ms").select(*DAY, inc))


def failing_children(placed: DataFrame, threshold: float, cumulative: bool) -> DataFrame:
    """``thread, build_date, n1, n2`` of the nodes whose share of their parent isn't above the threshold: by the totals of each build date alone
    (T1), or by those summed over every build date up to and including each (T2, ms per hour of usage; the original's single processor fed day by
    day).  Per build date a parent has the (integer) ms of its children and of the stacks that end at it."""
    steps = (_positions(placed, ends=True).groupBy(*DAY, "p1", "p2", *NODE).agg(F.sum("ms").alias("ms"), F.max("usage_h").alias("usage_h"))
             .repartition("thread", "p1", "p2"))
    # ids before names: they differ in their first bytes, by which rows are sorted
    parent = ["p1", "p2", "thread"]
    siblings = Window.partitionBy(*parent, "build_date")
    rows = steps.withColumn("v", F.col("ms"))
    if cumulative:
        # the first of these windows sorts for the next two as well; the nodes' own one sorts again
        rows = rows.withColumn("at", F.row_number().over(siblings.orderBy(*NODE))).withColumn("pv", F.sum("ms").over(siblings))
        until = lambda *by: Window.partitionBy(*by, *parent).orderBy("build_date")
        # each build date adds to its parent once
        once = F.when(F.col("at") == 1, F.col("pv") / F.col("usage_h"))
        rows = (rows.withColumn("inc", once)
                .withColumn("pv", F.sum("inc").over(until().rangeBetween(Window.unboundedPreceding, Window.currentRow)))
                .withColumn("v", F.sum(F.col("ms") / F.col("usage_h")).over(until(*NODE).rowsBetween(Window.unboundedPreceding, 0))))
    else:
        rows = rows.withColumn("pv", F.sum("ms").over(siblings))
    return rows.where(F.col("n1").isNotNull() & _fails(threshold)).select(*DAY, *NODE)


def cumulative_totals(increments: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """T2 totals: increments summed over every build date up to and including
    each date (the original's single processor fed day by day), on top of the
    totals of earlier dates (``state``: thread, n1, n2, v)."""
    run = Window.partitionBy("thread", *NODE).orderBy("build_date").rowsBetween(Window.unboundedPreceding, 0)
    t = increments.select(*DAY, *NODE, "p1", "p2", F.sum("inc").over(run).alias("v"))
    if state is None:
        return t
    before = state.select("thread", *NODE, F.col("v").alias("before"))
    return t.join(before, ["thread", *NODE], "left").withColumn("v", F.col("v") + F.coalesce("before", F.lit(0.0))).drop("before")


def next_state(increments: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The cumulative totals after the dates of ``increments``: ``thread, n1, n2, v``."""
    added = increments.select("thread", *NODE, F.col("inc").alias("v"))
    every = added if state is None else state.select("thread", *NODE, "v").unionByName(added)
    return every.groupBy("thread", *NODE).agg(F.sum("v").alias("v"))


def _fails(threshold: float) -> Column:
    ratio = F.try_divide(F.col("v").cast("double"), F.col("pv").cast("double"))
    return ~F.coalesce(ratio > F.lit(threshold), F.lit(False))


def failing_nodes(totals: DataFrame, threshold: float) -> DataFrame:
    """``thread, build_date, n1, n2`` of the nodes whose share of their parent isn't above the threshold."""
    parents = totals.select(*DAY, F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("v").alias("pv"))
    return totals.where(F.col("p1").isNotNull()).join(parents, ["p1", "p2"] + DAY).where(_fails(threshold)).select(*DAY, *NODE)


def stack_cuts(placed: DataFrame, failing: DataFrame) -> DataFrame:
    """``thread, build_date, ssid, cut`` of the stacks that are cut: the first position whose node fails."""
    places = placed.select(*DAY, "ssid", F.posexplode("ids").alias("pos", "n")).select(
        *DAY, "ssid", "pos", F.col("n.h1").alias("n1"), F.col("n.h2").alias("n2"))
    return places.join(materialize(failing), NODE + DAY).groupBy(*DAY, "ssid").agg(F.min("pos").alias("cut"))


def pruned_stack(stack: Column, cut: Column) -> Column:
    """Keep frames before ``cut``; the frame at ``cut`` becomes ``(other)`` in
    its own lib; later frames are dropped."""
    other = F.struct(F.lit(OTHER_FRAME).alias("func"), stack[cut]["lib"].alias("lib"))
    return F.when(cut.isNull(), stack).otherwise(F.concat(F.slice(stack, F.lit(1), cut), F.array(other)))


def _replaced(r: DataFrame, stacks: DataFrame, cuts: DataFrame) -> Pruned:
    """Rows with their stacks cut; each (stack, cut) is worked out once.

    A stack that isn't cut keeps its id, which is its content's; only the cut
    ones get a new one.  The pruned stacks are those before pruning and the new
    ones, so some may have no row."""
    cuts = materialize(cuts)
    p = pruned_stack(F.col("sym_stack"), F.col("cut"))
    kinds = materialize(stacks.join(cuts.select("ssid", "cut").distinct(), "ssid").select("ssid", "cut", p.alias("pruned"))
                        .withColumn("pssid", stack_id(F.col("pruned"))).withColumn("rid", F.monotonically_increasing_id()))
    named = cuts.join(kinds.select("ssid", "cut", "pssid"), ["ssid", "cut"]).drop("cut")
    rows = join_by_id(r, named, "ssid", tuple(DAY), "left").withColumn("pssid", F.coalesce("pssid", "ssid"))
    cut_ones = one_stack_each(kinds, "pssid", "pruned")
    whole = stacks.select(F.col("ssid").alias("pssid"), F.col("sym_stack").alias("pruned"))
    # new stacks that occur whole too are there already
    known = whole.select("pssid").join(cut_ones.select("pssid"), "pssid", "left_semi")
    return Pruned(rows, whole.unionByName(cut_ones.join(known, "pssid", "left_anti")), stacks)


def _inputs(rates: DataFrame, stacks: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written rate rows without arrays, the distinct stacks and the stack weights with their nodes."""
    if stacks is None:
        # the id is the stack's content: distinct pairs have distinct ids, and an array that is a key is aggregated by hash
        stacks = materialize(rates.select("ssid", "sym_stack").distinct())
    r = materialize(positive_ms(rates).drop("sym_stack"))
    return r, stacks, materialize(placed_weights(stack_weights(r), stacks))


def prune(rates: DataFrame, cfg: HangConfig, cumulative: bool = False, stacks: DataFrame | None = None) -> Pruned:
    """T1 (daily totals) or T2 (cumulative totals): rate rows with the id of
    their pruned stack.  ``stacks`` (``ssid, sym_stack``, one row per id,
    written) when the rows don't carry their ``sym_stack``."""
    r, stacks, placed = _inputs(rates, stacks)
    return _replaced(r, stacks, stack_cuts(placed, failing_children(placed, cfg.stack_acceptance_threshold, cumulative)))


def prune_step(rates: DataFrame, cfg: HangConfig, state: DataFrame | None = None, stacks: DataFrame | None = None) -> tuple[Pruned, DataFrame]:
    """T2 for some dates after those that ``state`` holds the totals of: their pruned rows, and the totals to keep for the next ones.
    Reads the rows of the new dates and a row per node of the state."""
    r, stacks, placed = _inputs(rates, stacks)
    inc = materialize(day_increments(placed))
    totals = materialize(cumulative_totals(inc, state))
    return _replaced(r, stacks, stack_cuts(placed, failing_nodes(totals, cfg.stack_acceptance_threshold))), next_state(inc, state)


def post_sample(pruned: Pruned, cfg: HangConfig) -> Pruned:
    """A deterministic sample of pruned rows, for finalize only; totals
    for pruning are taken before it, and rows sampled out add no stack nodes."""
    if cfg.post_sample_size >= 1.0:
        return pruned
    texts = pruned.sources.select("ssid", stack_text(F.col("sym_stack")).alias("source_text"))
    key = F.concat_ws("|", "thread", "build_date", "source_text", "runnable", F.col("pending_input").cast("string"), "platform")
    return replace(pruned, rows=pruned.rows.join(texts, "ssid").where(sample_keep(key, cfg.post_sample_size)).drop("source_text"))


def minimal_samples(rows: DataFrame) -> DataFrame:
    """Without Gecko_Child rows that have no pending input."""
    return rows.where(~((F.col("thread") == "Gecko_Child") & ~F.col("pending_input")))


def sample_sums(pruned: Pruned, cfg: HangConfig) -> DataFrame:
    """A11 (+P13): per (thread, build date, pruned stack id, runnable,
    pending input, platform): summed hang ms / count, then per usage hour.

    With ``use_minimal_sample_table`` Gecko_Child samples without pending
    input are dropped (their stack nodes stay in the stack table)."""
    p = minimal_samples(pruned.rows) if cfg.use_minimal_sample_table else pruned.rows
    g = (p.groupBy("thread", "build_date", "pssid", "runnable", "pending_input", "platform")
          .agg(F.sum("hang_ms").alias("hang_ms"), F.sum("hang_count").alias("hang_count"),
               F.max("usage_h").alias("usage_h")))
    return (g.withColumn("sample_ms", F.try_divide(F.col("hang_ms"), F.col("usage_h")))
             .withColumn("sample_count", F.try_divide(F.col("hang_count"), F.col("usage_h"))))


def sample_table_by_date(pruned: Pruned, cfg: HangConfig) -> DataFrame:
    """:func:`sample_sums` with the pruned stacks themselves (``pruned``)."""
    return sample_sums(pruned, cfg).join(pruned.stacks, "pssid")
