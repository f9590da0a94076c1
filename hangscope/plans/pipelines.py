"""Shared plan fragments of the registered queries and jobs.

Each fragment materializes only what several branches read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from hangscope.config import HangConfig
from hangscope.operators import histograms as HG
from hangscope.operators import stacktree as ST
from hangscope.operators.rates import hang_rates_from, hang_sums, hang_sums_raw, rate_rows, usage_hours_by_date
from hangscope.operators.symbolicate import distinct_stacks, symbolicate_stacks
from hangscope.plans.jobs import Inputs
from hangscope.session import materialize


def _symbolic(raw: DataFrame, i: Inputs, cfg: HangConfig) -> DataFrame:
    """The stacks of ``raw`` (written) with their symbols and labels, each raw stack once."""
    return symbolicate_stacks(materialize(distinct_stacks(raw)), i.symbols, cfg)


def rates_by_id(i: Inputs, cfg: HangConfig, usage: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Hang rates that name their stack by ``ssid``, and the stacks (``ssid, sym_stack``, each once).

    The pings are scanned once for the hangs and once, for two columns, for the usage hours."""
    raw = materialize(rate_rows(i.hangs, cfg))
    named = materialize(_symbolic(raw, i, cfg).select("sid", "ssid", "sym_stack"))
    # a row per build date: written, its size is known and the sums aren't shuffled to meet it
    usage = materialize(usage_hours_by_date(i.pings)) if usage is None else usage
    return hang_rates_from(hang_sums(hang_sums_raw(raw), named), usage), named.select("ssid", "sym_stack").distinct()


def rates(i: Inputs, cfg: HangConfig) -> DataFrame:
    r, stacks = rates_by_id(i, cfg)
    return r.join(stacks, "ssid")


def histogram_counts(i: Inputs, cfg: HangConfig, all_hangs: bool = True) -> DataFrame:
    raw = materialize(HG.bucket_counts_raw(i.hangs))
    sd = _symbolic(raw, i, cfg)
    return HG.histogram_all_hangs(raw, sd) if all_hangs else HG.duration_histogram(raw, sd)


def histogram_rates(i: Inputs, cfg: HangConfig, usage: DataFrame | None = None) -> DataFrame:
    return HG.histogram_rates(histogram_counts(i, cfg), usage_hours_by_date(i.pings) if usage is None else usage)


def pruned(i: Inputs, cfg: HangConfig, cumulative: bool = False) -> ST.Pruned:
    r, stacks = rates_by_id(i, cfg)
    return ST.prune(r, cfg, cumulative, materialize(stacks))


def samples(i: Inputs, cfg: HangConfig, cumulative: bool = False) -> DataFrame:
    return ST.sample_table_by_date(pruned(i, cfg, cumulative), cfg)


def profile_tables(i: Inputs, cfg: HangConfig, cumulative: bool = True):
    """T3-T8 for the window (cumulative pruning, as the windowed job)."""
    return tables_of(pruned(i, cfg, cumulative), cfg)


def tables_of(pr: ST.Pruned, cfg: HangConfig):
    """T3-T8 of pruned rows."""
    from hangscope.operators.profile import build_tables
    pr = pr.written()
    return build_tables(pr, materialize(ST.sample_sums(pr, cfg)))
