"""Jobs: the original entry points as DataFrame plans.

Plans are declarative, but not one lazy plan: intermediates that several
branches read are written (``session.materialize``) and deleted when the job
ends.

* :func:`etl_hang_profile`   - windowed hang profile (cumulative pruning)
* :func:`etl_tracked_stats`  - duration histograms merged into a prior result
* :func:`etl_incremental_write` / :func:`etl_incremental_finalize`
                             - daily profiles by build date, then one profile
* :func:`etl_cumulative_write` / :func:`etl_cumulative_profile`
                             - the windowed profile kept up day by day
* :func:`etl_finalize_profiles` - written profiles read back as one

All dates of a window go into one plan (build date is a grouping column);
nothing is collected to the driver.

Output.  A profile is written into a folder of its run (``<name>_<run id>``);
then ``<name>/latest.json`` names that run.  Readers of the name see the earlier
run or the new one, and a later run leaves this one's folder.  Increments and
histograms are tables of ``sources.snapshots``.  Beside an output lie the
symbol lines that could not be parsed and ``counters.json``, the counts taken
while the job ran.
"""

from __future__ import annotations

import functools
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hangscope.config import HangConfig
from hangscope.functions.frames import stack_id
from hangscope.operators import stacktree as ST
from hangscope.operators.hangs import hangs_of
from hangscope.operators.rates import merge_usage_hours, usage_hours_by_date
from hangscope.session import clear_materialized, materialize, materialized_mark
from hangscope.sources import derived
from hangscope.sources.pings import project_properties, scan_hang_pings, valid_pings
from hangscope.sources.profiles import output_name
from hangscope.sources.snapshots import exists, put_text, read_days, read_text, versions, write_days
from hangscope.sources.symbols import parse_symbol_lines, symbol_precedence


@dataclass
class Inputs:
    every: DataFrame      # projected pings before P1
    pings: DataFrame      # valid, projected hang pings (S1-S4, P1)
    hangs: DataFrame      # decoded hangs with flags and stack ids (P2-P8, P11)
    symbols: DataFrame    # resolved symbols (S8, S9)
    rejects: DataFrame    # symbol lines that failed to parse


def symbols_from_lines(lines: DataFrame, failfast: bool = False) -> tuple[DataFrame, DataFrame]:
    parsed, rejects = parse_symbol_lines(lines, failfast)
    # lazy: the as-of join's semi-join on the modules that occur is pushed below the parse
    return symbol_precedence(parsed), rejects


def prepare(raw_pings: DataFrame, symbol_lines: DataFrame, cfg: HangConfig, scanned: bool = False) -> Inputs:
    """``scanned``: the pings come from a source adapter that already applied
    its own scan (the crash source), so only S4 and P1 remain."""
    # exclude_modules is a switch of the hang-ping source; crash pings keep their modules
    every = (project_properties(raw_pings, cfg.with_(exclude_modules=False)) if scanned
             else project_properties(scan_hang_pings(raw_pings, cfg), cfg))
    pings = valid_pings(every)
    symbols, rejects = symbols_from_lines(symbol_lines, cfg.failfast)
    return Inputs(every, pings, hangs_of(pings), symbols, rejects)


def derived_inputs(spark: SparkSession, sf_dir: str, cfg: HangConfig) -> Inputs:
    """Inputs derived from the given tables (see ``sources.derived``)."""
    return prepare(derived.raw_pings(spark, sf_dir), derived.symbol_lines(spark, sf_dir), cfg)


def _finalized_pruned(spark: SparkSession, path: str, cfg: HangConfig) -> ST.Pruned:
    """Daily increments of the window read back and pruned again per day."""
    d = read_days(spark, path, cfg.start_date, cfg.end_date)
    rows = d.select("thread", "build_date", F.col("pruned").alias("sym_stack"), "runnable", "pending_input",
                    "platform", "hang_ms", "hang_count", "usage_h",
                    F.col("sample_ms").alias("ms_per_hour")).withColumn("ssid", stack_id(F.col("sym_stack")))
    return ST.prune(rows, cfg, cumulative=False)


def finalize_daily(spark: SparkSession, path: str, cfg: HangConfig) -> DataFrame:
    """A12 (+S11, P14): read daily sample increments back, prune them again
    per day (a no-op for output written with the same threshold), apply the
    post-sample and add up.  Returns sample rows like
    ``stacktree.sample_table_by_date``."""
    return ST.sample_table_by_date(ST.post_sample(_finalized_pruned(spark, path, cfg), cfg), cfg)


# ---- what jobs share ----

def _tidy(job):
    """The job's intermediates are deleted when it ends, well or not."""
    @functools.wraps(job)
    def run(*args, **kw):
        spark = next(a.sparkSession if isinstance(a, DataFrame) else a for a in (*args, *kw.values()) if isinstance(a, (DataFrame, SparkSession)))
        mark = materialized_mark(spark)
        try:
            return job(*args, **kw)
        finally:
            clear_materialized(spark, mark)
    return run


class Counters:
    """Row counts of a job, each taken by the action that computes the rows."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, **counts) -> DataFrame:
        """``df``, counted by the first action on it (which must come before :meth:`write`)."""
        self._seen[name] = Observation()
        return df.observe(self._seen[name], *[c.alias(k) for k, c in counts.items()])

    def values(self) -> dict[str, dict[str, int]]:
        return {name: dict(o.get) for name, o in self._seen.items()}

    def write(self, spark: SparkSession, path: str) -> None:
        put_text(spark, f"{path}/counters.json", json.dumps(self.values()), replace=True)


def counted_usage(i: Inputs, counters: Counters) -> DataFrame:
    """Usage hours (written), with the pings read and those that P1 rejects counted on the way."""
    valid = F.col("os_name").isNotNull() & F.col("os_version").isNotNull() & F.col("build_id").isNotNull() & F.col("since_ms").isNotNull()
    seen = counters.watch(i.every, "pings", rows=F.count(F.lit(1)), rejected=F.count_if(~valid))
    return materialize(usage_hours_by_date(valid_pings(seen)))


def counted_rates(i: Inputs, cfg: HangConfig, counters: Counters, usage: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hang rates by stack id and the stacks (written); rows of build dates without usage hours, whose rates are null, are counted."""
    from hangscope.plans import pipelines as PL
    r, stacks = PL.rates_by_id(i, cfg, usage)
    return counters.watch(r, "rates", rows=F.count(F.lit(1)), without_usage_hours=F.count_if(F.col("ms_per_hour").isNull())), materialize(stacks)


def write_rejects(i: Inputs, path: str, counters: Counters) -> None:
    counters.watch(i.rejects, "symbol_lines", rejected=F.count(F.lit(1))).write.mode("overwrite").json(f"{path}/rejects")


def _day_before(yyyymmdd: str) -> str:
    import datetime as _dt
    return (_dt.datetime.strptime(yyyymmdd, "%Y%m%d").date() - _dt.timedelta(days=1)).strftime("%Y%m%d")


def _end_excluded(cfg: HangConfig) -> HangConfig:
    """The profile jobs' day loops stop before ``end_date``."""
    return cfg.with_(end_date=_day_before(cfg.end_date)) if cfg.end_date else cfg


def inputs_for(raw_pings: DataFrame, symbol_lines: DataFrame, cfg: HangConfig) -> Inputs:
    """Hang pings, or crash pings of every day of the window when
    ``cfg.use_crashes`` (only the source changes; crash jobs should pass
    ``hang_lower_bound=0``)."""
    if cfg.use_crashes:
        from hangscope.sources.crashes import crash_to_hang, scan_crash_pings
        return prepare(crash_to_hang(scan_crash_pings(raw_pings, cfg)), symbol_lines, cfg, scanned=True)
    return prepare(raw_pings, symbol_lines, cfg)


def _run_path(root: str, cfg: HangConfig) -> str:
    return f"{root.rstrip('/')}/{output_name(cfg.out_name, cfg)}_{cfg.run_id}"


def _publish(spark: SparkSession, root: str, cfg: HangConfig) -> str:
    """Make the run the one that readers of the (dated) name see."""
    path = _run_path(root, cfg)
    name = f"{root.rstrip('/')}/{output_name(cfg.out_name, cfg)}"
    put_text(spark, f"{name}/latest.json", json.dumps({"run": path.rsplit("/", 1)[1]}), replace=True)
    return path


def latest_run(spark: SparkSession, root: str, cfg: HangConfig) -> str:
    """Folder of the last run written under ``cfg.hang_profile_in_filename`` (with the run date where names carry it)."""
    root = root.rstrip("/")
    return f"{root}/{json.loads(read_text(spark, f'{root}/{output_name(cfg.hang_profile_in_filename, cfg)}/latest.json'))['run']}"


def _write_tables(tables, usage: DataFrame, cfg: HangConfig, path: str) -> None:
    """The profile's sections in chunks; split section tables with a
    manifest and main file when ``cfg.split_threads_in_out_file``; one document
    per thread when ``cfg.one_document_per_thread``."""
    from hangscope.operators.profile import pack_chunks, pack_profile, usage_hours_json
    from hangscope.sources.profiles import write_chunks, write_profile, write_split, write_split_main
    minimal = cfg.use_minimal_sample_table
    if cfg.split_threads_in_out_file:
        manifest = write_split(tables, path, minimal)
        manifest.write.mode("overwrite").json(f"{path}/manifest")
        write_split_main(manifest, usage_hours_json(usage), path, cfg.run_id)
    elif not cfg.one_document_per_thread:
        write_chunks(pack_chunks(tables, cfg.profile_chunk_rows, minimal), usage_hours_json(usage), path, cfg.run_id)
    else:
        packed = pack_profile(tables, usage, cfg.run_id, minimal=minimal)
        write_profile(packed, usage_hours_json(usage), path, cfg.run_id)


# ---- job entry points ----

@_tidy
def etl_hang_profile(raw_pings: DataFrame, symbol_lines: DataFrame, cfg: HangConfig, out_root: str) -> str:
    """Job 3.1: the windowed hang profile (start_date up to, not including,
    end_date; cumulative pruning) written under ``out_root``.  Returns the
    run's folder."""
    from hangscope.plans import pipelines as PL
    spark, counters = raw_pings.sparkSession, Counters()
    cfg = _end_excluded(cfg)
    i = inputs_for(raw_pings, symbol_lines, cfg)
    path = _run_path(out_root, cfg)
    usage = counted_usage(i, counters)
    rates, stacks = counted_rates(i, cfg, counters, usage)
    _write_tables(PL.tables_of(ST.prune(rates, cfg, True, stacks), cfg), usage, cfg, path)
    write_rejects(i, path, counters)
    counters.write(spark, path)
    return _publish(spark, out_root, cfg)


@_tidy
def etl_tracked_stats(raw_pings: DataFrame, symbol_lines: DataFrame, cfg: HangConfig, path: str) -> None:
    """Job 3.2: duration histograms per usage hour for the window (end date
    included) merged into the result stored at ``path`` (J6: new keys win,
    earlier keys stay).  Only the build dates the window touches are written,
    beside the earlier ones, and all become visible at once."""
    from hangscope.operators.histograms import merge_histograms
    from hangscope.plans import pipelines as PL
    spark, counters = raw_pings.sparkSession, Counters()
    i = inputs_for(raw_pings, symbol_lines, cfg)
    new = materialize(PL.histogram_rates(i, cfg, counted_usage(i, counters)))
    if versions(spark, path):
        old = read_days(spark, path).select(*new.columns)
        new = merge_histograms(old.join(new.select("build_date").distinct(), "build_date", "left_semi"), new)
    write_rejects(i, path, counters)
    write_days(new, path)
    counters.write(spark, path)


@_tidy
def etl_incremental_write(raw_pings: DataFrame, symbol_lines: DataFrame, cfg: HangConfig, path: str) -> None:
    """Job 3.3, write half: daily pruned samples of the window (end date
    excluded) and the usage hours of its dates, one partition per build date;
    rewriting a day replaces only that day, and a day of the window without
    rows leaves none.  Minimal sample rows lack what finalize needs for node
    totals, so they are refused."""
    spark, counters = raw_pings.sparkSession, Counters()
    cfg = _full_samples(_end_excluded(cfg))
    i = inputs_for(raw_pings, symbol_lines, cfg)
    usage = counted_usage(i, counters)
    rates, stacks = counted_rates(i, cfg, counters, usage)
    samples = ST.sample_table_by_date(ST.prune(rates, cfg, False, stacks), cfg)
    write_days(samples, f"{path}/samples", cfg.start_date, cfg.end_date)
    write_days(usage, f"{path}/usage", cfg.start_date, cfg.end_date)
    write_rejects(i, path, counters)
    counters.write(spark, path)


def _full_samples(cfg: HangConfig) -> HangConfig:
    if cfg.use_minimal_sample_table:
        raise ValueError("increments need the full sample table: use_minimal_sample_table is for final output")
    return cfg


@_tidy
def etl_incremental_finalize(spark: SparkSession, cfg: HangConfig, in_path: str, out_root: str) -> str:
    """Job 3.3, finalize half (A12): the window's daily increments read back,
    re-pruned per day, post-sampled, added up and written as one profile under
    ``out_root``; usage hours are those of every date of the window, also of
    dates without a surviving sample.  Returns the run's folder."""
    from hangscope.plans import pipelines as PL
    cfg = _end_excluded(cfg)
    pr = ST.post_sample(_finalized_pruned(spark, f"{in_path}/samples", cfg), cfg)
    usage = merge_usage_hours(read_days(spark, f"{in_path}/usage", cfg.start_date, cfg.end_date))
    _write_tables(PL.tables_of(pr, cfg), usage, cfg, _run_path(out_root, cfg))
    return _publish(spark, out_root, cfg)


@_tidy
def etl_cumulative_write(raw_pings: DataFrame, symbol_lines: DataFrame, cfg: HangConfig, path: str) -> None:
    """The windowed profile's cumulative pruning (T2) day by day: the samples
    of the window's dates (end date excluded), pruned by the totals of all
    dates up to each, added to the table at ``path``.

    Needs the pings of the new dates and the totals kept for the date before
    them: ``state/<last date>`` is a table of node totals, written after the
    samples.  Windows must follow each other; repeating the last one reads the
    totals before it and replaces its samples."""
    spark, counters = raw_pings.sparkSession, Counters()
    cfg = _full_samples(_end_excluded(cfg))
    if cfg.start_date is None or cfg.end_date is None:
        raise ValueError("a cumulative step needs a start and an end date")
    i = inputs_for(raw_pings, symbol_lines, cfg)
    usage = counted_usage(i, counters)
    rates, stacks = counted_rates(i, cfg, counters, usage)
    pr, state = ST.prune_step(rates, cfg, _state_before(spark, path, cfg.start_date), stacks)
    write_days(ST.sample_table_by_date(pr, cfg), f"{path}/samples", cfg.start_date, cfg.end_date)
    write_days(usage, f"{path}/usage", cfg.start_date, cfg.end_date)
    state.write.mode("overwrite").parquet(f"{path}/state/{cfg.end_date}")
    write_rejects(i, path, counters)
    counters.write(spark, path)


def _state_before(spark: SparkSession, path: str, start: str) -> DataFrame | None:
    """Node totals of all dates before ``start``; none for the first window."""
    from hangscope.sources.snapshots import list_names
    whole = sorted(n for n in list_names(spark, f"{path}/state") if exists(spark, f"{path}/state/{n}/_SUCCESS"))
    before = [n for n in whole if n < start]
    return spark.read.schema(ST.STATE).parquet(f"{path}/state/{before[-1]}") if before else None


@_tidy
def etl_cumulative_profile(spark: SparkSession, cfg: HangConfig, in_path: str, out_root: str) -> str:
    """The profile of the samples that :func:`etl_cumulative_write` keeps, for a date range.  Returns the run's folder."""
    from hangscope.plans import pipelines as PL
    cfg = _end_excluded(cfg)
    pr = kept_samples(read_days(spark, f"{in_path}/samples", cfg.start_date, cfg.end_date))
    usage = merge_usage_hours(read_days(spark, f"{in_path}/usage", cfg.start_date, cfg.end_date))
    _write_tables(PL.tables_of(pr, cfg), usage, cfg, _run_path(out_root, cfg))
    return _publish(spark, out_root, cfg)


def kept_samples(samples: DataFrame) -> ST.Pruned:
    """Stored samples as pruned rows: their stacks are not cut again."""
    stacks = materialize(samples.select("pssid", "pruned").dropDuplicates(["pssid"]))
    return ST.Pruned(samples.drop("pruned"), stacks, stacks.select(F.col("pssid").alias("ssid"), F.col("pruned").alias("sym_stack")))


@_tidy
def etl_finalize_profiles(spark: SparkSession, cfg: HangConfig, runs: list[str], out_root: str) -> str:
    """A12 on written profiles: the chunks of several runs (their folders) read
    back, each pruned by its own totals, post-sampled, added up and written as
    one profile, with the usage hours of all.  Returns the run's folder."""
    from hangscope.operators import reingest
    from hangscope.sources.profiles import read_chunks, read_usage
    chunks = read_chunks(spark, runs)
    rows, stacks = reingest.profile_rows_by_id(reingest.decode_chunks(chunks))
    tables = reingest.finalize(rows, cfg, stacks)
    _write_tables(tables, merge_usage_hours(read_usage(spark, runs)), cfg, _run_path(out_root, cfg))
    return _publish(spark, out_root, cfg)
