"""What is written and read again: snapshots, the symbol store, kept totals, profiles, and the jobs around them."""

import datetime
import glob
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from hangscope.config import DEFAULT
from hangscope.functions.frames import stack_id
from hangscope.operators import reingest
from hangscope.operators import stacktree as ST
from hangscope.plans import jobs
from hangscope.session import _WRITTEN, ensure_checkpoint_dir
from hangscope.sources import derived, snapshots
from hangscope.sources.profiles import read_chunks, read_profile, read_usage
from tests.conftest import SF_SMALL


def out(spark):
    return tempfile.mkdtemp(prefix="store-", dir=ensure_checkpoint_dir(spark))


def src(spark):
    return derived.raw_pings(spark, SF_SMALL), derived.symbol_lines(spark, SF_SMALL)


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def days(spark, pairs):
    return spark.createDataFrame(pairs, "build_date string, v long")


# ---- snapshots ----

def test_snapshot_replaces_days_and_keeps_versions(spark):
    path = out(spark) + "/t"
    assert snapshots.write_days(days(spark, [("20200101", 1), ("20200102", 2), ("20200103", 3)]), path) == 1
    assert snapshots.write_days(days(spark, [("20200102", 20), ("20200102", 21)]), path, "20200102", "20200103") == 2
    assert rows(snapshots.read_days(spark, path)) == [("20200101", 1), ("20200102", 20), ("20200102", 21)]
    assert rows(snapshots.read_days(spark, path, "20200102", "20200102")) == [("20200102", 20), ("20200102", 21)]
    assert rows(snapshots.read_days(spark, path, version=1)) == [("20200101", 1), ("20200102", 2), ("20200103", 3)]
    assert snapshots.read_days(spark, path, "20210101").count() == 0 and snapshots.read_days(spark, path, "20210101").columns == ["build_date", "v"]
    snapshots.write_days(days(spark, [("20200101", 9)]), path)
    snapshots.vacuum(spark, path)
    assert rows(snapshots.read_days(spark, path)) == [("20200101", 9), ("20200102", 20), ("20200102", 21)]
    assert len(snapshots.list_names(spark, f"{path}/data")) == 2 and snapshots.versions(spark, path) == [3]


def test_failed_write_leaves_the_earlier_state(spark):
    path = out(spark) + "/t"
    snapshots.write_days(days(spark, [("20200101", 1), ("20200102", 2)]), path)
    broken = days(spark, [("20200101", 5), ("20200102", 6)]).repartition(2, "build_date").withColumn(
        "v", F.when(F.col("v") == 6, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        snapshots.write_days(broken, path)
    assert rows(snapshots.read_days(spark, path)) == [("20200101", 1), ("20200102", 2)]


def test_two_writers_cannot_publish_the_same_version(spark):
    path = out(spark) + "/t"
    snapshots.write_days(days(spark, [("20200101", 1)]), path)
    with pytest.raises(Exception, match="(?i)exist"):
        snapshots.put_text(spark, f"{path}/snapshots/1.json", "{}")
    assert rows(snapshots.read_days(spark, path)) == [("20200101", 1)]


def test_tracked_stats_failing_half_way(spark, monkeypatch):
    pings, lines = src(spark)
    store = out(spark) + "/tracked"
    w = DEFAULT.with_(start_date="19950101", end_date="19950601")
    jobs.etl_tracked_stats(pings, lines, w, store)
    before = rows(snapshots.read_days(spark, store))

    def lost(*a, **k):
        raise OSError("driver lost")
    monkeypatch.setattr(snapshots, "put_text", lost)
    with pytest.raises(OSError):
        jobs.etl_tracked_stats(pings, lines, w.with_(end_date="19960101"), store)
    assert rows(snapshots.read_days(spark, store)) == before


# ---- symbol store ----

def test_unused_modules_are_not_opened(spark):
    from hangscope.operators.symbolicate import symbol_asof
    from hangscope.sources.symbol_store import needed_symbols, read_symbol_store, write_symbol_store
    path = out(spark) + "/symbols"
    symbols = spark.createDataFrame([(m, i, a, f"{m}:{a}") for m, i in (("a.pdb", "007"), ("b c.so", "I#1"), ("d", "X")) for a in (0, 64, 1 << 40)],
                                    "debug_name string, breakpad_id string, address long, symbol string")
    write_symbol_store(symbols, path)
    assert rows(read_symbol_store(spark, path).select(symbols.columns)) == rows(symbols)
    for f in glob.glob(f"{path}/debug_name=d/*/*.parquet"):
        with open(f, "wb") as h:
            h.write(b"not parquet")
    frames = spark.createDataFrame([("a.pdb", "007", "41"), ("b c.so", "I#1", "3f"), ("d", None, "41"), ("d", "X", "zz"), (None, None, "1"), ("e", "Y", "0")],
                                   "debug_name string, breakpad_id string, offset string")
    need = needed_symbols(read_symbol_store(spark, path), frames)
    assert "dynamicpruning" in need._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.debug_name, r.offset): r.symbol for r in symbol_asof(frames, need).collect()}
    assert got == {("a.pdb", "41"): "a.pdb:64", ("b c.so", "3f"): "b c.so:0", ("d", "41"): None, ("d", "zz"): None, (None, "1"): None, ("e", "0"): None}
    # beyond the bound the list is joined, not broadcast; the unreadable module must then be whole
    write_symbol_store(symbols.where("debug_name = 'd'"), path)
    assert rows(needed_symbols(read_symbol_store(spark, path), frames, limit=0)) == rows(need)


def test_symbols_without_module_are_refused(spark):
    from hangscope.sources.symbol_store import write_symbol_store
    with pytest.raises(Exception, match="no name or id"):
        write_symbol_store(spark.createDataFrame([("", "x", 1, "s")], "debug_name string, breakpad_id string, address long, symbol string"), out(spark) + "/s")


def test_offset_sets_are_exact(spark):
    from hangscope.operators.symbolicate import decode_offset_sets, offset_sets
    values = [0, 1, 7, 8, 32767, 32768, 32769, 65536, 65537, (1 << 40) + 3]
    frames = spark.createDataFrame([(False, "m", "i", f"{v:x}") for v in values] + [(False, "m", "i", "0X8"), (False, "n", None, "5"), (True, None, None, "5"),
                                   (False, "m", "i", "zz"), (False, None, None, "9")], "pseudo boolean, debug_name string, breakpad_id string, offset string")
    got = sorted((r.debug_name, r.breakpad_id, r.value) for r in decode_offset_sets(offset_sets(frames)).collect())
    assert got == sorted([("m", "i", v) for v in values] + [("n", None, 5)])


# ---- totals kept day by day ----

def test_daily_steps_equal_one_cumulative_run(spark):
    rnd = random.Random(8)
    funcs = [(f"f{i}", f"l{i % 3}") for i in range(5)]
    data = [("T", f"2020010{d}", [funcs[rnd.randrange(5)] for _ in range(rnd.randint(1, 5))], rnd.choice([1, 5, 50])) for d in range(1, 5) for _ in range(60)]
    df = spark.createDataFrame([(t, d, [{"func": f, "lib": l} for f, l in s], ms) for t, d, s, ms in data],
                               "thread string, build_date string, sym_stack array<struct<func:string,lib:string>>, hang_ms long")
    r = (df.groupBy("thread", "build_date", "sym_stack").agg(F.sum("hang_ms").alias("hang_ms")).withColumn("ssid", stack_id(F.col("sym_stack")))
         .select("*", F.lit("r").alias("runnable"), F.lit(False).alias("pending_input"), F.lit("p").alias("platform"), F.lit(1).cast("long").alias("hang_count"),
                 F.lit(2.0).alias("usage_h"), (F.col("hang_ms") / 2).alias("ms_per_hour")))
    cfg = DEFAULT.with_(stack_acceptance_threshold=0.07)
    show = lambda p: rows(ST.sample_table_by_date(p, cfg).select("build_date", "pruned", "hang_ms", "sample_ms"))
    whole, steps, state = show(ST.prune(r, cfg, cumulative=True)), [], None
    for d in range(1, 5):
        p, state = ST.prune_step(r.where(F.col("build_date") == f"2020010{d}"), cfg, state)
        steps += show(p)
    assert sorted(steps, key=repr) == whole
    assert whole != show(ST.prune(r, cfg))      # the days' own totals would prune otherwise


def test_cumulative_job_equals_windowed_job(spark):
    pings, lines = src(spark)
    cfg = DEFAULT.with_(start_date="19950101", end_date="19960101")
    whole = jobs.etl_hang_profile(pings, lines, cfg, out(spark))
    kept = out(spark) + "/kept"
    for start, end in (("19950101", "19950501"), ("19950501", "19960101"), ("19950501", "19960101")):    # the last step twice
        jobs.etl_cumulative_write(pings, lines, cfg.with_(start_date=start, end_date=end), kept)
    stepped = jobs.etl_cumulative_profile(spark, cfg, kept, out(spark))
    decode = lambda p: rows(reingest.profile_rows(reingest.decode_chunks(read_chunks(spark, p))).drop("profile"))
    assert decode(stepped) == decode(whole) != []


# ---- profiles read back ----

def test_written_profile_finalizes_to_the_direct_result(spark):
    """Daily profiles in each written form against the increments' own finalize."""
    pings, lines = src(spark)
    cfg = DEFAULT.with_(start_date="19950101", end_date="19950301")
    daily = out(spark) + "/daily"
    jobs.etl_incremental_write(pings, lines, cfg, daily)
    direct = jobs.etl_incremental_finalize(spark, cfg, daily, out(spark))
    runs = []
    for day in ("19950101", "19950201"):       # a profile of each date, as the original wrote them
        after = (datetime.date(int(day[:4]), int(day[4:6]), int(day[6:])) + datetime.timedelta(days=1)).strftime("%Y%m%d")
        runs.append(jobs.etl_incremental_finalize(spark, cfg.with_(start_date=day, end_date=after, run_id=day), daily, out(spark)))
    again = jobs.etl_finalize_profiles(spark, cfg, runs, out(spark))
    decode = lambda p: rows(reingest.profile_rows(reingest.decode_chunks(read_chunks(spark, p))).drop("profile"))
    assert decode(again) == decode(direct) != []
    assert rows(read_usage(spark, again).groupBy("build_date").agg(F.sum("usage_h"))) == rows(read_usage(spark, direct))
    documents = jobs.etl_incremental_finalize(spark, cfg.with_(one_document_per_thread=True), daily, out(spark))
    assert rows(reingest.profile_rows(reingest.decode_documents(read_profile(spark, documents))).drop("profile")) == decode(direct)


def test_runs_are_published_and_kept(spark):
    pings, lines = src(spark)
    root = out(spark)
    cfg = DEFAULT.with_(start_date="19950101", end_date="19950301", append_date=True, run_date="20200102", run_id="one")
    one = jobs.etl_hang_profile(pings, lines, cfg, root)
    assert jobs.latest_run(spark, root, cfg) == one == f"{root}/hang_profile_128_16000-20200102_one"
    two = jobs.etl_hang_profile(pings, lines, cfg.with_(run_id="two", end_date="19950201"), root)
    assert jobs.latest_run(spark, root, cfg) == two
    assert {r.date for r in read_chunks(spark, two).where("section = 'dates'").collect()} == {"19950101"}
    assert {r.date for r in read_chunks(spark, one).where("section = 'dates'").collect()} == {"19950101", "19950201"}


def test_jobs_count_and_tidy(spark):
    pings, lines = src(spark)
    mark = len(_WRITTEN[spark.sparkContext.applicationId]) if spark.sparkContext.applicationId in _WRITTEN else 0
    tables = f"{ensure_checkpoint_dir(spark)}/hangscope-tmp"
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    path = jobs.etl_hang_profile(pings, lines.withColumn("line", F.when(F.col("line_no") % 7 == 0, "FUNC zz").otherwise(F.col("line"))),
                                 DEFAULT.with_(start_date="19950101", end_date="19950301"), out(spark))
    told = json.loads(snapshots.read_text(spark, f"{path}/counters.json"))
    assert told["pings"]["rows"] > told["pings"]["rejected"] > 0 and told["rates"]["without_usage_hours"] == 0 < told["rates"]["rows"]
    assert told["symbol_lines"]["rejected"] == spark.read.json(f"{path}/rejects").count() > 0
    assert set(os.listdir(tables)) == before and len(_WRITTEN[spark.sparkContext.applicationId]) == mark


def test_failfast(spark):
    pings, lines = src(spark)
    bad = lines.withColumn("line", F.when(F.col("line_no") % 64 == 0, "FUNC zz").otherwise(F.col("line")))
    cfg = DEFAULT.with_(start_date="19950101", end_date="19950301")
    with pytest.raises(Exception, match="can't be parsed: FUNC zz"):
        jobs.etl_hang_profile(pings, bad, cfg.with_(failfast=True), out(spark))


# ---- pings that lack a path ----

def test_store_without_a_path_is_an_empty_day(spark):
    from hangscope.sources.pings import hang_pings
    pings = derived.raw_pings(spark, SF_SMALL)
    assert hang_pings(pings.withColumn("environment", F.struct(F.lit("x").alias("system"))), DEFAULT).count() == 0
    no_modules = pings.withColumn("payload", F.col("payload").dropFields("modules"))
    got = hang_pings(no_modules, DEFAULT)
    assert got.count() == hang_pings(pings, DEFAULT).count() and got.where(F.size("modules") > 0).count() == 0


@pytest.mark.parametrize("value,reason", [
    ("{", "not JSON"), (None, "not JSON"), ('{"meta":{"docType":"bhr"}}', "os version is not text"), ('{"meta":{"docType":"main"}}', None), ("[1]", None)])
def test_json_rejects(spark, value, reason):
    from hangscope.sources.json_pings import json_pings
    lines = spark.createDataFrame([(1, "bhr", "nightly", value), (2, "bhr", "beta", "{"), (3, "main", "nightly", "{")],
                                  "ping_id long, doc_type string, channel string, value string")
    pings, rejects = json_pings(lines, DEFAULT)
    assert pings.count() == 0 and [r.reason for r in rejects.collect()] == ([reason] if reason else [])
