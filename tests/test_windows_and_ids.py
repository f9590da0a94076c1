"""Scans, windows, sampling, ids and increments at their edges."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from hangscope.config import DEFAULT, HangConfig
from hangscope.functions.frames import sample_keep, stack_id
from hangscope.sources import derived
from hangscope.sources.pings import scan_hang_pings


def _out(spark):
    from hangscope.session import ensure_checkpoint_dir
    return tempfile.mkdtemp(prefix="jobs-", dir=ensure_checkpoint_dir(spark))


def test_default_window_and_sample():
    c, today = HangConfig(), dt.datetime.now(dt.timezone.utc).date()
    assert (c.start_date, c.end_date) == tuple((today - dt.timedelta(days=n)).strftime("%Y%m%d") for n in (9, 1))
    assert c.sample_size == 0.5
    assert (DEFAULT.start_date, DEFAULT.end_date, DEFAULT.sample_size) == (None, None, 1.0)


def test_build_window_is_pushed_to_the_scan(spark):
    path = _out(spark) + "/pings"
    derived.raw_pings(spark, SF_SMALL).write.parquet(path)
    cfg = DEFAULT.with_(start_date="19950101", end_date="19951231")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    scan = scan_hang_pings(spark.read.parquet(path), cfg)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(application.buildId,19950101)" in pushed and "LessThan(application.buildId,19960101)" in pushed
    date = F.substring("application.buildId", 1, 8)
    want = spark.read.parquet(path).where(date.between("19950101", "19951231")).count()
    assert scan.count() == want > 0


def test_end_date_without_start_date(spark):
    raw = derived.raw_pings(spark, SF_SMALL)
    got = scan_hang_pings(raw, DEFAULT.with_(end_date="19930101"))
    want = raw.where(F.substring("application.buildId", 1, 8) <= "19930101").count()
    assert got.count() == want < raw.count()


def test_crash_scan_reads_every_day_of_the_window_sampled(spark):
    from hangscope.sources.crashes import scan_crash_pings
    raw = derived.raw_crash_pings(spark, SF_SMALL)
    cfg = DEFAULT.with_(start_date="19950101", end_date="19951231")
    days = {r[0] for r in scan_crash_pings(raw, cfg).select("submissionDate").distinct().collect()}
    assert len(days) == 12 and all(d.startswith("1995") for d in days)
    n, half = raw.count(), scan_crash_pings(raw, DEFAULT.with_(sample_size=0.5)).count()
    assert 0.4 * n < half < 0.6 * n
    one = scan_crash_pings(raw, DEFAULT.with_(start_date="19950101")).select("submissionDate").distinct().collect()
    assert [r[0] for r in one] == ["19950101"]


def test_crash_jobs_keep_modules_and_days(spark):
    from hangscope.plans.jobs import inputs_for
    cfg = DEFAULT.with_(hang_lower_bound=0, use_crashes=True, exclude_modules=True, start_date="19950101", end_date="19951231")
    i = inputs_for(derived.raw_crash_pings(spark, SF_SMALL), derived.symbol_lines(spark, SF_SMALL), cfg)
    assert i.pings.where(F.size("modules") == 0).count() == 0
    assert i.hangs.select("build_date").distinct().count() == 12


def test_rebase_high_addresses(spark):
    from hangscope.sources.crashes import rebase_frame
    rows = [("0xfffff80312345678", "0xfffff80312340000"), ("0x10", "0x20"), ("0xffffffffffffffff", "0x0"), ("0x0", "0xffffffffffffffff"), (None, "0x1"), ("0x5", None)]
    df = spark.createDataFrame(rows, "ip string, base string")
    frame = F.struct("ip", F.lit(0).alias("module_index"))
    got = df.select(rebase_frame(frame, F.array(F.struct(F.col("base").alias("base_addr"))))["offset"].alias("o")).collect()
    assert [r.o for r in got] == ["0x5678", "-0x10", "0xffffffffffffffff", "-0xffffffffffffffff", None, "0x5"]


def test_small_sampling_fraction_keeps_its_share(spark):
    n = spark.range(2_000_000).where(sample_keep(F.col("id"), 0.00002)).count()
    assert 10 <= n <= 90


def test_stack_ids_tell_nulls_apart(spark):
    rows = [([("x", None, "y")],), ([("x", "y", None)],), ([("x", "", "y")],), ([(None, "x", "y")],), ([("x", "n", "y")],)]
    df = spark.createDataFrame(rows, "s array<struct<a:string,b:string,c:string>>")
    assert df.select(stack_id(F.col("s"), ("a", "b", "c")).alias("i")).distinct().count() == len(rows)


def test_symbol_files_with_odd_names(spark):
    from hangscope.sources.symbols import parse_symbol_lines, read_symbol_files, symbol_path, symbol_precedence
    root = _out(spark)
    mods = [("my lib+x.pdb", "A 1"), ("libstdc++.so.6", "B%2"), ("plain.so", "C*3"), ("é&=.pdb", "D+4")]
    lines = ["PUBLIC 10 0 first", "FUNC 20 4 0 f one", "PUBLIC 10 0 last", "FUNC zz 1 0 bad", "PUBLIC ffffffffffffffff 0 far"]
    df = spark.createDataFrame(mods, "n string, i string").select(symbol_path(F.col("n"), F.col("i")).alias("p"))
    for r in df.collect():
        folder, _, name = r.p.rpartition("/")
        import pathlib
        pathlib.Path(root, folder).mkdir(parents=True)
        pathlib.Path(root, folder, name).write_text("\n".join(lines))
    parsed, rejects = parse_symbol_lines(read_symbol_files(spark, root))
    got = {(r.debug_name, r.breakpad_id, r.address, r.symbol) for r in symbol_precedence(parsed).collect()}
    assert got == {(n, i, a, s) for n, i in mods for a, s in ((16, "last"), (32, "f one"))}
    assert {r.reason for r in rejects.collect()} == {"address is not hex", "address past 2^63 - 1"} and rejects.count() == 2 * len(mods)


def test_increments_keep_usage_and_drop_stale_days(spark):
    from hangscope.operators.rates import usage_hours_by_date
    from hangscope.plans.jobs import etl_incremental_finalize, etl_incremental_write, inputs_for
    from hangscope.sources.snapshots import read_days
    import json
    pings, lines = derived.raw_pings(spark, SF_SMALL), derived.symbol_lines(spark, SF_SMALL)
    cfg = DEFAULT.with_(start_date="19950101", end_date="19960101")
    with pytest.raises(ValueError):
        etl_incremental_write(pings, lines, cfg.with_(use_minimal_sample_table=True), _out(spark))
    store = _out(spark) + "/daily"
    etl_incremental_write(pings, lines, cfg, store)
    few = cfg.with_(hang_lower_bound=14500)
    etl_incremental_write(pings, lines, few, store)
    days = {r[0] for r in read_days(spark, f"{store}/samples").select("build_date").distinct().collect()}
    assert 0 < len(days) < 12
    path = etl_incremental_finalize(spark, few, store, _out(spark))
    hours = json.loads(spark.read.json(f"{path}/meta").first().usageHoursByDate)
    want = {r.build_date: r.usage_h for r in usage_hours_by_date(inputs_for(pings, lines, few.with_(end_date="19951231")).pings).collect()}
    assert hours.keys() == want.keys() and len(hours) == 12


def test_increments_without_rows_can_be_finalized(spark):
    from hangscope.sources.snapshots import read_days, write_days
    store = _out(spark) + "/none"
    df = spark.createDataFrame([("19950101", 1, "x")], "build_date string, n int, s string")
    write_days(df.where("false"), store, "19950101", "19950102")
    back = read_days(spark, store)
    assert back.count() == 0 and sorted(back.columns) == ["build_date", "n", "s"]


def test_looping_stack_table_is_an_error(spark):
    from hangscope.operators.profile import reconstruct_paths
    rows = [("t", 0, "(root)", None, None), ("t", 1, "a", "l", 2), ("t", 2, "b", "l", 1)]
    with pytest.raises(ValueError):
        reconstruct_paths(spark.createDataFrame(rows, "thread string, idx long, func string, lib string, prefix_idx long"))
