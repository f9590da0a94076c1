"""The four job entry points end to end on derived sf0.001 data."""

import json
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from hangscope.config import DEFAULT
from hangscope.sources import derived


def _out(spark):
    from hangscope.session import ensure_checkpoint_dir
    return tempfile.mkdtemp(prefix="jobs-", dir=ensure_checkpoint_dir(spark))


def _src(spark):
    return derived.raw_pings(spark, SF_SMALL), derived.symbol_lines(spark, SF_SMALL)


def _docs(spark, path):
    from hangscope.sources.profiles import read_profile
    return {r.name: json.loads(r.profile) for r in read_profile(spark, path).collect()}


def test_hang_profile_packed_and_split(spark):
    from hangscope.plans.jobs import etl_hang_profile
    pings, lines = _src(spark)
    cfg = DEFAULT.with_(start_date="19950101", end_date="19960101", one_document_per_thread=True)
    path = etl_hang_profile(pings, lines, cfg, _out(spark))
    docs = _docs(spark, path)
    assert docs and all(d["stackTable"]["length"] > 0 for d in docs.values())
    # end date excluded (D10): every date of every thread is in 1995
    assert {x["date"][:4] for d in docs.values() for x in d["dates"]} == {"1995"}
    split = etl_hang_profile(pings, lines, cfg.with_(split_threads_in_out_file=True), _out(spark))
    m = spark.read.json(f"{split}/manifest")
    assert {r.section for r in m.select("section").distinct().collect()} == {
        "stringArray", "libs", "funcTable", "stackTable", "sampleTable", "dates"}
    stacks = {r.thread: r.rows for r in m.where(F.col("section") == "stackTable").collect()}
    assert stacks == {k: d["stackTable"]["length"] for k, d in docs.items()}
    meta = spark.read.json(f"{split}/main/meta").first()
    assert meta.isSplit and meta.uuid == cfg.run_id and set(json.loads(meta.usageHoursByDate)) >= {x["date"] for d in docs.values() for x in d["dates"]}
    files = {r.name: r for r in spark.read.json(f"{split}/main/splitFiles").collect()}
    assert files.keys() == docs.keys() and all(files[k].processType == d["processType"] and len(files[k].files) == 6 for k, d in docs.items())


def test_chunks_hold_the_same_profile(spark):
    """The default output against the documents: every section entry by entry, with null gaps only in the documents."""
    from hangscope.plans.jobs import etl_hang_profile
    from hangscope.sources.profiles import read_chunks
    pings, lines = _src(spark)
    cfg = DEFAULT.with_(start_date="19950101", end_date="19960101", profile_chunk_rows=7)
    for minimal in (False, True):
        c = cfg.with_(use_minimal_sample_table=minimal)
        docs = _docs(spark, etl_hang_profile(pings, lines, c.with_(one_document_per_thread=True), _out(spark)))
        rows = read_chunks(spark, etl_hang_profile(pings, lines, c, _out(spark))).collect()
        assert all(r.rows == len(json.loads(r.entries)) <= 7 for r in rows)
        got = {}
        for r in sorted(rows, key=lambda r: r.chunk):
            got.setdefault((r.thread, r.section, r.date), []).extend(json.loads(r.entries))
        for name, d in docs.items():
            assert [e["string"] for e in got[name, "stringArray", None]] == d["stringArray"]
            for section in ("funcTable", "stackTable", "sampleTable"):
                keys = [k for k in d[section] if k != "length"]
                if section == "sampleTable":
                    assert keys == (["stack", "platform", "category"] if minimal else ["stack", "runnable", "userInteracting", "platform", "category"])
                entries = got.get((name, section, None), [])
                assert d[section]["length"] == len(entries) and [e["idx"] for e in entries] == list(range(len(entries)))
                assert all([e.get(k) for e in entries] == d[section][k] for k in keys)
            for x in d["dates"] or ():
                entries = {e["idx"]: e for e in got[name, "dates", x["date"]]}
                assert ("sampleHangMs" in x) is not minimal and len(x["sampleHangCount"]) == max(entries) + 1
                for field in [k for k in x if k != "date"]:
                    assert x[field] == [entries[i].get(field) if i in entries else None for i in range(len(x[field]))]


def test_tracked_stats_merge_into_store(spark):
    from hangscope.operators.histograms import merge_histograms
    from hangscope.plans import pipelines as PL
    from hangscope.plans.jobs import derived_inputs, etl_tracked_stats
    from hangscope.sources.snapshots import read_days
    pings, lines = _src(spark)
    store = _out(spark) + "/tracked"
    w1 = DEFAULT.with_(start_date="19950101", end_date="19960601")
    w2 = DEFAULT.with_(start_date="19960101", end_date="19961231")
    etl_tracked_stats(pings, lines, w1, store)
    etl_tracked_stats(pings, lines, w2, store)
    h1 = PL.histogram_rates(derived_inputs(spark, SF_SMALL, w1), w1)
    h2 = PL.histogram_rates(derived_inputs(spark, SF_SMALL, w2), w2)
    want = merge_histograms(h1, h2)
    got = read_days(spark, store).select(*want.columns)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(got) == rows(want)
    # earlier-only dates kept (1995), overlap replaced by the new window
    assert got.where(F.col("build_date") < "19960101").count() > 0


def test_incremental_write_then_finalize(spark):
    from hangscope.plans.jobs import etl_incremental_finalize, etl_incremental_write, finalize_daily
    pings, lines = _src(spark)
    cfg = DEFAULT.with_(start_date="19950101", end_date="19960101", one_document_per_thread=True)
    daily = _out(spark) + "/daily"
    etl_incremental_write(pings, lines, cfg, daily)
    path = etl_incremental_finalize(spark, cfg, daily, _out(spark))
    docs = _docs(spark, path)
    samples = finalize_daily(spark, daily + "/samples", cfg.with_(end_date="19951231"))
    per_thread = {r.thread: r.n for r in samples.select("thread", "pssid", "runnable", "pending_input", "platform")
                  .distinct().groupBy("thread").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {k: d["sampleTable"]["length"] for k, d in docs.items()} == per_thread
