"""Sources, sinks, streaming staging and the end-to-end job."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, checkout, exposure, ts
from liftlens.operators import filtered_summary, stage_events
from liftlens.operators.quality import DataQualityError
from liftlens.plans.job import (
    build_from_staged, build_warehouse, export_reports, open_warehouse, run_all, run_quality,
)
from liftlens.plans.chain import build_tables
from liftlens.schema import STAGED_COLUMNS
from liftlens.sources import driver_events, read_ndjson_events, read_table
from liftlens.sources.tables import WAREHOUSE_TABLES
from liftlens.streaming import stage_event_stream, write_staged_stream


def _write_ndjson(path, records, extra_lines=()):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "events.jsonl"), "w") as fh:
        for rec in records:
            fh.write(json.dumps(rec) + "\n")
        for line in extra_lines:
            fh.write(line + "\n")


RECORDS = [
    {"event_id": "a1", "user_id": "user_00001", "session_id": "s1", "event_name": "experiment_exposure",
     "event_ts": "2026-01-01 09:00:00", "experiment_key": "homepage", "variant": "control",
     "country": "IN", "device_type": "mobile", "revenue": None},
    {"event_id": "a2", "user_id": "user_00001", "session_id": "s1", "event_name": "checkout_completed",
     "event_ts": "2026-01-02 10:30:00.123456", "experiment_key": None, "variant": None,
     "country": "IN", "device_type": "mobile", "revenue": 42.5},
    {"event_id": "a3", "user_id": 17, "session_id": "s2", "event_name": "page_view",
     "event_ts": "2026-01-03 11:00:00", "country": "US", "device_type": "tablet"},
]


def test_ndjson_read(spark, tmp_path):
    path = str(tmp_path / "raw")
    _write_ndjson(path, RECORDS)
    staged = stage_events(read_ndjson_events(spark, path))
    rows = {r.event_id: r for r in staged.collect()}
    assert staged.columns == STAGED_COLUMNS
    assert rows["a2"].event_ts.microsecond == 123456 and rows["a2"].revenue == 42.5
    assert rows["a3"].user_id == "17" and rows["a3"].experiment_key is None
    [c] = build_tables(read_ndjson_events(spark, path)).conversions.collect()
    assert c.revenue == 42.5 and c.conversion_ts is not None


def test_ndjson_bad_line_fails(spark, tmp_path):
    path = str(tmp_path / "bad")
    _write_ndjson(path, RECORDS, ['{"event_id": "x", "event_ts": '])
    with pytest.raises(Exception):
        read_ndjson_events(spark, path).collect()


def test_ndjson_bad_timestamp_fails(spark, tmp_path):
    path = str(tmp_path / "badts")
    bad = dict(RECORDS[0], event_ts="not a time")
    _write_ndjson(path, [bad])
    with pytest.raises(Exception):
        stage_events(read_ndjson_events(spark, path)).collect()


def test_ndjson_zones_and_quoted_numbers(spark, tmp_path):
    path = str(tmp_path / "zones")
    times = ["2026-01-05T09:00:00Z", "2026-01-05T09:00:00+02:00", "2026-01-05 09:00:00",
             "2026-01-05T09:00:00.5-0130", "2026-01-05"]
    _write_ndjson(path, [dict(RECORDS[1], event_id=f"z{i}", event_ts=t, revenue="12.5")
                         for i, t in enumerate(times)])
    rows = sorted(stage_events(read_ndjson_events(spark, path)).collect())
    assert [str(r.event_ts) for r in rows] == [
        "2026-01-05 09:00:00", "2026-01-05 07:00:00", "2026-01-05 09:00:00",
        "2026-01-05 10:30:00.500000", "2026-01-05 00:00:00"]
    assert {r.revenue for r in rows} == {12.5}


@pytest.mark.parametrize("revenue", ["NaN", "Infinity", "twelve"])
def test_revenue_that_is_no_number_fails_in_staging(spark, tmp_path, revenue):
    path = str(tmp_path / "nan")
    _write_ndjson(path, [dict(RECORDS[1], revenue=revenue)])
    with pytest.raises(Exception):
        stage_events(read_ndjson_events(spark, path)).collect()


def test_streaming_staging_matches_batch(spark, tmp_path):
    src = str(tmp_path / "incoming")
    _write_ndjson(src, RECORDS)
    wh, ckpt = str(tmp_path / "wh"), str(tmp_path / "ckpt")
    out = f"{wh}/stg_events"
    q = write_staged_stream(stage_event_stream(spark, src), wh, ckpt)
    q.awaitTermination(120)
    batch = stage_events(read_ndjson_events(spark, src))
    streamed = spark.read.parquet(out).select(*STAGED_COLUMNS)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    # a second run over the same files appends nothing
    q2 = write_staged_stream(stage_event_stream(spark, src), wh, ckpt)
    q2.awaitTermination(120)
    assert spark.read.parquet(out).count() == len(RECORDS)
    # a new file is picked up once, on the next run
    more = [dict(r, event_id=r["event_id"] + "-b") for r in RECORDS]
    with open(os.path.join(src, "events-2.jsonl"), "w") as fh:
        for rec in more:
            fh.write(json.dumps(rec) + "\n")
    q3 = write_staged_stream(stage_event_stream(spark, src), wh, ckpt)
    q3.awaitTermination(120)
    ids = sorted(r.event_id for r in spark.read.parquet(out).select("event_id").collect())
    assert ids == sorted([r["event_id"] for r in RECORDS] + [r["event_id"] for r in more])
    # the warehouse goes on from the stream's table
    built = build_from_staged(spark, wh)
    lazy = build_tables(read_ndjson_events(spark, src))
    assert sorted(map(tuple, built.summary.collect())) == sorted(map(tuple, lazy.summary.collect()))


def test_run_all_end_to_end(spark, tmp_path):
    wh, rep = str(tmp_path / "wh"), str(tmp_path / "rep")
    checks = run_all(driver_events(spark, SF001), wh, rep)
    assert checks.where(~F.col("passed")).count() == 0
    for name in WAREHOUSE_TABLES:
        assert read_table(spark, wh, name).count() > 0
    w = open_warehouse(spark, wh)
    assert w.conversions.count() == 44 and w.daily.count() == 33 and w.summary.count() == 6
    summary_csv = spark.read.option("header", True).csv(f"{rep}/experiment_summary")
    assert summary_csv.count() == 6 and "p_value" in summary_csv.columns
    assert spark.read.option("header", True).csv(f"{rep}/experiment_daily_metrics").count() == 33
    report = export_reports(spark, wh, str(tmp_path / "rep2"))
    assert report.count() == 3
    # stored tables agree with the lazy chain
    lazy = build_tables(driver_events(spark, SF001))
    assert sorted(map(tuple, lazy.summary.collect())) == sorted(map(tuple, w.summary.collect()))


def test_run_all_fails_after_writing_reports(raw, tmp_path):
    rows = [exposure("a", "u1", "x", "control", ts()), checkout("c", "u1", ts(hours=1), 2.0)]
    wh, rep = str(tmp_path / "wh"), str(tmp_path / "rep")
    with pytest.raises(DataQualityError, match="expected both control and treatment variants"):
        run_all(raw(rows), wh, rep)
    assert os.path.isdir(f"{rep}/experiment_summary")
    checks = {r.check_name: r.passed for r in run_quality(raw(rows).sparkSession, wh).collect()}
    assert checks == {"staging_not_empty": True, "exposures_not_null": True,
                      "exposures_unique": True, "variants_present": False,
                      "converters_bounded": True}


def test_build_warehouse_partitions(spark, tmp_path):
    wh = str(tmp_path / "wh")
    build_warehouse(driver_events(spark, SF001), wh)
    conversions = read_table(spark, wh, "experiment_conversions", only=["exp_0"])
    plan = conversions._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    assert {r[0] for r in conversions.select("experiment_key").distinct().collect()} == {"exp_0"}


def test_stored_tables_keep_odd_experiment_keys(spark, raw, tmp_path):
    keys = ["7", "007", "2026-01-01", "", "a/b=c", "exp 1", "ünï"]
    rows = []
    for n, key in enumerate(keys):
        for u in range(4):
            user = f"u{n}_{u}"
            rows.append(exposure(f"e{user}", user, key, "control" if u % 2 else "treatment", ts()))
            if (u + n) % 2:
                rows.append(checkout(f"c{user}", user, ts(hours=3), 1.255 * (n + 1)))
    df, wh = raw(rows), str(tmp_path / "wh")
    stored, lazy = build_warehouse(df, wh), build_tables(df)
    for name in ("exposures", "conversions", "daily", "summary"):
        assert getattr(stored, name).schema == getattr(lazy, name).schema or name != "conversions"
        assert sorted(map(str, getattr(stored, name).collect())) == sorted(
            map(str, getattr(lazy, name).collect())), name
    assert {r.experiment_key for r in stored.summary.collect()} == set(keys)
    assert filtered_summary(stored.conversions, "abc").collect() == []
    assert read_table(spark, wh, "experiment_conversions", only=["007"]).count() == 4


def test_partitioned_writes_make_few_files(spark, raw, tmp_path):
    rows = [exposure(f"e{k}_{u}", f"u{u}", f"k{k}", "control" if u % 2 else "treatment", ts())
            for k in range(200) for u in range(6)]
    wh = str(tmp_path / "wh")
    build_warehouse(raw(rows).repartition(8), wh)
    files = [f for _, _, names in os.walk(f"{wh}/experiment_conversions") for f in names
             if f.endswith(".parquet")]
    assert 200 <= len(files) <= 300


def test_checkpoint_dir_is_read_from_session(spark):
    from liftlens.config import checkpoint_dir
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_dashboard_session_materializes_under_checkpoint_dir(spark):
    from liftlens.plans.dashboard import DashboardSession
    t = build_tables(driver_events(spark, SF001))
    dash = DashboardSession(t.conversions, "exp_1")
    files = dash.cells.inputFiles()
    folder = dash._copy
    assert files and all(spark.conf.get("spark.checkpoint.dir").rstrip("/") in f for f in files)
    full, part = dash.view(), dash.view(["IN", "US", "DE"], ["mobile", "desktop"])
    lazy = build_tables(driver_events(spark, SF001)).conversions
    assert sorted(map(tuple, full.summary.collect())) == sorted(
        map(tuple, filtered_summary(lazy, "exp_1").collect()))
    assert part.snapshot.count() == 1 and full.snapshot.count() == 1
    n_full = full.summary.agg(F.sum("exposed_users")).first()[0]
    n_seg = full.segments.agg(F.sum("exposed_users")).first()[0]
    assert n_full == n_seg
    dash.close()
    assert not os.path.exists(folder.removeprefix("file:"))


def test_ndjson_path_equals_parquet_path(spark, tmp_path):
    """Driver events written as NDJSON by Spark, read back FAILFAST, full job."""
    from conftest import SF01
    from liftlens.sources.events import JSON_TIMESTAMP_FORMAT
    raw = driver_events(spark, SF01)
    path = str(tmp_path / "events_json")
    raw.write.option("timestampNTZFormat", JSON_TIMESTAMP_FORMAT).json(path)
    from_json_files = build_tables(read_ndjson_events(spark, path))
    from_parquet = build_tables(raw)
    for name in ("staged", "summary", "daily"):
        a = sorted(map(tuple, getattr(from_json_files, name).collect()), key=str)
        b = sorted(map(tuple, getattr(from_parquet, name).collect()), key=str)
        assert a == b, name


def test_cli_run_all_and_quality_exit_code(spark, tmp_path, capsys):
    from liftlens.cli import main
    wh, rep = str(tmp_path / "wh"), str(tmp_path / "rep")
    assert main(["run-all", "--tables", SF001, "--warehouse", wh, "--reports", rep], spark) == 0
    assert "every check passed" in capsys.readouterr().out
    path = str(tmp_path / "one_variant")
    _write_ndjson(path, RECORDS[:2])
    wh2 = str(tmp_path / "wh2")
    assert main(["build", "--events", path, "--warehouse", wh2], spark) == 0
    assert main(["quality", "--warehouse", wh2], spark) == 1
    assert "check failed: expected both control and treatment variants" in capsys.readouterr().out


def test_materialize_cuts_lineage(spark):
    from liftlens.config import materialize
    t = build_tables(driver_events(spark, SF001))
    stored, _ = materialize(t.conversions, "lineage-test")
    plan = stored._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and "Aggregate" not in plan
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, t.conversions.collect()))
