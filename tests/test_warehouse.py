"""Versioned tables, observed checks, joined CSV files, positions and kept results."""

from __future__ import annotations

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF001, checkout, exposure, ts
from liftlens.operators import quality_checks
from liftlens.operators.order import _part_number, with_position
from liftlens.operators.quality import ObservedChecks
from liftlens.plans import job, stored
from liftlens.plans.chain import build_tables
from liftlens.plans.job import build_warehouse, export_reports, open_warehouse, run_all
from liftlens.sources import WAREHOUSE_TABLES, driver_events, read_table, write_table
from liftlens.sources.tables import Build, current_path


def _rows(df):
    return sorted(map(str, df.collect()))


def _events(n, revenue=2.0):
    rows = []
    for u in range(n):
        rows.append(exposure(f"e{u}", f"u{u}", "x", "control" if u % 2 else "treatment", ts()))
        rows.append(checkout(f"c{u}", f"u{u}", ts(hours=u + 1), revenue))
    return rows


def _snapshot(spark, wh):
    return {name: _rows(read_table(spark, wh, name)) for name in WAREHOUSE_TABLES}


@pytest.mark.parametrize("dies_at", WAREHOUSE_TABLES)
def test_a_build_that_fails_leaves_the_old_tables(spark, raw, tmp_path, monkeypatch, dies_at):
    wh = str(tmp_path / "wh")
    build_warehouse(raw(_events(4)), wh)
    before = _snapshot(spark, wh)
    write = Build.write

    def failing(self, df, name, observed=None):
        if name == dies_at:  # in the middle of a write: some rows come, then an error
            df = df.withColumn(df.columns[0], F.expr(
                f"CASE WHEN rand() >= 0 THEN CAST(raise_error('lost') AS {df.dtypes[0][1]}) END"))
        write(self, df, name, observed)

    monkeypatch.setattr(job.Build, "write", failing)
    with pytest.raises(Exception, match="lost"):
        build_warehouse(raw(_events(9)), wh)
    assert _snapshot(spark, wh) == before
    monkeypatch.undo()
    build_warehouse(raw(_events(9)), wh)
    assert read_table(spark, wh, "experiment_exposures").count() == 9


def test_a_killed_build_leaves_folders_that_nobody_reads(spark, raw, tmp_path):
    wh = str(tmp_path / "wh")
    build_warehouse(raw(_events(3)), wh)
    before = _snapshot(spark, wh)
    killed = Build(spark, wh)  # never ends: no switch, no clean-up
    killed.write(raw(_events(8)), "stg_events")
    folder = f"{wh}/{killed.written['stg_events']}"
    shutil.rmtree(f"{folder}/_temporary", ignore_errors=True)
    assert os.path.isdir(folder) and _snapshot(spark, wh) == before
    build_warehouse(raw(_events(5)), wh)
    assert not os.path.isdir(folder)  # gone with the next switch
    assert read_table(spark, wh, "stg_events").count() == 10


def test_readers_keep_the_version_that_they_opened(spark, raw, tmp_path):
    wh = str(tmp_path / "wh")
    build_warehouse(raw(_events(3)), wh)
    opened = open_warehouse(spark, wh)
    build_warehouse(raw(_events(6)), wh)
    assert opened.exposures.count() == 3 and open_warehouse(spark, wh).exposures.count() == 6
    versions = os.listdir(f"{wh}/experiment_exposures")
    assert len(versions) == 2
    build_warehouse(raw(_events(7)), wh)
    assert len(os.listdir(f"{wh}/experiment_exposures")) == 2
    assert len([f for f in os.listdir(wh) if f.startswith("CURRENT")]) == 1


def test_one_table_is_replaced_alone(spark, raw, tmp_path):
    wh = str(tmp_path / "wh")
    built = build_warehouse(raw(_events(3)), wh)
    summary = current_path(spark, wh, "experiment_metrics_summary")
    write_table(built.exposures.where("user_id <> 'u1'"), wh, "experiment_exposures")
    assert read_table(spark, wh, "experiment_exposures").count() == 2
    assert current_path(spark, wh, "experiment_metrics_summary") == summary


BAD = [
    [],
    _events(6),
    [exposure("a", "u1", "x", "control", ts()), checkout("c", "u1", ts(hours=1), 2.0)],
    [exposure("a", "u1", "x", "control", None), exposure("b", None, "x", "treatment", ts()),
     exposure("c", "u2", None, "treatment", ts())],
]


@pytest.mark.parametrize("rows", BAD)
def test_observed_checks_are_the_checks_of_the_stored_tables(spark, raw, tmp_path, rows):
    wh, observed = str(tmp_path / "wh"), ObservedChecks()
    built = build_warehouse(raw(rows), wh, checks=observed)
    stored_checks = quality_checks(built.staged, built.exposures, built.summary)
    assert _rows(observed.rows(spark)) == _rows(stored_checks)
    assert observed.rows(spark).schema.simpleString() == stored_checks.schema.simpleString()


def test_repeated_keys_are_observed(spark, tmp_path):
    rows = [("x", f"u{u % 3}", "control", "IN", "mobile", ts()) for u in range(7)] + [
        (None, "u9", "treatment", "IN", "mobile", ts())]
    df = spark.createDataFrame(rows, "experiment_key string, user_id string, variant string, "
                               "country string, device_type string, exposure_ts timestamp_ntz")
    observed = ObservedChecks()
    with Build(spark, str(tmp_path)) as build:
        build.write(observed.numbered(df, ["experiment_key", "user_id"], "exposure_ts"),
                    "experiment_exposures", observed.of_exposures)
        assert build.read("experiment_exposures").columns == df.columns
    assert observed._exposures.get == {"lacking": 1, "repeated": 3}


def test_run_all_scans_the_staging_for_the_exposures_and_checkouts_only(spark, tmp_path, monkeypatch):
    """The checks read no table: every read of stg_events is one of the build."""
    reads = []
    read = Build.read
    monkeypatch.setattr(Build, "read", lambda self, name, only=None: (
        reads.append((name, only)), read(self, name, only))[1])
    checks = run_all(driver_events(spark, SF001), str(tmp_path / "wh"), str(tmp_path / "rep"))
    assert [o for n, o in reads if n == "stg_events"] == [["experiment_exposure"], ["checkout_completed"]]
    assert checks.where("passed").count() == 5
    plan = checks._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_numbering_the_exposures_adds_no_exchange(spark):
    t = build_tables(driver_events(spark, SF001))
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    numbered = ObservedChecks.numbered(t.exposures, ["experiment_key", "user_id"], "exposure_ts")
    assert count(numbered) == count(t.exposures) == 1


def test_exports_are_one_file_each(spark, raw, tmp_path):
    wh, rep = str(tmp_path / "wh"), str(tmp_path / "rep")
    build_warehouse(driver_events(spark, SF001), wh)
    export_reports(spark, wh, rep)
    first = {}
    for name, columns in (("experiment_summary", 12), ("experiment_daily_metrics", 8),
                          ("experiment_report", 7)):
        with open(f"{rep}/{name}.csv") as fh:
            lines = fh.read().splitlines()
        assert lines[0].count(",") == columns - 1 and lines.count(lines[0]) == 1
        parts = spark.read.option("header", True).csv(f"{rep}/{name}")
        assert len(lines) == parts.count() + 1
        first[name] = lines
    keys = [line.split(",")[:3] for line in first["experiment_daily_metrics"][1:]]
    assert keys == sorted(keys) and len(keys) == 33
    export_reports(spark, wh, rep)  # again, over the old files: the same bytes
    for name, lines in first.items():
        with open(f"{rep}/{name}.csv") as fh:
            assert fh.read().splitlines() == lines
    assert not [f for f in os.listdir(rep) if ".csv." in f and not f.endswith(".crc")]


def test_empty_export_has_a_header(spark, raw, tmp_path):
    wh, rep = str(tmp_path / "wh"), str(tmp_path / "rep")
    build_warehouse(raw([]), wh)
    export_reports(spark, wh, rep)
    with open(f"{rep}/experiment_report.csv") as fh:
        assert fh.read().splitlines() == [
            "experiment_key,lookback_days,control_rate,treatment_rate,uplift_pp,z_score,p_value"]


def test_positions_are_those_of_a_sort(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, "a", "b", "ü", "c"]), rnd.choice([None, *range(200)]), i)
            for i in range(1_000)]
    df = spark.createDataFrame(rows, "k string, n int, id int").repartition(6)
    got = with_position(df, ["k", "n", "id"]).collect()
    ordered = sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))
    assert [(r.k, r.n, r.id) for r in sorted(got, key=lambda r: r.position)] == ordered
    assert sorted(r.position for r in got) == list(range(1, 1_001))
    plan = with_position(df, ["k", "n", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    assert with_position(df.where("false"), ["k"]).collect() == []


def test_part_files_are_ordered_by_number():
    names = ["part-100000-a.c000.snappy.parquet", "part-99999-a-c001.snappy.parquet",
             "part-99999-a-c000.snappy.parquet", "part-00002-a-c000.snappy.parquet"]
    assert sorted(names, key=_part_number) == list(reversed(names))


def test_kept_results_are_built_anew_when_the_input_changes(spark, tmp_path):
    sf = str(tmp_path / "sf")
    events = spark.read.parquet(f"{SF001}/events.parquet")
    events.limit(600).coalesce(1).write.parquet(f"{sf}/events.parquet")
    first = stored.stored_cells(spark, sf)
    assert stored.stored_cells(spark, sf).inputFiles() == first.inputFiles()
    events.write.mode("overwrite").parquet(f"{sf}/events.parquet")
    again = stored.stored_cells(spark, sf)
    assert again.inputFiles() != first.inputFiles()
    assert again.agg(F.sum("exposed_users")).first()[0] == 44
    shutil.rmtree(os.path.dirname(again.inputFiles()[0].removeprefix("file://")))
    assert stored.stored_cells(spark, sf).agg(F.sum("exposed_users")).first()[0] == 44
