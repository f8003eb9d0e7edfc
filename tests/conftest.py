from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from liftlens.schema import RAW_EVENTS  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("liftlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # Tests own no cluster: install a checkpoint folder only because none is set.
    if not session.conf.get("spark.checkpoint.dir", None):
        ckpt = str(tmp_path_factory.mktemp("checkpoints"))
        session.sparkContext.setCheckpointDir(ckpt)
        session.conf.set("spark.checkpoint.dir", ckpt)
    yield session


T0 = dt.datetime(2026, 1, 5, 9, 0, 0)


def ts(days=0, hours=0, minutes=0, micros=0):
    return T0 + dt.timedelta(days=days, hours=hours, minutes=minutes, microseconds=micros)


def exposure(eid, user, key, variant, t, country="IN", device="mobile"):
    return (eid, user, f"s_{user}", "experiment_exposure", t, key, variant, country, device, None)


def checkout(eid, user, t, revenue, country="IN", device="mobile"):
    return (eid, user, f"s_{user}", "checkout_completed", t, None, None, country, device, revenue)


def other(eid, user, name, t):
    return (eid, user, f"s_{user}", name, t, None, None, "IN", "mobile", None)


@pytest.fixture
def raw(spark):
    def make(rows):
        return spark.createDataFrame(rows, RAW_EVENTS)
    return make
