"""The metric log says the same before, during and after it is merged."""

import datetime as dt
import random
import threading

import pytest

from tidemark.sources import files
from tidemark.sources.metric_log import MetricLog
from tidemark.sources.schemas import METRIC_SCHEMA


def samples(spark, day, n=30, shift=0.0):
    rnd = random.Random(day)
    rows = [(rnd.choice(["auc", "psi"]), dt.date(2024, rnd.randrange(1, 4), 1), rnd.choice(["m1", "m2", None]), rnd.random() + shift,
             dt.datetime(2024, 5, day, rnd.randrange(24), rnd.randrange(60), i % 60, i)) for i in range(n)]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def told(log):
    rows = [tuple(r) for r in log.latest().collect()]
    assert len({r[:3] for r in rows}) == len(rows)
    return sorted(rows, key=str)


@pytest.fixture
def log(spark, tmp_path):
    return MetricLog(spark, f"file://{tmp_path}/metrics")


def test_latest_is_the_same_after_merging(spark, log):
    assert told(log) == [] and log.merge() is None
    for day in (3, 1, 2):
        log.append(samples(spark, day))
    before = told(log)
    assert log.merge() == 1 and told(log) == before and log.merge() is None
    assert log._read([f"{log.root}/_merged/{log._record()['merged']}"]).count() == len(before)
    log.append(samples(spark, 2, shift=5.0))  # older samples come in later: they change nothing but ties
    log.append(samples(spark, 4))
    now = told(log)
    assert now != before
    assert log.merge() == 2 and told(log) == now


def test_a_watermark_leaves_younger_files(spark, log):
    for day in (1, 2, 3):
        log.append(samples(spark, day).coalesce(1))
    before = told(log)
    assert log.merge("2024-05-03") == 1
    record = log._record()
    assert len(record["absorbed"]) == 2 and record["upto"] == "2024-05-03" and told(log) == before
    assert log.merge("2024-05-03") is None
    assert log.clean() == 0  # too young
    assert log.clean(older_than_hours=-1) == 2 and told(log) == before and log._record()["absorbed"] == []
    assert log.merge() == 3 and told(log) == before
    assert log.clean(older_than_hours=-1) == 2 and told(log) == before
    assert [n for n, _ in files.names(spark, log.root) if n.endswith(".parquet")] == []


def test_appends_that_meet_a_merge_are_not_lost(spark, log, monkeypatch):
    log.append(samples(spark, 1))
    real = files.create_if_absent

    def slow(spark_, path, text):  # an append lands between listing and record
        if "_merges" in path:
            log.append(samples(spark, 9))
        return real(spark_, path, text)

    with monkeypatch.context() as m:
        m.setattr("tidemark.sources.metric_log.files.create_if_absent", slow)
        assert log.merge() == 1
    assert any(r[4].day == 9 for r in told(log))
    assert log.merge() == 2 and any(r[4].day == 9 for r in told(log))


def test_of_two_merges_one_counts(spark, log):
    for day in range(1, 5):
        log.append(samples(spark, day))
    before, got, start = told(log), [], threading.Barrier(2)

    def merge():
        start.wait()
        got.append(log.merge())

    threads = [threading.Thread(target=merge) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert 1 in got and told(log) == before
    log.clean(older_than_hours=-1)
    assert told(log) == before
