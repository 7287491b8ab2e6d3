"""Watermark and finality scenarios on hand-made files, one file per micro-batch."""

from __future__ import annotations

import os

import pytest
from helpers import activity, write_batch

from tidemill import GoldJob, run_gold_aggregation
from tidemill.functions import utc_wall_clock
from tidemill.sources import scan_table, stream_table
from tidemill.streaming.sinks import settings
from tidemill.topics import USER_ACTIVITY

COUNT = GoldJob("counts", {"n": "count(*)"})


class Scenario:
    """A silver folder, a job on it, and the job's table."""

    def __init__(self, spark, root, job=COUNT, **options):
        self.spark = spark
        self.silver = f"{root}/silver"
        self.job = GoldJob(
            job.name, job.aggs, job.group_by, job.filter, f"{root}/gold", f"{root}/mark"
        )
        self.options = options

    def add(self, *events):
        """One file from (event type, clock) pairs."""
        rows = [(f"e{i}", kind, clock, 1.0) for i, (kind, clock) in enumerate(events)]
        write_batch(activity(self.spark, rows), self.silver)
        return self

    def run(self):
        stream = stream_table(
            self.spark,
            self.silver,
            schema=USER_ACTIVITY.payload_schema,
            max_files_per_trigger=1,
        )
        self.total = run_gold_aggregation(self.spark, stream, self.job, **self.options)
        return self

    def windows(self):
        rows = scan_table(self.spark, self.job.table)
        rows = utc_wall_clock(rows, "window_start", "window_end")
        return sorted((r.window_start.strftime("%H:%M"), r.n) for r in rows.collect())


def views(*clocks):
    return [("product_view", c) for c in clocks]


def test_window_is_final_when_the_watermark_reaches_its_end(spark, root):
    scenario = Scenario(spark, root).add(*views("00:05", "01:05", "02:30")).run()
    assert scenario.windows() == [("00:00", 1), ("01:00", 1)]
    assert scenario.total == 2


def test_window_stays_open_just_before(spark, root):
    scenario = Scenario(spark, root).add(*views("00:05", "01:05", "02:05", "02:29")).run()
    assert scenario.windows() == [("00:00", 1)]


def test_late_row_counts_one_batch_after_the_jump_and_not_later(spark, root):
    scenario = Scenario(spark, root)
    scenario.add(*views("00:05", "05:05")).add(*views("00:10")).add(*views("00:15")).run()
    assert scenario.windows() == [("00:00", 2)]


def test_open_windows_and_watermark_survive_between_runs(spark, root):
    scenario = Scenario(spark, root).add(*views("00:05", "01:05", "02:30")).run()
    scenario.add(*views("01:10", "02:05")).run()
    scenario.add(*views("03:35")).run()
    assert scenario.windows() == [("00:00", 1), ("01:00", 1), ("02:00", 2)]


PAYMENTS = GoldJob("payments", {"n": "count(*)"}, filter="event_type = 'payment'")


def test_filtered_job_moves_its_watermark_with_matching_rows(spark, root):
    scenario = Scenario(spark, root, PAYMENTS)
    scenario.add(("payment", "00:05"), ("product_view", "05:00")).run()
    assert scenario.total == 0


def test_watermark_scope_all_moves_it_with_every_row(spark, root):
    scenario = Scenario(spark, root, PAYMENTS, watermark_scope="all")
    scenario.add(("payment", "00:05"), ("product_view", "05:00")).run()
    assert scenario.windows() == [("00:00", 1)]


def test_window_and_watermark_are_parameters(spark, root):
    scenario = Scenario(spark, root, window="15 minutes", watermark="5 minutes")
    scenario.add(*views("00:05", "00:14:59", "00:15", "00:35")).run()
    assert scenario.windows() == [("00:00", 2), ("00:15", 1)]


def test_nothing_to_read_gives_an_empty_table(spark, root):
    scenario = Scenario(spark, root).add().run()
    assert scenario.total == 0


def test_group_with_nulls(spark, root):
    job = GoldJob("queries", {"n": "count(*)", "total": "sum(amount)"}, group_by=("search_query",))
    scenario = Scenario(spark, root, job).add(*views("00:05", "00:06", "02:30")).run()
    row = scan_table(spark, scenario.job.table).first()
    assert (row.search_query, row.n, row.total) == (None, 2, 2.0)


@pytest.mark.parametrize("runs", [1, 3])
def test_rerun_without_new_data_adds_nothing(spark, root, runs):
    scenario = Scenario(spark, root).add(*views("00:05", "02:30"))
    for _ in range(runs):
        scenario.run()
    assert scenario.windows() == [("00:00", 1)]


def test_rocksdb_state(spark, root):
    """Session settings reach the job's query; the state may live in RocksDB."""
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    with settings(spark, {"spark.sql.streaming.stateStore.providerClass": provider}):
        silver = f"{root}/silver"
        write_batch(activity(spark, [("a", "login", "00:05", None)]), silver)
        job = GoldJob("counts", {"n": "count(*)"}, (), None, f"{root}/gold", f"{root}/mark")
        assert run_gold_aggregation(spark, silver, job) == 0
        write_batch(activity(spark, [("b", "login", "03:00", None)]), silver)
        assert run_gold_aggregation(spark, silver, job) == 1
    zips = [f for _, _, files in os.walk(f"{root}/mark/state") for f in files]
    assert any(f.endswith((".zip", ".changelog")) for f in zips)
