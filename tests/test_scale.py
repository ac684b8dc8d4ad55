"""What must not grow with the table: tasks that do everything, and plans that do it again."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.plans import forecast
from clickloom.sources import raw_clicks, sessionised
from harness import adapter
from harness.queries import QUERIES

EVENTS = 4_000


@pytest.fixture
def events(spark, tmp_path):
    """A folder with a table of events in one file, a null and a repeated id among them."""
    start = datetime(2024, 1, 1)
    found = [
        (k, start + timedelta(minutes=3 * k), k % 90, ("view", "click", "error")[k % 3], k % 250 + 0.5, f'{{"k": {k % 100}}}')
        for k in range(EVENTS)
    ]
    found[7], found[9] = (None, *found[7][1:]), (8, *found[9][1:])
    table = spark.createDataFrame(
        found, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    )
    table.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_raw_lines_of_one_split_are_made_in_many_tasks(spark, events):
    lines = adapter.raw_lines(spark, events)
    sizes = [n for n, in lines.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(sizes) == EVENTS and max(sizes) < EVENTS / 2


def test_click_files_of_one_name_are_cut_at_the_advised_size(spark, events, tmp_path):
    root, advised = tmp_path / "files", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advised, "8k")
    try:
        adapter.write_click_files(spark, events, str(root))
    finally:
        spark.conf.unset(advised)
    assert len(list(root.glob("01-2024-smh-view/*.gz"))) > 1
    read = raw_clicks.read_click_lines(spark, raw_clicks.click_paths(str(root), ["*"], ["smh", "theage", "drive", "traveller"]))
    columns = ("value", "masthead", "device")
    want = adapter.raw_lines(spark, events).na.fill("", ["value"])  # an event without an id is an empty line
    assert sorted(read.select(*columns).collect()) == sorted(want.select(*columns).collect())


def test_small_click_files_are_one_a_name(spark, events, tmp_path):
    adapter.write_click_files(spark, events, str(tmp_path / "files"))
    for folder in (tmp_path / "files").glob("01-2024-*"):
        assert len(list(folder.glob("*.gz"))) == 1, folder


def test_monthly_metrics_work_heads_out_once(spark, tmp_path):
    """The heads are read for the sums only, and not again for the addresses to locate."""
    heads, ranges = f"{tmp_path}/heads", "lo long, hi long, Country string, Region string, City string, ipBlock string, ipBlockIndex long"
    # 1 January 2024 in Sydney
    views = [("overall", "smh", 1_704_100_000_000 + k, f"1.0.0.{k % 3 + 1}", 2) for k in range(6)]
    views += [("overall", "smh", 1_704_100_000_000, None, 1), ("overall", "smh", 1_704_100_000_000, "9.9.9.9", 5)]
    spark.createDataFrame(views, "scope string, site string, timestamp long, IpAddress string, numPage long").write.parquet(heads)
    located = spark.createDataFrame([(16777217, 16777218, "AU", "0", "Here", "b", 0)], ranges)
    rows = forecast.monthly_metrics(spark.read.parquet(heads), located, "all")
    assert {(row.metric, row.device, row.site, row.value) for row in rows.collect()} == {
        ("Month_visit", "overall", "smh", 4.0), ("Month_pageviews", "overall", "smh", 8.0),
    }
    assert not [path for path in rows.inputFiles() if "/heads/" in path]


def test_weeks_are_written_from_clicks_sessionised_once(spark, events, monkeypatch):
    read = []
    write = sessionised.write_parquet

    def watched(clicks, path):
        read.extend(clicks.inputFiles())
        write(clicks, path)

    monkeypatch.setattr(sessionised, "write_parquet", watched)
    assert QUERIES["repeated_weeks"](spark, events).count() > 0
    assert read and not [path for path in read if "events.parquet" in path]
