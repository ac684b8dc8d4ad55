from __future__ import annotations

import random

import brute
import pytest
from brute import rows
from pyspark.sql import functions as F

from clickloom.functions.reloads import is_reload, reload_probability
from clickloom.operators.reload import (
    index_gaps,
    index_views,
    reload_flags,
    remove_reloads,
    with_reload_probability,
)
from clickloom.operators.sessions import GAP_MS, session_heads, sessionise
from clickloom.operators.slots import with_next_timestamp
from clickloom.plans.etl import combine, in_week, sessionised_clicks

BASE = 1_415_000_000_000
SCHEMA = "trackingId string, timestamp bigint, masthead string, assetType string, assetCategory string"
ATTRIBUTES = ("trackingId", "timestamp", "sessionStart", "sessionEnd", "numPage")


def clicks_of(spark, items):
    full = [(*item, *("smh", "Article", "News")[len(item) - 2 :]) for item in items]
    return spark.createDataFrame(full, SCHEMA)


def random_clicks(seed, n=1500, span=40_000_000):
    """A hot visitor with half the clicks, many ties, and gaps at the limit."""
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        visitor = "hot" if draw.random() < 0.5 else f"v{draw.randrange(20)}"
        at = BASE + draw.randrange(span)
        out.append((visitor, at))
        if draw.random() < 0.2:
            out.append((visitor, at))
        if draw.random() < 0.1:
            out.append((visitor, at + GAP_MS + draw.choice([-1, 0, 1])))
    return out


def test_gap_limit_is_inclusive(spark):
    at = [BASE, BASE + GAP_MS, BASE + 2 * GAP_MS + 1]
    got = rows(sessionise(clicks_of(spark, [("a", t) for t in at])), *ATTRIBUTES, "sessionId", "sessionDuration")
    assert got == [
        ("a", at[0], at[0], at[1], 2, f"{at[0]}a", 1800),
        ("a", at[1], at[0], at[1], 2, f"{at[0]}a", 1800),
        ("a", at[2], at[2], at[2], 1, f"{at[2]}a", 0),
    ]


def test_duration_is_whole_seconds(spark):
    got = rows(sessionise(clicks_of(spark, [("a", BASE), ("a", BASE + 1999)])), "sessionDuration")
    assert got == [(1,), (1,)]


def test_equal_clicks_stay_as_many_rows(spark):
    got = rows(sessionise(clicks_of(spark, [("a", BASE)] * 3)), *ATTRIBUTES)
    assert got == [("a", BASE, BASE, BASE, 3)] * 3
    assert session_heads(sessionise(clicks_of(spark, [("a", BASE)] * 3))).count() == 3


def test_missing_visitor_is_one_visitor(spark):
    got = rows(sessionise(clicks_of(spark, [(None, BASE), (None, BASE + 5)])), *ATTRIBUTES)
    assert got == [("", BASE, BASE, BASE + 5, 2), ("", BASE + 5, BASE, BASE + 5, 2)]


@pytest.mark.parametrize("slot_ms", [1_000, 77_777, 600_000, 10**9])
def test_sessions_equal_brute_force(spark, slot_ms):
    items = random_clicks(slot_ms)
    got = rows(sessionise(clicks_of(spark, items), slot_ms=slot_ms), *ATTRIBUTES)
    want = brute.sessions([{"trackingId": v, "timestamp": t} for v, t in items])
    assert got == sorted(want, key=repr)


def test_sessions_do_not_depend_on_partitioning(spark):
    clicks = clicks_of(spark, random_clicks(5))
    one = rows(sessionise(clicks), *ATTRIBUTES)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert rows(sessionise(clicks.repartition(9)), *ATTRIBUTES) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(one) == clicks.count()
    heads = session_heads(sessionise(clicks)).dropDuplicates(["sessionId"])
    assert heads.agg(F.sum("numPage")).first()[0] == len(one)


def test_sessions_cut_at_local_midnight(spark):
    midnight = 1_415_019_600_000  # 2014-11-04 00:00 in Sydney
    at = [midnight - 60_000, midnight - 1, midnight, midnight + 60_000]
    got = rows(
        sessionise(clicks_of(spark, [("a", t) for t in at]), by_day=True),
        "timestamp", "sessionStart", "numPage", "sessionId",
    )
    assert got == [
        (at[0], at[0], 2, f"{at[0]}a307 ' 2014"),
        (at[1], at[0], 2, f"{at[0]}a307 ' 2014"),
        (at[2], at[2], 2, f"{at[2]}a308 ' 2014"),
        (at[3], at[2], 2, f"{at[2]}a308 ' 2014"),
    ]


def test_scope_keeps_sites_apart(spark):
    items = [("a", BASE, "smh"), ("a", BASE + 1, "theage"), ("a", BASE + 2, "smh")]
    clicks = clicks_of(spark, items)
    assert rows(sessionise(clicks), "numPage") == [(3,)] * 3
    assert rows(sessionise(clicks, scope=["masthead"]), "masthead", "numPage") == [
        ("smh", 2), ("smh", 2), ("theage", 1),
    ]


@pytest.mark.parametrize("slot_ms", [1, 50, 10_000])
def test_next_timestamp_equals_brute_force(spark, slot_ms):
    draw = random.Random(slot_ms)
    items = [(f"k{draw.randrange(3)}", draw.randrange(2000), f"x{draw.randrange(3)}") for _ in range(600)]
    df = spark.createDataFrame(sorted(set(items)), "key string, timestamp bigint, item string")
    got = rows(with_next_timestamp(df, ["key"], ["item"], slot_ms), "key", "timestamp", "item", "nextTimestamp")
    assert got == brute.next_timestamps(items, 1)


INDEX = ("smh", "Index", "The Sydney Morning Herald")


def test_index_views_by_masthead(spark):
    clicks = clicks_of(
        spark,
        [
            ("a", 1, *INDEX),
            ("a", 2, "theage", "Index", "The Sydney Morning Herald"),
            ("a", 3, "theage", "Index", "The Age"),
            ("a", 4, "smh", "Article", "The Sydney Morning Herald"),
            ("a", 5, "drive", "Index", "Home"),
        ],
    )
    assert rows(index_views(clicks), "timestamp") == [(1,), (3,)]
    assert rows(index_views(clicks, {}), "timestamp") == []


def test_gap_belongs_to_the_earlier_view(spark):
    at = [BASE, BASE, BASE + 300_000, BASE + 900_000]
    gaps = index_gaps(index_views(clicks_of(spark, [("a", t, *INDEX) for t in at])))
    assert rows(gaps, "timestamp", "gap") == [(at[0], 300_000), (at[2], 600_000), (at[3], 0)]
    scored = dict(rows(with_reload_probability(gaps), "timestamp", "probability"))
    assert scored[at[0]] == pytest.approx(0.996) and scored[at[3]] == 0.0


def reloading(spark, n=400):
    """Visitors whose homepage reloads every five minutes, and articles in between."""
    items = [(f"v{i % 7}", BASE + (i // 7) * 300_000, *INDEX) for i in range(n)]
    items += [(v, t, "smh", "Article", "News") for v, t, *_ in items[::3]]  # same instant
    items += [(v, t, "theage", "Article", "News") for v, t, *_ in items[::4]]  # other masthead
    items += [(v, t + 1000, "smh", "Article", "News") for v, t, *_ in items[::5]]
    return clicks_of(spark, items)


def test_reload_flags_follow_the_draws(spark):
    clicks = reloading(spark)
    flags = rows(reload_flags(clicks))
    scored = with_reload_probability(index_gaps(index_views(clicks)))
    at = F.col("timestamp")
    want = scored.where(is_reload(reload_probability(F.col("gap")), F.col("trackingId"), at))
    assert flags == rows(want, "masthead", "trackingId", "timestamp")
    assert len(flags) > 200
    assert flags != rows(reload_flags(clicks, salt="other"))


def test_removal_takes_every_click_of_the_masthead_at_a_flagged_instant(spark):
    clicks = reloading(spark)
    flags = {tuple(row) for row in rows(reload_flags(clicks))}
    want = sorted(
        (c.trackingId, c.timestamp, c.masthead, c.assetType)
        for c in clicks.collect()
        if (c.masthead, c.trackingId, c.timestamp) not in flags
    )
    kept = remove_reloads(clicks, reload_flags(clicks))
    assert rows(kept, "trackingId", "timestamp", "masthead", "assetType") == sorted(want, key=repr)
    assert len(want) < clicks.count()


@pytest.mark.parametrize("scope", [[], ["masthead"]])
def test_sessions_without_reloads_equal_removal_then_sessions(spark, scope):
    clicks = reloading(spark)
    flags = reload_flags(clicks)
    columns = (*ATTRIBUTES, "masthead", "assetType")
    at_once = rows(sessionise(clicks, scope=scope, reloads=flags), *columns)
    in_turn = rows(sessionise(remove_reloads(clicks, flags), scope=scope), *columns)
    assert at_once == in_turn
    by_day = rows(sessionise(clicks, scope=scope, by_day=True, reloads=flags), *columns)
    assert by_day == rows(
        sessionise(remove_reloads(clicks, flags), scope=scope, by_day=True), *columns
    )


def test_etl_adds_the_referer_class(spark):
    clicks = reloading(spark).withColumns({"referer": F.lit("direct"), "url": F.lit("")})
    done = sessionised_clicks(clicks)
    assert rows(done.select("finalReferer").distinct()) == [("DIRECT",)]
    assert not [name for name in done.columns if name.startswith("_")]


def test_week_filter_and_year(spark):
    # 2014-11-03 and 2015-11-03 are both in ISO week 45.
    clicks = clicks_of(spark, [("a", 1_415_000_000_000), ("a", 1_446_500_000_000), ("a", 1_416_000_000_000)])
    assert rows(in_week(clicks, 45), "timestamp") == [(1_415_000_000_000,), (1_446_500_000_000,)]
    assert rows(in_week(clicks, 45, 2015), "timestamp") == [(1_446_500_000_000,)]


def test_combine_fills_missing_fields(spark):
    one = spark.createDataFrame([("a", 1)], "trackingId string, timestamp bigint")
    two = spark.createDataFrame([("b", "x")], "trackingId string, title string")
    assert rows(combine(one, two, one)) == [("a", 1, None), ("a", 1, None), ("b", None, "x")]


def test_a_slot_of_a_hundred_thousand_marks(spark):
    """Every second instant of one slot is marked; work grows with marks plus clicks."""
    at = F.col("id") + 1_415_000_400_000
    clicks = spark.range(200_000).select(
        F.lit("v").alias("trackingId"), at.alias("timestamp"), F.lit("smh").alias("masthead"), F.lit("smh").alias("site")
    )
    marks = spark.range(0, 200_000, 2).select(F.lit("smh").alias("masthead"), F.lit("v").alias("trackingId"), at.alias("timestamp"))
    other = marks.limit(10).withColumn("masthead", F.lit("theage"))  # marks of another site take nothing away
    done = sessionise(clicks, reloads=marks.union(other).withColumn("timestamp", F.col("timestamp")))
    got = done.agg(F.count("*"), F.min("numPage"), F.max("numPage"), F.sum(F.col("timestamp") % 2)).first()
    assert tuple(got) == (100_000, 100_000, 100_000, 100_000)
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "array_contains" not in plan
