from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date

import brute
from brute import rows
from pyspark.sql import functions as F

from clickloom.operators.dwell import dwell_by
from clickloom.operators.paths import brand_paths
from clickloom.operators.ranking import top_per_group
from clickloom.plans import content, segments, visitors

DAY_MS = 86_400_000
MIDNIGHT = 1_415_019_600_000  # 2014-11-04 00:00 in Sydney, a Tuesday
SCHEMA = (
    "sessionStart bigint, sessionId string, timestamp bigint, assetCategory string, "
    "site string, title string, url string"
)
SITES = ("smh", "m.smh", "theage", "M.TheAge", "drive")


def random_views(seed, n=900):
    """One session has half of the views; many of them share an instant."""
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        session = 0 if draw.random() < 0.5 else draw.randrange(1, 60)
        start = MIDNIGHT + session
        at = start + draw.randrange(300) * 137_000
        k = draw.randrange(8)
        out.append(
            (start, f"s{session}", at, f"c{draw.randrange(4)}", draw.choice(SITES), f"t {k}", f"u{k % 3}")
        )
    return out + out[::20]


def views_of(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def day_of(ms):
    return 4 + (ms - MIDNIGHT) // DAY_MS


def test_dwell_example(spark):
    at = [MIDNIGHT, MIDNIGHT + 10, MIDNIGHT + 25]
    items = [(MIDNIGHT, "s", t, c, "smh", "t", "u") for t, c in zip(at, ["a", "b", "a"])]
    items.append((MIDNIGHT + 99, "lone", MIDNIGHT + 99, "only", "smh", "t", "u"))
    # A last view, and a session of one view, have no dwell at all.
    assert rows(dwell_by(views_of(spark, items))) == [(4, "a", 10), (4, "b", 15)]


def test_dwell_equals_brute_force(spark):
    for seed, slot_ms in ((1, 1_000), (2, 600_000), (3, 10**9)):
        items = random_views(seed)
        want = brute.dwell_totals([(day_of(i[2]), i[0], i[2], i[3]) for i in items])
        got = rows(dwell_by(views_of(spark, items), slot_ms=slot_ms))
        assert {(d, c): ms for d, c, ms in got} == want


def test_paths_equal_brute_force(spark):
    brand = {"m.smh": "smh", "M.TheAge": "theage"}
    for seed, slot_ms in ((4, 1_000), (5, 600_000), (6, 10**9)):
        items = random_views(seed)
        want = brute.path_counts(
            [(day_of(i[2]), i[1], i[2], brand.get(i[4], i[4])) for i in items]
        )
        got = rows(brand_paths(views_of(spark, items), slot_ms=slot_ms))
        assert {(d, tuple(p)): n for d, p, n in got} == want
        assert max(len(p) for _, p, _ in got) == 5


def test_session_over_midnight_counts_on_both_days(spark):
    items = [(1, "s", MIDNIGHT + DAY_MS + d, "c", "smh", "t", "u") for d in (-5, 5)]
    assert rows(brand_paths(views_of(spark, items))) == [(4, ["smh"], 1), (5, ["smh"], 1)]


def test_views_and_visits(spark):
    items = random_views(7)
    views, visits = Counter(), defaultdict(set)
    for start, _, at, category, *_ in items:
        views[day_of(at), category] += 1
        visits[day_of(at), category].add(start)
    df = views_of(spark, items)
    assert {tuple(r)[3:5]: r.value for r in content.section_views(df, "smh").collect()} == views
    got = {tuple(r)[3:5]: r.value for r in content.section_visits(df, "smh").collect()}
    assert got == {key: len(starts) for key, starts in visits.items()}
    labels = rows(content.section_visits(df, "smh").select("grain", "metric", "masthead").distinct())
    assert labels == [("Day", "Visits", "smh")]


def test_visits_can_be_counted_by_session_id(spark):
    items = [(MIDNIGHT, s, MIDNIGHT, "c", "smh", "t", "u") for s in ("a", "b")]
    df = views_of(spark, items)
    assert content.section_visits(df, "x").first().value == 1
    assert content.section_visits(df, "x", session_key="sessionId").first().value == 2


def test_missing_text_is_empty(spark):
    df = views_of(spark, [(MIDNIGHT, "s", MIDNIGHT, None, None, None, None)])
    assert rows(content.section_views(df, "x"), "assetCategory", "value") == [("", 1)]
    assert rows(content.article_views(df), "title", "url", "value") == [("", "", 1)]


def test_top_k_breaks_ties(spark):
    items = [(g, name, n) for g in (1, 2) for name, n in (("b", 5), ("a", 5), ("c", 9), ("d", 1))]
    df = spark.createDataFrame(items, "g int, name string, n int")
    got = rows(top_per_group(df, ["g"], "n", ["name"], 2))
    assert got == [(1, "a", 5), (1, "c", 9), (2, "a", 5), (2, "c", 9)]


def test_top_articles_limit_before_the_shuffle(spark):
    df = content.top_articles_by_views(views_of(spark, random_views(8)), "smh", k=3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert max(Counter(row.day for row in df.collect()).values()) == 3


def test_top_dwell_lists_every_url_of_a_title(spark):
    items = [
        (MIDNIGHT, "s", MIDNIGHT, "c", "smh", "one x", "u1"),
        (MIDNIGHT, "s", MIDNIGHT + 50, "c", "smh", "one x", "u2"),
        (MIDNIGHT, "s", MIDNIGHT + 60, "c", "smh", "two", "u3"),
    ]
    got = rows(content.top_articles_by_dwell(views_of(spark, items), "m"), "day", "title", "url", "value")
    assert got == [(4, "one#x", "u1", 60), (4, "one#x", "u2", 60)]


def test_top_dwell_of_a_title_with_thousands_of_urls(spark):
    """Untitled pages: their best urls only, unless all are asked for."""
    items = [(MIDNIGHT, "s", MIDNIGHT + 10 * k, "c", "smh", None, f"u{k:04d}") for k in range(3000)]
    items += [(MIDNIGHT, "s", MIDNIGHT + 30_000 + 10 * k, "c", "smh", None, f"u{k:04d}") for k in range(5, 9)]
    views = views_of(spark, items)
    few = content.top_articles_by_dwell(views, "m", urls=6)
    assert [u for u, in rows(few, "url")] == ["u0000", "u0001", "u0005", "u0006", "u0007", "u0008"]
    assert "WindowGroupLimit" in few._jdf.queryExecution().executedPlan().toString()
    assert content.top_articles_by_dwell(views, "m").count() == 10
    assert content.top_articles_by_dwell(views, "m", urls=None).count() == 3000


def test_active_days_are_dates(spark):
    """The fifth of January and the fifth of February are two days."""
    january = MIDNIGHT + 62 * DAY_MS
    items = [("v", january, 1, 0), ("v", january + 31 * DAY_MS, 1, 0), ("v", january + 3_600_000, 1, 0)]
    features = segments.visitor_features(heads_of(spark, items))
    assert rows(features, "activeDays") == [(2,)]
    trend = segments.segment_trend(heads_of(spark, items), segments.visitor_segments(features, features.select("trackingId").limit(0)))
    assert rows(trend, "date", "day", "visitors") == [(date(2015, 1, 5), 5, 1), (date(2015, 2, 5), 5, 1)]


HEADS = "trackingId string, timestamp bigint, numPage bigint, sessionDuration bigint, assetType string"


def heads_of(spark, items):
    return spark.createDataFrame([(*item, "Article")[:5] for item in items], HEADS)


def test_visitor_metrics(spark):
    heads = heads_of(
        spark,
        [
            ("a", MIDNIGHT, 1, 0),
            ("a", MIDNIGHT + 5, 4, 60),
            ("b", MIDNIGHT + 6, 2, 0),
            ("b", MIDNIGHT + DAY_MS, 1, 0),
        ],
    )
    got = {(r.metric, r.period): r.value for r in visitors.visitor_metrics(heads, "m").collect()}
    assert got == {
        ("Week_visitor", 45): 2, ("Daily_visitors", 4): 2, ("Daily_visitors", 5): 1,
        ("Week_visit", 45): 4, ("Daily_visit", 4): 3, ("Daily_visit", 5): 1,
        ("Week_numpage", 45): 3, ("Daily_numpage", 4): 3,
        ("Week_session", 45): 60, ("Daily_session", 4): 60,
        ("Week_bounce", 45): 2, ("Daily_bounce", 4): 1, ("Daily_bounce", 5): 1,
        ("Week_repeat", 45): 2, ("Daily_repeat", 4): 1,
    }
    for metric in visitors.LABELS:
        alone = visitors.visitor_metrics(heads, "m", [metric]).collect()
        assert {(r.metric, r.period): r.value for r in alone} == {
            key: value for key, value in got.items() if key[0] in visitors.LABELS[metric]
        }


def test_visitor_features(spark):
    saturday = MIDNIGHT + 4 * DAY_MS
    heads = heads_of(
        spark,
        [
            ("a", MIDNIGHT, 1, 0, "Index"),
            ("a", MIDNIGHT + 1, 4, 9),
            ("a", saturday, 5, 9, "Index"),
            ("b", saturday, 1, 0),
        ],
    )
    assert rows(segments.visitor_features(heads)) == [
        ("a", 3, 1, 2, 1, 1, 1, 1, 2),
        ("b", 1, 1, 0, -1, 1, 0, 0, 1),
    ]


def test_cookie_clearers_need_two_to_five_ids(spark):
    items = [("m1", "ip", f"ua{i}", f"one{i}") for i in range(1)]
    items += [("m2", f"ip2-{i}", "ua", f"two{i}") for i in range(2)] * 3
    items += [("m5", f"ip5-{i}", "ua", f"five{i}") for i in range(5)]
    items += [("m6", f"ip6-{i}", "ua", f"six{i}") for i in range(6)]
    items += [("0", f"ip0-{i}", "ua", f"zero{i}") for i in range(3)]
    items += [("0", "shared", "ua", f"machine{i}") for i in range(3)]
    items += [("0", "crowd", "ua", f"crowd{i}") for i in range(50)]
    clicks = spark.createDataFrame(items, "memberId string, IpAddress string, userAgent string, trackingId string")
    want = [f"two{i}" for i in range(2)] + [f"five{i}" for i in range(5)] + [f"machine{i}" for i in range(3)]
    assert [row[0] for row in rows(segments.cookie_clearers(clicks))] == sorted(want)


FEATURES = (
    "trackingId string, sessions bigint, weekendSessions bigint, weekdaySessions bigint, "
    "indexSessions bigint, singleSessions bigint, middleSessions bigint, deepSessions bigint, "
    "activeDays bigint"
)


def test_segment_rules_in_order(spark):
    cases = {
        "HABITUAL ENGAGED VISITORS": (10, 5, 5, -1, 2, 3, 5, 3),
        "HABITUAL NON-ENGAGED VISITORS": (5, 2, 3, -1, 2, 3, 0, 3),
        "UNENGAGED VISITORS": (3, 1, 2, 2, 3, 0, 0, 1),
        "VISITORS BY CHANCE": (1, 1, 0, 1, 1, 0, 0, 1),
        "COOKIE CLEARER": (1, 0, 1, -1, 1, 0, 0, 1),
        "AT HOME READERS": (5, 4, 1, -1, 5, 0, 0, 2),
        "AT OFFICE READERS": (5, 1, 4, -1, 5, 0, 0, 2),
        "MISSION READERS": (4, 2, 2, 1, 4, 0, 0, 2),
        "EVENT READERS": (6, 3, 3, -1, 0, 0, 6, 2),
        "UNFLAGGED": (6, 3, 3, -1, 3, 0, 3, 5),
    }
    features = spark.createDataFrame([(name, *values) for name, values in cases.items()], FEATURES)
    clearers = spark.createDataFrame([("COOKIE CLEARER",), ("not seen",)], "trackingId string")
    got = segments.visitor_segments(features, clearers)
    for row in got.collect():
        assert row.segment == row.trackingId
    heads = spark.createDataFrame(
        [("EVENT READERS", MIDNIGHT), ("EVENT READERS", MIDNIGHT + 1), ("stranger", MIDNIGHT)],
        "trackingId string, timestamp bigint",
    )
    assert rows(segments.flag_heads(heads, got), "timestamp", "repeatFlag") == [
        (MIDNIGHT, "EVENT READERS"), (MIDNIGHT, "UNFLAGGED"), (MIDNIGHT + 1, "EVENT READERS"),
    ]
    assert rows(segments.segment_trend(heads, got)) == [
        ("EVENT READERS", date(2014, 11, 4), 4, 1), ("UNFLAGGED", date(2014, 11, 4), 4, 1),
    ]
    assert got.where(F.col("cookieClearer")).count() == 1
