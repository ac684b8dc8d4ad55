from __future__ import annotations

import hashlib
import math
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from brute import rows
from pyspark.sql import functions as F

from clickloom.functions.addresses import ip_block, ip_to_long
from clickloom.functions.referers import FIXED_RULES, referer_class
from clickloom.functions.reloads import is_reload, reload_probability, uniform_draw
from clickloom.functions.sites import brand_of_site, collapse_repeats, first_steps, hashed_title
from clickloom.functions.timekeys import (
    day_key,
    day_of_month,
    is_weekend,
    iso_year,
    local_time,
    month_key,
    month_start,
    week_of_year,
)

SYDNEY = ZoneInfo("Australia/Sydney")


def ms_of(*parts, tz=UTC):
    return int(datetime(*parts, tzinfo=tz).timestamp() * 1000)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Australia/Sydney"])
def test_time_keys_follow_the_wall_clock_in_any_session_zone(spark, zone):
    # Hours around both 2014 daylight saving changes and the turn of the year.
    starts = [datetime(2014, 4, 5, 12), datetime(2014, 10, 4, 12), datetime(2014, 12, 31, 6)]
    instants = [
        int((start + timedelta(minutes=17 * i)).replace(tzinfo=UTC).timestamp() * 1000) + i
        for start in starts
        for i in range(60)
    ]
    ms = F.col("ms")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = spark.createDataFrame([(i,) for i in instants], "ms bigint").select(
            "ms",
            week_of_year(ms),
            iso_year(ms),
            day_of_month(ms),
            day_key(ms),
            month_key(ms),
            month_start(ms).cast("string"),
            is_weekend(ms),
            F.date_format(local_time(ms), "yyyy-MM-dd HH:mm:ss.SSS"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for row in got:
        local = datetime.fromtimestamp(row[0] / 1000, SYDNEY)
        iso = local.isocalendar()
        assert tuple(row[1:]) == (
            iso.week,
            iso.year,
            local.day,
            f"{local.timetuple().tm_yday} ' {local.year}",
            f"{local.month - 1}-{local.year}",
            f"{local.year}-{local.month:02d}-01",
            local.weekday() >= 5,
            local.strftime("%Y-%m-%d %H:%M:%S.") + f"{row[0] % 1000:03d}",
        )


SMH_URL = "http://www.smh.com.au/a"


@pytest.mark.parametrize(
    ("referer", "url", "label", "fixed"),
    [
        ("direct", "", "DIRECT", "DIRECT"),
        ("", SMH_URL, "DIRECT", "DIRECT"),
        (None, "http://www.theage.com.au/", "DIRECT", "DIRECT"),
        ("", "http://www.drive.com.au/", "referral", "referral"),
        ("direct.example.org", SMH_URL, "referral", "referral"),
        ("http://www.google.com/", "", "GOOGLE", "GOOGLE"),
        ("http://www.google.com/?q=www.smh.com.au", "", "GOOGLE", "GOOGLE"),
        ("http://www.bing.com/", "", "referral", "BING"),
        ("http://*.bing.com/", "", "BING", "BING"),
        ("http://au.yahoo.com/", "", "referral", "YAHOO"),
        ("x*.yahoo.y", "", "YAHOO", "YAHOO"),
        ("http://www.drive.com.au/", "", "referral", "DRIVE"),
        ("*.drive.", "", "DRIVE", "DRIVE"),
        ("http://www.smh.com.au/b", SMH_URL, "SMH", "SMH"),
        ("http://www.theage.com.au/?u=reddit.com", "", "THEAGE", "THEAGE"),
        ("http://traffic.outbrain.com/x", "", "OUTBRAIN", "OUTBRAIN"),
        ("http://www.reddit.com/?twitter.com", "", "REDDIT", "REDDIT"),
        ("https://mobile.twitter.com/", "", "TWITTER", "TWITTER"),
        ("https://au.linkedin.com/", "", "LINKEDIN", "LINKEDIN"),
        ("https://m.facebook.com/", "", "FACEBOOK", "FACEBOOK"),
        ("http://wwwxsmhxcomxau/", "", "referral", "referral"),
    ],
)
def test_referer_rules(spark, referer, url, label, fixed):
    row = spark.createDataFrame([(referer, url)], "r string, u string").select(
        referer_class(F.col("r"), F.col("u")), referer_class(F.col("r"), F.col("u"), FIXED_RULES)
    ).first()
    assert tuple(row) == (label, fixed)


def test_mobile_sites(spark):
    sites = ["m.smh", "M.SMH", "m.TheAge", "m.drive", "m.traveller", "m.domain", "smh", "SMH", ""]
    got = spark.createDataFrame([(s,) for s in sites], "s string").select(brand_of_site(F.col("s")))
    assert [row[0] for row in got.collect()] == [
        "smh", "smh", "theage", "drive", "traveller", "m.domain", "smh", "SMH", "",
    ]


def test_paths(spark):
    path = F.split(F.lit("age,age,smh,smh,age,age"), ",")
    long = F.split(F.lit("a,b,a,b,a,b,a"), ",")
    row = spark.range(1).select(
        collapse_repeats(path), first_steps(collapse_repeats(long)), hashed_title(F.lit("a b  c")),
        hashed_title(F.lit(None).cast("string")),
    ).first()
    assert list(row) == [["age", "smh", "age"], ["a", "b", "a", "b", "a"], "a#b##c", ""]


def test_addresses(spark):
    cases = {
        "1.2.3.4": 16909060,
        "255.255.255.255": 4294967295,
        "256.0.0.1": 1,  # octets are cut to 8 bits
        "999.1.1.1": (999 & 255) * 2**24 + 65536 + 256 + 1,
        "0.0.0.0": 0,
        "1.2.3": 1,
        "1.2.3.4.5": 1,
        " 1.2.3.4": 1,
        "": 1,
        "::1": 1,
    }
    df = spark.createDataFrame([(ip,) for ip in cases], "ip string")
    got = {row[0]: row[1] for row in df.select("ip", ip_to_long(F.col("ip"))).collect()}
    assert got == cases
    assert df.select(ip_block(F.lit("1.0.0.0"), F.lit("1.0.0.9"))).first()[0] == "1.0.0.0 - 1.0.0.9"


def test_reload_probability_at_its_edges(spark):
    gaps = [0, 1, 299_999, 300_000, 300_001, 420_000, 160_000, 3_600_000]
    got = {
        row[0]: row[1]
        for row in spark.createDataFrame([(g,) for g in gaps], "g bigint")
        .select("g", reload_probability(F.col("g")))
        .collect()
    }
    assert got[0] == 0.0
    assert got[300_000] == pytest.approx(0.996)
    assert got[420_000] == pytest.approx(0.996 * math.exp(-1))
    assert got[160_000] == pytest.approx(0.996 * math.exp(-1))
    assert got[300_001] == pytest.approx(0.996 * math.exp(-((1 / 120_000) ** 2)))
    assert got[1] == pytest.approx(0.996 * math.exp(-((299_999 / 140_000) ** 2)))
    assert got[3_600_000] == 0.0


def test_draws_are_repeatable_and_even(spark):
    df = spark.range(20_000).select(F.lit("v").alias("t"), (F.col("id") * 1000).alias("ms"))
    draw = uniform_draw(F.col("t"), F.col("ms"), "1")
    one = rows(df.select("ms", draw.alias("u")))
    two = rows(df.repartition(7).select("ms", draw.alias("u")))
    assert one == two
    mean = sum(u for _, u in one) / len(one)
    assert 0.49 < mean < 0.51 and all(0 <= u < 1 for _, u in one)
    digest = hashlib.md5(b"v|1000|1").hexdigest()
    assert dict(one)[1000] == int(digest[:8], 16) / 2**32
    certain = df.where(is_reload(F.lit(1.0), F.col("t"), F.col("ms"))).count() / 20_000
    assert 0.85 < certain < 0.87
    assert df.where(is_reload(F.lit(0.0), F.col("t"), F.col("ms"))).count() == 0
