from __future__ import annotations

import bisect
import gzip
import random

import pytest
from brute import rows
from pyspark.sql import functions as F

from clickloom.operators.geo import _last_ranges, add_location, in_country, locate_addresses
from clickloom.sources.ip_ranges import parse_ranges, read_ranges, with_line_offsets

RANGES = (
    "lo bigint, hi bigint, Country string, Region string, City string, "
    "ipBlock string, ipBlockIndex bigint"
)


def ranges_of(spark, bounds):
    return spark.createDataFrame(
        [(lo, hi, f"C{i}", f"R{i}", f"T{i}", f"{lo}-{hi}", i) for i, (lo, hi) in enumerate(bounds)],
        RANGES,
    )


def random_bounds(draw, n):
    """Disjoint ranges of very different sizes, with and without gaps."""
    bounds, at = [], 0
    for _ in range(n):
        at += draw.choice([0, 0, 1, 1000, 70_000])
        size = draw.choice([1, 2, 255, 65_536, 65_537, 1_000_000])
        bounds.append((at, at + size - 1))
        at += size
    return bounds


def test_lookup_equals_brute_force(spark):
    draw = random.Random(3)
    bounds = random_bounds(draw, 120)
    edges = {a + d for lo, hi in bounds for a in (lo, hi) for d in (-1, 0, 1) if a + d >= 0}
    asked = sorted(edges | {draw.randrange(2**32) for _ in range(200)})
    addresses = spark.createDataFrame([(a,) for a in asked], "address bigint")
    got = rows(locate_addresses(addresses, ranges_of(spark, bounds)), "address", "ipBlockIndex")
    want = [
        (a, next((i for i, (lo, hi) in enumerate(bounds) if lo <= a <= hi), None)) for a in asked
    ]
    assert got == sorted(want, key=repr)


def test_lookup_in_buckets_of_many_ranges(spark):
    """Short ranges at any place, gaps, blocks without a start, one long range, ends on the edges of blocks."""
    draw = random.Random(11)
    bounds, at = [], 70_000
    while at < 400_000:
        at += draw.choice([0, 1, 3, 40, 255, 256, 900])
        size = draw.choice([1, 2, 9, 100, 255, 256, 257, 5000])
        bounds.append((at, at + size - 1))
        at += size
    asked = sorted({draw.randrange(60_000, 410_000) for _ in range(3000)} | {b + d for pair in bounds for b in pair for d in (-1, 0, 1)})
    addresses = spark.createDataFrame([(a,) for a in asked], "address bigint")
    found = locate_addresses(addresses, ranges_of(spark, bounds))
    starts = sorted((lo, hi, i) for i, (lo, hi) in enumerate(bounds))
    want = []
    for a in asked:
        k = bisect.bisect_right(starts, (a, float("inf"))) - 1
        want.append((a, starts[k][2] if k >= 0 and a <= starts[k][1] else None))
    assert rows(found, "address", "ipBlockIndex") == sorted(want, key=repr)


def test_no_task_orders_a_bucket(spark):
    """A full bucket, every address in twelve months, over many tasks of which none has a tenth of it."""
    asked = spark.range(65_536).select((F.col("id") + 65_536).alias("address")).crossJoin(spark.range(12).toDF("month"))
    ranges = ranges_of(spark, [(65_536 + 100 * k, 65_536 + 100 * k + 69) for k in range(655)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = locate_addresses(asked, ranges)
        assert found.where("City is not null").count() == 12 * (65_536 - 30 * 655 - 36)
        plan = found._jdf.queryExecution().executedPlan().toString()
        blocks = _last_ranges(asked.select("address").distinct(), ranges)
        sizes = [r["count"] for r in blocks.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 65_536 and max(sizes) < 6554
    assert "hashpartitioning(_bucket#" in plan and "_block#" in plan


def test_lookup_of_addresses_without_ranges(spark):
    asked = spark.createDataFrame([(5, "x"), (None, "y")], "address bigint, tag string")
    assert rows(locate_addresses(asked, ranges_of(spark, [])), "address", "tag", "City") == [(5, "x", None), (None, "y", None)]
    assert locate_addresses(asked.limit(0), ranges_of(spark, [(1, 9)])).count() == 0


def test_lookup_keeps_other_columns_and_repeated_addresses(spark):
    asked = spark.createDataFrame([(5, "x"), (5, "x"), (9, "y")], "address bigint, tag string")
    got = rows(locate_addresses(asked, ranges_of(spark, [(5, 6)])), "address", "tag", "City")
    assert got == [(5, "x", "T0"), (5, "x", "T0"), (9, "y", None)]


def test_one_range_over_everything(spark):
    addresses = spark.createDataFrame([(0,), (65_536,), (2**32 - 1,)], "address bigint")
    got = rows(locate_addresses(addresses, ranges_of(spark, [(0, 2**32 - 1)])), "address", "City")
    assert got == [(0, "T0"), (4294967295, "T0"), (65536, "T0")]


def test_every_click_is_kept_once(spark):
    ranges = ranges_of(spark, [(16_777_216, 16_777_471)])  # 1.0.0.0 - 1.0.0.255
    clicks = spark.createDataFrame(
        [("a", "1.0.0.7")] * 5 + [("b", "9.9.9.9"), ("c", None), ("d", "junk")],
        "trackingId string, IpAddress string",
    )
    got = rows(add_location(clicks, ranges), "trackingId", "Country", "ipBlockIndex")
    assert got == [("a", "C0", 0)] * 5 + [("b", None, None), ("c", None, None), ("d", None, None)]
    assert in_country(add_location(clicks, ranges), "C0").count() == 5
    assert in_country(add_location(clicks, ranges)).count() == 0
    given = add_location(clicks, ranges, default_ip="1.0.0.0")
    assert rows(in_country(given, "C0"), "trackingId") == [("a",)] * 5 + [("c",)]


LINES = [
    '"1.0.0.0","1.0.0.255","AU","Queensland","South Brisbane, City"',
    '"2001:db8::1","2001:db8::2","AU","x","y"',
    '"1.0.1.0","1.0.1.255","CN","Fujian","Fuzhöu"',
    '"1.0.2.0","1.0.2.0","CN","",""',
]


def test_read_ranges_gives_byte_offsets(spark, tmp_path):
    path = tmp_path / "ranges.csv"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    content = path.read_bytes()
    got = rows(read_ranges(spark, str(path)), "lo", "hi", "Country", "City", "ipBlock", "ipBlockIndex")
    assert [row[5] for row in got] == [content.index(line.encode()) for line in (LINES[0], LINES[2], LINES[3])]
    assert got[0] == (16777216, 16777471, "AU", "South Brisbane, City", "1.0.0.0 - 1.0.0.255", 0)
    assert got[1][3] == "Fuzhöu"


def test_byte_offsets_across_splits(spark, tmp_path):
    lines = [f'"1.{i // 256}.{i % 256}.0","1.{i // 256}.{i % 256}.255","AU","r{"x" * (i % 50)}","c"' for i in range(3000)]
    path = tmp_path / "many.csv"
    path.write_text("\n".join(lines) + "\n")
    content = path.read_bytes()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        ranges = read_ranges(spark, str(path))
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 4
        got = {row.ipBlock.split(" ")[0]: row.ipBlockIndex for row in ranges.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    at = 0
    for line in lines:
        assert got[line.split('"')[1]] == at
        at += len(line) + 1
    assert at == len(content)


@pytest.mark.parametrize("together", [1, 7, 1000, 65_536])
def test_byte_offsets_of_blocks_and_files(spark, tmp_path, together):
    """A packed file, which cannot be split, beside a plain one; blocks of any size."""
    draw = random.Random(together)
    lines = ["x" * draw.randrange(40) + draw.choice(["", "é", "漢"]) + str(k) for k in range(2500)]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    with gzip.open(tmp_path / "b.csv.gz", "wt", encoding="utf-8") as out:
        out.write("\n".join(reversed(lines)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        placed = with_line_offsets(spark.read.text(str(tmp_path)), together=together)
        got = rows(placed)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = []
    for order in (lines, lines[::-1]):
        at = 0
        for line in order:
            want.append((line, at))
            at += len(line.encode()) + 1
    assert got == sorted(want, key=repr)


def test_empty_places_are_kept(spark):
    lines = spark.createDataFrame([(LINES[3], 7)], "value string, offset bigint")
    row = parse_ranges(lines).first()
    assert (row.lo, row.hi, row.Country, row.ipBlockIndex) == (16777728, 16777728, "CN", 7)


def test_bad_range_lines_move_nobody(spark):
    from clickloom.sources.ip_ranges import parse_ranges, quarantined_ranges

    lines = spark.createDataFrame(
        [
            ('"1.0.0.0","1.0.0.255","AU","NSW","Sydney"', 0),
            ('"oops","9.0.0.0","BAD","",""', 50),
            ('"5.0.0.9","5.0.0.1","BAD","",""', 90),
            ('"0.0.0.0","0.0.0.9","LOW","",""', 130),
        ],
        "value string, offset long",
    )
    ranges = parse_ranges(lines)
    clicks = spark.createDataFrame(
        [("1.0.0.7",), ("2.0.0.1",), ("junk",), (None,), ("0.0.0.1",)], "IpAddress string"
    )
    got = {r.IpAddress: r.Country for r in add_location(clicks, ranges).collect()}
    assert got == {"1.0.0.7": "AU", "2.0.0.1": None, "junk": None, None: None, "0.0.0.1": "LOW"}
    assert rows(quarantined_ranges(lines), "offset") == [(50,), (90,)]
