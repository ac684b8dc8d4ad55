"""Clicks, raw lines and IP ranges derived from the driver's tables (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.sites import brand_of_site
from clickloom.sources.raw_clicks import ZERO_GUID, spread_lines

# One referer per branch of the referer rules, by event_id % 16.
REFERERS = (
    "direct",
    "",
    "https://www.google.com.au/search",
    "http://www.bing.com/search",
    "",
    "http://au.yahoo.com/",
    "",
    "http://www.drive.com.au/",
    "http://www.smh.com.au/",
    "http://www.theage.com.au/",
    "http://traffic.outbrain.com/r",
    "http://www.reddit.com/r/news",
    "http://mobile.twitter.com/t",
    "http://www.linkedin.com/in",
    "http://m.facebook.com/f",
    "http://*.bing.com/",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The events with what clicks are made of, if ``spread`` dealt over a shuffle's tasks before anything is made."""
    events = table(spark, sf_dir, "events")
    if spread:
        events = spread_lines(events)
    # ``ts`` has no zone: read as session time, then shifted back, it is taken as UTC.
    epoch = F.unix_millis(
        F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    )
    eighth = F.col("event_id") % 8
    site = (
        F.when(eighth == 3, "m.smh")
        .when(eighth == 4, "theage")
        .when(eighth == 5, "m.theage")
        .when(eighth == 6, "drive")
        .when(eighth == 7, "traveller")
        .otherwise("smh")
    )
    return events.select(
        "*",
        epoch.alias("timestamp"),
        F.expr("cast(user_id div 10 as string)").alias("visitor"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        site.alias("site"),
        brand_of_site(site).alias("masthead"),
    )


def _fields() -> dict[str, Column]:
    eighth = F.col("event_id") % 8
    index = F.col("event_type").isin("view", "click")
    homepage = (
        F.when(eighth.isin(4, 5), "The Age")
        .when(eighth.isin(6, 7), "Home")
        .otherwise("The Sydney Morning Herald")
    )
    referers = F.array(*[F.lit(text) for text in REFERERS])
    return {
        "assetType": F.when(index, "Index").otherwise("Article"),
        "assetCategory": F.when(index, homepage).otherwise(
            F.concat(F.lit("Category "), (F.col("event_id") % 7).cast("string"))
        ),
        "title": F.concat(F.lit("Title "), F.col("k").cast("string")),
        "url": F.concat(
            F.lit("http://www."), F.col("masthead"), F.lit(".com.au/a/"), F.col("k").cast("string")
        ),
        "referer": F.get(referers, (F.col("event_id") % 16).cast("int")),
        "IpAddress": F.concat_ws(
            ".",
            (F.col("user_id") % 25 + 1).cast("string"),
            F.col("k").cast("string"),
            (F.col("event_id") % 256).cast("string"),
            F.lit("7"),
        ),
        "memberId": (F.col("user_id") % 40).cast("string"),
        "userAgent": F.concat(F.lit("UA"), (F.col("user_id") % 3).cast("string")),
    }


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a parsed click."""
    return (
        _events(spark, sf_dir)
        .withColumns(_fields())
        .select(
            F.md5("visitor").alias("trackingId"),
            "timestamp",
            "site",
            "masthead",
            F.when(F.col("site").startswith("m."), "mobile").otherwise("desktop").alias("device"),
            *_fields(),
        )
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a raw JSON line, some of them damaged (by the event's value).

    Lines are made, and whatever follows is done, in as many tasks as a shuffle has: a
    table's few splits would make and parse them all.
    """
    rows = _events(spark, sf_dir, spread=True).withColumns(_fields())
    escape = (
        F.when(F.col("event_type") == "error", r"\'")
        .when(F.col("event_type") == "signup", r"\v")
        .when(F.col("event_type") == "purchase", r"\a")
        .when(F.col("event_type") == "click", r"\q")
        .otherwise("")
    )
    value = F.col("value")
    visitor = F.when((value >= 40) & (value < 42), ZERO_GUID).otherwise(F.col("visitor"))
    named = F.concat(F.lit('"trackingId":"'), visitor, F.lit('",'))
    id_part = F.when((value >= 42) & (value < 44), "").otherwise(named)
    stamp = F.when((value >= 44) & (value < 46), '"n/a"').otherwise(
        F.col("timestamp").cast("string")
    )
    plain = [
        part
        for name in ("site", "assetType", "assetCategory", "referer", "IpAddress", "memberId", "userAgent")
        for part in (F.lit(f'"{name}":"'), F.col(name), F.lit('",'))
    ]
    line = F.concat(
        F.lit('{"timestamp":'), stamp, F.lit(","), id_part, *plain,
        F.lit('"title":"shadowed","extras":[{"name":"title","value":"'),
        escape, F.col("title"),
        F.lit('"},{"name":"url","value":"'), F.col("url"),
        F.lit('"},{"name":"slot","value":"'), (F.col("event_id") % 5).cast("string"),
        F.lit('"}]}'),
    )
    cut = F.substring(line, F.lit(1), F.length(line) - 5)
    line = (
        F.when((value >= 46) & (value < 47), F.concat(line, F.lit(" tail")))
        .when((value >= 47) & (value < 48), F.concat(line, F.lit(","), line))
        .when((value >= 48) & (value < 50), F.regexp_replace(line, r'"extras":\[\{.*\}\]', '"extras":{"name":"title"}'))
        .otherwise(line)
    )
    # As with lines read from a file, filters on them do not build them again.
    return rows.select(
        F.explode(F.array(F.when(value >= 200, cut).otherwise(line))).alias("value"),
        "masthead",
        F.when(F.col("site").startswith("m."), "mobile").otherwise("desktop").alias("device"),
    )


def _dotted(number: Column) -> Column:
    octets = [F.shiftright(number, bits) % 256 for bits in (24, 16, 8, 0)]
    return F.concat_ws(".", *[octet.cast("string") for octet in octets])


def nation_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One address range per nation, with gaps between them; region 0 is 'AU'."""
    lo = (F.col("n_nationkey") + 1).cast("bigint") * 16777216
    hi = lo + 80 * 65536 - 1
    return table(spark, sf_dir, "nation").select(
        lo.alias("lo"),
        hi.alias("hi"),
        F.when(F.col("n_regionkey") == 0, "AU").otherwise(F.col("n_name")).alias("Country"),
        F.col("n_regionkey").cast("string").alias("Region"),
        F.col("n_name").alias("City"),
        F.concat_ws(" - ", _dotted(lo), _dotted(hi)).alias("ipBlock"),
        F.col("n_nationkey").cast("bigint").alias("ipBlockIndex"),
    )


def unaligned_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short address range per customer, some six hundred to a bucket, with gaps, on no power of two."""
    lo = F.lit(16777216 + 31).cast("bigint") + F.col("c_custkey") * 100 + F.col("c_custkey") % 7
    hi = lo + 50 + F.col("c_custkey") % 44
    return table(spark, sf_dir, "customer").select(
        lo.alias("lo"),
        hi.alias("hi"),
        F.col("c_mktsegment").alias("Country"),
        F.col("c_nationkey").cast("string").alias("Region"),
        F.col("c_name").alias("City"),
        F.concat_ws(" - ", _dotted(lo), _dotted(hi)).alias("ipBlock"),
        F.col("c_custkey").cast("bigint").alias("ipBlockIndex"),
    )


def events_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with an address among, or beside, ``unaligned_ranges``."""
    number = F.lit(16777216).cast("bigint") + (F.col("event_id") * 7919) % 200_000
    return table(spark, sf_dir, "events").select("event_id", _dotted(number).alias("IpAddress"))


def write_click_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The raw lines as packed files under ``root``, in a folder named by month, masthead and device for each.

    A folder's lines are gathered in one file up to the advised size, and in several beyond: no task
    has to put all lines of a name in order.
    """
    mobile = F.when(F.col("device") == "mobile", "-m").otherwise("")
    name = F.concat(F.lit("01-2024-"), F.col("masthead"), mobile, F.lit("-view"))
    lines = raw_lines(spark, sf_dir).select("value", name.alias("file"))
    # Few large files, as the logs come: nothing can split one.
    lines.hint("rebalance", "file").write.partitionBy("file").option("compression", "gzip").text(root)
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.listStatus(folder):
        given = found.getPath().getName()
        if given.startswith("file="):
            files.rename(found.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder, given.removeprefix("file=")))


#: 8 January 2024, a Monday, 00:00 in Sydney.
MONDAY_MS = 1_704_632_400_000
#: Views to a group of visitors, and kinds of groups.
GROUP, KINDS = 36, 10


def visitors_of_every_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a click of visitors who behave by turns in each way the segments tell apart.

    36 events in a row are a group, and a group is one visitor (three who share a member id, in
    kind 4).  A kind's views are cut into visits of equal length on given days.
    """
    group, nth = F.expr(f"event_id div {GROUP}"), F.col("event_id") % GROUP
    kind = group % KINDS
    shared = kind == 4

    def by_kind(values: list[Column | int]) -> Column:
        return F.get(F.array(*[F.lit(v).cast("bigint") if isinstance(v, int) else v.cast("bigint") for v in values]), kind.cast("int"))

    pages = by_kind([5, 9, 1, 36, 12, 18, 18, 3, 5, 18])
    visit = F.least(F.call_function("div", nth, pages), F.when(kind.isin(0, 8), 6).otherwise(99))
    page = nth - visit * pages
    day = by_kind([visit, visit + 4, visit % 12, F.lit(1), F.lit(1), visit + 5, visit + 1, visit % 2 * 2 + 5, visit % 2 * 2 + 5, visit * 2 + 5])
    visitor = F.concat(F.lit("v"), group.cast("string"), F.when(shared, F.concat(F.lit("-"), visit.cast("string"))).otherwise(""))
    return table(spark, sf_dir, "events").select(
        visitor.alias("trackingId"),
        (F.lit(MONDAY_MS) + day * 86_400_000 + visit * 2_400_000 + page * 20_000).alias("timestamp"),
        F.when(kind == 2, "Index").otherwise("Article").alias("assetType"),
        F.when(shared, F.concat(F.lit("m"), group.cast("string"))).otherwise("0").alias("memberId"),
        F.concat(F.lit("ip of "), visitor).alias("IpAddress"),
        F.lit("UA").alias("userAgent"),
    )


def customer_range_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An IPv4 and an IPv6 line per customer, as in an IP-to-city file."""
    customers = table(spark, sf_dir, "customer")
    lo = F.lit(16777216).cast("bigint") + F.col("c_custkey") * 256
    place = F.concat(
        F.lit('","'), F.col("c_mktsegment"),
        F.lit('","Region '), F.col("c_nationkey").cast("string"),
        F.lit('","'), F.col("c_name"), F.lit(', City"'),
    )
    four = F.concat(F.lit('"'), _dotted(lo), F.lit('","'), _dotted(lo + 255), place)
    six = F.concat(F.lit('"2001:db8::1","2001:db8::ff'), place)
    return customers.select(
        F.explode(F.array(four, six)).alias("value"), F.col("c_custkey").alias("offset")
    )
