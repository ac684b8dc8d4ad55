from __future__ import annotations

import gzip
import hashlib
import json

import pytest
from brute import rows
from pyspark.sql import functions as F

from clickloom.__main__ import main
from clickloom.fields import TEXT_FIELDS
from clickloom.operators.sessions import sessionise
from clickloom.plans import jobs
from clickloom.plans.etl import months_of_week
from clickloom.sources import raw_clicks as raw
from clickloom.sources import sessionised
from clickloom.sources.metrics import read_metrics, write_metrics
from clickloom.staging import new_path, shared_folder, stage


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def lines_of(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def parse_one(spark, text):
    return raw.parse_lines(lines_of(spark, [text])).first()


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (r"it\'s", "it's"),
        (r"a\vb", "a\u0007b"),
        (r"a\ab", "a\u0013b"),
        (r"a\qb\zc", "aqbzc"),
        (r"back\\slash \\v \\'", "back\\slash \\v \\'"),
        (r"odd\\\v", "odd\\\u0007"),
        (r"\v\v\a\'\q", "\u0007\u0007\u0013'q"),
        (r"good \" \/ \b\f\n\r\t A", 'good " / \b\f\n\r\t A'),
        ("plain", "plain"),
        (r"\'" * 5000, "'" * 5000),
        (r"\\" * 5000 + r"\v", "\\" * 5000 + "\u0007"),
    ],
)
def test_escape_repair(spark, text, want):
    row = parse_one(spark, '{"trackingId":"t","timestamp":1,"title":"%s"}' % text)
    assert (row.title, row.reason) == (want, None)


def test_record_is_flattened(spark):
    record = {
        "trackingId": "guid", "timestamp": 1415000000000, "title": "top", "site": "smh", "views": 3,
        "extras": [
            {"name": "title", "value": "given"}, {"name": "colour", "value": "red"},
            {"name": "colour", "value": "blue"}, {"value": "nameless"},
        ],
    }
    row = parse_one(spark, json.dumps(record))
    assert (row.trackingId, row.timestamp, row.title, row.site) == (
        md5("guid"), 1415000000000, "given", "smh",
    )
    assert row.extras == {"views": "3", "colour": "blue"}
    assert row.url is None and row.reason is None


def test_last_of_repeated_fields_counts(spark):
    row = parse_one(spark, '{"trackingId":"a","trackingId":"b","timestamp":"5","x":"1","x":"2"}')
    assert (row.trackingId, row.timestamp, row.extras) == (md5("b"), 5, {"x": "2"})


def test_visitor_id_from_extras_is_not_hashed(spark):
    row = parse_one(
        spark,
        '{"trackingId":"a","timestamp":5,"extras":[{"name":"trackingId","value":"given"}]}',
    )
    assert row.trackingId == "given"


def test_bad_lines_are_quarantined(spark):
    good = '{"trackingId":"t","timestamp":"7"}'
    bad = {
        '{"trackingId":"t","timestamp":7': raw.UNPARSEABLE,
        "": raw.UNPARSEABLE,
        "[1,2]": raw.UNPARSEABLE,
        '{"timestamp":7}': raw.NO_TRACKING_ID,
        '{"timestamp":7,"extras":[{"name":"trackingId","value":"x"}]}': raw.NO_TRACKING_ID,
        '{"trackingId":"t"}': raw.BAD_TIMESTAMP,
        '{"trackingId":"t","timestamp":"soon"}': raw.BAD_TIMESTAMP,
        good + " more": raw.TRAILING_TEXT,
        good + good: raw.TRAILING_TEXT,
        good + "," + good: raw.TRAILING_TEXT,
        good + "}": raw.TRAILING_TEXT,
        good + "]": raw.TRAILING_TEXT,
        good + '] "x"': raw.TRAILING_TEXT,
        good + ',"x"': raw.TRAILING_TEXT,
        '{"trackingId":"t","timestamp":7,"extras":"none"}': raw.BAD_EXTRAS,
        '{"trackingId":"t","timestamp":7,"extras":3}': raw.BAD_EXTRAS,
        '{"trackingId":"t","timestamp":7,"extras":{"name":"a","value":"b"}}': raw.BAD_EXTRAS,
        '{"trackingId":"t","timestamp":7,"extras":[1,2]}': raw.BAD_EXTRAS,
        '{"trackingId":"t","timestamp":7,"extras":["a"]}': raw.BAD_EXTRAS,
    }
    zero = '{"trackingId":"%s","timestamp":7}' % raw.ZERO_GUID
    lines = lines_of(spark, [good, zero, *bad])
    parsed = raw.parse_lines(raw.drop_zero_guid(lines))
    assert {tuple(row) for row in raw.quarantined(parsed).collect()} == set(bad.items())
    clicks = raw.parsed_clicks(parsed)
    assert rows(clicks, "trackingId", "timestamp") == [(md5("t"), 7)]
    fine = [f"  {good} \t", '{"trackingId":"t","timestamp":7,"extras":[]}', '{"trackingId":"t","timestamp":7,"extras":null}']
    assert raw.parsed_clicks(raw.parse_lines(lines_of(spark, fine))).count() == 3
    assert set(clicks.columns) == {"timestamp", *TEXT_FIELDS, "extras"}


def test_filters_do_not_parse_lines_twice(spark):
    lines = lines_of(spark, ['{"trackingId":"t","timestamp":7}'])
    clicks = raw.parsed_clicks(raw.parse_lines(lines)).where(F.col("timestamp") > 1)
    plan = clicks._jdf.queryExecution().optimizedPlan().toString()
    # once as a list, and once more for the reason of those that are none
    assert plan.count("ArrayType(MapType(StringType,StringType") == 1
    assert plan.count("MapType(StringType,StringType") <= 2


def click(visitor, at, site, category="News", kind="Article", ip="1.0.0.1", **more):
    return json.dumps(
        {
            "trackingId": visitor, "timestamp": at, "site": site, "assetType": kind,
            "assetCategory": category, "referer": "direct", "url": f"http://{site}/", "title": "a b",
            "IpAddress": ip, "memberId": "0", "userAgent": "ua", **more,
        }
    )


WEEK_45 = 1_415_000_000_000


@pytest.fixture
def click_files(tmp_path):
    root = tmp_path / "clicks"
    root.mkdir()
    files = {
        "11-2014-smh-view-1.gz": [
            click("a", WEEK_45, "smh"), click("a", WEEK_45 + 60_000, "smh"), "{broken",
        ],
        "11-2014-smh-m-view-1.gz": [click("a", WEEK_45 + 120_000, "m.smh")],
        "11-2014-theage-view-1.gz": [click("a", WEEK_45 + 180_000, "theage"), click("b", WEEK_45, "theage")],
        "11-2014-drive-view-1.gz": [click("c", WEEK_45, "drive", ip="9.9.9.9")],
        "12-2014-smh-view-1.gz": [click("z", WEEK_45 + 30 * 86_400_000, "smh")],
        "11-2014-smh-other-1.gz": ["not wanted"],
    }
    for name, lines in files.items():
        with gzip.open(root / name, "wt") as out:
            out.write("\n".join(lines) + "\n")
    return root


def test_file_names_give_masthead_and_device(spark, click_files):
    paths = raw.click_paths(str(click_files), ["11-2014"], ["smh", "theage"])
    got = raw.read_click_lines(spark, paths).groupBy("masthead", "device").count()
    assert rows(got) == [("smh", "desktop", 3), ("smh", "mobile", 1), ("theage", "desktop", 2)]


def test_a_masthead_without_files_stops_nothing(spark, click_files):
    paths = raw.click_paths(str(click_files), ["10-2014", "11-2014"], ["smh", "nowhere", "drive"])
    got = raw.read_click_lines(spark, paths).groupBy("masthead", "device").count()
    assert rows(got) == [("drive", "desktop", 1), ("smh", "desktop", 3), ("smh", "mobile", 1)]
    assert raw.read_click_lines(spark, raw.click_paths(str(click_files), ["*"], ["smh"])).count() == 5


def test_folders_of_parts_are_read_like_files(spark, tmp_path):
    root = tmp_path / "page-views"
    for name in ("11-2014-smh-m-view", "11-2014-theage-view"):
        spark.range(7).selectExpr("cast(id as string)").write.option("compression", "gzip").text(str(root / name))
    got = raw.read_click_lines(spark, raw.click_paths(str(root), ["11-2014"], ["smh", "theage"]))
    assert rows(got.groupBy("masthead", "device").count()) == [("smh", "mobile", 7), ("theage", "desktop", 7)]


def test_lines_of_one_file_are_parsed_in_many_tasks(spark, tmp_path):
    path = tmp_path / "11-2014-smh-view-1.gz"
    with gzip.open(path, "wt") as out:
        out.write((click("a", WEEK_45, "smh") + "\n") * 4000)
    lines = raw.read_click_lines(spark, str(path))
    assert lines.rdd.getNumPartitions() == 1
    spread = raw.spread_lines(lines, 8)
    sizes = [n for n, in spread.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)  # though all lines are equal
    of = F.struct(F.spark_partition_id(), "value")
    once, again = (spread.groupBy(of).count().collect() for _ in range(2))
    assert sorted(once) == sorted(again)
    assert raw.read_clicks(spark, str(path), 5).select(F.spark_partition_id()).distinct().count() == 5
    assert raw.read_clicks(spark, str(path), 0).rdd.getNumPartitions() == 1
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert raw.read_clicks(spark, str(path)).select(F.spark_partition_id()).distinct().count() == default


def sample(spark):
    clicks = spark.createDataFrame(
        [("a", WEEK_45, "smh", "smh", "x", {"k": "v"}), ("b", WEEK_45 + 7 * 86_400_000, "theage", "theage", None, {"title": "no", "brace}": "{,}", "none": None})],
        "trackingId string, timestamp bigint, site string, masthead string, title string, extras map<string,string>",
    )
    return sessionise(clicks)


def test_json_lines_are_flat_strings_and_read_back(spark, tmp_path):
    path = str(tmp_path / "json")
    sessionised.write_json(sample(spark), path, files=1)
    texts = [json.loads(row.value) for row in spark.read.text(path).collect()]
    assert all(isinstance(value, str) for text in texts for value in text.values())
    one = next(text for text in texts if text["trackingId"] == "a")
    assert one["k"] == "v" and one["numPage"] == "1" and one["sessionId"] == f"{WEEK_45}a"
    back = sessionised.read_json(spark, path)
    columns = ("trackingId", "timestamp", "title", "sessionStart", "sessionId", "numPage", "masthead", "extras")
    want = sample(spark).withColumn(
        "extras", F.map_filter("extras", lambda k, v: (k != "title") & v.isNotNull())
    )
    assert rows(back, *columns) == rows(want, *columns)


def test_parquet_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "parquet")
    sessionised.write_parquet(sample(spark), path)
    assert sorted(p.name for p in (tmp_path / "parquet").iterdir() if p.is_dir()) == [
        "masthead=smh", "masthead=theage",
    ]
    one = sessionised.read_parquet(spark, path, "smh", 45)
    assert rows(one, "trackingId") == [("a",)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(masthead" in plan
    assert sessionised.read_parquet(spark, path).count() == 2


def test_metrics_are_cut_by_rows_and_read_back(spark, tmp_path):
    path = tmp_path / "metrics"
    df = spark.range(100, numPartitions=1).select(
        F.array(F.lit("a"), F.lit("b, \"c\"")).alias("path"),
        F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, 'x,"y"').alias("site"),
        (F.col("id") / 7).alias("value"),
    )
    for rows_a_file, files in ((1000, 1), (30, 4)):
        write_metrics(df, str(path), rows_a_file=rows_a_file)
        parts = list(path.glob("part-*"))
        assert len(parts) == files and all(p.read_text().startswith("path,site,value\n") for p in parts)
        back = read_metrics(spark, str(path), df.schema)
        assert back.schema.simpleString() == df.schema.simpleString() and rows(back) == rows(df), rows_a_file


def test_a_small_report_is_one_file(spark, tmp_path):
    report = spark.range(5000).groupBy((F.col("id") % 9).alias("k")).agg(F.count("*").alias("value"))
    write_metrics(report, str(tmp_path / "report"))
    assert len(list((tmp_path / "report").glob("part-*"))) == 1


def test_stage_uses_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(3).toDF("x"), "t")
    assert rows(staged) == [(0,), (1,), (2,)]
    assert shared_folder(spark) in staged.inputFiles()[0]
    assert new_path(spark, "n") != new_path(spark, "n")


def read_csv(spark, path):
    return spark.read.option("header", True).csv(str(path))


@pytest.mark.parametrize("as_json", [False, True])
def test_jobs_from_files_to_files(spark, click_files, tmp_path, as_json):
    flag = ["--json"] if as_json else []
    out, bad, reports = (str(tmp_path / name) for name in ("out", "bad", "reports"))
    main(
        ["sessionise", "--root", str(click_files), "--month", "11-2014", "--masthead", "smh", "theage",
         "drive", "--week", "45", "--output", out, "--quarantine", bad, *flag]
    )
    assert rows(spark.read.json(bad), "reason", "value") == [(raw.UNPARSEABLE, "{broken")]
    for job in ("brand-path", "content", "visitors", "segments"):
        main([job, "--input", out, "--output", reports, *flag])

    paths = rows(read_csv(spark, f"{reports}/brand_path"))
    assert paths == [("3", "drive", "1"), ("3", "smh>theage", "1"), ("3", "theage", "1")]
    visits = {(r.metric, r.period): r.value for r in read_csv(spark, f"{reports}/all_visitors").collect()}
    assert visits["Week_visitor", "45"] == "3.0" and visits["Week_numpage", "45"] == "4.0"
    assert visits["Week_session", "45"] == "180.0" and visits["Week_bounce", "45"] == "2.0"
    dwell = rows(read_csv(spark, f"{reports}/all_duration"), "assetCategory", "value")
    assert dwell == [("News", "180000")]
    assert read_csv(spark, f"{reports}/all_article_pageviews").count() == 4
    trend = rows(read_csv(spark, f"{reports}/repeat_trend"), "repeatFlag", "visitors")
    assert trend == [("COOKIE CLEARER", "2"), ("VISITORS BY CHANCE", "1")]


def test_forecast_job(spark, click_files, tmp_path):
    ips = tmp_path / "ips.csv"
    ips.write_text('"1.0.0.0","1.0.0.255","AU","NSW","Sydney"\n"9.0.0.0","9.255.255.255","US","",""\n')
    out = str(tmp_path / "forecast")
    main(
        ["forecast", "--root", str(click_files), "--month", "*", "--masthead", "smh",
         "--ip-file", str(ips), "--output", out]
    )
    got = rows(read_csv(spark, f"{out}/smh_metrics"), "metric", "label", "device", "site", "month", "month_start", "value")
    visit, pages = ("Month_visit", "Overall"), ("Month_pageviews", "Overall")
    november, december = ("10-2014", "2014-11-01"), ("11-2014", "2014-12-01")
    assert got == sorted(
        [
            (*visit, "overall", "smh", *november, "1.0"), (*pages, "overall", "smh", *november, "3.0"),
            (*visit, "desktop", "smh", *november, "1.0"), (*pages, "desktop", "smh", *november, "2.0"),
            (*visit, "mobile", "m.smh", *november, "1.0"), (*pages, "mobile", "m.smh", *november, "1.0"),
            (*visit, "overall", "smh", *december, "1.0"), (*pages, "overall", "smh", *december, "1.0"),
            (*visit, "desktop", "smh", *december, "1.0"), (*pages, "desktop", "smh", *december, "1.0"),
        ],
        key=repr,
    )


def test_both_formats_give_the_reports_of_one_masthead_and_week(spark, click_files, tmp_path):
    reports = {}
    for flag in ([], ["--json"]):
        out = str(tmp_path / f"out{len(flag)}")
        for week in ("45", "46", "45"):  # the second run of week 45 replaces the first
            main(["sessionise", "--root", str(click_files), "--month", "11-2014", "--masthead", "smh",
                  "theage", "drive", "--week", week, "--year", "2014", "--output", out, *flag])
        for week in ("45", "46"):
            for masthead in ("smh", "drive"):
                main(["visitors", "--input", out, "--masthead", masthead, "--week", week, "--year", "2014",
                      "--output", f"{out}-reports", *flag])
                path = f"{out}-reports/year=2014/week={week}/{masthead}_visitors"
                got = rows(read_csv(spark, path), "metric", "period", "value")
                reports.setdefault((week, masthead), []).append(got)
    assert all(one == two for one, two in reports.values())
    assert reports["45", "smh"][0] != reports["45", "drive"][0] and reports["45", "smh"][0]
    assert {period for _, period, _ in reports["46", "smh"][0]}.isdisjoint({"45"})


def test_staging_needs_a_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_week_with_year_can_skip_files(spark, tmp_path):
    from clickloom.plans.etl import in_week

    spark.range(5).select((F.col("id") * 86_400_000 * 4 + 1_415_000_000_000).alias("timestamp")).write.parquet(
        str(tmp_path / "t")
    )
    clicks = spark.read.parquet(str(tmp_path / "t"))
    plan = in_week(clicks, 45, 2014)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(timestamp" in plan
    assert rows(in_week(clicks, 45, 2014)) == rows(in_week(clicks, 45))


def test_options_of_the_sessionise_job(spark, click_files, tmp_path, capsys):
    at = WEEK_45
    views = [click("r", at + k * 300_000, "drive", "Drive Home", "Index", referer="http://www.bing.com/x") for k in range(200)]
    with gzip.open(click_files / "11-2014-drive-view-2.gz", "wt") as out:
        out.write("\n".join(views) + "\n")
    counts = {}
    for name, more in {"plain": [], "options": ["--index-category", "drive=Drive Home", "--referer-rules", "any-prefix", "--preview", "3"]}.items():
        out = str(tmp_path / name)
        main(["sessionise", "--root", str(click_files), "--month", "11-2014", "--masthead", "drive", "--week", "45",
              "--output", out, "--parse-partitions", "3", *more])
        done = sessionised.read_parquet(spark, out)
        counts[name] = (done.count(), done.where("finalReferer = 'BING'").count())
    assert counts["plain"] == (201, 0)
    assert 0 < counts["options"][0] < 120 and counts["options"][1] == counts["options"][0] - 1
    shown = capsys.readouterr().out
    assert shown.count("BING") + shown.count("DIRECT") == 3
    with pytest.raises(SystemExit):
        main(["sessionise", "--root", "r", "--month", "m", "--masthead", "x", "--week", "1", "--output", "o",
              "--index-category", "nothing"])


def test_months_of_a_week(spark, click_files, tmp_path):
    assert months_of_week(45, 2014) == ["11-2014"]
    assert months_of_week(1, 2015) == ["12-2014", "01-2015"] and months_of_week(53, 2015) == ["12-2015", "01-2016"]
    out = str(tmp_path / "out")
    main(["sessionise", "--root", str(click_files), "--masthead", "smh", "theage", "--week", "45", "--year", "2014", "--output", out])
    assert sessionised.read_parquet(spark, out).count() == 5
    with pytest.raises(SystemExit):
        main(["sessionise", "--root", str(click_files), "--masthead", "smh", "--week", "45", "--output", out])
