"""The same results in plain SQL, written row by row over the driver's tables.

Sydney is UTC+11 throughout the tables' month, so local time is an addition.
"""

from __future__ import annotations

from harness.adapter import GROUP, KINDS, MONDAY_MS, REFERERS

_referer_list = ", ".join(f"'{text}'" for text in REFERERS)
_ZERO = "00000000-0000-0000-0000-000000000000"
_local = "(to_timestamp(0)::TIMESTAMP + to_milliseconds(timestamp) + INTERVAL 11 HOUR)"

_EVENTS = f"""
events_k AS (
  SELECT *, epoch_us(ts) // 1000 AS timestamp, CAST(user_id // 10 AS VARCHAR) AS visitor,
    ts + INTERVAL 11 HOUR AS local_ts,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CASE event_id % 8 WHEN 3 THEN 'm.smh' WHEN 4 THEN 'theage' WHEN 5 THEN 'm.theage'
      WHEN 6 THEN 'drive' WHEN 7 THEN 'traveller' ELSE 'smh' END AS site
  FROM events),
events_m AS (
  SELECT *, CASE site WHEN 'm.smh' THEN 'smh' WHEN 'm.theage' THEN 'theage' ELSE site END AS masthead,
    CASE WHEN site LIKE 'm.%' THEN 'mobile' ELSE 'desktop' END AS device
  FROM events_k),
events_c AS (
  SELECT *, md5(visitor) AS "trackingId",
    CASE WHEN event_type IN ('view', 'click') THEN 'Index' ELSE 'Article' END AS "assetType",
    CASE WHEN event_type NOT IN ('view', 'click') THEN 'Category ' || (event_id % 7)
      WHEN event_id % 8 IN (4, 5) THEN 'The Age' WHEN event_id % 8 IN (6, 7) THEN 'Home'
      ELSE 'The Sydney Morning Herald' END AS "assetCategory",
    'Title ' || k AS title,
    'http://www.' || masthead || '.com.au/a/' || k AS url,
    list_extract([{_referer_list}], CAST(event_id % 16 AS INTEGER) + 1) AS referer,
    (user_id % 25 + 1) || '.' || k || '.' || (event_id % 256) || '.7' AS "IpAddress",
    CAST(user_id % 40 AS VARCHAR) AS "memberId", 'UA' || (user_id % 3) AS "userAgent"
  FROM events_m)"""

_CLICKS = _EVENTS + """,
clicks AS (
  SELECT "trackingId", timestamp, local_ts, CAST(day(local_ts) AS INTEGER) AS day,
    CAST(week(local_ts) AS INTEGER) AS week, site, masthead, device, "assetType",
    "assetCategory", title, url, referer, "IpAddress", "memberId", "userAgent"
  FROM events_c)"""


def _sessions(source: str, keys: str = '"trackingId"', name: str = "sessionised", suffix: str = "") -> str:
    """Session columns by lag, running sum and a window over each session."""
    return f"""
{name}_opened AS (
  SELECT *, CASE WHEN timestamp - lag(timestamp) OVER (PARTITION BY {keys} ORDER BY timestamp)
    <= 1800000 THEN 0 ELSE 1 END AS opens FROM {source}),
{name}_numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY {keys} ORDER BY timestamp) AS session_no
  FROM {name}_opened),
{name}_bounds AS (
  SELECT *, min(timestamp) OVER s AS "sessionStart", max(timestamp) OVER s AS "sessionEnd",
    CAST(count(*) OVER s AS BIGINT) AS "numPage"
  FROM {name}_numbered WINDOW s AS (PARTITION BY {keys}, session_no)),
{name} AS (
  SELECT *, ("sessionEnd" - "sessionStart") // 1000 AS "sessionDuration",
    "sessionStart" || "trackingId"{suffix} AS "sessionId" FROM {name}_bounds)"""


_DAY_KEY = "dayofyear(local_ts) || ' '' ' || year(local_ts)"
_SESSIONISED = _CLICKS + "," + _sessions("clicks")
_HEADS = _SESSIONISED + """,
heads AS (SELECT * FROM sessionised WHERE timestamp = "sessionStart")"""
_SESSION_COLUMNS = (
    '"trackingId", timestamp, site, "sessionId", "sessionStart", "sessionEnd", '
    '"sessionDuration", "numPage"'
)

_INDEX = """
index_views AS (
  SELECT * FROM {source} WHERE "assetType" = 'Index' AND
    ((masthead = 'smh' AND "assetCategory" = 'The Sydney Morning Herald')
     OR (masthead = 'theage' AND "assetCategory" = 'The Age'))),
index_gaps AS (
  SELECT masthead, "trackingId", timestamp,
    coalesce(lead(timestamp) OVER (PARTITION BY masthead, "trackingId" ORDER BY timestamp)
      - timestamp, 0) AS gap
  FROM (SELECT DISTINCT masthead, "trackingId", timestamp FROM index_views)),
scored AS (
  SELECT *, CASE
      WHEN gap > 300000 THEN 0.996::DOUBLE * exp(-pow((gap - 300000) / 120000.0::DOUBLE, 2))
      WHEN gap > 0 THEN 0.996::DOUBLE * exp(-pow((gap - 300000) / 140000.0::DOUBLE, 2))
      ELSE 0.0::DOUBLE END AS probability,
    ('0x' || substr(md5("trackingId" || '|' || timestamp || '|1'), 1, 8))::BIGINT
      / 4294967296e0 AS draw_1,
    ('0x' || substr(md5("trackingId" || '|' || timestamp || '|2'), 1, 8))::BIGINT
      / 4294967296e0 AS draw_2
  FROM index_gaps),
flags AS (
  SELECT masthead, "trackingId", timestamp FROM scored
  WHERE probability > 0 AND probability > draw_1 AND draw_2 > 0.14),
kept AS (SELECT * FROM {source} ANTI JOIN flags USING (masthead, "trackingId", timestamp))"""
_RELOADS = _CLICKS + "," + _INDEX.format(source="clicks")


def _referer(bing: str, yahoo: str, drive: str) -> str:
    return f"""CASE
    WHEN referer = 'direct' THEN 'DIRECT'
    WHEN referer = '' AND (url LIKE '%www.smh.com.au%' OR url LIKE '%www.theage.com.au%') THEN 'DIRECT'
    WHEN referer LIKE '%www.google.%' THEN 'GOOGLE'
    WHEN referer LIKE '{bing}' THEN 'BING'
    WHEN referer LIKE '{yahoo}' THEN 'YAHOO'
    WHEN referer LIKE '{drive}' THEN 'DRIVE'
    WHEN referer LIKE '%www.smh.com.au%' THEN 'SMH'
    WHEN referer LIKE '%www.theage.com.au%' THEN 'THEAGE'
    WHEN referer LIKE '%traffic.outbrain.com%' THEN 'OUTBRAIN'
    WHEN referer LIKE '%reddit.com%' THEN 'REDDIT'
    WHEN referer LIKE '%twitter.com%' THEN 'TWITTER'
    WHEN referer LIKE '%linkedin.com%' THEN 'LINKEDIN'
    WHEN referer LIKE '%facebook.com%' THEN 'FACEBOOK'
    ELSE 'referral' END"""


_REFERER = _referer("%*.bing.%", "%*.yahoo.%", "%*.drive.%")
_REFERER_FIXED = _referer("%.bing.%", "%.yahoo.%", "%.drive.%")
_ETL = _RELOADS + "," + _sessions("kept")


def _metric(label: str, value: str, source: str = "heads", where: str = "TRUE") -> str:
    """One metric by week and by day; ``value`` may be null to leave a period out."""
    week, day = label.split("/")
    parts = [
        f"""SELECT '{name}' AS metric, 'all' AS masthead, {period} AS period,
        CAST({value} AS DOUBLE) AS value FROM {source} WHERE {where} GROUP BY {period}"""
        for name, period in ((week, "week"), (day, "day"))
    ]
    return " UNION ALL ".join(parts)


def _repeat(source: str = "heads") -> str:
    parts = [
        f"""SELECT '{name}' AS metric, 'all' AS masthead, {period} AS period,
        CAST(count(*) AS DOUBLE) AS value
        FROM (SELECT {period}, "trackingId" FROM {source} GROUP BY 1, 2 HAVING count(*) > 1)
        GROUP BY {period}"""
        for name, period in (("Week_repeat", "week"), ("Daily_repeat", "day"))
    ]
    return " UNION ALL ".join(parts)


_METRICS = {
    "visitors": _metric("Week_visitor/Daily_visitors", 'count(DISTINCT "trackingId")'),
    "visits": _metric("Week_visit/Daily_visit", "count(*)"),
    "numpage": _metric("Week_numpage/Daily_numpage", 'avg("numPage")', where='"numPage" <> 1'),
    "session_duration": _metric(
        "Week_session/Daily_session", 'avg("sessionDuration")', where='"sessionDuration" <> 0'
    ),
    "bounce": _metric("Week_bounce/Daily_bounce", "count(*)", where='"numPage" = 1'),
    "repeat_visitors": _repeat(),
}
_ALL_METRICS = " UNION ALL ".join(_METRICS.values())


def _daily(metric: str, keys: str, value: str, source: str = "sessionised") -> str:
    return f"""SELECT 'Day' AS grain, '{metric}' AS metric, 'all' AS masthead, {keys},
      CAST({value} AS BIGINT) AS value FROM {source} GROUP BY {keys}"""


_ARTICLES = _SESSIONISED + """,
articles AS (
  SELECT day, replace(title, ' ', '#') AS title, url, count(*) AS views,
    count(DISTINCT "sessionStart") AS visits
  FROM sessionised GROUP BY ALL)"""


def _top_articles(metric: str, score: str) -> str:
    return f"""WITH {_ARTICLES}
    SELECT 'Day' AS grain, '{metric}' AS metric, 'all' AS masthead, day, title, url,
      CAST({score} AS BIGINT) AS value FROM articles
    QUALIFY row_number() OVER (PARTITION BY day ORDER BY {score} DESC, title, url) <= 10"""


def _dwell(item: str, session: str = '"sessionStart"') -> str:
    return f"""
dwelt AS (
  SELECT day, {item} AS item, lead(timestamp) OVER
    (PARTITION BY day, {session} ORDER BY timestamp, {item}) - timestamp AS dwell
  FROM sessionised),
dwell AS (
  SELECT day, item, CAST(sum(dwell) AS BIGINT) AS dwell FROM dwelt
  WHERE dwell IS NOT NULL GROUP BY day, item)"""


_TITLE = "replace(title, ' ', '#')"
_PATHS = _SESSIONISED + """,
stops AS (
  SELECT day, "sessionId", timestamp, masthead AS brand, lag(masthead) OVER
    (PARTITION BY day, "sessionId" ORDER BY timestamp, masthead) AS before
  FROM sessionised),
changes AS (
  SELECT * FROM stops WHERE before IS NULL OR before <> brand
  QUALIFY row_number() OVER (PARTITION BY day, "sessionId" ORDER BY timestamp, brand) <= 5),
paths AS (
  SELECT day, "sessionId", string_agg(brand, '>' ORDER BY timestamp, brand) AS path
  FROM changes GROUP BY 1, 2)"""

# Raw lines, rebuilt from the same parts.
_RAW = _EVENTS + f""",
raw AS (
  SELECT *,
    CASE event_type WHEN 'error' THEN chr(92) || '''' WHEN 'signup' THEN chr(92) || 'v'
      WHEN 'purchase' THEN chr(92) || 'a' WHEN 'click' THEN chr(92) || 'q' ELSE '' END AS escape,
    CASE event_type WHEN 'error' THEN '''' WHEN 'signup' THEN chr(7)
      WHEN 'purchase' THEN chr(19) WHEN 'click' THEN 'q' ELSE '' END AS meaning,
    CASE WHEN value >= 200 THEN 'unparseable'
      WHEN value >= 42 AND value < 44 THEN 'missing trackingId'
      WHEN value >= 44 AND value < 46 THEN 'bad timestamp'
      WHEN value >= 46 AND value < 48 THEN 'text after the object'
      WHEN value >= 48 AND value < 50 THEN 'malformed extras' END AS reason
  FROM events_c WHERE NOT (value >= 40 AND value < 42)),
whole_lines AS (
  SELECT reason, value, '{{"timestamp":'
    || CASE WHEN reason = 'bad timestamp' THEN '"n/a"' ELSE CAST(timestamp AS VARCHAR) END || ','
    || CASE WHEN reason = 'missing trackingId' THEN '' ELSE '"trackingId":"' || visitor || '",' END
    || '"site":"' || site || '","assetType":"' || "assetType" || '","assetCategory":"'
    || "assetCategory" || '","referer":"' || referer || '","IpAddress":"' || "IpAddress"
    || '","memberId":"' || "memberId" || '","userAgent":"' || "userAgent"
    || '","title":"shadowed","extras":' || CASE WHEN reason = 'malformed extras' THEN '{{"name":"title"}}'
      ELSE '[{{"name":"title","value":"' || escape || title || '"}},{{"name":"url","value":"' || url
        || '"}},{{"name":"slot","value":"' || (event_id % 5) || '"}}]' END || '}}' AS line
  FROM raw),
raw_lines AS (
  SELECT reason, CASE WHEN reason <> 'text after the object' THEN line
    WHEN value < 47 THEN line || ' tail' ELSE line || ',' || line END AS line FROM whole_lines),
raw_clicks AS (
  SELECT "trackingId", timestamp, local_ts, CAST(day(local_ts) AS INTEGER) AS day,
    CAST(week(local_ts) AS INTEGER) AS week, site, masthead, device, "assetType",
    "assetCategory", meaning || title AS title, url, referer, "IpAddress", "memberId",
    "userAgent", CAST(event_id % 5 AS VARCHAR) AS slot
  FROM raw WHERE reason IS NULL)"""

_RANGES = """
range_bounds AS (
  SELECT *, CAST(n_nationkey + 1 AS BIGINT) * 16777216 AS lo,
    CAST(n_nationkey + 1 AS BIGINT) * 16777216 + 80 * 65536 - 1 AS hi FROM nation),
ranges AS (
  SELECT lo, hi, CASE WHEN n_regionkey = 0 THEN 'AU' ELSE n_name END AS "Country",
    CAST(n_regionkey AS VARCHAR) AS "Region", n_name AS "City",
    (lo // 16777216) || '.' || (lo // 65536 % 256) || '.' || (lo // 256 % 256) || '.' || (lo % 256)
      || ' - ' || (hi // 16777216) || '.' || (hi // 65536 % 256) || '.' || (hi // 256 % 256)
      || '.' || (hi % 256) AS "ipBlock",
    CAST(n_nationkey AS BIGINT) AS "ipBlockIndex" FROM range_bounds)"""


def _address(ip: str) -> str:
    parts = [f"CAST(split_part({ip}, '.', {i}) AS BIGINT)" for i in range(1, 5)]
    return f"({parts[0]} * 16777216 + {parts[1]} * 65536 + {parts[2]} * 256 + {parts[3]})"


def _monthly(metric: str, value: str) -> str:
    return f"""WITH {_CLICKS},
scoped AS (
  SELECT *, 'overall' AS scope FROM clicks UNION ALL SELECT *, device AS scope FROM clicks),
{_sessions("scoped", 'scope, "trackingId", CAST(local_ts AS DATE)')},
{_RANGES},
heads AS (
  SELECT h.*, "Country" FROM sessionised h
  JOIN ranges r ON {_address('h."IpAddress"')} BETWEEN r.lo AND r.hi
  WHERE timestamp = "sessionStart" AND "Country" = 'AU')
SELECT '{metric}' AS metric, 'all' AS masthead, 'Overall' AS label, scope AS device, site,
  (month(local_ts) - 1) || '-' || year(local_ts) AS month,
  CAST(CAST(date_trunc('month', local_ts) AS DATE) AS VARCHAR) AS month_start,
  CAST({value} AS DOUBLE) AS value
FROM heads GROUP BY ALL"""


_FEATURES = _HEADS + """,
features AS (
  SELECT "trackingId", count(*) AS sessions,
    count(*) FILTER (isodow(local_ts) >= 6) AS "weekendSessions",
    count(*) FILTER (isodow(local_ts) < 6) AS "weekdaySessions",
    CASE WHEN count(*) FILTER ("numPage" = 1 AND "assetType" = 'Index') = 0 THEN -1
      ELSE count(*) FILTER ("numPage" = 1 AND "assetType" = 'Index') END AS "indexSessions",
    count(*) FILTER ("numPage" = 1) AS "singleSessions",
    count(*) FILTER ("numPage" BETWEEN 2 AND 4) AS "middleSessions",
    count(*) FILTER ("numPage" > 4) AS "deepSessions",
    count(DISTINCT CAST(local_ts AS DATE)) AS "activeDays"
  FROM heads GROUP BY "trackingId")"""
_CLEARERS = """
member_pairs AS (
  SELECT DISTINCT "memberId" AS m, "trackingId" FROM clicks WHERE "memberId" <> '0'),
machine_pairs AS (
  SELECT DISTINCT "IpAddress" AS i, "userAgent" AS u, "trackingId" FROM clicks),
clearers AS (
  SELECT "trackingId" FROM member_pairs WHERE m IN
    (SELECT m FROM member_pairs GROUP BY m HAVING count(*) BETWEEN 2 AND 5)
  UNION
  SELECT "trackingId" FROM machine_pairs JOIN
    (SELECT i, u FROM machine_pairs GROUP BY i, u HAVING count(*) BETWEEN 2 AND 5) USING (i, u))"""
_SEGMENTS = _FEATURES + "," + _CLEARERS + """,
shares AS (
  SELECT f.*, CASE WHEN c."trackingId" IS NULL THEN 0 ELSE 1 END AS "cookieClearer",
    CAST("weekendSessions" AS DOUBLE) / sessions AS we,
    CAST("indexSessions" AS DOUBLE) / sessions AS ix
  FROM features f LEFT JOIN clearers c USING ("trackingId")),
segments AS (
  SELECT * EXCLUDE (we, ix), CASE
    WHEN sessions > 5 AND we > 0.2 AND we < 0.8 AND "activeDays" >= 3
      AND "middleSessions" + "deepSessions" > "singleSessions" AND "deepSessions" > "middleSessions"
      THEN 'HABITUAL ENGAGED VISITORS'
    WHEN sessions BETWEEN 2 AND 5 AND we > 0.2 AND we < 0.8 AND "activeDays" >= 3
      AND "middleSessions" + "deepSessions" > "singleSessions" THEN 'HABITUAL NON-ENGAGED VISITORS'
    WHEN sessions > 1 AND "indexSessions" <> -1 AND ix > 0.5 THEN 'UNENGAGED VISITORS'
    WHEN sessions = 1 AND "cookieClearer" = 0 THEN 'VISITORS BY CHANCE'
    WHEN sessions = 1 THEN 'COOKIE CLEARER'
    WHEN sessions > 1 AND we >= 0.8 THEN 'AT HOME READERS'
    WHEN sessions > 1 AND we <= 0.2 THEN 'AT OFFICE READERS'
    WHEN sessions > 1 AND "singleSessions" + "middleSessions" > "deepSessions" AND ix <= 0.5
      THEN 'MISSION READERS'
    WHEN sessions > 5 AND "activeDays" < 3 THEN 'EVENT READERS'
    ELSE 'UNFLAGGED' END AS segment
  FROM shares)"""


def _dotted(number: str) -> str:
    return f"""({number} // 16777216) || '.' || ({number} // 65536 % 256) || '.' || ({number} // 256 % 256) || '.' || ({number} % 256)"""


_UNALIGNED = f"""
short_ranges AS (
  SELECT *, 16777216 + 31 + CAST(c_custkey AS BIGINT) * 100 + c_custkey % 7 AS lo,
    16777216 + 31 + CAST(c_custkey AS BIGINT) * 100 + c_custkey % 7 + 50 + c_custkey % 44 AS hi FROM customer),
unaligned AS (
  SELECT lo, hi, c_mktsegment AS "Country", CAST(c_nationkey AS VARCHAR) AS "Region", c_name AS "City",
    {_dotted("lo")} || ' - ' || {_dotted("hi")} AS "ipBlock", CAST(c_custkey AS BIGINT) AS "ipBlockIndex" FROM short_ranges)"""

# Visitors who behave in every way that the segments tell apart.
_KIND_CLICKS = f"""
grouped AS (
  SELECT event_id // {GROUP} AS g, event_id % {GROUP} AS n, event_id // {GROUP} % {KINDS} AS kind FROM events),
paged AS (SELECT *, list_extract([5, 9, 1, 36, 12, 18, 18, 3, 5, 18], CAST(kind AS INTEGER) + 1) AS pages FROM grouped),
visited AS (SELECT *, least(n // pages, CASE WHEN kind IN (0, 8) THEN 6 ELSE 99 END) AS visit FROM paged),
dated AS (
  SELECT *, n - visit * pages AS page, CASE kind WHEN 0 THEN visit WHEN 1 THEN visit + 4 WHEN 2 THEN visit % 12
    WHEN 5 THEN visit + 5 WHEN 6 THEN visit + 1 WHEN 7 THEN visit % 2 * 2 + 5 WHEN 8 THEN visit % 2 * 2 + 5
    WHEN 9 THEN visit * 2 + 5 ELSE 1 END AS on_day FROM visited),
timed AS (
  SELECT *, 'v' || g || CASE WHEN kind = 4 THEN '-' || visit ELSE '' END AS "trackingId",
    {MONDAY_MS} + on_day * 86400000 + visit * 2400000 + page * 20000 AS timestamp FROM dated),
clicks AS (
  SELECT "trackingId", timestamp, {_local} AS local_ts, CAST(day({_local}) AS INTEGER) AS day,
    CASE WHEN kind = 2 THEN 'Index' ELSE 'Article' END AS "assetType",
    CASE WHEN kind = 4 THEN 'm' || g ELSE '0' END AS "memberId",
    'ip of ' || "trackingId" AS "IpAddress", 'UA' AS "userAgent" FROM timed)"""
_KIND_SEGMENTS = _SEGMENTS.replace(_CLICKS, _KIND_CLICKS)

ORACLES: dict[str, str] = {
    "time_keys": f"""WITH {_CLICKS}
      SELECT "trackingId", timestamp, strftime(local_ts, '%Y-%m-%d %H:%M:%S') AS local_time, week,
        day, {_DAY_KEY} AS day_key, (month(local_ts) - 1) || '-' || year(local_ts) AS month_key
      FROM clicks""",
    "week_filter": f'WITH {_CLICKS} SELECT "trackingId", timestamp, site FROM clicks WHERE week = 2',
    "sessionise": f"WITH {_SESSIONISED} SELECT {_SESSION_COLUMNS} FROM sessionised",
    "session_heads": f"WITH {_HEADS} SELECT {_SESSION_COLUMNS} FROM heads",
    "sessionise_daily": f"""WITH {_CLICKS},
      {_sessions("clicks", '"trackingId", CAST(local_ts AS DATE)', suffix=f" || {_DAY_KEY}")}
      SELECT {_SESSION_COLUMNS} FROM sessionised""",
    **{name: f"WITH {_HEADS} {sql}" for name, sql in _METRICS.items()},
    "visitor_metrics_all": f"WITH {_HEADS} {_ALL_METRICS}",
    "pageviews_by_category": f"""WITH {_SESSIONISED}
      {_daily("PageViews", 'day, "assetCategory"', "count(*)")}""",
    "visits_by_category": f"""WITH {_SESSIONISED}
      {_daily("Visits", 'day, "assetCategory"', 'count(DISTINCT "sessionStart")')}""",
    "visits_by_category_exact": f"""WITH {_SESSIONISED}
      {_daily("Visits", 'day, "assetCategory"', 'count(DISTINCT "sessionId")')}""",
    "visits_by_article_exact": f"""WITH {_SESSIONISED}
      SELECT day, replace(title, ' ', '#') AS title, url, count(DISTINCT "sessionId") AS value
      FROM sessionised GROUP BY ALL""",
    "dwell_by_category_exact": f"""WITH {_SESSIONISED}, {_dwell('"assetCategory"', '"sessionId"')}
      SELECT 'Day' AS grain, 'Duration' AS metric, 'all' AS masthead, day,
        item AS "assetCategory", dwell AS value FROM dwell""",
    "pageviews_by_article": f"""WITH {_ARTICLES}
      SELECT day, title, url, CAST(views AS BIGINT) AS value FROM articles""",
    "visits_by_article": f"""WITH {_ARTICLES}
      SELECT day, title, url, CAST(visits AS BIGINT) AS value FROM articles""",
    "top10_articles_by_views": _top_articles("View_article", "views"),
    "top10_articles_by_visits": _top_articles("Visit_article", "visits"),
    "dwell_by_category": f"""WITH {_SESSIONISED}, {_dwell('"assetCategory"')}
      SELECT 'Day' AS grain, 'Duration' AS metric, 'all' AS masthead, day,
        item AS "assetCategory", dwell AS value FROM dwell""",
    "top10_dwell_articles": f"""WITH {_SESSIONISED}, {_dwell(_TITLE)},
      best AS (SELECT * FROM dwell ORDER BY dwell DESC, day, item LIMIT 10),
      urls AS (SELECT DISTINCT day, {_TITLE} AS item, url FROM sessionised)
      SELECT 'Day' AS grain, 'Duration_Article' AS metric, 'all' AS masthead, day,
        item AS title, coalesce(url, '') AS url, dwell AS value
      FROM best LEFT JOIN urls USING (day, item)""",
    "brand_path": f"""WITH {_PATHS}
      SELECT day, path, count(*) AS sessions FROM paths GROUP BY day, path""",
    "parse_raw": f"""WITH {_RAW}
      SELECT "trackingId", timestamp, masthead, device, site, "assetType", "assetCategory", title,
        url, referer, "IpAddress", "memberId", "userAgent", slot, 1 AS other_fields
      FROM raw_clicks""",
    "quarantine": f"""WITH {_RAW}
      SELECT CASE WHEN reason = 'unparseable' THEN left(line, length(line) - 5) ELSE line END AS value,
        reason FROM raw_lines WHERE reason IS NOT NULL""",
    "index_views": f"""WITH {_RELOADS}
      SELECT "trackingId", timestamp, masthead, "assetCategory" FROM index_views""",
    "index_gaps": f"WITH {_RELOADS} SELECT * FROM index_gaps",
    "reload_probability": f"""WITH {_RELOADS}
      SELECT masthead, "trackingId", timestamp, gap, round(probability, 9) AS probability
      FROM scored""",
    "reload_flags": f"WITH {_RELOADS} SELECT * FROM flags",
    "clicks_after_reload": f"""WITH {_RELOADS}
      SELECT "trackingId", timestamp, masthead, site, "assetCategory" FROM kept""",
    "combined_mastheads": f"""WITH {_RELOADS}
      SELECT masthead, device, count(*) AS clicks, CAST(sum(timestamp) AS BIGINT) AS checksum
      FROM kept GROUP BY masthead, device""",
    "sessionise_all_mastheads": f"""WITH {_ETL}
      SELECT {_SESSION_COLUMNS}, masthead, {_REFERER} AS "finalReferer" FROM sessionised""",
    "sessionise_each_masthead": f"""WITH {_RELOADS}, {_sessions("kept", 'masthead, "trackingId"')}
      SELECT {_SESSION_COLUMNS}, masthead, {_REFERER} AS "finalReferer" FROM sessionised""",
    "referer_class": f"""WITH {_CLICKS}
      SELECT "trackingId", timestamp, referer, url, {_REFERER} AS "finalReferer" FROM clicks""",
    "referer_class_fixed": f"""WITH {_CLICKS}
      SELECT "trackingId", timestamp, referer, url, {_REFERER_FIXED} AS "finalReferer" FROM clicks""",
    "ip_ranges": """WITH starts AS (
        SELECT *, 16777216 + CAST(c_custkey AS BIGINT) * 256 AS lo FROM customer),
      dotted AS (SELECT *, (lo // 16777216) || '.' || (lo // 65536 % 256) || '.' || (lo // 256 % 256)
        || '.' AS net FROM starts)
      SELECT lo, lo + 255 AS hi, c_mktsegment AS "Country", 'Region ' || c_nationkey AS "Region",
        c_name || ', City' AS "City", net || '0 - ' || net || '255' AS "ipBlock",
        c_custkey AS "ipBlockIndex" FROM dotted""",
    "ip_enrich": f"""WITH {_CLICKS}, {_RANGES}
      SELECT "trackingId", timestamp, "IpAddress", "Country", "Region", "City", "ipBlock",
        "ipBlockIndex"
      FROM clicks LEFT JOIN ranges ON {_address('"IpAddress"')} BETWEEN lo AND hi""",
    "monthly_visits": _monthly("Month_visit", "count(*)"),
    "monthly_pageviews": _monthly("Month_pageviews", 'sum("numPage")'),
    "sessionised_roundtrip": f"""WITH {_ETL}
      SELECT {_SESSION_COLUMNS}, masthead, device, title, {_REFERER} AS "finalReferer"
      FROM sessionised""",
    "sessionised_parquet": f"""WITH {_ETL}
      SELECT {_SESSION_COLUMNS}, masthead, week FROM sessionised
      WHERE masthead = 'smh' AND week = 2""",
    "json_by_masthead_week": f"""WITH {_ETL}
      SELECT {_SESSION_COLUMNS}, masthead FROM sessionised WHERE masthead = 'smh' AND week = 2""",
    "repeated_weeks": f"""WITH {_ETL}
      SELECT {_SESSION_COLUMNS}, masthead, 2024 AS year, week FROM sessionised
      WHERE week IN (1, 2)""",
    "raw_to_visitor_metrics": f"""WITH {_RAW},
      week_clicks AS (SELECT * FROM raw_clicks WHERE week = 2),
      {_INDEX.format(source="week_clicks")}, {_sessions("kept")},
      heads AS (SELECT * FROM sessionised WHERE timestamp = "sessionStart")
      {_ALL_METRICS}""",
    "visitor_features": f"WITH {_FEATURES} SELECT * FROM features",
    "cookie_clearers": f'WITH {_CLICKS}, {_CLEARERS} SELECT "trackingId" FROM clearers',
    "visitor_segments": f"WITH {_SEGMENTS} SELECT * FROM segments",
    "flagged_heads": f"""WITH {_SEGMENTS}
      SELECT "trackingId", timestamp, "sessionId", segment AS "repeatFlag"
      FROM heads JOIN segments USING ("trackingId")""",
    "segment_trend": f"""WITH {_SEGMENTS}
      SELECT segment AS "repeatFlag", CAST(CAST(local_ts AS DATE) AS VARCHAR) AS date, day,
        count(DISTINCT "trackingId") AS visitors
      FROM heads JOIN segments USING ("trackingId") GROUP BY ALL""",
    "segments_of_every_kind": f"""WITH {_KIND_SEGMENTS} SELECT * FROM segments""",
    "trend_of_every_kind": f"""WITH {_KIND_SEGMENTS}
      SELECT segment AS "repeatFlag", CAST(CAST(local_ts AS DATE) AS VARCHAR) AS date, day,
        count(DISTINCT "trackingId") AS visitors
      FROM heads JOIN segments USING ("trackingId") GROUP BY ALL""",
    "ip_lookup_unaligned": f"""WITH {_UNALIGNED}
      SELECT event_id, "IpAddress", "Country", "Region", "City", "ipBlock", "ipBlockIndex"
      FROM (SELECT event_id, 16777216 + (event_id * 7919) % 200000 AS address,
          {_dotted("(16777216 + (event_id * 7919) % 200000)")} AS "IpAddress" FROM events)
      LEFT JOIN unaligned ON address BETWEEN lo AND hi""",
    "ip_file_offsets": """WITH nets AS (
        SELECT *, 16777216 + CAST(c_custkey AS BIGINT) * 256 AS lo FROM customer),
      places AS (SELECT *, (lo // 16777216) || '.' || (lo // 65536 % 256) || '.' || (lo // 256 % 256) || '.' AS net,
        '","' || c_mktsegment || '","Region ' || c_nationkey || '","' || c_name || ', City"' AS place FROM nets),
      lines AS (
        SELECT c_custkey, 0 AS nth, '"' || net || '0","' || net || '255' || place AS line, net FROM places
        UNION ALL SELECT c_custkey, 1, '"2001:db8::1","2001:db8::ff' || place, net FROM places),
      placed AS (SELECT *, CAST(sum(strlen(line) + 1) OVER (ORDER BY c_custkey, nth) AS BIGINT) - strlen(line) - 1 AS begins FROM lines)
      SELECT kind AS file, net || '0 - ' || net || '255' AS "ipBlock", begins AS "ipBlockIndex"
      FROM placed, (VALUES ('packed'), ('plain')) kinds(kind) WHERE nth = 0""",
}
# The same lines from files, whole or by name; the same reports from files.
ORACLES["parse_spread"] = ORACLES["parse_raw"]
ORACLES["click_files"] = f"""WITH {_RAW}
  SELECT masthead, device, "trackingId", timestamp, title FROM raw_clicks WHERE masthead IN ('smh', 'theage', 'drive')"""
ORACLES["metrics_roundtrip"] = ORACLES["visitor_metrics_all"]
ORACLES["paths_roundtrip"] = ORACLES["brand_path"]
