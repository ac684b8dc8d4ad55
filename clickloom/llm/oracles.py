"""SQL for the queries that SQL can express."""

from __future__ import annotations

from clickloom.llm import filter_audit, middle, quality, url_filters


def _quality_sql() -> str:
    shift = "(length(bin(value)) - 6)"
    floor = "CASE WHEN {0} < 64 THEN {0} ELSE ({0} - 32 * ({0} // 32 - 1)) << CAST({0} // 32 - 1 AS INTEGER) END"
    slack = " ".join(f"WHEN '{m}' THEN {x}" for m, x in quality.SLACK.items())
    inside = " AND ".join(
        f"{m} <= max(high) FILTER (measure = '{m}')" for m in quality.MEASURES
    ) + " AND word_length >= max(low) FILTER (measure = 'word_length')"
    ratios = ", ".join(f"1000 * {a} // greatest({b}, 1) AS {m}" for m, (a, b) in quality.RATIOS.items())
    return f"""
WITH split AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, greatest(len(w) - 6, 1))) AS pos, w FROM split
), hit AS (
  SELECT doc_id, pos, array_to_string(w[pos:pos + 7], ' ') AS win FROM windows
), repeated AS (
  SELECT doc_id, pos FROM hit QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
  SELECT doc_id, CAST(sum(least(8, coalesce(pos - before, 8))) AS BIGINT) AS n
  FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM repeated) GROUP BY doc_id
), counted AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)
), measured AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
         {ratios} FROM counted
), valued AS (
  SELECT lang, source, measure, CASE WHEN value < 64 THEN value ELSE 32 * {shift} + (value >> {shift}) END AS bucket
  FROM (UNPIVOT (SELECT * FROM measured WHERE NOT base_failed) ON {', '.join(quality.MEASURES)} INTO NAME measure VALUE value)
), sketch AS (
  SELECT level, l AS lang, s AS source, measure, bucket, count(*) AS n FROM (
    SELECT 2 AS level, lang AS l, source AS s, measure, bucket FROM valued
    UNION ALL SELECT 1, lang, '', measure, bucket FROM valued
    UNION ALL SELECT 0, '', '', measure, bucket FROM valued)
  GROUP BY ALL
), running AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bucket) AS up_to,
         sum(n) OVER (PARTITION BY level, lang, source, measure) AS total FROM sketch
), quartiles AS (
  SELECT level, lang, source, measure, max(total) AS total,
         min(bucket) FILTER (100 * up_to >= 25 * total) AS b25, min(bucket) FILTER (100 * up_to >= 75 * total) AS b75
  FROM running GROUP BY ALL
), valuedq AS (
  SELECT level, lang, source, measure, total, {floor.format('b25')} AS q25, {floor.format('b75')} AS q75 FROM quartiles
), fence AS (
  SELECT level, lang, source, measure, total,
         q25 - greatest({quality.REACH} * (q75 - q25), CASE measure {slack} END) AS low,
         q75 + greatest({quality.REACH} * (q75 - q25), CASE measure {slack} END) AS high FROM valuedq
), chosen AS (
  SELECT a.lang, a.source, a.measure,
         CASE WHEN a.total >= {quality.MIN_GROUP} THEN a.low WHEN b.total >= {quality.MIN_GROUP} THEN b.low ELSE c.low END AS low,
         CASE WHEN a.total >= {quality.MIN_GROUP} THEN a.high WHEN b.total >= {quality.MIN_GROUP} THEN b.high ELSE c.high END AS high
  FROM fence a JOIN fence b ON b.level = 1 AND a.lang = b.lang AND a.measure = b.measure
  JOIN fence c ON c.level = 0 AND a.measure = c.measure WHERE a.level = 2
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({inside}, true) AS kept
FROM measured LEFT JOIN chosen USING (lang, source)
GROUP BY doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {', '.join(quality.MEASURES)}
"""


_SUBSTRING = """
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), hit AS (
  SELECT doc_id, pos, array_to_string(w[pos:pos + 19], ' ') AS win
  FROM (SELECT doc_id, unnest(range(1, greatest(len(w) - 18, 1))) AS pos, w FROM split)
), later AS (
  SELECT doc_id, pos FROM hit QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1
), cut AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM later
), word AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM split
), counted AS (
  SELECT word.doc_id, count(*) AS n_words, count(cut.pos) AS n_removed,
         string_agg(word, ' ' ORDER BY word.pos) FILTER (cut.pos IS NULL) AS kept
  FROM word LEFT JOIN cut USING (doc_id, pos) GROUP BY word.doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN counted USING (doc_id)
"""


_NGRAM_JOIN = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[pos:pos + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS pos FROM split WHERE len(w) > 0)
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), overlap AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM overlap JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * overlap.n >= 75 * (x.n + y.n - overlap.n)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""


def _url_sql() -> str:
    rules = sorted(url_filters.RULES, key=lambda r: (-len(r[1]), r[1]))

    def case(pick: int) -> str:
        whens = []
        for rule in rules:
            host, slash, path = rule[1].partition("/")
            whens.append(
                f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}') THEN '{rule[pick]}'"
            )
        return "CASE " + " ".join(whens) + " END"

    prior, chars = url_filters.PRIOR, url_filters.CHARACTERS
    levels = f"""
level1 AS (SELECT gram, (a + {prior / chars}) / (sum(a) OVER () + {prior}) AS pa, (r + {prior / chars}) / (sum(r) OVER () + {prior}) AS pr
           FROM (SELECT right(gram, 1) AS gram, sum(a) AS a, sum(r) AS r FROM gram GROUP BY 1))"""
    for n in (2, 3, 4):
        levels += f""",
level{n} AS (SELECT t.gram, (a + {prior} * pa) / (sum(a) OVER (PARTITION BY t.gram[1:{n - 1}]) + {prior}) AS pa,
                    (r + {prior} * pr) / (sum(r) OVER (PARTITION BY t.gram[1:{n - 1}]) + {prior}) AS pr
             FROM (SELECT right(gram, {n}) AS gram, sum(a) AS a, sum(r) AS r FROM gram GROUP BY 1) t
             JOIN level{n - 1} s ON s.gram = right(t.gram, {n - 1}))"""
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages
), page AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), site AS (
  SELECT host, path, {case(0)} AS decided, {case(1)} AS rule, '^^^' || host || path || '$' AS s,
         md5(host || path)[1:1] IN {url_filters.CALIBRATING} AS calibrates
  FROM (SELECT DISTINCT host, path FROM page)
), place AS (
  SELECT host, path, decided, calibrates, s[i:i + 3] AS gram FROM (SELECT *, unnest(range(1, len(s) - 2)) AS i FROM site)
), gram AS (
  SELECT gram, CAST(count(*) FILTER (NOT calibrates AND decided = 'allow') AS DOUBLE) AS a,
         CAST(count(*) FILTER (NOT calibrates AND decided = 'block') AS DOUBLE) AS r FROM place GROUP BY gram
), {levels},
scored AS (
  SELECT host, path, CAST(floor(sum(llr) / count(*)) AS BIGINT) AS llr
  FROM place JOIN (SELECT gram, CAST(floor((ln(pa) - ln(pr)) * 1000000 + 0.5) AS BIGINT) AS llr FROM level4) USING (gram) GROUP BY host, path
), stepped AS (
  SELECT site.*, llr, CAST(floor(llr / {url_filters.STEP}) AS BIGINT) AS step FROM scored JOIN site USING (host, path)
), kinds AS (
  SELECT step, count(*) FILTER (decided = 'allow') AS a, count(*) FILTER (decided = 'block') AS r FROM stepped
  WHERE calibrates AND decided IS NOT NULL GROUP BY step
), gains AS (
  SELECT step, sum(a) OVER () AS all_a, sum(r) OVER () AS all_r,
         coalesce(lag(step) OVER (ORDER BY step), step) AS before,
         (sum(r) OVER (ORDER BY step) - r) * sum(a) OVER () - (sum(a) OVER (ORDER BY step) - a) * sum(r) OVER () AS gain FROM kinds
), threshold AS (
  SELECT coalesce((SELECT CAST(floor((step + before) / 2) AS BIGINT) FROM gains WHERE all_a > 0 AND all_r > 0 ORDER BY gain DESC, step LIMIT 1), 0) AS t
)
SELECT page_id, page.host, page.path, rule, coalesce(decided, CASE WHEN step >= t THEN 'allow' ELSE 'block' END) AS verdict, llr
FROM page JOIN stepped USING (host, path), threshold
"""


def _middle_sql() -> str:
    p, s, m = middle.PREFIX, middle.SUFFIX, middle.MIDDLE
    draws = ", ".join(f"CAST('0x' || digest[{8 * k + 1}:{8 * k + 8}] AS BIGINT) AS h{k + 1}" for k in range(4))
    return f"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{middle.SEED}:' || doc_id) AS digest FROM documents
), split AS (
  SELECT doc_id, text, {draws}, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units FROM drawn
), cut AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}')
                OR h3 % 100 >= {middle.FIM_RATE} THEN 'plain'
              WHEN h4 % 100 < {middle.SPM_RATE} THEN 'spm' ELSE 'psm' END AS form
  FROM split
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{p}' || prefix || '{s}' || suffix || '{m}' || middle
              ELSE '{s}' || suffix || '{p}' || prefix || '{m}' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def _audit_sql() -> str:
    letters = ", ".join(f"('{f}')" for f in filter_audit.FILTERS)
    return f"""
WITH split AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), failing AS (
  SELECT doc_id, part, [f for f in [
    CASE WHEN len(w) < {filter_audit.MIN_WORDS} THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(w)) < {filter_audit.MIN_DISTINCT_PERCENT} * len(w) THEN 'B' END,
    CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {filter_audit.MAX_CAPITAL_PERCENT} * length(text) THEN 'C' END,
    CASE WHEN regexp_matches(text, '[{filter_audit.SYMBOLS}]') THEN 'D' END,
    CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 'E' END] if f IS NOT NULL] AS fails
  FROM split
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), combination AS (
  SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
  FROM failing LEFT JOIN known USING (doc_id) GROUP BY ALL
), letter(f) AS (VALUES {letters}
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, filter_order[k:k] AS f, string_split(filter_order[1:k - 1], '') AS before
  FROM orders, range(1, 6) AS r(k)
), judged AS (
  SELECT part, filter_order, step, f, list_contains(fails, f) AS failed, len(fails) = 1 AND list_contains(fails, f) AS only_f,
         list_has_any(fails, before) AS gone, good, toxic, n
  FROM combination, steps
), counted AS (
  SELECT part, filter_order, step, f,
         CAST(coalesce(sum(n) FILTER (NOT gone AND NOT failed), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (NOT gone AND failed), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (gone AND failed), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (only_f), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(n) FILTER (NOT gone AND failed AND good = 1), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(n) FILTER (NOT gone AND failed AND toxic = 1), 0) AS BIGINT) AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT * EXCLUDE (f), CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM counted
"""


ORACLES: dict[str, str] = {
    "op4_url_filters": _url_sql(),
    "op6_substring_dedup": _SUBSTRING,
    "op7_quality_rules": _quality_sql(),
    "op10_ngram_jaccard_join": _NGRAM_JOIN,
    "op12_fill_in_middle": _middle_sql(),
    "op13_filter_audit": _audit_sql(),
}
