"""URL filters: host and path rules, and a character language-model ratio for what no rule decides.

Urls that rules allow or block teach two variable-order Markov models of host and
path: a character's probability after the longest context seen (up to three
characters) is smoothed with that after the next shorter one, down to a uniform
one.  An undecided url is allowed if its log-likelihood difference for each character
reaches a threshold calibrated on decided urls that the models have not seen.

All of it is DataFrame operations.  Log-likelihoods are whole millionths, so sums
do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import lower_ascii, small, written

#: (verdict, host and path), for the registered query.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
PRIOR = 4.0
CHARACTERS = 256
#: Of the distinct decided urls, those whose md5 begins with one of these calibrate, the others teach.
CALIBRATING = ("0", "1", "2")
#: Scores are calibrated in steps of so many millionths.
STEP = 1000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.when(has, lower_ascii(F.regexp_extract(after, r"^[^/?#]*", 0))).otherwise("")
    path = F.when(has, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def matched(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Verdict and text of the longest rule that fits; null if none does."""
    verdict, text = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # longer ones tested first
        at, slash, under = rule.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(slash + under)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
        text = F.when(fits, F.lit(rule)).otherwise(text)
    return verdict, text


def _sums(rows: DataFrame, key: str, begin: int, length: int) -> DataFrame:
    return rows.groupBy(F.substring("gram", begin, length).alias(key)).agg(
        F.sum("a").alias("a"), F.sum("r").alias("r")
    )


def gram_scores(grams: DataFrame) -> DataFrame:
    """(gram, llr) from (gram, a, r): four characters, and how often accepted and rejected urls have them.

    ``llr`` is the log of the ratio of the last character's two probabilities, in millionths.
    """
    grams = grams.select("gram", F.col("a").cast("double"), F.col("r").cast("double"))
    totals = grams.agg(F.coalesce(F.sum("a"), F.lit(0.0)), F.coalesce(F.sum("r"), F.lit(0.0))).first()
    uniform = PRIOR / CHARACTERS
    level = _sums(grams, "gram", 4, 1).select(
        "gram",
        ((F.col("a") + uniform) / (totals[0] + PRIOR)).alias("pa"),
        ((F.col("r") + uniform) / (totals[1] + PRIOR)).alias("pr"),
    )
    for length in (2, 3, 4):
        own = _sums(grams, "gram", 5 - length, length)
        context = _sums(own, "context", 1, length - 1).select(
            "context", F.col("a").alias("ca"), F.col("r").alias("cr")
        )
        shorter = level.select(F.col("gram").alias("end"), "pa", "pr")
        level = (
            own.withColumn("context", F.substring("gram", 1, length - 1))
            .withColumn("end", F.substring("gram", 2, length - 1))
            .join(context, "context")
            .join(shorter, "end")
            .select(
                "gram",
                ((F.col("a") + PRIOR * F.col("pa")) / (F.col("ca") + PRIOR)).alias("pa"),
                ((F.col("r") + PRIOR * F.col("pr")) / (F.col("cr") + PRIOR)).alias("pr"),
            )
        )
    llr = F.floor((F.log("pa") - F.log("pr")) * 1_000_000 + 0.5).cast("bigint")
    return level.select("gram", llr.alias("llr"))


def _threshold(scored: DataFrame) -> int:
    """The step from which on calibrating urls are best called accepted: most of both kinds right, on average.

    Halfway from the step before, as nothing is known in between.
    """
    kinds = scored.where("calibrates").groupBy("step").agg(
        F.count_if(F.col("decided") == "allow").alias("a"), F.count_if(F.col("decided") == "block").alias("r")
    )
    steps = kinds.where("a + r > 0")  # one row for each step, however many urls
    everything = Window.partitionBy()
    below = everything.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    right = steps.select(
        "step",
        F.sum("a").over(everything).alias("all_a"),
        F.sum("r").over(everything).alias("all_r"),
        F.coalesce(F.sum("a").over(below), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("r").over(below), F.lit(0)).alias("caught"),
        F.coalesce(F.max("step").over(below), F.col("step")).alias("before"),
    ).where("all_a > 0 and all_r > 0")
    gain = F.col("caught") * F.col("all_a") - F.col("lost") * F.col("all_r")
    best = right.orderBy(gain.desc(), "step").select("step", "before").first()
    return (best["step"] + best["before"]) // 2 if best else 0


def filtered(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and verdict for every row, with ``llr`` (millionths per character).

    Urls that are null or have no ``://`` have an empty host and path, fit no rule
    and are scored as the empty string.  Equal urls get equal verdicts.  Where the
    rules decide nothing of one kind, or nothing is left to calibrate, the threshold is 0.
    """
    host, path = host_and_path(F.col("url"))
    read = pages.select("page_id", host.alias("host"), path.alias("path"))
    decided, rule = matched(F.col("host"), F.col("path"), rules)
    site = F.concat("host", "path")
    sites = written(
        read.select("host", "path").distinct().select(
            "host", "path", decided.alias("decided"), rule.alias("rule"), F.concat(F.lit("^^^"), site, F.lit("$")).alias("s"),
            F.substring(F.md5(site.cast("binary")), 1, 1).isin(*CALIBRATING).alias("calibrates"),
        ),
        "sites",
    )
    positions = sites.select(
        "host", "path", "decided", "calibrates",
        F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 3), lambda i: F.substr(F.col("s"), i, F.lit(4)))).alias("gram"),
    )
    teaches = ~F.col("calibrates")
    grams = written(
        positions.groupBy("gram").agg(
            F.count_if(teaches & (F.col("decided") == "allow")).alias("a"),
            F.count_if(teaches & (F.col("decided") == "block")).alias("r"),
        ),
        "grams",
    )
    scores = written(gram_scores(grams), "gram-scores")
    scored = written(
        positions.join(small(scores), "gram")
        .groupBy("host", "path")
        .agg(F.floor(F.sum("llr") / F.count("*")).cast("bigint").alias("llr"))
        .join(sites.select("host", "path", "decided", "rule", "calibrates"), ["host", "path"])
        .withColumn("step", F.floor(F.col("llr") / STEP)),
        "scored-sites",
    )
    threshold = _threshold(scored)
    verdict = F.coalesce("decided", F.when(F.col("step") >= threshold, "allow").otherwise("block"))
    return read.join(scored.select("host", "path", "rule", "llr", verdict.alias("verdict")), ["host", "path"]).select(
        "page_id", "host", "path", "rule", "verdict", "llr"
    )
