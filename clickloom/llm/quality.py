"""Quality rules: thresholds read from mergeable quantile sketches per language and source.

Every document gets a few whole-number measures.  Per (language, source) and
measure, a sketch of log-linear buckets (32 for each power of two, so a value
is known to 1/32) counts them; counts merge by addition, so groups too small to
judge by themselves borrow the sketch of their language, and small languages that
of the corpus.  Fences read from the sketches are joined back to the documents.

Everything is built-in Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import let, words, written

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Groups with fewer documents that pass the base rules use the next larger group's sketch.
MIN_GROUP = 200
#: A fence stands this many quartile ranges outside the quartiles, ``slack`` at least.
REACH = 4
SLACK = {"word_length": 2500, "symbols": 100, "dup_lines": 500}
MEASURES = tuple(SLACK)


def _repeat_words(found: Column) -> Column:
    """Words covered by windows of 8 words that occur twice or more in the array ``found``.

    Windows are compared by a 64-bit hash of the words' 64-bit hashes, within one document.
    """

    def covered(hashes: Column) -> Column:  # hashes: of the windows, in order
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(ordered: Column) -> Column:
            last = F.size(ordered) - 1
            twins = F.filter(
                ordered,
                lambda e, k: ((k > 0) & (ordered[F.greatest(k - 1, F.lit(0))]["h"] == e["h"]))
                | ((k < last) & (ordered[F.least(k + 1, last)]["h"] == e["h"])),
            )
            return F.sort_array(F.transform(twins, lambda e: e["i"]))

        return F.aggregate(
            let(pairs, starts),
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("total")),
            lambda acc, at: F.struct(
                at.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("total")
            ),
            lambda acc: acc["total"],
        )

    def joined(parts: Column, gap: int) -> Column:
        """Hash of each part with the one ``gap`` further on."""
        return F.transform(
            F.slice(parts, F.lit(1), F.size(parts) - gap), lambda x, i: F.xxhash64(x, parts[i + gap])
        )

    zero = F.lit(0).cast("bigint")
    fours = let(joined(found, 1), lambda h: joined(h, 2))  # most texts repeat no four words: done
    count = let(
        fours,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(
            let(joined(h, 4), covered)
        ),
    )
    return F.when(F.size(found) <= WINDOW, zero).otherwise(count)


def base_measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the whole-text counts of every document.

    Null text counts as empty; null lang or source as ''.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return docs.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        let(
            words(text),
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.aggregate(w, F.lit(0), lambda n, x: n + F.length(x)).cast("bigint").alias("word_chars"),
                _repeat_words(w).alias("n_repeat_words"),
            ),
        ).alias("w"),
        F.when(text.rlike(r"[#*$%&|<>]"), symbols).otherwise(0).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        let(lines, lambda x: F.size(x)).cast("bigint").alias("n_lines"),
    ).select(
        "doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines",
        "w.n_repeat_words", "n_lines",
        ((F.col("w.n_words") < MIN_WORDS)
         | (100 * F.col("w.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("w.n_words"))).alias("base_failed"),
    )


#: Measure -> thousandths of the first count in the second.
RATIOS = {
    "word_length": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
}


def _ratio(measure: str) -> Column:
    count, of = RATIOS[measure]
    return F.expr(f"1000 * {count} div greatest({of}, 1)")


def _bucket(value: str) -> Column:
    """Bucket of a whole number from 0: itself below 64, then 32 to each power of two."""
    shift = f"(length(bin({value})) - 6)"
    return F.expr(
        f"if({value} < 64, {value}, cast(32 * {shift} + shiftright({value}, {shift}) as bigint))"
    )


def _bucket_floor(bucket: str) -> Column:
    """Smallest value in a bucket."""
    shift = f"(cast({bucket} div 32 as int) - 1)"
    return F.expr(
        f"if({bucket} < 64, {bucket}, shiftleft(cast({bucket} - 32 * {shift} as bigint), {shift}))"
    )


def sketches(measured: DataFrame) -> DataFrame:
    """Bucket counts per level, language, source and measure, over documents that pass the base rules.

    Level 2 is (language, source), level 1 the language, level 0 everything; the
    larger levels are sums of the smaller ones' buckets.
    """
    entries = F.array(*(F.struct(F.lit(m).alias("measure"), _ratio(m).alias("value")) for m in MEASURES))
    smallest = (
        measured.where(~F.col("base_failed"))
        .select("lang", "source", F.explode(entries).alias("e"))
        .select("lang", "source", "e.measure", _bucket("e.value").alias("bucket"))
        .groupBy("lang", "source", "measure", "bucket")
        .agg(F.count("*").alias("n"))
    )
    levels = F.expr(
        "array(struct(2 as level, lang as lang, source as source),"
        " struct(1 as level, lang as lang, '' as source), struct(0 as level, '' as lang, '' as source))"
    )
    return (
        smallest.select(F.explode(levels).alias("g"), "measure", "bucket", "n")
        .groupBy("g.level", "g.lang", "g.source", "measure", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def fences(counts: DataFrame) -> DataFrame:
    """Per (lang, source): the lowest and highest value of each measure that is kept."""
    group = Window.partitionBy("level", "lang", "source", "measure")
    reached = counts.select(
        "*",
        F.sum("n").over(group.orderBy("bucket")).alias("up_to"),
        F.sum("n").over(group).alias("total"),
    ).groupBy("level", "lang", "source", "measure").agg(
        F.max("total").alias("total"),
        F.min(F.when(F.expr("100 * up_to >= 25 * total"), F.col("bucket"))).alias("b25"),
        F.min(F.when(F.expr("100 * up_to >= 75 * total"), F.col("bucket"))).alias("b75"),
    )
    slack = F.element_at(F.create_map(*(F.lit(x) for kv in SLACK.items() for x in kv)), F.col("measure"))
    spread = F.greatest(REACH * (F.col("q75") - F.col("q25")), slack)
    per_measure = reached.select(
        "level", "lang", "source", "measure", "total", _bucket_floor("b25").alias("q25"), _bucket_floor("b75").alias("q75")
    ).select(
        "level", "lang", "source", "total", "measure",
        F.when(F.col("measure") == "word_length", F.col("q25") - spread).alias("low"),
        (F.col("q75") + spread).alias("high"),
    )
    wide = per_measure.groupBy("level", "lang", "source").agg(
        F.max("total").alias("total"),
        *(
            F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{side}_{m}")
            for m in MEASURES
            for side in ("low", "high")
        ),
    )
    bounds = F.struct(*(f"{side}_{m}" for m in MEASURES for side in ("low", "high"))).alias("bounds")
    wide = wide.select("level", "lang", "source", "total", bounds)
    sizes = wide.where("level = 2").select("lang", "source", F.col("total").alias("n2"))
    of_lang = wide.where("level = 1").select("lang", F.col("total").alias("n1"))
    level = F.when(F.col("n2") >= MIN_GROUP, 2).when(F.col("n1") >= MIN_GROUP, 1).otherwise(0)
    used = sizes.join(of_lang, "lang").select("lang", "source", level.alias("level"))
    used = used.select(
        "*",
        F.when(F.col("level") > 0, F.col("lang")).otherwise("").alias("_lang"),
        F.when(F.col("level") == 2, F.col("source")).otherwise("").alias("_source"),
    )
    borrowed = wide.select(
        "level", F.col("lang").alias("_lang"), F.col("source").alias("_source"), "bounds"
    )
    return used.join(borrowed, ["level", "_lang", "_source"]).select("lang", "source", "bounds")


def judged(docs: DataFrame) -> DataFrame:
    """Every document's measures with ``base_failed`` and ``kept``; other columns of ``docs`` are not read.

    A document that fails the base rules is not kept; any other is kept if each
    of its measures lies within the fences of its language and source.  Repeated
    rows are judged one by one and all returned; an empty table gives an empty one.
    """
    measured = written(base_measures(docs), "quality")
    limits = fences(sketches(measured))
    inside = F.lit(True)
    for m in MEASURES:
        inside &= _ratio(m) <= F.col(f"bounds.high_{m}")
    inside &= _ratio("word_length") >= F.col("bounds.low_word_length")
    return measured.join(limits, ["lang", "source"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is kept, all columns as they were.

    Rows that share a doc_id stay together: all stay if one of them is kept.
    """
    kept = judged(docs).where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"]), "left_semi")
