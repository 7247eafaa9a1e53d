"""Quality rules with thresholds that adapt to language and source, by DataFrame expressions only.

Each document gets five measures in whole numbers: symbols, repeated lines and
repeated words per 1000, and the mean word length (per 1000), looked at from both
sides. A sketch of a measure is a table of counts over logarithmic buckets (exact
below 128, seven leading bits above, so a relative error below 1/64): sketches are
merged by adding counts, do not depend on the order of rows, and have a bounded
number of rows. From the sketch of a (language, source) group come the median and
the quartile on its clean side, and the threshold

    median +- reach * max(distance of that quartile from the median, floor)

which holds as long as less than half of a group is bad. A group of fewer than
``least_docs`` documents merges with those of its language, then with all.

Nulls: a null text has no words, so the base rule fails it. A null language or
source is a value of its own. Rows that repeat are judged alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.durable import checkpoint

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
LEAST_DOCS = 50
REACH = 6
BLANKS = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"

# Measure, its side (1: too much, -1: too little) and the least spread, per 1000.
MEASURES = (("symbols", 1, 8), ("dup_lines", 1, 60), ("repeat_words", 1, 25), ("long_words", 1, 400), ("short_words", -1, 250))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column, window: int) -> Column:
    """How many words lie in a run of ``window`` words that the text has twice or more."""
    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, j: F.when(j + 1 < F.size(at), F.least(F.lit(window), F.element_at(at, j + 2) - x)).otherwise(F.lit(window)))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def marked(runs: Column) -> Column:
        before = lambda e, j: F.when(j > 0, F.element_at(runs, j)["h"] == e["h"]).otherwise(False)
        after = lambda e, j: F.when(j + 2 <= F.size(runs), F.element_at(runs, j + 2)["h"] == e["h"]).otherwise(False)
        twin = lambda e, j: before(e, j) | after(e, j)
        return _let(F.sort_array(F.transform(F.filter(runs, twin), lambda e: e["i"])), covered)

    def searched(hashes: Column) -> Column:
        sorted_runs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(sorted_runs, marked))

    count = F.size(words) - (window - 1)
    hashes = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(words, i, window)))
    return F.when(count < 2, F.lit(0)).otherwise(_let(hashes, searched)).cast("bigint")


def base_measures(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.transform(F.filter(F.split(text, "\n"), lambda x: x.rlike(HAS_WORD)), lambda x: F.xxhash64(x))
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        _let(F.filter(F.split(text, BLANKS), lambda w: w != ""), lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("bigint"), lambda n, x: n + F.length(x)).alias("word_chars"),
            _repeated_words(w, window).alias("n_repeat_words"))).alias("_w"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        F.size(lines).cast("bigint").alias("n_lines"))
    rows = rows.select("doc_id", "lang", "source", "_w.n_words", "_w.word_chars", "n_symbols", "n_dup_lines", "n_lines", "_w.n_repeat_words")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _measures() -> dict[str, Column]:
    per = lambda a, b: F.when(F.col(b) > 0, F.floor(1000 * F.col(a) / F.col(b))).otherwise(0).cast("bigint")
    length = per("word_chars", "n_words")
    return {
        "symbols": per("n_symbols", "word_chars"), "dup_lines": per("n_dup_lines", "n_lines"), "repeat_words": per("n_repeat_words", "n_words"),
        "long_words": length, "short_words": length,
    }


def bucket(value: Column) -> Column:
    """The lower edge of the value's bucket."""
    step = F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - 7, F.lit(0))).cast("bigint")
    return value - value % step


def sketches(measured: DataFrame) -> DataFrame:
    """Counts per lang, source, measure and bucket."""
    names = [m for m, _, _ in MEASURES]
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in names])
    rows = measured.select("lang", "source", F.explode(pairs).alias("_p")).select("lang", "source", "_p.measure", "_p.bucket")
    return rows.groupBy("lang", "source", "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _quantiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and measure: number of documents, quartiles and median (lower edges of their buckets)."""
    merged = counts.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    own = Window.partitionBy(*keys, "measure")
    upto = F.sum("n").over(own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.withColumn("_upto", upto).withColumn("_all", F.sum("n").over(own))
    at = lambda q: F.min(F.when(4 * F.col("_upto") >= q * F.col("_all"), F.col("bucket")))
    return ranked.groupBy(*keys, "measure").agg(F.max("_all").alias("docs"), at(1).alias("q1"), at(2).alias("q2"), at(3).alias("q3"))


def thresholds(counts: DataFrame, least_docs: int = LEAST_DOCS, reach: int = REACH) -> DataFrame:
    """One row per (lang, source): ``max_...`` or ``min_...`` of each measure."""
    fine = _quantiles(counts, ["lang", "source"])
    middle = _quantiles(counts, ["lang"]).select(F.col("lang").alias("_l"), F.col("measure").alias("_m"), *[F.col(c).alias(f"l_{c}") for c in ("docs", "q1", "q2", "q3")])
    whole = _quantiles(counts, []).select(F.col("measure").alias("_w"), *[F.col(c).alias(f"w_{c}") for c in ("docs", "q1", "q2", "q3")])
    rows = fine.join(middle, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("measure") == F.col("_m"))).join(whole, F.col("measure") == F.col("_w"))
    pick = lambda c: F.when(F.col("docs") >= least_docs, F.col(c)).when(F.col("l_docs") >= least_docs, F.col(f"l_{c}")).otherwise(F.col(f"w_{c}"))
    limits = []
    for measure, side, floor in MEASURES:
        spread = pick("q2") - pick("q1") if side > 0 else pick("q3") - pick("q2")
        limit = pick("q2") + side * reach * F.greatest(spread, F.lit(floor))
        limits.append(F.max(F.when(F.col("measure") == measure, limit)).alias(f"limit_{measure}"))
    return rows.groupBy("lang", "source").agg(*limits)


def quality_rules(documents: DataFrame, least_docs: int = LEAST_DOCS, reach: int = REACH) -> DataFrame:
    """doc_id, the base measures, base_failed, kept."""
    measured = base_measures(documents)
    for name, value in _measures().items():
        measured = measured.withColumn(name, value)
    measured = checkpoint(measured)
    limits = checkpoint(thresholds(checkpoint(sketches(measured)), least_docs, reach))
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    good = F.lit(True)
    for measure, side, _ in MEASURES:
        good = good & (F.col(measure) <= F.col(f"limit_{measure}") if side > 0 else F.col(measure) >= F.col(f"limit_{measure}"))
    kept = ~F.col("base_failed") & F.coalesce(good, F.lit(True))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
