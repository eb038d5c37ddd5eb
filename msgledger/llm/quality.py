"""Quality rules with thresholds learned per language and source.

Counts are taken from each whole text. Texts that pass the fixed base rules feed one quantile
sketch per (lang, source, measure): a log-linear histogram of whole numbers, whose bins are six
significant bits wide. Sketches merge by adding bin counts, so they are built with map-side
combine and do not depend on order. Every group's sketch gets its language's added, scaled to a
fixed number of rows: a small group follows its language, a large one itself, and no size is a
switch. A fence lies beyond the group's outer quartile by the quartile's distance from the
median, so a source's style moves it; but not further from the median, or from the medians of
the language's sources, than a second fence allows, so junk inside a source does not. Fences
are joined back to the rows.
"""
from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from msgledger.llm.common import small_batches, stage_table

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
# Blanks that end a word, and the characters counted as symbols.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Fence:
    """How far a measure may lie beyond its group's outer quartile (``spread`` times the quartile's
    distance from the median, plus ``slack``), and at ``most`` beyond the group's median or the outer
    quartile of the medians of the language's sources, with its spread."""

    spread: int
    slack: int
    most: int
    lower: bool = False


# Measures are whole numbers: shares in 1/10,000, word length in 1/100 characters.
FENCES: Mapping[str, Fence] = {
    "symbol_share": Fence(3, 500, 1000),
    "word_length": Fence(4, 200, 400, lower=True),
    "dup_line_share": Fence(3, 400, 800),
    "repeat_share": Fence(3, 3500, 4200),
}
MIN_ROWS = 50  # what a language's sketch counts for in each of its groups
UNIT = 1_000_000
SMALL_GROUPS = 100_000


def counts_of(text: str | None) -> tuple[int, int, int, int, int]:
    """The five counts of one text; null and empty texts have none."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    seen, again = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            again += 1
        elif line.strip():
            seen.add(line)
    return len(words), chars, symbols, again, _repeated(words)


def _repeated(words: list[bytes]) -> int:
    """Words inside a window of three that occurs twice or more."""
    first: dict[tuple, int] = {}
    marks = set()
    for at, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
        was = first.setdefault(window, at)
        if was != at:
            marks.update((was, was + 1, was + 2, at, at + 1, at + 2))
    return len(marks)


@F.pandas_udf(COUNTS_TYPE)
def _counts(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([counts_of(t) for t in text], columns=list(COUNTS))


def base_failed(q: str = "") -> Column:
    """Fewer than 50 words, or more than half of the words in repeated windows."""
    return (F.col(f"{q}n_words") < 50) | (100 * F.col(f"{q}n_repeat_words") > 50 * F.col(f"{q}n_words"))


def measures(q: str = "") -> dict[str, Column]:
    def ratio(top: str, below: str, scale: int) -> Column:
        return F.expr(f"coalesce(({q}{top} * {scale}) div nullif({q}{below}, 0), 0)")

    return {
        "symbol_share": ratio("n_symbols", "word_chars", 10_000),
        "word_length": ratio("word_chars", "n_words", 100),
        "dup_line_share": ratio("n_dup_lines", "n_words", 10_000),
        "repeat_share": ratio("n_repeat_words", "n_words", 10_000),
    }


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n) from rows with lang, source and one column per measure."""
    long = rows.select("lang", "source", F.explode(F.create_map(
        *[x for m in FENCES for x in (F.lit(m), F.col(m))])).alias("measure", "v"))
    shift = "greatest(length(bin(v)) - 6, 0)"
    low = F.expr(f"shiftleft(shiftright(v, {shift}), {shift})")
    return long.withColumn("bin", low).groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))


def _quartiles(sketch: DataFrame, keys: list[str], names: str) -> DataFrame:
    """Lower quartile, median and upper quartile of each sketch (bin, w) as <names>1 to <names>3; a sketch has a bounded number of bins."""
    group = Window.partitionBy(*keys, "measure")
    seen = sketch.withColumn("upto", F.sum("w").over(group.orderBy("bin"))).withColumn("all", F.sum("w").over(group))
    return seen.groupBy(*keys, "measure").agg(*[
        F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("bin"))).alias(f"{names}{k}") for k in (1, 2, 3)])


def _blended(sketch: DataFrame, rows: int) -> DataFrame:
    """Each group's sketch with its language's added, scaled to so many rows; weights in 1/UNIT rows."""
    by_lang = sketch.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n"))
    every = F.sum("n").over(Window.partitionBy("lang", "measure"))
    scaled = by_lang.withColumn("all", every).select(
        F.col("lang").alias("l"), F.col("measure").alias("m"), "bin", F.expr(f"cast(n AS decimal(20,0)) * {rows * UNIT} div all").alias("w"))
    groups = sketch.select("lang", "source", "measure").distinct()
    lent = groups.join(scaled, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("m"))).select("lang", "source", "measure", "bin", "w")
    own = sketch.select("lang", "source", "measure", "bin", (F.col("n") * UNIT).alias("w"))
    return own.unionByName(lent).groupBy("lang", "source", "measure", "bin").agg(F.sum("w").alias("w"))


def thresholds(sketch: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per (lang, source): ``lo_<measure>`` and ``hi_<measure>``, null where unbounded.

    ``min_rows`` is how many rows the language's sketch counts for in every group.
    """
    own = stage_table(_quartiles(_blended(sketch, min_rows), ["lang", "source"], "q"), "quality-quartiles")
    # One vote per source: the quartiles of the sources' medians.
    medians = own.groupBy("lang", "measure", F.col("q2").alias("bin")).agg(F.count("*").alias("w"))
    votes = _quartiles(medians, ["lang"], "m").withColumnsRenamed({"lang": "l", "measure": "of"})
    got = own.join(votes, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("of")))
    out = []
    for m, f in FENCES.items():
        mine = F.col("measure") == m
        hi = F.least(F.expr(f"q3 + {f.spread} * (q3 - q2) + {f.slack}"), F.expr(f"greatest(m3 + {f.spread} * (m3 - m2), q2) + {f.most}"))
        out.append(F.max(F.when(mine, hi)).alias(f"hi_{m}"))
        if f.lower:
            lo = F.greatest(F.expr(f"q1 - {f.spread} * (q2 - q1) - {f.slack}"), F.expr(f"least(m1 - {f.spread} * (m2 - m1), q2) - {f.most}"))
            out.append(F.max(F.when(mine, lo)).alias(f"lo_{m}"))
    return got.groupBy(F.col("lang").alias("t_lang"), F.col("source").alias("t_source")).agg(*out)


def with_thresholds(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Join each row with its group's limits; the limits are broadcast if counted as few."""
    if limits.limit(SMALL_GROUPS + 1).count() <= SMALL_GROUPS:
        limits = F.broadcast(limits)
    on = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    return rows.join(limits, on, "left").drop("t_lang", "t_source")


def verdict(q: str = "") -> Column:
    """Inside all fences; a row without limits (no text of its group passed the base) stays out
    by the base rules anyway."""
    ok = ~base_failed(q)
    for m, value in measures(q).items():
        ok = ok & (value <= F.coalesce(F.col(f"hi_{m}"), value))
        if FENCES[m].lower:
            ok = ok & (value >= F.coalesce(F.col(f"lo_{m}"), value))
    return ok


def learn(rows: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Limits from rows that have lang, source and the counts; only base-passing rows count."""
    passing = rows.where(~base_failed()).select("lang", "source", *[v.alias(m) for m, v in measures().items()])
    return stage_table(thresholds(stage_table(sketches(passing), "quality-sketch"), min_rows), "quality-limits")


def score(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """doc_id, the counts, ``base_failed`` and ``kept`` for every row of ``docs``.

    Needs doc_id, text, lang and source; other columns are ignored, whatever their names.
    Null and empty texts have no words and fail the base rules. Null lang or source is a group
    of its own. Repeated rows are judged one by one; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    counted = stage_table(docs.select("doc_id", "lang", "source", _counts("text").alias("c"))
                          .select("doc_id", "lang", "source", "c.*"), "quality-counts")
    judged = with_thresholds(counted, learn(counted, min_rows))
    return judged.select("doc_id", *COUNTS, base_failed().alias("base_failed"),
                         verdict().alias("kept"))


def keep_good(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, with their own columns.

    Counts are taken twice, once for the sketches and once for the filter, so that texts are
    neither shuffled nor written.
    """
    small_batches(docs.sparkSession)
    q = "__quality"
    limits = learn(docs.select("lang", "source", _counts("text").alias(q)).select("lang", "source", f"{q}.*"), min_rows)
    limits = limits.select(F.struct(*[c for c in limits.columns]).alias("__limits"))
    if limits.limit(SMALL_GROUPS + 1).count() <= SMALL_GROUPS:
        limits = F.broadcast(limits)
    rows = docs.withColumn(q, F.struct("lang", "source", _counts("text").alias("c")))
    on = F.col(f"{q}.lang").eqNullSafe(F.col("__limits.t_lang")) & F.col(f"{q}.source").eqNullSafe(F.col("__limits.t_source"))
    ok = ~base_failed(f"{q}.c.")
    for m, value in measures(f"{q}.c.").items():
        ok = ok & (value <= F.coalesce(F.col(f"__limits.hi_{m}"), value))
        if FENCES[m].lower:
            ok = ok & (value >= F.coalesce(F.col(f"__limits.lo_{m}"), value))
    return rows.join(limits, on, "left").where(ok).select(*docs.columns)
