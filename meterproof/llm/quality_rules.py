"""Quality rules with thresholds that adapt to each language and source.

Every text is measured once (`measures`). A histogram of each rate is the sketch: counts of bins,
which merge by addition, in any order, with an error of one bin. Bins are one unit wide below EXACT
and widen with the value above, without an upper end; verdicts compare the rate itself. The
sketches of a language's sources merge into the language's, those of languages into one for
all. A fence lies beyond a group's upper decile by a multiple of the decile's distance to the
third quartile (from the outer edges of their bins, so one bin at least), the low one likewise below; for rates that are zero almost
everywhere the quantiles are those of the documents that have any. Where quartiles coincide the deciles
still move it. A group's fence is the mean of its own and that of the next larger group,
weighed by its documents against SHRINK: small groups lean on the larger one, large ones stand alone.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterproof.llm.common import in_arrow, split_join, stored

# Words, symbols and window length of the contract.
WORD = re.compile("[^\x20\x09-\x0D]+")
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Documents that the next larger group's fence counts for.
SHRINK = 100
#: Per rate: how many distances its fences lie beyond the deciles. Rates are thousandths, word length is in tenths.
RATES = {"symbol_rate": 5, "word_length": 6, "dup_line_rate": 4, "repeat_rate": 3, "stutter_rate": 10}
#: Rates whose quantiles are those of documents above zero: most texts have none of what they count.
SPARSE = ("dup_line_rate", "repeat_rate")
#: Standard deviations of a count that a text may lie beyond a fence.
DEVIATIONS = 3
#: Bits of a rate that its bin keeps: below EXACT bins are exact, above their width is under 1/512 of the value.
BITS = 10
EXACT = 1 << BITS
TWO_SIDED = ("word_length",)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutters")


def repeated_words(words: list) -> int:
    """Words inside windows of WINDOW words that the list holds twice or more, first included.

    Windows are numbered by doubling: pairs of equal numbers get one number, then pairs of
    pairs; equality is exact, and the work ends as soon as no two windows are alike.
    """
    if len(words) <= WINDOW:
        return 0
    seen: dict = {}
    code = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    step = 1
    while True:
        paired, code, often = np.unique((code[:-step] << 32) | code[step:], return_inverse=True, return_counts=True)
        step *= 2
        if len(paired) == len(code):
            return 0
        if step == WINDOW:
            break
    starts = np.flatnonzero(often[code] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines), len(lines) - len(set(lines))


def stutters(words: list) -> int:
    """Words equal to the word before them."""
    return sum(map(operator.eq, words, words[1:]))


def measure(text: str | None) -> tuple[int, ...]:
    """COUNTS of one whole text; NULL has none of anything."""
    if not text:
        return (0,) * len(COUNTS)
    words = WORD.findall(text)
    lines, repeated = duplicate_lines(text)
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), lines, repeated, repeated_words(words), stutters(words))


def _measuring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = np.array([measure(t) for t in batch.column(3).to_pylist()], np.int64).reshape(-1, len(COUNTS))
        columns = [pa.array(c, pa.int64()) for c in counts.T.copy()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["id", "lang", "source", *COUNTS])


def measures(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document: id, lang, source and COUNTS of the whole text."""
    rows = docs.select(F.col(doc_id).alias("id"), "lang", "source", "text")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "lang", "source"))
    return in_arrow(rows, _measuring, f"{kinds}, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    """Fixed values of the contract: fewer than 20 words, or more than 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


#: Per rate: what it counts, what that is measured against, and its unit.
PARTS = {
    "symbol_rate": ("n_symbols", "word_chars", 1000),
    "word_length": ("word_chars", "n_words", 10),
    "dup_line_rate": ("n_dup_lines", "n_lines", 1000),
    "repeat_rate": ("n_repeat_words", "n_words", 1000),
    "stutter_rate": ("n_stutters", "n_words", 1000),
}


def _rate(name: str) -> Column:
    over, under, scale = PARTS[name]
    return F.expr(f"{over} * {scale} div {under}")


def _too_high(name: str) -> Column:
    """Whether a document lies beyond its group's high fence. Of what is counted, a short text may
    have as many as DEVIATIONS standard deviations of a Poisson count more than the fence says."""
    over, under, scale = PARTS[name]
    high = F.col(f"{name}_high")
    if name in TWO_SIDED:
        return _rate(name) > high
    allowed = high.cast("double") * F.col(under)
    excess = F.col(over).cast("double") * scale - allowed
    return (excess > 0) & (excess * excess > allowed * (DEVIATIONS * DEVIATIONS * scale))


def _width(rate: Column) -> Column:
    """Width of the bin that holds a rate: a power of two, so that bins do not overlap."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(rate)) - BITS, F.lit(0)))


def sketches(measured: DataFrame) -> DataFrame:
    """Sketch of each rate per language and source: (lang, source, rate, bin, n); a bin goes by its
    least rate. Documents that the base rules reject say nothing about the others of their group."""
    with_words = measured.where(~base_failed())
    rates = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), (_rate(r) - _rate(r) % _width(_rate(r))).alias("bin")) for r in RATES]))
    return (
        with_words.select("lang", "source", rates.alias("r"))
        .groupBy("lang", "source", "r.rate", "r.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of finer groups added up to those of `keys`."""
    return sketch.groupBy(*keys, "rate", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and rate: its documents (those above zero for SPARSE rates), low and high fence."""
    by = [*keys, "rate"]
    counted = sketch.where(~F.col("rate").isin(*SPARSE) | (F.col("bin") > 0))
    upto = Window.partitionBy(*by).orderBy("bin")
    ranked = counted.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy(*by)))

    def quantile(percent: int) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("all") * percent, F.col("bin")))

    found = ranked.groupBy(*by).agg(F.max("all").alias("docs"), *[quantile(q).alias(f"q{q}") for q in (10, 25, 75, 90)])
    edge = {q: F.col(f"q{q}") + _width(F.col(f"q{q}")) for q in (25, 90)}
    times = F.element_at(F.create_map(*[F.lit(x) for r in RATES.items() for x in r]), F.col("rate"))
    return found.select(
        *by, "docs",
        (F.col("q10") - (edge[25] - F.col("q10")) * times).alias("low"),
        (edge[90] - 1 + (edge[90] - F.col("q75")) * times).alias("high"),
    )


def thresholds(sketch: DataFrame, shrink: int = SHRINK) -> DataFrame:
    """Fences of every language and source (lang, source, docs and, per rate, rate_low and rate_high), each leaning
    on its language's, and that on the one of all, by its size. A rate that nobody has is not fenced (NULL)."""
    sketch = stored(sketch, "sketch")
    groups = sketch.where(F.col("rate") == next(iter(RATES))).groupBy("lang", "source").agg(F.sum("n").alias("docs"))
    # One row per language, source and rate; rates that a group lacks lean on the next larger group alone.
    every = groups.withColumn("rate", F.explode(F.array(*map(F.lit, RATES))))
    renamed = lambda df, tag: df.select(*[F.col(c).alias(f"{tag}_{c}") for c in df.columns])
    own, language, world = (renamed(fences(merged(sketch, k), k), tag) for k, tag in ((["lang", "source"], "own"), (["lang"], "mid"), ([], "all")))
    joined = every.join(own, F.col("lang").eqNullSafe(F.col("own_lang")) & F.col("source").eqNullSafe(F.col("own_source")) & (F.col("rate") == F.col("own_rate")), "left")
    joined = joined.join(language, F.col("lang").eqNullSafe(F.col("mid_lang")) & (F.col("rate") == F.col("mid_rate")), "left")
    # At most one row per rate.
    joined = joined.join(F.broadcast(world), F.col("rate") == F.col("all_rate"), "left")

    def leaning(tag: str, side: str, larger: Column) -> Column:
        n = F.coalesce(f"{tag}_docs", F.lit(0))
        total = (n * F.coalesce(f"{tag}_{side}", F.lit(0)) + shrink * larger).cast("long")
        return ((total - F.pmod(total, n + shrink)) / (n + shrink)).cast("long")  # rounded down, exactly

    sides = {side: leaning("own", side, leaning("mid", side, F.col(f"all_{side}"))) for side in ("low", "high")}
    wide = [
        F.max(F.when(F.col("rate") == r, F.col(side))).alias(f"{r}_{side}")
        for r in RATES
        for side in (("low", "high") if r in TWO_SIDED else ("high",))
    ]
    return joined.select("lang", "source", "docs", "rate", *[v.alias(k) for k, v in sides.items()]).groupBy("lang", "source").agg(F.max("docs").alias("docs"), *wide)


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", shrink: int = SHRINK) -> DataFrame:
    """Per row of `docs`: its id, the COUNTS, base_failed and kept.

    base_failed: fewer than 20 words, or more than 30 % of the words in repeated windows. A
    document is kept when it has not failed there and every rate lies within its group's
    fences, up to the chance of a short text's counts. NULL and empty texts have no words and fail; a NULL language or source is a group
    of its own; repeated rows are judged and counted each; columns besides id, lang, source
    and text are not read; an empty table gives an empty result.
    """
    measured = stored(measures(docs, doc_id), "measures")
    limits = thresholds(sketches(measured), shrink)
    failed = base_failed()
    within = F.lit(True)
    for r in RATES:
        within = within & F.coalesce(~_too_high(r), F.lit(True))
        if r in TWO_SIDED:
            within = within & (_rate(r) >= F.col(f"{r}_low"))
    fit = split_join(measured.where(~failed), stored(limits, "limits"), ["lang", "source"], "docs")
    judged = fit.select("id", *COUNTS, F.lit(False).alias("base_failed"), within.alias("kept"))
    rest = measured.where(failed).select("id", *COUNTS, F.lit(True).alias("base_failed"), F.lit(False).alias("kept"))
    return judged.unionByName(rest).withColumnRenamed("id", doc_id)
