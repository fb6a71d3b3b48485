"""Quality classifier: random Fourier features, ridge from partition-summed normal equations,
isotonic calibration.

Each text becomes STATISTICS, which are standardised and mapped to cosines whose inner
products approximate a Gaussian kernel. Each partition adds up X'X and X'y of its labelled
rows; Spark sums these matrices, whose size depends on the number of features only, and the
driver solves one linear system. Scores of a fold kept aside are pooled into bins and made
monotone (pool adjacent violators). All labelled rows are used; there is no sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterproof.llm.common import in_arrow, ragged, stored
from meterproof.llm.quality_rules import BLANKS, SYMBOLS, WORD, duplicate_lines, repeated_words, stutters

STATISTICS = (
    "log_words", "word_length", "word_length_sd", "short_words", "distinct_words", "top_word", "symbols", "pipes", "upper", "digits",
    "shouts", "stops", "commas", "foreign", "dup_lines", "repeats", "line_words", "capital_words", "spaces", "stutters",
)
FEATURES = 256
SEED = 20260
#: Width of the Gaussian kernel on standardised statistics.
WIDTH = 4.0
RIDGE = 1e-3
CLIP = 6.0
BINS = 2000
THRESHOLD = 0.3
_UPPER, _DIGIT = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"[0-9]")


def statistics(text: str | None) -> list[float]:
    """STATISTICS of one whole text; zeros for NULL and empty."""
    if not text:
        return [0.0] * len(STATISTICS)
    words = WORD.findall(text)
    n, chars = max(1, len(words)), len(text)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    often: dict[str, int] = {}
    for word in words:
        often[word] = often.get(word, 0) + 1
    inked = max(1, int(sizes.sum()))
    lines, dup = duplicate_lines(text)
    return [
        float(np.log1p(len(words))), float(sizes.mean()), float(sizes.std()), float((sizes <= 3).mean()), len(often) / n, max(often.values(), default=0) / n,
        sum(map(text.count, SYMBOLS)) / inked, text.count("|") / n, len(_UPPER.findall(text)) / inked, len(_DIGIT.findall(text)) / inked,
        (text.count("!") + text.count("?")) / n, text.count(".") / n, text.count(",") / n, 1 - len(text.encode("ascii", "ignore")) / chars,
        dup / max(1, lines), repeated_words(words) / n, float(np.log1p(n / max(1, lines))), sum(w[0].isupper() for w in words) / n,
        sum(map(text.count, BLANKS)) / chars, stutters(words) / n,
    ]


def _measuring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([statistics(t) for t in batch.column(2).to_pylist()], np.float64).reshape(-1, len(STATISTICS))
        lists = ragged(rows.ravel(), np.full(len(rows), len(STATISTICS)), pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, batch.column(3)], ["id", "remainder", "stats", "hash"])


def document_statistics(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per row: id, remainder (crc32 of the id as text modulo 5; 4 for NULL), stats and hash (of the text)."""
    remainder = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(4)).cast("int")
    rows = docs.select(F.col(doc_id).alias("id"), remainder.alias("remainder"), "text", F.xxhash64("text").alias("hash"))
    kind = rows.schema["id"].dataType.simpleString()
    return in_arrow(rows, _measuring, f"id {kind}, remainder int, stats array<double>, hash long")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass(frozen=True)
class Kernel:
    """Map from statistics to random Fourier features, with a constant as the last one."""

    mean: np.ndarray
    spread: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(SEED)
        slopes = random.normal(size=(len(STATISTICS), FEATURES)) / WIDTH
        phases = random.uniform(0, 2 * np.pi, FEATURES)
        standard = np.clip((stats - self.mean) / self.spread, -CLIP, CLIP)
        waves = np.sqrt(2 / FEATURES) * np.cos(standard @ slopes + phases)
        return np.hstack([waves, np.ones((len(stats), 1))])


def _fit_kernel(labelled: DataFrame) -> Kernel:
    found = (
        labelled.select(F.posexplode("stats").alias("i", "v"))
        .groupBy("i")
        .agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("spread"))
        .collect()
    )
    mean, spread = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))
    for row in found:
        mean[row.i], spread[row.i] = row["mean"], max(row["spread"], 1e-6)
    return Kernel(mean, spread)


def _equations(kernel: Kernel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = FEATURES + 1
        total = np.zeros((width, width + 1))
        for batch in batches:
            x = kernel.features(matrix(batch.column(0), len(STATISTICS)))
            y = batch.column(1).to_numpy(zero_copy_only=False)
            total += x.T @ np.column_stack([x, y])
        if total[-1, -2]:
            lists = ragged(total.ravel(), np.full(width, width + 1), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), lists], ["i", "row"])

    return run


def _adding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows of each number; there are FEATURES + 1 numbers."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, row in zip(batch.column(0).to_pylist(), matrix(batch.column(1), FEATURES + 2)):
            totals[i] = totals[i] + row if i in totals else row.copy()
    if totals:
        lists = ragged(np.concatenate(list(totals.values())), np.full(len(totals), FEATURES + 2), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), lists], ["i", "row"])


def _fit_ridge(labelled: DataFrame, kernel: Kernel) -> np.ndarray:
    sums = in_arrow(labelled.select("stats", "quality"), _equations(kernel), "i int, row array<double>")
    rows = in_arrow(sums.repartition("i"), _adding, "i int, row array<double>").collect()
    width = FEATURES + 1
    total = np.zeros((width, width + 1))
    for row in rows:
        total[row.i] = row["row"]
    n = max(1.0, total[-1, -2])
    penalty = RIDGE * np.eye(width)
    penalty[-1, -1] = 1e-9  # the constant is not shrunk
    return np.linalg.solve(total[:, :-1] / n + penalty, total[:, -1] / n)


def monotone(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of sorted, weighted points: centres and values of the pooled blocks."""
    blocks: list[list[float]] = []
    for point in zip(x * n, y * n, n):
        blocks.append(list(point))
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _raw(kernel: Kernel, weights: np.ndarray, columns: int):
    """Scores from the last column's statistics; the columns before it pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = kernel.features(matrix(batch.column(columns), len(STATISTICS))) @ weights
            names = [*batch.schema.names[:columns], "raw"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:columns], pa.array(scores, pa.float64())], names)

    return run


def _fit_calibration(labelled: DataFrame, kernel: Kernel, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = in_arrow(labelled.select("quality", "stats"), _raw(kernel, weights, 1), "quality double, raw double")
    clipped = F.greatest(F.lit(-0.5), F.least(F.lit(1.5), F.col("raw")))
    bins = (
        raw.groupBy(F.floor((clipped + 0.5) * (BINS / 2)).alias("bin"))
        .agg(F.avg(clipped).alias("x"), F.avg("quality").alias("y"), F.count(F.lit(1)).alias("n"))
        .orderBy("bin")
        .collect()
    )
    if not bins:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return monotone(*(np.array([float(b[c]) for b in bins]) for c in ("x", "y", "n")))


def _means(labels: DataFrame) -> DataFrame:
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy(F.col("doc_id").alias("id")).agg(F.avg(F.col("quality").cast("double")).alias("quality"))


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of `docs`: its id, hash (of the text), held_out, score (0 to 1, higher: label 1 likelier), predicted.

    Learns from the labels of rows whose remainder is not 0: those of remainder 1 calibrate,
    the others fit. Several labels of one id count as their mean; NULL labels and ids do not
    count; without any usable label every score is 0.5. NULL texts are scored like empty ones,
    a NULL id is not held out, repeated rows get equal scores, columns besides id and text are
    not read, and an empty table gives an empty result.
    """
    stats = stored(document_statistics(docs, doc_id), "statistics")
    labelled = stored(stats.where("remainder <> 0").join(_means(labels), "id"), "labelled")
    fit, aside = labelled.where("remainder <> 1"), labelled.where("remainder = 1")
    kind = stats.schema["id"].dataType.simpleString()
    held = (F.col("remainder") == 0).alias("held_out")
    if labelled.isEmpty():
        scored = stats.select("id", "hash", held, F.lit(0.5).alias("score"))
    else:
        if fit.isEmpty():
            fit = aside
        kernel = _fit_kernel(fit)
        weights = _fit_ridge(fit, kernel)
        centres, values = _fit_calibration(aside, kernel, weights)
        raw = in_arrow(stats.select("id", "remainder", "hash", "stats"), _raw(kernel, weights, 3), f"id {kind}, remainder int, hash long, raw double")
        scored = in_arrow(raw, _calibrating(centres, values), f"id {kind}, remainder int, hash long, score double").select("id", "hash", held, "score")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")).withColumnRenamed("id", doc_id)


def _calibrating(centres: np.ndarray, values: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.interp(batch.column(3).to_numpy(zero_copy_only=False), centres, values)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.round(np.clip(scores, 0, 1), 6))], ["id", "remainder", "hash", "score"])

    return run
