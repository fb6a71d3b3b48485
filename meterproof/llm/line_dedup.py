"""Line dedup by overlapping windows of three lines.

Every run of three consecutive lines with ink is a window, known by the hashes of its lines.
Windows that occur more than once anywhere are found by one aggregation, which keeps the first
occurrence; all later ones mark the lines they cover, overlapping marks are merged, and the
marked lines go. Only hashes and positions are shuffled for this; texts move once, to meet
their marks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterproof.llm.common import in_arrow, split_join, stored
from meterproof.llm.quality_rules import BLANKS

WINDOW = 3
_HASHES = [f"h{k}" for k in range(WINDOW)]


def _lines(text: str = "text") -> Column:
    return F.split(text, "\n", -1)


def _has_ink(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) != ""


def windows(docs: DataFrame) -> DataFrame:
    """Windows of (id, hash, text) rows: id, hash, place of the first line among those with ink, line hashes."""
    hashed = docs.select("id", "hash", F.transform(F.filter(_lines(), _has_ink), lambda line: F.xxhash64(line)).alias("lines"))
    many = hashed.where(F.size("lines") >= WINDOW)
    place = F.explode(F.sequence(F.lit(0), F.size("lines") - WINDOW)).alias("place")
    return many.select("id", "hash", "lines", place).select(
        "id", "hash", "place", *[F.col("lines")[F.col("place") + k].alias(h) for k, h in enumerate(_HASHES)]
    )


def later_windows(found: DataFrame) -> DataFrame:
    """Windows (id, hash, place) that repeat an earlier one; the order is id (NULL first), hash, place."""
    here = F.struct("id", "hash", "place")
    repeated = found.groupBy(*_HASHES).agg(F.count(F.lit(1)).alias("n"), F.min(here).alias("first")).where("n > 1")
    joined = split_join(found, stored(repeated, "repeated"), _HASHES, "n")
    return joined.where(~here.eqNullSafe(F.col("first"))).select("id", "hash", "place")


def _cutting(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, cuts = [], [], []
            for text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = [] if text is None else text.split("\n")
                inked = [i for i, line in enumerate(lines) if line.strip(BLANKS)]
                covered = {inked[p + k] for p in places or () for k in range(width)}
                counts.append(len(inked))
                cuts.append(len(covered))
                texts.append("\n".join(line for i, line in enumerate(lines) if i not in covered) if covered else text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(cuts, pa.int64()), *batch.columns[2:]],
                ["text", "n_lines", "n_removed", *batch.schema.names[2:]],
            )

    return run


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", keep: Sequence[str] = ()) -> DataFrame:
    """Per row of `docs`: its id, the text left, n_lines, n_removed, and the columns of `keep`.

    Lines end at newlines; lines without ink belong to no window, are not counted and stay. A
    text with fewer than three lines with ink has no window and stays as it is. Lines are equal
    when they are the same text; windows when the hashes of all three lines are. The first
    occurrence is that of the lowest id (NULL first), then in order of the text; later ones go,
    in the same document too. Rows that repeat both id and text are one document and get equal
    results. A NULL text stays NULL with no lines. Columns other than `keep` are not read. An
    empty table gives an empty result.
    """
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.col(doc_id).alias("id"), F.col("text").alias("text"), F.xxhash64("text").alias("hash"), *kept)
    found = stored(windows(rows), "windows")
    marks = later_windows(found).groupBy(F.col("id").alias("_id"), F.col("hash").alias("_hash")).agg(F.collect_set("place").alias("places"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    names = [f"k{i}" for i in range(len(keep))]
    # By shuffle at every size: marks grow with the corpus, so they must not be broadcast here.
    marked = rows.join(stored(marks, "marks").hint("merge"), same, "left").select("text", "places", "id", *names)
    kinds = ", ".join(f"{c} {marked.schema[c].dataType.simpleString()}" for c in ["id", *names])
    cut = in_arrow(marked, _cutting(WINDOW), f"text string, n_lines long, n_removed long, {kinds}")
    return cut.select(F.col("id").alias(doc_id), "text", "n_lines", "n_removed", *[F.col(n).alias(c) for n, c in zip(names, keep)])
