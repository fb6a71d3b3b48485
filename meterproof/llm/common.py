"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterproof.session import shared_dir

# Fixed value: the word pattern of the contamination contract, on UTF-8 bytes with A-Z lowered.
# A byte from 0x80 on belongs to a character outside ASCII, so bytes decide as code points would.
WORD_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER_ASCII = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

# Rows of one Arrow batch: whole texts travel in batches, so a batch of long texts must stay small.
BATCH_ROWS = 1000


def lowered_words(text: str | None) -> list[bytes]:
    """Words of the contamination contract; NULL has none."""
    return WORD_BYTES.findall(text.encode("utf-8", "surrogatepass").translate(LOWER_ASCII)) if text else []


def each_lowered_word(text: str | None) -> Iterator[bytes]:
    """The same words one by one, for texts whose list of words would be large."""
    folded = text.encode("utf-8", "surrogatepass").translate(LOWER_ASCII) if text else b""
    return (found.group() for found in WORD_BYTES.finditer(folded))


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds the rows of an Arrow batch, unless the session already asks for fewer."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def in_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow in batches that hold whole texts without holding many of them."""
    small_batches(df.sparkSession)
    return df.mapInArrow(function, schema)


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Writes a frame to the shared folder and reads it back: lineage ends here, and a lost
    executor costs a re-read instead of the computation."""
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_join(rows: DataFrame, keyed: DataFrame, keys: list[str], size: str, how: str = "inner", share: int = 1000) -> DataFrame:
    """Joins rows to one keyed row per key although a few keys hold a large share of the rows.

    `size` is the keyed side's number of rows per key. A key is heavy when it holds more than
    1/`share` of the sum of sizes, so there are fewer than `share` heavy keys whatever the data:
    they are broadcast and their rows stay where they are. All other keys are joined by a
    shuffle in which none is large. NULL keys match NULL keys.
    """
    total = keyed.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    bound = total // share
    heavy = keyed.where(F.col(size) > bound)
    light = keyed.where(F.col(size) <= bound)
    mark = [*[F.col(k).alias(f"_k_{k}") for k in keys]]

    def on(right: DataFrame) -> Column:
        condition = F.lit(True)
        for k in keys:
            condition = condition & rows[k].eqNullSafe(right[f"_k_{k}"])
        return condition

    hot = heavy.select(*mark, *[c for c in keyed.columns if c not in keys])
    cold = light.select(*mark, *[c for c in keyed.columns if c not in keys])
    gone = [f"_k_{k}" for k in keys]
    first = rows.join(F.broadcast(hot), on(hot), "inner").drop(*gone)
    marks = heavy.select(*mark)
    rest = rows.join(F.broadcast(marks), on(marks), "left_anti")
    second = rest.join(cold, on(cold), how).drop(*gone)
    return first.unionByName(second)


def ragged(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from one flat array and the length of each list."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
