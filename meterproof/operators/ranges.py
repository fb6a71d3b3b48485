"""Rows in a global order over range partitions, for scans that no single key can hold."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterproof.session import COMPRESSION, shared_dir


def in_ranges(rows: DataFrame, order: Sequence[Column | str], slices: int | None = None) -> DataFrame:
    """Adds `_slice` (range partition) and `_place` (global place) to rows, stored in that order.

    Slices hold about equal shares whatever the keys, so a key that owns most rows lies in many
    of them. Stored because every reader must see the same slices, also after an executor is lost.
    """
    spark = rows.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = placed.withColumn("_slice", F.shiftright("_place", 33))
    path = f"{shared_dir(spark)}/ranges-{uuid.uuid4().hex}"
    placed.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(placed.schema).parquet(path)
