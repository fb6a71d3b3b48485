"""The recipes as Spark DataFrames."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from meterproof.session import COMPRESSION, shared_dir, use_utc
from testkit.recipes import recipes

TABLES = ("nation", "customer", "supplier", "orders", "lineitem", "events", "part")


# Tables of the pipeline, written once per session and directory so that operators
# read stored tables, as they do in production, and not the recipes behind them. Raw events and raw
# records are scanned once, into a layer that is stored: their texts are not written as well.
STORED = (
    "input_session", "tariffs_raw", "tariffs_faulty", "run_manifest", "damage", "landing", "sess", "receipts", "batch_snapshots", "frozen", "observed",
    "run_snapshots", "run_receipts", "task_states", "attempt_log", "tampered", "layered",
)
# Few rows whatever the input: without this a large table is dealt out by seven keys to meet them.
FEW = ("batch_sizes",)
_written: dict[tuple[str, str, str], tuple[str, StructType]] = {}


class Derived:
    """Lazily built inputs for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        use_utc(spark)
        self.spark, self.sf_dir = spark, sf_dir
        self._recipes = recipes("spark")
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = (
                self.store(name, lambda: self._build(name)) if name in STORED else self._build(name)
            )
        return self._frames[name]

    def passing(self, name: str) -> DataFrame:
        """A table that is scanned once, into a stored layer: its rows are not written before."""
        return self._build(name)

    def store(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Writes a table to the shared folder the first time and reads it from there."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _written:
            frame = build()
            path = f"{shared_dir(self.spark)}/meterproof-{uuid.uuid4().hex}/{name}"
            frame.write.option("compression", COMPRESSION).parquet(path)
            _written[key] = (path, frame.schema)
        path, schema = _written[key]
        return self.spark.read.schema(schema).parquet(path)

    def _build(self, name: str) -> DataFrame:
        if name not in self._recipes:
            if name in TABLES:
                # One test file is one split; spread it as a large table would be.
                return self.table(name).repartition(self.spark.sparkContext.defaultParallelism)
            raise AttributeError(name)
        body = self._recipes[name]
        order = list(self._recipes)
        sources = [*TABLES, *order[: order.index(name)]]
        used = {source for source in sources if re.search(rf"(FROM|JOIN) {source}\b", body)}
        for source in used:
            view = f"derived_{source}"
            frame = getattr(self, source)
            (F.broadcast(frame) if source in FEW else frame).createOrReplaceTempView(view)
            body = re.sub(rf"(FROM|JOIN) {source}\b", rf"\1 {view}", body)
        return self.spark.sql(body)
