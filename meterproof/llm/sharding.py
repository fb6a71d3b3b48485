"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Equal texts form a group. A group that holds more than 1/ATOMS of the bytes, tokens or rows is
an item of its own (there are fewer than 3 * ATOMS such groups, whatever the data). A group stays
whole unless its bytes alone exceed a shard's, when equal sums could not be had; it is then cut into as few
parts as fit. All other groups are hashed into ATOMS items. So the packing itself works on a number of items that does not grow with the
data: largest first, each goes to the shard where the dot product of its demand with the
residual capacity is highest. Rows then only look up their item's shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from meterproof.llm.common import stored

SHARDS = 24
ATOMS = 4096
#: The law is equal bytes; tokens and rows are balanced as far as bytes allow.
WEIGHTS = np.array([4.0, 1.0, 1.0])
DIMENSIONS = ("size", "tokens", "rows")
#: Pieces of a cut group that its parts are made of: parts are equal up to one of them.
LOTS = 1024
ROWS_A_SLOT_GROUP = 200_000


def pack(demands: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item (rows of bytes, tokens, rows), largest first: of the shards whose residual
    bytes hold it, the one where the dot product of its demand with the residual capacity is
    highest, the lowest of equals; where none holds it, the one with most bytes left."""
    total = demands.sum(axis=0)
    capacity = np.where(total > 0, total, 1) / shards
    needs = demands / capacity
    residual = np.ones((shards, needs.shape[1]))
    placed = np.zeros(len(needs), np.int64)
    for i in np.lexsort((np.arange(len(needs)), -needs[:, 0])):
        fits = residual[:, 0] >= needs[i, 0] - 1e-12
        dots = np.round(residual @ (needs[i] * WEIGHTS), 12) if fits.any() else residual[:, 0]
        best = int(np.argmax(np.where(fits, dots, -np.inf) if fits.any() else dots))
        placed[i] = best
        residual[best] -= needs[i]
    return placed


def _narrow(docs: DataFrame, doc_id: str) -> DataFrame:
    """One small row per document; the salt spreads even rows that are alike in every column."""
    return docs.select(
        F.col(doc_id).alias("id"),
        F.xxhash64("text", F.octet_length("text")).alias("group"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("tokens"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(doc_id, F.monotonically_increasing_id()), F.lit(1 << 20)).alias("salt"),
    )


def _places(spark: SparkSession, narrow: DataFrame, shards: int, atoms: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Shards of large groups (group, shard), of the lots of cut groups (group, lot, parts, shard) and of hashed items (atom, shard)."""
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    groups = stored(narrow.groupBy("group").agg(*sums), "groups")
    total = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in DIMENSIONS]).first()
    large = F.lit(False)
    for c in DIMENSIONS:
        large = large | (F.col(c) > max(1, total[c] // atoms))
    parts = F.least(F.ceil(F.col("size") * shards / max(1, total["size"])), F.col("rows")).cast("int")
    # Fewer than 3 * atoms groups can exceed a bound of total / atoms, and fewer than `shards` a whole shard.
    own = groups.where(large).withColumn("parts", parts)
    whole = own.where("parts = 1").select("group", *DIMENSIONS).collect()
    cut = own.where("parts > 1").select("group", "parts")
    lots = narrow.join(F.broadcast(cut), "group").groupBy("group", "parts", _lot()).agg(*sums).orderBy("group", "lot").collect()
    hashed = groups.where(~large).groupBy(_atom(atoms)).agg(*[F.sum(c).alias(c) for c in DIMENSIONS]).collect()
    pieces: dict[tuple[int, int], np.ndarray] = {}
    piece_of = {}
    bytes_of: dict[int, int] = {}
    for r in lots:
        bytes_of[r["group"]] = bytes_of.get(r["group"], 0) + r["size"]
    so_far = dict.fromkeys(bytes_of, 0)
    for r in lots:
        # Lots in their order, cut where the parts' equal shares of the bytes end.
        group = r["group"]
        piece = piece_of[group, r["lot"]] = (group, min(r["parts"] - 1, (2 * so_far[group] + r["size"]) * r["parts"] // (2 * bytes_of[group])))
        so_far[group] += r["size"]
        pieces[piece] = pieces.get(piece, np.zeros(3)) + [r[c] for c in DIMENSIONS]
    whole, hashed, names = sorted(whole, key=lambda r: r["group"]), sorted(hashed, key=lambda r: r["atom"]), sorted(pieces)
    demands = [[r[c] for c in DIMENSIONS] for r in whole] + [pieces[n] for n in names] + [[r[c] for c in DIMENSIONS] for r in hashed]
    placed = pack(np.array(demands, np.float64).reshape(-1, 3), shards).tolist() if demands else []
    at = dict(zip(names, placed[len(whole) :]))
    return (
        spark.createDataFrame([(r["group"], s) for r, s in zip(whole, placed)], "group long, shard int"),
        spark.createDataFrame([(r["group"], r["lot"], r["parts"], at[piece_of[r["group"], r["lot"]]]) for r in lots], "group long, lot int, parts int, shard int"),
        spark.createDataFrame([(r["atom"], s) for r, s in zip(hashed, placed[len(whole) + len(names) :])], "atom long, shard int"),
    )


def _lot():
    return F.pmod("salt", F.lit(LOTS)).cast("int").alias("lot")


def _atom(atoms: int):
    return F.pmod(F.xxhash64("group"), F.lit(atoms)).alias("atom")


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", atoms: int = ATOMS) -> DataFrame:
    """Per row of `docs`: id, size, tokens, text_crc32, law, shard, slot, grown_shard, group_parts.

    The law is `bytes`: shards have nearly equal sums of size. Equal texts share a shard; only a group of more
    bytes than a shard is cut, into group_parts parts. Slots count from 0 in each shard, by hashed place
    and id. A NULL text has size 8 and the crc32 of nothing; NULL texts are one group, apart
    from empty ones; repeated rows are rows; other columns are not read; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    narrow = stored(_narrow(docs, doc_id), "narrow")
    whole, cut, hashed = _places(spark, narrow, shards, atoms)
    one = F.lit(1).alias("group_parts")
    first = narrow.join(F.broadcast(whole), "group").select(*narrow.columns, one, "shard")
    second = narrow.withColumn("lot", _lot()).join(F.broadcast(cut), ["group", "lot"]).select(*narrow.columns, F.col("parts").alias("group_parts"), "shard")
    rest = narrow.join(F.broadcast(whole.select("group").union(cut.select("group").distinct())), "group", "left_anti")
    third = rest.withColumn("atom", _atom(atoms)).join(F.broadcast(hashed), "atom").select(*narrow.columns, one, "shard")
    placed = stored(first.unionByName(second).unionByName(third), "placed")
    rows = placed.count()
    spread = max(16, rows // (shards * ROWS_A_SLOT_GROUP))
    slotted = placed.withColumn("lot", F.pmod("salt", F.lit(spread)))
    before = Window.partitionBy("shard").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slotted.groupBy("shard", "lot").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    own_place = F.row_number().over(Window.partitionBy("shard", "lot").orderBy("id", "salt", "group"))
    numbered = slotted.withColumn("place", own_place).join(offsets, ["shard", "lot"])
    return numbered.select(
        F.col("id").alias(doc_id), "size", "tokens", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("place") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "group_parts",
    )
