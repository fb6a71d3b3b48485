"""Effective-dated tariffs: contract checks, overlapping periods, typed history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterproof.functions.columns import absent_at, broken_rules, filled, keeps_all, once, packed, sha256, text_at, unpacked
from meterproof.operators.ranges import in_ranges

# Fixed value: layout of a tariff document.
TARIFF_DOCUMENT = (
    "STRUCT<id: STRING, currency: STRING, elements: ARRAY<STRUCT<price_components: "
    "ARRAY<STRUCT<type: STRING, price: DECIMAL(18,6), step_size: INT>>>>>"
)
PERIOD = ("run_id", "tariff_id", "valid_from", "valid_to", "currency", "payload", "payload_hash")


def tariff_rules(document: Column) -> dict[str, Column]:
    """Only one unrestricted flat EUR energy price per tariff can be priced."""
    component = "$.elements[0].price_components[0]"

    def entries(path: str) -> Column:
        return F.size(F.try_variant_get(document, path, "array<variant>"))

    return {
        "blank_identity": filled("run_id") & filled("tariff_id"),
        "hash_mismatch": F.col("payload_hash") == sha256("payload"),
        "malformed_document": document.isNotNull(),
        "id_mismatch": text_at(document, "$.id") == F.col("tariff_id"),
        "currency_mismatch": text_at(document, "$.currency") == F.col("currency"),
        "currency_not_eur": F.col("currency") == "EUR",
        "invalid_period": F.col("valid_from").isNotNull()
        & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))),
        "not_one_element": entries("$.elements") == 1,
        "not_one_component": entries("$.elements[0].price_components") == 1,
        "not_energy": text_at(document, f"{component}.type") == "ENERGY",
        "invalid_price": text_at(document, f"{component}.price").try_cast("decimal(18,6)") >= 0,
        "step_size_not_one": text_at(document, f"{component}.step_size") == "1",
        "has_vat": absent_at(document, f"{component}.vat"),
        "has_restrictions": absent_at(document, "$.elements[0].restrictions"),
        "has_price_bounds": absent_at(document, "$.min_price") & absent_at(document, "$.max_price"),
        "has_document_dates": absent_at(document, "$.start_date_time")
        & absent_at(document, "$.end_date_time"),
    }


def tariff_validate(tariffs: DataFrame) -> DataFrame:
    """Every raw period with the contract rules it breaks. No shuffle."""
    rules = tariff_rules(F.col("_document"))
    parsed = tariffs.withColumn("_document", once(F.try_parse_json("payload")))
    return parsed.withColumns({"reasons": broken_rules(rules), "ok": keeps_all(rules)}).drop("_document")


def tariff_overlaps(tariffs: DataFrame) -> DataFrame:
    """Distinct periods that still run when the tariff's next period begins.

    Adjacent [from, to) periods are fine; the same start twice is a conflict.
    A tariff may own a large share of all periods, so the next start is looked up
    inside calendar days; a second pass over one row per (tariff, day) supplies
    the start that follows the last period of a day.
    """
    day = F.to_date("valid_from")
    periods = tariffs.select(*PERIOD).distinct().withColumn("_day", day)
    in_day = Window.partitionBy("run_id", "tariff_id", "_day").orderBy(
        "valid_from", F.col("valid_to").asc_nulls_last(), "payload_hash"
    )
    # A period without a start sorts first and meets the next start like any other.
    key = ("run_id", "tariff_id", "_day")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
    over_days = Window.partitionBy("run_id", "tariff_id").orderBy("_day")
    later = (
        periods.groupBy("run_id", "tariff_id", "_day")
        .agg(F.min("valid_from").alias("_opens"))
        .withColumn("_later", F.lead("_opens").over(over_days))
        .drop("_opens")
    )
    return (
        periods.withColumn("_next", F.lead("valid_from").over(in_day))
        .join(later.withColumnsRenamed({c: f"_{c}" for c in key}), same)
        .withColumn("next_valid_from", F.coalesce("_next", "_later"))
        .where(
            F.col("next_valid_from").isNotNull()
            & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("next_valid_from")))
        )
        .select(*PERIOD, "next_valid_from")
    )


def tariff_overlaps_all(tariffs: DataFrame, slices: int | None = None) -> DataFrame:
    """Every distinct period that shares an instant with another one of its tariff: `overlaps_earlier`
    with one that begins before it (or at the same time, in the order of ends and hashes), `overlaps_later`
    with the one that begins next.

    The next start alone misses periods enclosed by a long earlier one. The latest end so far
    tells them: it is a running maximum inside each range partition, started with the maximum of the tariff's
    earlier partitions. A period without a start has always run, one without an end runs for
    ever, and one that ends before it begins covers nothing.
    """
    always, never = (F.lit(t).cast("timestamp") for t in ("0001-01-01 00:00:00", "9999-12-31 23:59:59.999999"))
    opens, ends = F.coalesce("valid_from", always), F.coalesce("valid_to", never)
    periods = tariffs.select(*PERIOD).distinct().withColumns({"_opens": opens, "_ends": ends}).where(F.col("_ends") > F.col("_opens"))
    rows = in_ranges(periods, ["run_id", "tariff_id", "_opens", "_ends", "payload_hash", "currency", "payload"], slices)
    tariff = ("run_id", "tariff_id")
    own = Window.partitionBy(*tariff, "_slice")
    before = own.orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    # One row per tariff and slice: no more of a tariff than there are slices.
    spans = rows.groupBy(*tariff, "_slice").agg(F.max("_ends").alias("_most"), F.min("_opens").alias("_first"))
    along = Window.partitionBy(*tariff).orderBy("_slice")
    carried = spans.select(
        *[F.col(c).alias(f"_{c}") for c in tariff], F.col("_slice").alias("_s"),
        F.max("_most").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"), F.lead("_first").over(along).alias("_later"),
    )
    same = (F.col("_slice") == F.col("_s")) & reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in tariff])
    scanned = rows.withColumns({"_so_far": F.max("_ends").over(before), "_next": F.lead("_opens").over(own.orderBy("_place"))}).join(carried, same)
    reach, following = F.greatest("_so_far", "_carried"), F.coalesce("_next", "_later")
    return scanned.select(
        *PERIOD,
        F.coalesce(reach > F.col("_opens"), F.lit(False)).alias("overlaps_earlier"),
        F.coalesce(following < F.col("_ends"), F.lit(False)).alias("overlaps_later"),
    ).where("overlaps_earlier OR overlaps_later")


def tariff_history(tariffs: DataFrame) -> DataFrame:
    """Typed periods of the tariffs that honour the contract, without repeated evidence.

    A hash that was checked stands for its payload: copies are removed by the hash and what was read of the payload.
    """
    document = F.from_json("payload", TARIFF_DOCUMENT)
    components = F.try_element_at(document["elements"], F.lit(1))["price_components"]
    columns = ["run_id", "tariff_id", "valid_from", "valid_to", "currency", "price_components"]
    return (
        tariff_validate(tariffs)
        .where("ok")
        .withColumn("price_components", components)
        .select(*columns, packed("payload_hash").alias("_hash"))
        .distinct()
        .select(*columns, unpacked("_hash").alias("source_payload_hash"))
    )


def lineage_check(history: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Each priced period with whether its stored hash still belongs to raw evidence."""
    raw = (
        tariffs.select(
            "run_id",
            "tariff_id",
            "valid_from",
            F.col("payload_hash").alias("source_payload_hash"),
            (F.col("payload_hash") == sha256("payload")).alias("_intact"),
        )
        .groupBy("run_id", "tariff_id", "valid_from", "source_payload_hash")
        .agg(F.bool_and("_intact").alias("_intact"))
    )
    keys = ["run_id", "tariff_id", "valid_from", "source_payload_hash"]
    return history.join(raw, keys, "left").select(
        *keys, F.coalesce("_intact", F.lit(False)).alias("traced")
    )
