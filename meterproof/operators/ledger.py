"""The independent expected charge and the normalised reported charge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterproof.functions.columns import (
    broken_rules,
    cents,
    digest_words,
    filled,
    holds,
    hours,
    iso_utc,
    keeps_all,
    kind_at,
    kwh,
    micros_between,
    once,
    packed,
    plain_decimal,
    set_digest,
    sha256,
    tally,
    text_at,
    unpacked,
)
from meterproof.operators.joins import mixed_validity
from meterproof.schemas import MONEY, ROLES

SESSION = ("run_id", "session_id")
IDENTITY = ("run_id", "release_role", "country_code", "party_id", "cdr_id")
# Fixed value: the part of a reported record that is checked.
CDR_DOCUMENT = (
    "STRUCT<country_code: STRING, party_id: STRING, id: STRING, session_id: STRING, "
    "start_date_time: STRING, end_date_time: STRING, currency: STRING, credit: STRING, "
    "charging_periods: ARRAY<STRUCT<tariff_id: STRING>>>"
)
CHARGE = (
    "session_id",
    "started_at",
    "ended_at",
    "currency",
    "actual_energy_kwh",
    "actual_duration_hours",
    "actual_amount",
    "tariff_id",
)


def registry_check(registry: DataFrame) -> DataFrame:
    """Per run: a session registry must be unique and name a tariff for every session."""
    complete = holds(filled("run_id") & filled("session_id") & filled("tariff_id"))
    # Counting per session first keeps a run with a third of all sessions out of one task.
    per_session = registry.groupBy("run_id", "session_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(complete).alias("complete")
    )
    return (
        per_session.groupBy("run_id")
        .agg(
            F.sum("rows").cast("bigint").alias("session_rows"),
            F.count("session_id").alias("distinct_sessions"),
            F.sum("complete").cast("bigint").alias("complete_rows"),
        )
        .withColumn(
            "ok",
            (F.col("session_rows") == F.col("distinct_sessions"))
            & (F.col("complete_rows") == F.col("session_rows")),
        )
    )


def priced_sessions(registry: DataFrame, sessions: DataFrame, history: DataFrame) -> DataFrame:
    """One row per registered session: how many registrations, sessions and tariffs apply, and its price.

    Left joins keep a session without evidence visible. Only counts of exactly one make
    a row `ok`; a second registration fails even under a tariff nobody knows.
    """
    valid_session = (
        (F.col("status") == "Completed")
        & F.col("started_at").isNotNull()
        & (F.col("ended_at") >= F.col("started_at"))
        & (F.col("meter_start_wh") >= 0)
        & (F.col("meter_end_wh") >= F.col("meter_start_wh"))
    )
    # Identical to grouping nothing away when sessions are unique, as the roll-up makes them.
    evidence = sessions.groupBy(*SESSION).agg(
        F.count(F.lit(1)).alias("session_rows"),
        F.count_if(valid_session).alias("valid_session_rows"),
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
        F.min("meter_start_wh").alias("meter_start_wh"),
        F.max("meter_end_wh").alias("meter_end_wh"),
    )
    price = F.try_element_at("price_components", F.lit(1))
    periods = history.select(
        "run_id",
        "tariff_id",
        "valid_from",
        "valid_to",
        F.col("currency").alias("tariff_currency"),
        packed("source_payload_hash").alias("tariff_payload_hash"),
        price["price"].alias("price_per_kwh"),
        holds(
            (F.col("currency") == "EUR")
            & (F.size("price_components") == 1)
            & (price["type"] == "ENERGY")
            & (price["price"] >= 0)
            & (price["step_size"] == 1)
            & F.col("source_payload_hash").isNotNull()
        ).alias("flat"),
    )
    registered = registry.groupBy(*SESSION).agg(
        F.count(F.lit(1)).alias("registration_rows"), tally(holds(filled("tariff_id"))).alias("named_rows")
    )
    # Ids come first in sorts: run ids are mostly equal.
    tariff_key = ["tariff_id", "run_id"]
    candidates = mixed_validity(
        registry.join(registered, list(SESSION)).join(evidence, list(SESSION), "left"),
        periods,
        tariff_key,
        "started_at",
        by="session_id",
        sizes=registry.groupBy(*tariff_key).agg(F.count(F.lit(1)).alias("n")),
    )
    covers_end = F.col("valid_to").isNull() | (F.col("ended_at") <= F.col("valid_to"))
    tariff = F.struct(
        "tariff_id", "valid_from", "tariff_payload_hash", F.col("tariff_currency"), "price_per_kwh"
    )
    return (
        candidates.groupBy(*reversed(SESSION))
        .agg(
            F.max("registration_rows").alias("registration_rows"),
            F.max("named_rows").alias("named_rows"),
            F.max(F.coalesce("session_rows", F.lit(0))).alias("session_rows"),
            F.max(F.coalesce("valid_session_rows", F.lit(0))).alias("valid_session_rows"),
            F.count("valid_from").alias("tariff_rows"),
            tally(F.col("flat") & covers_end).alias("valid_tariff_rows"),
            F.max(F.when(F.col("valid_from").isNotNull(), tariff)).alias("tariff"),
            F.max("meter_start_wh").alias("meter_start_wh"),
            F.max("meter_end_wh").alias("meter_end_wh"),
        )
        .withColumn(
            "ok",
            (F.col("registration_rows") == 1)
            & (F.col("named_rows") == 1)
            & (F.col("session_rows") == 1)
            & (F.col("valid_session_rows") == 1)
            & (F.col("tariff_rows") == 1)
            & (F.col("valid_tariff_rows") == 1),
        )
    )


def pricing_preconditions(registry: DataFrame, sessions: DataFrame, history: DataFrame) -> DataFrame:
    return priced_sessions(registry, sessions, history).select(
        *SESSION, "registration_rows", "named_rows", "session_rows", "valid_session_rows", "tariff_rows", "valid_tariff_rows", "ok"
    )


def expected_ledger(registry: DataFrame, sessions: DataFrame, history: DataFrame) -> DataFrame:
    """Expected charge of the sessions that can be priced, from meters and tariffs only."""
    energy = kwh(F.col("meter_end_wh") - F.col("meter_start_wh"))
    return (
        priced_sessions(registry, sessions, history)
        .where("ok")
        .select(
            *SESSION,
            F.col("tariff.tariff_id"),
            F.col("tariff.valid_from").alias("tariff_valid_from"),
            unpacked("tariff.tariff_payload_hash").alias("tariff_payload_hash"),
            F.col("tariff.tariff_currency").alias("currency"),
            energy.alias("expected_energy_kwh"),
            F.col("tariff.price_per_kwh"),
        )
        .withColumn(
            "expected_amount_unrounded",
            (F.col("expected_energy_kwh") * F.col("price_per_kwh")).cast("decimal(37,12)"),
        )
        .withColumn("expected_amount", cents(F.col("expected_amount_unrounded")))
    )


def cdr_land(responses: DataFrame) -> DataFrame:
    """Raw responses (run, role, payload, arrival) with convenience projections and a hash."""
    document = F.col("_document")
    credit = text_at(document, "$.credit")
    return responses.withColumn("_document", F.try_parse_json("payload")).select(
        "run_id",
        "release_role",
        text_at(document, "$.country_code").alias("country_code"),
        text_at(document, "$.party_id").alias("party_id"),
        text_at(document, "$.id").alias("cdr_id"),
        text_at(document, "$.session_id").alias("session_id"),
        F.when(credit == "true", "CREDIT")
        .when((credit == "false") | credit.isNull(), "FINAL")
        .alias("cdr_type"),
        text_at(document, "$.currency").alias("currency"),
        text_at(document, "$.total_cost.excl_vat").try_cast(MONEY).alias("total_cost"),
        "payload",
        sha256("payload").alias("payload_hash"),
        "ingest_time",
    )


def _reported(cdrs: DataFrame) -> DataFrame:
    """Typed fields of each raw record, read once from the original payload.

    Text fields come from one schema-driven parse. The three amounts come from the
    parsed document, which keeps decimals exactly and refuses repeated keys.
    """
    exact = F.col("_exact")
    amounts = {"energy": "$.total_energy", "duration": "$.total_time", "amount": "$.total_cost.excl_vat"}
    # The hash as well: a filter on it would be pushed below, and whatever builds the payload repeated for it.
    read = {"parsed": exact.isNotNull(), "text": F.from_json("payload", CDR_DOCUMENT), "digest": sha256("payload")}
    for name, path in amounts.items():
        read |= {f"{name}_text": text_at(exact, path), f"{name}_kind": kind_at(exact, path)}
    typed = [
        plain_decimal(F.col(f"{name}_kind"), F.col(f"{name}_text")).alias(name) for name in amounts
    ]
    return (
        cdrs.select("run_id", "release_role", "payload", "payload_hash")
        .withColumn("_exact", F.try_parse_json("payload"))
        .withColumns(read)
        .withColumn("_fields", once(F.struct("parsed", "digest", "text", *typed)))
        .select(
            "run_id",
            "release_role",
            "payload",
            "payload_hash",
            F.col("_fields.parsed").alias("parsed"),
            F.col("_fields.digest").alias("digest"),
            F.col("_fields.text.country_code").alias("country"),
            F.col("_fields.text.party_id").alias("party"),
            F.col("_fields.text.id").alias("id"),
            F.col("_fields.text.session_id").alias("session_id"),
            F.col("_fields.text.start_date_time").try_cast("timestamp").alias("started_at"),
            F.col("_fields.text.end_date_time").try_cast("timestamp").alias("ended_at"),
            F.col("_fields.text.currency").alias("currency"),
            F.col("_fields.energy").alias("actual_energy_kwh"),
            F.col("_fields.duration").alias("actual_duration_hours"),
            F.col("_fields.amount").alias("actual_amount"),
            F.col("_fields.text.credit").alias("credit"),
            F.size("_fields.text.charging_periods").alias("periods"),
            F.try_element_at("_fields.text.charging_periods", F.lit(1))["tariff_id"].alias("tariff"),
        )
    )


def cdr_rules() -> dict[str, Column]:
    def short_id(column: str) -> Column:
        return F.length(column).between(1, 36) & (F.col(column) == F.trim(column))

    return {
        "malformed_document": F.col("parsed"),
        "blank_run": filled("run_id"),
        "unknown_role": F.col("release_role").isin(*ROLES),
        "hash_mismatch": F.col("payload_hash") == F.col("digest"),
        "invalid_country": F.col("country").rlike("^[A-Za-z]{2}$"),
        "invalid_party": F.col("party").rlike("^[A-Za-z0-9]{3}$"),
        "invalid_id": short_id("id"),
        "invalid_session": short_id("session_id"),
        "invalid_times": F.col("started_at").isNotNull() & (F.col("ended_at") >= F.col("started_at")),
        "invalid_currency": F.col("currency").rlike("^[A-Z]{3}$"),
        "invalid_energy": F.col("actual_energy_kwh").isNotNull(),
        "invalid_duration": F.col("actual_duration_hours").isNotNull(),
        "invalid_amount": F.col("actual_amount").isNotNull(),
        "credit_record": F.col("credit").isNull() | (F.col("credit") == "false"),
        "not_one_period": F.col("periods") == 1,
        "invalid_tariff": short_id("tariff"),
    }


def cdr_validate(cdrs: DataFrame) -> DataFrame:
    """Every raw record with its typed fields and the contract rules it breaks. No shuffle."""
    rules = cdr_rules()
    return _reported(cdrs).withColumns({"reasons": broken_rules(rules), "ok": keeps_all(rules)}).drop("digest")


def _checked(cdrs: DataFrame) -> DataFrame:
    """Raw records are validated; the stored result of `cdr_validate` is taken as it is.

    A job stores that layer once, without payloads, and derives ledger, sources,
    conflicts and quarantine from it, so that no payload is parsed twice.
    """
    return cdrs if "reasons" in cdrs.columns else cdr_validate(cdrs)


def _normalised(cdrs: DataFrame) -> DataFrame:
    return (
        _checked(cdrs)
        .where("ok")
        .select(
            "run_id",
            "release_role",
            F.upper("country").alias("country_code"),
            F.upper("party").alias("party_id"),
            F.lower("id").alias("cdr_id"),
            "session_id",
            "started_at",
            "ended_at",
            "currency",
            "actual_energy_kwh",
            "actual_duration_hours",
            "actual_amount",
            F.lower("tariff").alias("tariff_id"),
            "payload_hash",
        )
    )


def cdr_sources(cdrs: DataFrame) -> DataFrame:
    """Provenance as rows: every distinct payload hash behind a normalised record."""
    return _normalised(cdrs).select(*IDENTITY, "payload_hash").distinct()


def _by_identity(records: DataFrame) -> DataFrame:
    """Records sharing an identity agree exactly when the smallest and largest charge are equal.

    That needs a fixed-size state per identity, however many copies arrive. Copies of a payload are removed
    by hash, without a sort; ids come first in the sort of the rest, whose other columns are mostly equal.
    """
    charge = F.struct(*CHARGE)
    per_payload = records.select(*IDENTITY, *CHARGE, packed("payload_hash").alias("_hash")).distinct()
    words = [word.alias(f"w{i}") for i, word in enumerate(digest_words(unpacked("_hash")))]
    payloads = F.count(F.lit(1))
    return (
        per_payload.select(*IDENTITY, charge.alias("charge"), *words)
        .groupBy(*reversed(IDENTITY))
        .agg(
            F.min("charge").alias("charge"),
            F.max("charge").alias("_highest"),
            payloads.alias("source_payloads"),
            set_digest(payloads, [F.sum(f"w{i}") for i in range(4)]).alias("source_digest"),
        )
        .withColumn("conflict", F.col("charge") != F.col("_highest"))
    )


def actual_ledger(cdrs: DataFrame) -> DataFrame:
    """One row per reported record; equivalent payloads collapse into one.

    Different ids of one session stay apart. An identity with conflicting charges is
    left out here and listed by `cdr_conflicts`. The distinct payloads are counted and
    digested, whatever their number; their hashes are the rows of `cdr_sources`.
    """
    return (
        _by_identity(_normalised(cdrs))
        .where(~F.col("conflict"))
        .select(
            *IDENTITY,
            F.col("charge.session_id"),
            F.lit("FINAL").alias("cdr_type"),
            *[F.col(f"charge.{name}") for name in CHARGE[1:]],
            "source_payloads",
            "source_digest",
        )
    )


def cdr_conflicts(cdrs: DataFrame) -> DataFrame:
    """Identities reported with different charges."""
    return _by_identity(_normalised(cdrs)).where("conflict").select(*IDENTITY)


def cdr_quarantine(cdrs: DataFrame) -> DataFrame:
    """Raw records kept out of the ledger, each with its reasons."""
    checked = _checked(cdrs)
    invalid = checked.where(~F.col("ok")).select("run_id", "release_role", "payload_hash", "reasons")
    conflicting = (
        _normalised(checked)
        .join(cdr_conflicts(checked), list(IDENTITY), "left_semi")
        .select(
            "run_id", "release_role", "payload_hash", F.array(F.lit("conflicting_charge")).alias("reasons")
        )
    )
    return invalid.unionByName(conflicting)


def rate_sessions(
    sessions: DataFrame, registry: DataFrame, history: DataFrame, surcharge: dict[str, str] | None = None,
    silent: tuple[str, ...] = (),
) -> DataFrame:
    """Bills for each priceable session and release, as raw response documents.

    `surcharge` adds a fixed amount to every bill of a release, which reproduces a
    release that overcharges; a release named in `silent` sends no bill.
    """
    surcharge = surcharge or {}
    extra = F.lit("0").cast("decimal(18,2)")
    for role, amount in surcharge.items():
        extra = F.when(F.col("release_role") == role, F.lit(amount).cast("decimal(18,2)")).otherwise(extra)
    expected = expected_ledger(registry, sessions, history)
    start, end = iso_utc(F.col("started_at")), iso_utc(F.col("ended_at"))
    energy, duration = F.col("expected_energy_kwh"), hours(micros_between(F.col("started_at"), F.col("ended_at")))
    cdr_id = F.concat(F.lit("cdr-"), F.regexp_replace("session_id", "^txn-", ""))
    payload = F.to_json(
        F.struct(
            F.lit("FR").alias("country_code"),
            F.lit("CAS").alias("party_id"),
            cdr_id.alias("id"),
            F.col("session_id"),
            start.alias("start_date_time"),
            end.alias("end_date_time"),
            F.col("currency"),
            F.array(
                F.struct(
                    start.alias("start_date_time"),
                    F.array(
                        F.struct(F.lit("ENERGY").alias("type"), energy.alias("volume")),
                        F.struct(F.lit("TIME").alias("type"), duration.alias("volume")),
                    ).alias("dimensions"),
                    F.col("tariff_id"),
                )
            ).alias("charging_periods"),
            F.struct(F.col("amount").alias("excl_vat")).alias("total_cost"),
            energy.alias("total_energy"),
            duration.alias("total_time"),
            F.lit(False).alias("credit"),
            iso_utc(F.col("ended_at") + F.expr("INTERVAL 1 SECOND")).alias("last_updated"),
        )
    )
    billed = (
        expected.join(sessions.select(*SESSION, "started_at", "ended_at"), list(SESSION))
        .withColumn("release_role", F.explode(F.array(*[F.lit(role) for role in ROLES if role not in silent]).cast("array<string>")))
        .withColumn("amount", (F.col("expected_amount") + extra).try_cast("decimal(18,2)"))
    )
    return billed.select(
        "run_id",
        "release_role",
        payload.alias("payload"),
        (F.col("ended_at") + F.expr("INTERVAL 2 SECONDS")).alias("ingest_time"),
    )
