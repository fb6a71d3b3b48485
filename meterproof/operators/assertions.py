"""Seven checks per session and release, comparing reported with expected charges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterproof.functions.columns import digest_words, holds, hours, micros_between, packed, set_digest, unpacked
from meterproof.schemas import ROLES, RULE_VERSION

WIDE = "decimal(26,6)"
RECORD = (
    "country_code",
    "party_id",
    "cdr_id",
    "actual_energy_kwh",
    "actual_duration_hours",
    "actual_amount",
    "currency",
    "tariff_id",
)
#: What identifies a reported record's content inside an evidence digest.
DIGESTED = (*RECORD, "source_digest")

# Texts stored with each result.
DESCRIPTIONS = {
    "oracle_available": "Require one expected ledger row and one valid completed session.",
    "final_cdr_count": "Require exactly one final CDR per completed billable session.",
    "energy_match": "Reported kWh must equal independent expected kWh.",
    "duration_match": "Reported hours must equal elapsed session hours rounded HALF_UP to six decimals.",
    "currency_match": "Reported currency must equal the expected currency.",
    "tariff_match": "Reported tariff ID must equal the selected tariff ID (case-insensitive).",
    "amount_match": "Reported exclusive-VAT amount must equal the rounded expected amount, without rounding the report.",
}
NO_ORACLE = "No unique, valid independent expectation; inspect oracle_available."
NOT_ONE_CDR = "Require exactly one final CDR before comparing values; inspect final_cdr_count."
OTHER_CURRENCY = "Amounts use different currencies; inspect currency_match. No monetary difference calculated."
MISSING_CDR = "MISSING_CDR: completed billable session has no final CDR."
DUPLICATE_CDR = (
    "DUPLICATE_CDR: multiple final CDRs for one billable session; inspect every record in evidence."
)


def final_records(actual: DataFrame) -> DataFrame:
    return actual.where(F.col("release_role").isin(*ROLES) & (F.col("cdr_type") == "FINAL"))


def _record_words() -> list[Column]:
    content = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in DIGESTED])
    return [word.alias(f"w{i}") for i, word in enumerate(digest_words(content))]


def reconcile(expected: DataFrame, sessions: DataFrame, actual: DataFrame) -> DataFrame:
    """Everything known about a session, one row per (run, session).

    The three inputs are stacked and aggregated once instead of being grouped,
    joined and crossed with the releases: one shuffle on (run, session), and the
    state per key is fixed-size however many rows a session has. It is sorted by session first:
    run ids are mostly equal, and comparing them first costs most of the sort. A ledger from which a job
    dropped `source_digest` is not digested: its digests are NULL.
    """
    digested = "source_digest" in actual.columns
    completed = F.col("status") == "Completed"
    valid = completed & F.col("started_at").isNotNull() & (F.col("ended_at") >= F.col("started_at"))
    e = expected.select(
        "run_id",
        "session_id",
        F.struct(
            "expected_energy_kwh",
            "expected_amount",
            "currency",
            "tariff_id",
            F.col("tariff_valid_from").alias("valid_from"),
            packed("tariff_payload_hash").alias("payload_hash"),
        ).alias("charge"),
    )
    s = sessions.select(
        "run_id",
        "session_id",
        F.lit(1).alias("in_lifecycle"),
        completed.cast("int").alias("completed"),
        holds(valid).cast("int").alias("valid_completed"),
        "started_at",
        "ended_at",
    )
    a = final_records(actual).select(
        "run_id", "session_id", "release_role", F.struct(*RECORD).alias("record"), *(_record_words() if digested else [])
    )
    per_role = []
    for role in ROLES:
        own = F.when(F.col("release_role") == role, F.col("record"))
        # Counted by role, so that a reader of the number alone reads no records.
        rows = F.count_if(F.col("release_role") == role)
        sums = [F.sum(F.when(F.col("release_role") == role, F.col(f"w{i}"))) for i in range(4)]
        per_role += [
            rows.alias(f"{role}_rows"),
            F.max(own).alias(f"{role}_record"),
            (set_digest(rows, sums) if digested else F.lit(None).cast("string")).alias(f"{role}_digest"),
        ]
    stacked = e.unionByName(s, allowMissingColumns=True).unionByName(a, allowMissingColumns=True)
    return stacked.groupBy("session_id", "run_id").agg(
        F.count("charge").alias("expected_rows"),
        F.max("charge").alias("charge"),
        F.count("in_lifecycle").alias("lifecycle_rows"),
        F.coalesce(F.max("completed"), F.lit(0)).alias("completed"),
        F.coalesce(F.sum("valid_completed"), F.lit(0)).alias("valid_completed_rows"),
        F.max("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
        *per_role,
    )


def _per_release(facts: DataFrame) -> DataFrame:
    """Both releases of every expected or completed session; otherwise only reporting ones.

    Only what the filter reads goes through the generator, out of which nothing is pruned.
    """
    releases = F.array(*[F.struct(F.lit(role).alias("release_role"), F.col(f"{role}_rows").alias("cdr_count")) for role in ROLES])
    known = (F.col("expected_rows") > 0) | (F.col("completed") > 0)

    def own(part: str) -> Column:
        first, second = ROLES
        return F.when(F.col("release_role") == first, F.col(f"{first}_{part}")).otherwise(F.col(f"{second}_{part}"))

    return (
        facts.withColumn("_release", F.explode(releases))
        .select("*", "_release.*")
        .where(known | (F.col("cdr_count") > 0))
        .withColumns({"record": own("record"), "records_digest": own("digest")})
        .drop("_release", *[f"{role}_{part}" for role in ROLES for part in ("rows", "record", "digest")])
    )


def release_grid(expected: DataFrame, sessions: DataFrame, actual: DataFrame) -> DataFrame:
    """The (run, release, session) combinations that must be checked."""
    return _per_release(reconcile(expected, sessions, actual)).select(
        "run_id", "release_role", "session_id"
    )


def assertion_records(actual: DataFrame) -> DataFrame:
    """The reported records behind the checks, as rows: all of them, however many a session has."""
    return final_records(actual).select(
        "run_id", "release_role", "session_id", *RECORD, "source_payloads", "source_digest"
    )


def actual_evidence(actual: DataFrame) -> DataFrame:
    """Per (run, release, session): its reported records, counted and digested as in the checks' evidence."""
    records = F.count(F.lit(1))
    return (
        final_records(actual)
        .select("run_id", "release_role", "session_id", *_record_words())
        .groupBy("run_id", "release_role", "session_id")
        .agg(
            records.alias("cdr_count"),
            set_digest(records, [F.sum(f"w{i}") for i in range(4)]).alias("records_digest"),
        )
    )


def _rule(checked: dict[str, Column]) -> dict[str, Column]:
    """Result columns of one rule, from this rule's own comparison."""
    expected, actual = checked["expected"], checked["actual"]
    numeric = checked.get("numeric", False)
    evaluable, message = checked["evaluable"], checked["message"]
    equal = checked.get("equal", actual == expected)
    return {
        "expected_value": expected.cast("string"),
        "actual_value": actual.cast("string"),
        "difference": (
            F.when(evaluable, (actual - expected).cast("decimal(38,6)"))
            if numeric
            else F.lit(None).cast("decimal(38,6)")
        ),
        "status": F.when(~evaluable, "BLOCKED").when(holds(equal), "PASS").otherwise("FAIL"),
        "message": message,
    }


def _rules() -> dict[str, dict[str, Column]]:
    oracle, one_cdr = F.col("oracle"), F.col("cdr_count") == 1
    comparable = oracle & one_cdr
    currencies_differ = holds(F.col("record.currency") != F.col("charge.currency"))

    def wanted(value: Column) -> Column:
        return F.when(oracle, value)

    def reported(value: Column) -> Column:
        return F.when(one_cdr, value)

    def about(rule: str) -> Column:
        return (
            F.when(~oracle, NO_ORACLE).when(~one_cdr, NOT_ONE_CDR).otherwise(F.lit(DESCRIPTIONS[rule]))
        )

    def number(rule: str, expected: Column, actual: Column, evaluable=comparable, message=None) -> dict[str, Column]:
        return _rule(
            {
                "expected": wanted(expected.cast(WIDE)),
                "actual": reported(actual.cast(WIDE)),
                "numeric": True,
                "evaluable": evaluable,
                "message": about(rule) if message is None else message,
            },
        )

    def text(rule: str, expected: Column, actual: Column) -> dict[str, Column]:
        return _rule(
            {
                "expected": wanted(expected),
                "actual": reported(actual),
                "evaluable": comparable,
                "message": about(rule),
            },
        )

    amount_rule = "amount_match"
    return {
        "oracle_available": _rule(
            {
                "expected": F.lit("AVAILABLE"),
                "actual": F.when(oracle, "AVAILABLE").otherwise("UNAVAILABLE"),
                "equal": oracle,
                "evaluable": F.lit(True),
                "message": F.lit(DESCRIPTIONS["oracle_available"]),
            },
        ),
        "final_cdr_count": _rule(
            {
                "expected": wanted(F.lit(1).cast(WIDE)),
                "actual": F.col("cdr_count").cast(WIDE),
                "numeric": True,
                "evaluable": oracle,
                "message": F.when(~oracle, NO_ORACLE)
                .when(F.col("cdr_count") == 0, MISSING_CDR)
                .when(F.col("cdr_count") > 1, DUPLICATE_CDR)
                .otherwise(F.lit(DESCRIPTIONS["final_cdr_count"])),
            },
        ),
        "energy_match": number("energy_match", F.col("charge.expected_energy_kwh"), F.col("record.actual_energy_kwh")),
        "duration_match": number("duration_match", F.col("expected_hours"), F.col("record.actual_duration_hours")),
        "currency_match": text("currency_match", F.col("charge.currency"), F.col("record.currency")),
        "tariff_match": text("tariff_match", F.lower("charge.tariff_id"), F.col("record.tariff_id")),
        amount_rule: number(
            amount_rule,
            F.col("charge.expected_amount"),
            F.col("record.actual_amount"),
            evaluable=comparable & ~currencies_differ,
            message=F.when(comparable & currencies_differ, OTHER_CURRENCY).otherwise(about(amount_rule)),
        ),
    }


def _evidence() -> Column:
    lifecycle = F.when(F.col("lifecycle_rows") == 1, F.struct("started_at", "ended_at"))
    tariff = F.when(
        F.col("expected_rows") == 1,
        F.struct(
            F.col("charge.tariff_id").alias("tariff_id"),
            F.col("charge.valid_from").alias("valid_from"),
            unpacked("charge.payload_hash").alias("payload_hash"),
            F.col("charge.currency").alias("currency"),
        ),
    )
    return F.to_json(
        F.struct(
            F.lit(RULE_VERSION).alias("rule_version"),
            "expected_rows",
            "lifecycle_rows",
            "valid_completed_rows",
            "cdr_count",
            tariff.alias("expected_tariff"),
            lifecycle.alias("session"),
            F.col("records_digest").alias("actual_cdrs_digest"),
        )
    )


def assertion_result(expected: DataFrame, sessions: DataFrame, actual: DataFrame) -> DataFrame:
    """Seven results per (run, release, session).

    Rules are numbered out of the reconciled row, so the wide row is never crossed
    with a rule table. Each result column is an expression of its own beside the generator: a reader of
    the status alone computes neither texts nor evidence. `evidence` holds the number and the digest of the
    reported records, which are the rows of `assertion_records`.
    """
    single_session = (F.col("lifecycle_rows") == 1) & (F.col("valid_completed_rows") == 1)
    elapsed = hours(micros_between(F.col("started_at"), F.col("ended_at")))
    rules = _rules()
    # The release travels inside: kept beside the generator, the optimizer loses it in self unions.
    numbered = F.array(
        *[F.struct("release_role", F.lit(place).alias("place"), F.lit(rule).alias("assertion_id")) for place, rule in enumerate(rules)]
    )

    def result(name: str) -> Column:
        chosen = F.lit(None)
        for place, columns in enumerate(rules.values()):
            this = F.col("r.place") == place
            chosen = F.when(this, columns[name]) if place == 0 else chosen.when(this, columns[name])
        return chosen.alias(name)

    return (
        _per_release(reconcile(expected, sessions, actual))
        .withColumn("oracle", (F.col("expected_rows") == 1) & single_session)
        .withColumn("expected_hours", F.when(single_session, elapsed))
        .withColumn("evidence", _evidence())
        .select("run_id", "session_id", "oracle", "cdr_count", "record", "charge", "expected_hours", "evidence", F.explode(numbered).alias("r"))
        .select(
            "run_id",
            "r.release_role",
            "session_id",
            "r.assertion_id",
            result("expected_value"),
            result("actual_value"),
            result("difference"),
            result("status"),
            F.lit("ERROR").alias("severity"),
            result("message"),
            "evidence",
        )
    )
