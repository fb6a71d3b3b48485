"""Declared table schemas, logical keys and the fixed vocabulary of the checks."""

from __future__ import annotations

from pyspark.sql import types as T

# Names that appear in stored results.
ROLES = ("baseline", "candidate")
RULES = (
    "oracle_available",
    "final_cdr_count",
    "energy_match",
    "duration_match",
    "currency_match",
    "tariff_match",
    "amount_match",
)
STATUSES = ("PASS", "FAIL", "BLOCKED")
EVENT_TYPES = ("Started", "Updated", "Ended")
RULE_VERSION = "v1"
ASSERTIONS_PER_SESSION = len(ROLES) * len(RULES)

COUNTS = (
    "required_assertions",
    "passed_assertions",
    "failed_assertions",
    "blocked_assertions",
    "missing_assertions",
    "duplicate_assertion_keys",
    "unexpected_assertions",
    "invalid_assertions",
)
DEFECTS = COUNTS[4:]
PROVENANCE = ("scenario_id", "seed", "baseline_sha", "candidate_sha", "tariff_hash")

MONEY = T.DecimalType(18, 6)


_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "TIMESTAMP": T.TimestampType(),
    "DECIMAL(18,2)": T.DecimalType(18, 2),
    "DECIMAL(18,6)": MONEY,
    "DECIMAL(37,12)": T.DecimalType(37, 12),
    "DECIMAL(38,6)": T.DecimalType(38, 6),
    "STRINGS": T.ArrayType(T.StringType()),
    "COMPONENTS": T.ArrayType(
        T.StructType()
        .add("type", T.StringType())
        .add("price", MONEY)
        .add("step_size", T.IntegerType())
    ),
}


def _table(columns: str, optional: str = "") -> T.StructType:
    """Schema from "name TYPE, ..." in which every column is required unless listed as optional.

    Needs no session, so that schemas can be imported before one exists.
    """
    nullable = set(optional.split())
    fields = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind], name in nullable) for name, kind in fields])


_COUNT_COLUMNS = ", ".join(f"{name} BIGINT" for name in COUNTS)

TABLES: dict[str, T.StructType] = {
    "run_manifest": _table(
        "run_id STRING, scenario_id STRING, seed BIGINT, baseline_sha STRING, candidate_sha STRING, "
        "tariff_hash STRING, created_at TIMESTAMP"
    ),
    "input_session": _table("run_id STRING, session_id STRING, tariff_id STRING"),
    "events_raw": _table(
        "run_id STRING, event_id STRING, charging_station_id STRING, transaction_id STRING, "
        "event_type STRING, sequence_number BIGINT, event_time TIMESTAMP, ingest_time TIMESTAMP, "
        "payload STRING, payload_hash STRING"
    ),
    "tariffs_raw": _table(
        "run_id STRING, tariff_id STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, currency STRING, "
        "payload STRING, payload_hash STRING",
        optional="valid_to",
    ),
    "cdrs_raw": _table(
        "run_id STRING, release_role STRING, country_code STRING, party_id STRING, cdr_id STRING, "
        "session_id STRING, cdr_type STRING, currency STRING, total_cost DECIMAL(18,6), "
        "payload STRING, payload_hash STRING, ingest_time TIMESTAMP",
        optional="country_code party_id cdr_id session_id cdr_type currency total_cost",
    ),
    "landing": _table(
        "raw_record STRING, record_hash STRING, source_file_path STRING, source_file_name STRING, "
        "source_file_modification_time TIMESTAMP, ingested_at TIMESTAMP"
    ),
    "job_execution": _table(
        "execution_id STRING, job_id STRING, job_run_id STRING, repair_count INT, status STRING, "
        "expected_run_ids_json STRING, started_at TIMESTAMP, finished_at TIMESTAMP, "
        "task_states_json STRING, reason STRING",
        optional="finished_at task_states_json",
    ),
    "attempt_log": _table(
        "execution_id STRING, phase STRING, event_at TIMESTAMP, status STRING, reason STRING, job_id STRING, "
        "job_run_id STRING, repair_count INT, expected_run_ids_json STRING, task_states_json STRING",
        optional="job_id job_run_id repair_count expected_run_ids_json task_states_json",
    ),
    "batch_execution": _table(
        "execution_id STRING, batch_id STRING, candidate_mode STRING, pipeline_hash STRING, "
        "status STRING, reason STRING, run_id STRING, started_at TIMESTAMP, finished_at TIMESTAMP",
        optional="run_id finished_at",
    ),
    "session_lifecycle": _table(
        "run_id STRING, session_id STRING, started_at TIMESTAMP, ended_at TIMESTAMP, "
        "meter_start_wh BIGINT, meter_end_wh BIGINT, status STRING",
        optional="ended_at meter_end_wh",
    ),
    "tariff_history": _table(
        "run_id STRING, tariff_id STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, currency STRING, "
        "price_components COMPONENTS, "
        "source_payload_hash STRING",
        optional="valid_to",
    ),
    "expected_ledger": _table(
        "run_id STRING, session_id STRING, tariff_id STRING, tariff_valid_from TIMESTAMP, "
        "tariff_payload_hash STRING, currency STRING, expected_energy_kwh DECIMAL(18,6), "
        "price_per_kwh DECIMAL(18,6), expected_amount_unrounded DECIMAL(37,12), "
        "expected_amount DECIMAL(18,2)"
    ),
    "actual_ledger": _table(
        "run_id STRING, release_role STRING, country_code STRING, party_id STRING, cdr_id STRING, "
        "session_id STRING, cdr_type STRING, started_at TIMESTAMP, ended_at TIMESTAMP, currency STRING, "
        "actual_energy_kwh DECIMAL(18,6), actual_duration_hours DECIMAL(18,6), "
        "actual_amount DECIMAL(18,6), tariff_id STRING, source_payloads BIGINT, "
        # Order-free digest of the payload hashes, which are rows of their own.
        "source_digest STRING"
    ),
    "assertion_result": _table(
        "run_id STRING, release_role STRING, session_id STRING, assertion_id STRING, "
        "expected_value STRING, actual_value STRING, difference DECIMAL(38,6), status STRING, "
        "severity STRING, message STRING, evidence STRING",
        optional="expected_value actual_value difference",
    ),
    "release_verdict": _table(
        "run_id STRING, scenario_id STRING, seed BIGINT, baseline_sha STRING, candidate_sha STRING, "
        f"tariff_hash STRING, {_COUNT_COLUMNS}, baseline_verdict STRING, candidate_verdict STRING, "
        "verdict STRING, reason STRING, first_problem STRING, evidence STRING, evaluated_at TIMESTAMP",
        optional="scenario_id seed baseline_sha candidate_sha tariff_hash first_problem",
    ),
    "execution_verdict": _table(
        "execution_id STRING, run_id STRING, baseline_verdict STRING, candidate_verdict STRING, "
        f"verdict STRING, {_COUNT_COLUMNS}, reason STRING, first_problem STRING, evaluated_at TIMESTAMP",
        optional="first_problem",
    ),
    "batch_verdict": _table(
        "execution_id STRING, run_id STRING, input_hash STRING, pipeline_hash STRING, "
        "session_count BIGINT, assertion_count BIGINT, baseline_verdict STRING, "
        "candidate_verdict STRING, verdict STRING, captured_at TIMESTAMP"
    ),
    "frozen_assertion": _table(
        "execution_id STRING, run_id STRING, session_id STRING, release_role STRING, "
        "assertion_id STRING, status STRING, expected_value STRING, actual_value STRING, "
        "difference DECIMAL(38,6)",
        optional="expected_value actual_value difference",
    ),
    "evidence_digest": _table("execution_id STRING, run_id STRING, frozen_rows BIGINT, frozen_digest STRING"),
}

# Logical keys. Raw tariffs include valid_from so that one tariff may have several periods.
KEYS: dict[str, tuple[str, ...]] = {
    "run_manifest": ("run_id",),
    "input_session": ("run_id", "session_id"),
    "events_raw": ("run_id", "event_id"),
    "tariffs_raw": ("run_id", "tariff_id", "valid_from"),
    "cdrs_raw": ("run_id", "release_role", "payload_hash"),
    "job_execution": ("execution_id",),
    "batch_execution": ("execution_id",),
    "session_lifecycle": ("run_id", "session_id"),
    "tariff_history": ("run_id", "tariff_id", "valid_from"),
    "expected_ledger": ("run_id", "session_id"),
    "actual_ledger": ("run_id", "release_role", "country_code", "party_id", "cdr_id"),
    "assertion_result": ("run_id", "release_role", "session_id", "assertion_id"),
    "release_verdict": ("run_id",),
    "execution_verdict": ("execution_id", "run_id"),
    "batch_verdict": ("execution_id",),
    "evidence_digest": ("execution_id", "run_id"),
    # One session may belong to several runs of an attempt.
    "frozen_assertion": ("execution_id", "run_id", "session_id", "release_role", "assertion_id"),
}
