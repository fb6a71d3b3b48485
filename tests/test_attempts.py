"""The life cycle of attempts over stored tables, and frozen evidence that changes afterwards."""

import json
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterproof.operators.attempts import CONTRADICTED, UNREGISTERED, attempt_begin, attempt_receipts, frozen_digest_check, frozen_evidence
from meterproof.operators.evidence import REPAIR
from meterproof.operators.expectations import ExpectationFailed
from meterproof.plans.attempts import AttemptStore, Evidence, run_attempts
from meterproof.schemas import RULES, TABLES
from meterproof.session import shared_dir

T = datetime(2026, 9, 1, 12)
CAPTURE, FINISH = ["land", "verdict"], ["land", "verdict", "capture"]
ATTEMPT = "job_id LONG, job_run_id LONG, repair_count INT, expected_run_ids_json STRING"
RUNS = ("run-1", "run-2")


def at(minutes):
    return F.lit(T + timedelta(minutes=minutes))


def attempt(spark, number, repair=0, runs=RUNS):
    return spark.createDataFrame([(7, number, repair, json.dumps(list(runs)))], ATTEMPT)


def evidence(spark, minutes, failing=(), drop=False):
    """Two runs of one session each; `failing` runs have one failed check of the candidate."""
    checks, verdicts = [], []
    for run in RUNS:
        bad = run in failing
        for role in ("baseline", "candidate"):
            for rule in RULES:
                status = "FAIL" if bad and role == "candidate" and rule == "amount_match" else "PASS"
                checks.append((run, role, "s", rule, "1", "1", None, status, "ERROR", "m", "{}"))
        word = "FAIL" if bad else "PASS"
        verdicts.append((run, "sc", 1, "b", "c", "t", 14, 13 if bad else 14, int(bad), 0, 0, 0, 0, 0, "PASS", word, word, "why", None, "{}", T + timedelta(minutes=minutes)))
    tables = TABLES
    return Evidence(
        spark.createDataFrame([(run, "s", "t") for run in RUNS], tables["input_session"]),
        spark.createDataFrame([(run, "sc", 1, "b", "c", "t", T) for run in RUNS], tables["run_manifest"]),
        spark.createDataFrame(verdicts, tables["release_verdict"]),
        spark.createDataFrame(checks[: -1 if drop else None], tables["assertion_result"]),
    )


def states(spark, number, **changed):
    rows = {"land": "success", "verdict": "success", **changed}
    return spark.createDataFrame([(f"7:{number}:0", k, v) for k, v in rows.items() if v != "absent"], "execution_id STRING, task_key STRING, state STRING")


@pytest.fixture
def store(spark):
    return AttemptStore(spark, f"{shared_dir(spark)}/attempts-{uuid.uuid4().hex}")


def run(store, number, found, task_states, minutes):
    out = run_attempts(store, attempt(store.spark, number), lambda running: (found, task_states), CAPTURE, FINISH, at(minutes))
    return {r.run_id: r for r in out.collect()}


def status(store, number, repair=0):
    return store.receipts().where(F.col("execution_id") == f"7:{number}:{repair}").collect()


def test_A_passes_B_fails_C_passes_and_nothing_is_borrowed(spark, store):
    a = run(store, 1, evidence(spark, 1, failing=["run-2"]), states(spark, 1), 0)
    assert {k: (v.execution_status, v.verdict) for k, v in a.items()} == {"run-1": ("SUCCEEDED", "PASS"), "run-2": ("SUCCEEDED", "FAIL")}
    # B starts after those verdicts and its own never come: it must not show A's.
    b = run(store, 2, evidence(spark, 1), states(spark, 2, verdict="failed"), 10)
    assert {(v.execution_status, v.verdict, v.passed_assertions) for v in b.values()} == {("FAILED", "BLOCKED", None)}
    c = run(store, 3, evidence(spark, 21), states(spark, 3), 20)
    assert {(v.execution_status, v.verdict, v.passed_assertions) for v in c.values()} == {("SUCCEEDED", "PASS", 14)}
    asked = spark.createDataFrame([("7:1:0", "run-1"), ("7:2:0", "run-1"), ("7:9:0", "run-1"), ("7:1:0", "nowhere")], "execution_id STRING, run_id STRING")
    found = {(r.execution_id, r.run_id): (r.execution_status, r.verdict) for r in store.check(asked).collect()}
    assert found == {
        ("7:1:0", "run-1"): ("SUCCEEDED", "PASS"), ("7:2:0", "run-1"): ("FAILED", "BLOCKED"),
        ("7:9:0", "run-1"): ("MISSING", "BLOCKED"), ("7:1:0", "nowhere"): ("SUCCEEDED", "BLOCKED"),
    }
    assert store.table("frozen_assertion").groupBy("execution_id").count().count() == 2


def test_stale_verdicts_and_missing_checks_are_not_captured(spark, store):
    stale = run(store, 1, evidence(spark, -1), states(spark, 1), 0)
    assert {v.verdict for v in stale.values()} == {"BLOCKED"}
    cut = run(store, 2, evidence(spark, 1, drop=True), states(spark, 2), 0)
    assert {v.verdict for v in cut.values()} == {"BLOCKED"}
    reasons = {r.execution_id: r.reason for r in store.table("attempt_log").where("phase = 'capture'").collect()}
    assert reasons == {"7:1:0": "Capture refused: stale_verdict", "7:2:0": "Capture refused: inconsistent_results"}
    assert store.table("frozen_assertion").count() == store.table("evidence_digest").count() == 0


@pytest.mark.parametrize("state", ["failed", "excluded", "SUCCESS", "", None, "absent"])
def test_every_task_needs_success(spark, store, state):
    out = run(store, 1, evidence(spark, 1), states(spark, 1, land=state), 0)
    assert {(v.execution_status, v.verdict) for v in out.values()} == {("FAILED", "BLOCKED")}


def test_a_repair_is_refused_and_stays_failed(spark, store):
    receipts = store.begin(attempt(spark, 5, repair=1), at(0)).collect()
    assert [(r.status, r.reason, r.finished_at) for r in receipts] == [("FAILED", REPAIR, T)]
    ids = spark.createDataFrame([("7:5:1",)], "execution_id STRING")
    good = spark.createDataFrame([("7:5:1", k, "success") for k in FINISH], "execution_id STRING, task_key STRING, state STRING")
    assert [r.refusal for r in store.capture(ids, evidence(spark, 1), good, CAPTURE, at(1)).collect()] == ["not_running"]
    done = store.finish(ids, good, FINISH, at(2)).collect()
    assert [(r.status, r.reason, r.finished_at) for r in done] == [("FAILED", REPAIR, T)]
    with pytest.raises(Exception, match="not an attempt"):
        store.begin(spark.createDataFrame([(0, 5, 0, "[]")], ATTEMPT), at(0))


def test_work_that_raises_fails_the_attempt(spark, store):
    def work(running):
        assert running.count() == 1
        raise RuntimeError("no data")

    with pytest.raises(RuntimeError, match="no data"):
        run_attempts(store, attempt(spark, 1), work, CAPTURE, FINISH, at(0))
    assert [(r.status, r.reason) for r in status(store, 1)] == [("FAILED", "tasks_incomplete")]


def test_capture_may_be_repeated_but_not_changed(spark, store):
    store.begin(attempt(spark, 1), at(0))
    ids = spark.createDataFrame([("7:1:0",)], "execution_id STRING")
    ok = states(spark, 1, capture="success")
    for _ in range(2):
        assert [(r.runs, r.refusal) for r in store.capture(ids, evidence(spark, 1), ok, CAPTURE, at(1)).collect()] == [(2, None)]
    assert store.table("frozen_assertion").count() == 28 and store.table("evidence_digest").count() == 2
    with pytest.raises(ExpectationFailed, match="immutable"):
        store.capture(ids, evidence(spark, 1, failing=["run-1"]), ok, CAPTURE, at(2))
    assert [r.status for r in store.finish(ids, ok, FINISH, at(3)).collect()] == ["SUCCEEDED"]
    # A later failure is final; a later success does not undo it.
    assert [r.status for r in store.finish(ids, states(spark, 1, land="failed"), FINISH, at(4)).collect()] == ["FAILED"]
    assert [(r.status, r.reason, r.finished_at) for r in store.finish(ids, ok, FINISH, at(5)).collect()] == [("FAILED", "tasks_incomplete", T + timedelta(minutes=3))]


@pytest.mark.parametrize("fault", ["changed", "lost", "added", "verdict"])
def test_finish_reads_the_frozen_rows_again(spark, store, fault):
    store.begin(attempt(spark, 1), at(0))
    ids = spark.createDataFrame([("7:1:0",)], "execution_id STRING")
    ok = states(spark, 1, capture="success")
    store.capture(ids, evidence(spark, 1), ok, CAPTURE, at(1))
    name = "execution_verdict" if fault == "verdict" else "frozen_assertion"
    stored = store.table(name)
    if fault == "changed":
        rows = stored.withColumn("actual_value", F.when(F.col("assertion_id") == "energy_match", "2").otherwise(F.col("actual_value")))
    elif fault == "lost":
        rows = stored.where("NOT (assertion_id = 'energy_match' AND run_id = 'run-1')")
    elif fault == "added":
        rows = stored.unionByName(stored.where("assertion_id = 'energy_match'"))
    else:
        rows = stored.withColumn("passed_assertions", F.lit(13).cast("bigint")).withColumn("failed_assertions", F.lit(1).cast("bigint")).withColumn("verdict", F.lit("FAIL"))
    changed = spark.createDataFrame(rows.select(*TABLES[name].names).collect(), TABLES[name])
    changed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("run_id").parquet(f"{store.root}/{name}")
    done = store.finish(ids, ok, FINISH, at(2)).collect()
    assert [(r.status, r.reason) for r in done] == [("FAILED", "contradicted_verdict" if fault == "verdict" else "changed_evidence")]
    assert {r.verdict for r in store.check(spark.createDataFrame([("7:1:0", r) for r in RUNS], "execution_id STRING, run_id STRING")).collect()} == {"BLOCKED"}


def test_finish_without_registration_leaves_a_failed_receipt(spark, store):
    ids = spark.createDataFrame([("7:4:0",)], "execution_id STRING")
    assert [(r.status, r.reason, r.job_run_id) for r in store.finish(ids, states(spark, 4), FINISH, at(1)).collect()] == [("FAILED", UNREGISTERED, "4")]


def test_the_log_is_told_in_any_order(spark):
    first = attempt_begin(attempt(spark, 1), at(0))
    other = attempt_begin(attempt(spark, 1, runs=["elsewhere"]), at(5))
    assert [r.status for r in attempt_receipts(first.unionByName(first)).collect()] == ["RUNNING"]
    for log in (first.unionByName(other), other.unionByName(first)):
        row = attempt_receipts(log).collect()[0]
        assert (row.status, row.reason, row.expected_run_ids_json) == ("FAILED", CONTRADICTED, json.dumps(list(RUNS)))
    assert attempt_receipts(first.limit(0)).collect() == []


def test_digests_tell_each_fault(spark):
    def frozen(rows):
        return spark.createDataFrame(rows, TABLES["frozen_assertion"])

    rows = [("e", "r", "s", "baseline", rule, "PASS", "1", None, None) for rule in RULES]
    bound = frozen_evidence(frozen(rows))

    def state(now):
        return {(r.execution_id, r.run_id): r.state for r in frozen_digest_check(bound, frozen(now)).collect()}

    moved = [(*r[:6], None, "1", None) for r in rows]  # the same text in the next column
    assert state(rows[::-1]) == {("e", "r"): "intact"} and state(moved) == {("e", "r"): "changed"}
    assert state(rows[1:]) == {("e", "r"): "lost"} and state(rows + rows[:1]) == {("e", "r"): "added"}
    assert state([]) == {("e", "r"): "missing"} and state(rows + [("e", "q", *rows[0][2:])])["e", "q"] == "unbound"
    assert {r.state for r in frozen_digest_check(bound.unionByName(bound), frozen(rows)).collect()} == {"changed"}
