"""The life of an attempt over stored tables: register, capture, finish, read back.

Every phase appends events to the attempt log and never changes one; receipts are what the log
tells. A phase takes any number of attempts at once. Writers are single: one job per folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterproof.operators.attempts import attempt_begin, attempt_captures, attempt_events, attempt_outcomes, attempt_receipts, frozen_evidence
from meterproof.operators.evidence import check_execution, expected_runs
from meterproof.operators.expectations import require_schema
from meterproof.operators.joins import spread_join
from meterproof.schemas import TABLES
from meterproof.sources.tables import append_immutable, ensure_table


@dataclass(frozen=True)
class Evidence:
    """Current tables that a capture reads."""

    input_session: DataFrame
    run_manifest: DataFrame
    release_verdict: DataFrame
    assertion_result: DataFrame


@dataclass(frozen=True)
class AttemptStore:
    """Tables of attempts under one folder."""

    spark: SparkSession
    root: str

    def table(self, name: str) -> DataFrame:
        return ensure_table(self.spark, self.root, name)

    def receipts(self) -> DataFrame:
        return attempt_receipts(self.table("attempt_log"))

    def _of(self, executions: DataFrame) -> DataFrame:
        return self.receipts().join(executions.select("execution_id").distinct(), "execution_id", "left_semi")

    def _log(self, events: DataFrame) -> None:
        self.table("attempt_log")
        require_schema(events, TABLES["attempt_log"]).write.mode("append").parquet(f"{self.root}/attempt_log")

    def begin(self, attempts: DataFrame, at: Column) -> DataFrame:
        """Registers attempts; registering one again changes nothing. Returns their receipts."""
        events = attempt_begin(attempts, at)
        self._log(events)
        return self._of(attempts.select(F.concat_ws(":", *[F.col(c).cast("string") for c in ("job_id", "job_run_id", "repair_count")]).alias("execution_id")))

    def capture(self, executions: DataFrame, evidence: Evidence, task_states: DataFrame, required_tasks: Sequence[str], at: Column) -> DataFrame:
        """Freezes the results of every attempt that may capture, whole attempts only, and logs each decision.

        Frozen rows are written first and their digest last, so an attempt whose capture broke off
        has no digest and cannot succeed; repeating the capture completes it. Evidence that
        differs from what is stored is refused. Returns (execution_id, runs, refusal).
        """
        e = evidence
        mine = self._of(executions)
        decided = attempt_captures(mine, e.input_session, e.run_manifest, e.release_verdict, e.assertion_result, task_states, required_tasks)
        # One row an attempt; an attempt lists its runs in its own receipt.
        rows = decided.collect()
        decisions = self.spark.createDataFrame(rows, decided.schema)
        allowed = [r["execution_id"] for r in rows if r["refusal"] is None]
        if allowed:
            self._freeze(mine.where(F.col("execution_id").isin(*allowed)), e, allowed, at)
        outcome = decisions.select(
            "execution_id", F.lit("RUNNING").alias("status"),
            F.coalesce(F.concat(F.lit("Capture refused: "), "refusal"), F.concat(F.lit("Captured runs: "), F.col("runs").cast("string"))).alias("reason"),
        )
        self._log(attempt_events(outcome, "capture", at, task_states))
        return decisions

    def _freeze(self, receipts: DataFrame, e: Evidence, allowed: list[str], at: Column) -> None:
        pairs = expected_runs(receipts)
        run_ids = [r["run_id"] for r in pairs.select("run_id").distinct().collect()]
        scope = F.col("execution_id").isin(*allowed)
        verdicts = e.release_verdict.where(F.col("run_id").isin(*run_ids)).join(pairs, "run_id")
        result = [f.name for f in TABLES["frozen_assertion"].fields if f.name != "execution_id"]
        current = e.assertion_result.where(F.col("run_id").isin(*run_ids)).select(*result)
        frozen = spread_join(current, pairs, ["run_id"], "session_id").select("execution_id", *result)
        append_immutable(self.spark, self.root, "frozen_assertion", frozen, run_ids, scope=scope)
        append_immutable(self.spark, self.root, "execution_verdict", verdicts, run_ids, scope=scope)
        stored = self.table("frozen_assertion").where(F.col("run_id").isin(*run_ids) & scope)
        digests = frozen_evidence(stored).select(*[f.name for f in TABLES["evidence_digest"].fields])
        append_immutable(self.spark, self.root, "evidence_digest", digests, run_ids, scope=scope)

    def finish(self, executions: DataFrame, task_states: DataFrame, required_tasks: Sequence[str], at: Column) -> DataFrame:
        """Logs the outcome of attempts and returns their receipts. What was frozen is counted and
        hashed again; an attempt that nobody registered is logged as failed."""
        ids = executions.select("execution_id").distinct()
        mine = self._of(ids)

        def of_mine(name: str) -> DataFrame:
            return self.table(name).join(ids, "execution_id", "left_semi")

        outcomes = attempt_outcomes(mine, of_mine("execution_verdict"), of_mine("evidence_digest"), of_mine("frozen_assertion"), task_states, required_tasks)
        every = ids.join(outcomes, "execution_id", "left").select("execution_id", F.coalesce("status", F.lit("FAILED")).alias("status"), F.coalesce("reason", F.lit("not_registered")).alias("reason"))
        self._log(attempt_events(every, "finish", at, task_states))
        return self._of(ids)

    def check(self, requested: DataFrame) -> DataFrame:
        """Exactly one row per requested (execution_id, run_id), from frozen evidence only."""
        return check_execution(requested, self.receipts(), self.table("execution_verdict"))


def run_attempts(
    store: AttemptStore, attempts: DataFrame, work: Callable[[DataFrame], tuple[Evidence, DataFrame]],
    capture_tasks: Sequence[str], finish_tasks: Sequence[str], at: Column,
) -> DataFrame:
    """Registers attempts, does their work, captures, finishes and reads them back.

    `work` takes the receipts of the attempts that run and gives the current tables and the state
    of each task (execution_id, task_key, state); an error it raises fails the attempts and
    reaches the caller. The capture itself counts as the task "capture" when `finish_tasks` names it.
    Returns one row per attempt and expected run.
    """
    receipts = store.begin(attempts, at)
    running = receipts.where("status = 'RUNNING'")
    ids = receipts.select("execution_id")
    no_states = store.spark.createDataFrame([], "execution_id STRING, task_key STRING, state STRING")
    try:
        evidence, states = work(running)
    except Exception:
        store.finish(ids, no_states, finish_tasks, at)
        raise
    decisions = store.capture(ids, evidence, states, capture_tasks, at)
    captured = decisions.select("execution_id", F.lit("capture").alias("task_key"), F.when(F.col("refusal").isNull(), "success").otherwise("failed").alias("state"))
    store.finish(ids, states.select("execution_id", "task_key", "state").unionByName(captured), finish_tasks, at)
    return store.check(expected_runs(store._of(ids)))
