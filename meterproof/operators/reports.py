"""Reports over frozen results; nothing is shown unless its evidence holds together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from meterproof.functions.columns import holds
from meterproof.operators.evidence import _by_session, batch_context
from meterproof.schemas import COUNTS, ROLES, RULES

# Texts shown in the summary.
NO_RECEIPT = "No evaluator receipt exists for this selection."
DUPLICATE_RECEIPTS = "Duplicate evaluator receipts: results cannot be trusted."
INCONSISTENT = "Saved evidence is missing, duplicated or inconsistent; billing results are blocked."

VERDICTS = ("baseline_verdict", "candidate_verdict", "verdict")
CHECKS = ("passed_checks", "failed_checks", "blocked_checks")


def _session_results(context: DataFrame, frozen: DataFrame) -> DataFrame:
    trusted = context.where("receipt_usable").select("execution_id", F.col("run_id").alias("context_run"))
    counted = _by_session(frozen.join(trusted, "execution_id", "left_semi"))
    own_run = (
        (F.col("lowest_run") == F.col("context_run"))
        & (F.col("highest_run") == F.col("context_run"))
        & (F.col("run_rows") == F.col("assertion_rows"))
    )
    covered = (F.col("assertion_rows") == len(RULES)) & (F.col("distinct_rules") == len(RULES))
    return counted.join(trusted, "execution_id").withColumn(
        "coverage_valid", holds(covered & F.col("known_values") & own_run)
    )


def session_results(requested: DataFrame, receipts: DataFrame, snapshots: DataFrame, frozen: DataFrame) -> DataFrame:
    """Frozen results of usable executions counted per session and release: what `execution_summary`
    and `session_bills` both start from. Store it once and give it to both."""
    return _session_results(batch_context(requested, receipts, snapshots), frozen)


def _checked(context: DataFrame, results: DataFrame) -> DataFrame:
    """The context with recounted totals and whether they agree with the snapshot."""

    def verdict(role: str | None):
        passed = F.col("passed_checks") == len(RULES)
        if role is not None:
            passed = passed | (F.col("release_role") != role)
        return F.when(F.bool_and(passed), "PASS").otherwise("FAIL")

    # Roles per session first: an execution's sessions are then counted without a distinct.
    per_session = results.groupBy("execution_id", "session_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and("coverage_valid").alias("coverage_valid"),
        F.sum("assertion_rows").alias("assertion_rows"),
        *[F.sum(c).alias(c) for c in CHECKS],
        *[verdict(role).alias(f"s_{role}") for role in ROLES],
        verdict(None).alias("s_all"),
    )
    totals = per_session.groupBy("execution_id").agg(
        F.sum("rows").alias("session_release_rows"),
        F.count(F.lit(1)).alias("observed_sessions"),
        F.bool_and("coverage_valid").alias("coverage_valid"),
        F.sum("assertion_rows").alias("observed_assertions"),
        *[F.sum(c).alias(c) for c in CHECKS],
        *[F.min(f"s_{role}").alias(f"t_{role}") for role in ROLES],
        F.min("s_all").alias("t_all"),
    )
    agrees = (
        F.col("coverage_valid")
        & (F.col("session_release_rows") == 2 * F.col("session_count"))
        & (F.col("observed_sessions") == F.col("session_count"))
        & (F.col("observed_assertions") == F.col("assertion_count"))
        # FAIL sorts before PASS, so the smallest text is the strictest verdict.
        & (F.col("t_baseline") == F.col("baseline_verdict"))
        & (F.col("t_candidate") == F.col("candidate_verdict"))
        & (F.col("t_all") == F.col("verdict"))
    )
    return context.join(totals, "execution_id", "left").withColumn(
        "usable", F.col("receipt_usable") & holds(agrees)
    )


def execution_summary(
    requested: DataFrame, receipts: DataFrame, snapshots: DataFrame, frozen: DataFrame, results: DataFrame | None = None
) -> DataFrame:
    """One row per requested execution; counts and verdicts only when its evidence is trusted."""
    context = batch_context(requested, receipts, snapshots)
    checked = _checked(context, _session_results(context, frozen) if results is None else results)
    usable = F.col("usable")
    return checked.select(
        "execution_id",
        "batch_id",
        "candidate_mode",
        "started_at",
        "finished_at",
        F.coalesce("status", F.lit("MISSING")).alias("evaluation_status"),
        F.when(F.col("receipt_rows").isNull(), NO_RECEIPT)
        .when(F.col("receipt_rows") != 1, DUPLICATE_RECEIPTS)
        .when(~holds(F.col("status") == "SUCCEEDED"), F.col("reason"))
        .when(~usable, INCONSISTENT)
        .otherwise(F.col("reason"))
        .alias("reason"),
        "usable",
        "captured_at",
        *[F.when(usable, F.col(c)).alias(c) for c in ("session_count", "assertion_count", *CHECKS)],
        *[F.when(usable, F.col(v)).otherwise("BLOCKED").alias(v) for v in VERDICTS],
    )


def session_bills(
    requested: DataFrame, receipts: DataFrame, snapshots: DataFrame, frozen: DataFrame, results: DataFrame | None = None
) -> DataFrame:
    """Expected and reported amount per session and release of trusted executions."""
    context = batch_context(requested, receipts, snapshots)
    results = _session_results(context, frozen) if results is None else results
    trusted = _checked(context, results).where("usable").select("execution_id")
    amounts = ("expected_amount", "actual_amount", "difference")
    return results.join(trusted, "execution_id", "left_semi").select(
        "execution_id",
        "session_id",
        "release_role",
        "currency",
        *[F.col(a).try_cast("decimal(38,6)").alias(a) for a in amounts],
        "amount_status",
        F.when(F.col("passed_checks") == len(RULES), "PASS").otherwise("FAIL").alias("verdict"),
        *CHECKS,
    )


def bills_ranked(bills: DataFrame) -> DataFrame:
    """Failures first."""
    return bills.orderBy(
        F.desc("failed_checks"), F.desc("blocked_checks"), "session_id", "release_role"
    )


def bills_pivot(frozen: DataFrame) -> DataFrame:
    """Tall results to one wide row per session and release."""
    return _by_session(frozen).select(
        "execution_id", "session_id", "release_role", "currency", "expected_amount", "actual_amount",
        "difference", "amount_status",
    )


def execution_choices(receipts: DataFrame) -> DataFrame:
    latest = receipts.sparkSession.range(1).select(F.lit("latest").alias("execution_id"))
    return latest.union(receipts.select("execution_id")).distinct()


def recent_attempts(receipts: DataFrame, n: int = 20) -> DataFrame:
    return receipts.orderBy(F.desc("started_at"), F.desc("execution_id")).limit(n)


def bills_complete(summary: DataFrame, bills: DataFrame) -> DataFrame:
    """Per summarised execution: one summary row, and two bills per session when it is usable."""
    rows = bills.groupBy("execution_id").agg(F.count(F.lit(1)).alias("bill_rows"))
    wanted = F.when(F.col("usable"), 2 * F.col("session_count")).otherwise(F.lit(0))
    return (
        summary.groupBy("execution_id")
        .agg(
            F.count(F.lit(1)).alias("summary_rows"),
            F.bool_and("usable").alias("usable"),
            F.max("session_count").alias("session_count"),
        )
        .join(rows, "execution_id", "left")
        .select(
            "execution_id",
            "summary_rows",
            F.coalesce("bill_rows", F.lit(0)).alias("bill_rows"),
            holds((F.col("summary_rows") == 1) & (F.coalesce("bill_rows", F.lit(0)) == wanted)).alias(
                "complete"
            ),
        )
    )


def bills_filter(bills: DataFrame, role: str = "all", verdict: str = "all") -> DataFrame:
    if role != "all":
        bills = bills.where(F.col("release_role") == role)
    return bills if verdict == "all" else bills.where(F.col("verdict") == verdict)


def cdr_zero_fill(manifests: DataFrame, cdrs: DataFrame) -> DataFrame:
    """Raw record count per run and release, zeros included."""
    grid = manifests.select("run_id").distinct().withColumn(
        "release_role", F.explode(F.array(*[F.lit(r) for r in ROLES]))
    )
    counts = cdrs.groupBy("run_id", "release_role").agg(F.count(F.lit(1)).alias("cdr_rows"))
    return grid.join(counts, ["run_id", "release_role"], "left").withColumn(
        "cdr_rows", F.coalesce("cdr_rows", F.lit(0))
    )


def status_counts(assertions: DataFrame) -> DataFrame:
    return assertions.groupBy("run_id", "release_role", "assertion_id", "status").agg(
        F.count(F.lit(1)).alias("assertion_rows")
    )


def role_summary(verdicts: DataFrame) -> DataFrame:
    """Counts and verdict of each release, read from the evidence of the run's verdict."""
    per_role = F.explode(F.array(*[
        F.struct(F.lit(role).alias("release_role"), F.get_json_object("evidence", f"$.{role}").alias("summary")) for role in ROLES
    ]))
    rows = verdicts.select("run_id", per_role.alias("r")).select("run_id", "r.*")
    counts = [F.get_json_object("summary", f"$.{name}").cast("bigint").alias(name) for name in COUNTS]
    return rows.select("run_id", "release_role", *counts, F.get_json_object("summary", "$.verdict").alias("verdict"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table; a table without rows counts as 0."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
