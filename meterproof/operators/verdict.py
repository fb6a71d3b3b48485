"""Fail-closed verdicts: every required check must be present once and pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from meterproof.functions.columns import broken_rules, total
from meterproof.operators.assertions import release_grid
from meterproof.schemas import COUNTS, DEFECTS, PROVENANCE, ROLES, RULES, RULE_VERSION, STATUSES

KEY = ("run_id", "release_role", "session_id", "assertion_id")

# Problem kinds by priority, with the text stored for each.
PROBLEMS = (
    (1, "MANIFEST_COUNT", "Require exactly one run manifest; inspect run_manifest."),
    (2, "NO_REQUIRED_CHECKS", "No required checks for this release; an empty run cannot pass."),
    (3, "MISSING_ASSERTION", "Required assertion is absent; inspect the session and assertion job."),
    (4, "DUPLICATE_ASSERTION", "Multiple rows have the same assertion key; no arbitrary result is accepted."),
    (5, "UNEXPECTED_ASSERTION", "Assertion key is outside the required Silver session/release/rule set."),
    (6, "INVALID_STATUS", "Assertion status must be PASS, FAIL or BLOCKED."),
    (7, "FAILED_ASSERTION", "Assertion failed; inspect its expected/actual values, message and evidence."),
    (8, "BLOCKED_ASSERTION", "Assertion could not be evaluated; inspect its prerequisite and evidence."),
)
#: What is counted of the observed rows of a check.
COUNTED = ("assertion_rows", "passed_assertions", "failed_assertions", "blocked_assertions", "invalid_assertions")
ALL_PASSED = "All required assertions passed exactly once for baseline and candidate."
KINDS = {kind: priority for priority, kind, _ in PROBLEMS}


def _problem_text(priority: Column, position: int) -> Column:
    names = F.array(*[F.lit(problem[position]) for problem in PROBLEMS])
    return F.try_element_at(names, priority)


def singleton_value(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Row count per key, and values only where the key has exactly one row."""
    one = F.count(F.lit(1)) == 1
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("key_rows"), *[F.when(one, F.max(c)).alias(c) for c in columns]
    )


def checked_keys(
    expected: DataFrame, sessions: DataFrame, actual: DataFrame, assertions: DataFrame
) -> DataFrame:
    """Required and observed checks side by side, one row per check key.

    Both are counted in one aggregation, which is the full outer join of the two
    sets without joining. It runs per session and release with counters of every rule, so what is
    shuffled and held is a row per session and release, not one per check; a rule that nobody
    knows has a row of its own.
    """
    required = release_grid(expected, sessions, actual).select(
        "run_id", "release_role", "session_id", F.lit(True).alias("known"), F.lit(1).alias("required")
    )
    known = F.coalesce(F.col("assertion_id").isin(*RULES), F.lit(False))
    observed = assertions.select(
        *KEY[:3],
        known.alias("known"),
        F.when(~known, F.col("assertion_id")).alias("other"),
        F.when(known, F.col("assertion_id")).alias("rule"),
        "status",
        F.lit(1).alias("seen"),
    )

    def counts(place: int, here: Column) -> list[Column]:
        seen = [F.count_if(here).alias(f"seen{place}")]
        return seen + [F.count_if(here & (F.col("status") == status)).alias(f"{status}{place}") for status in STATUSES]

    # Place 0 counts the rows of an unknown rule.
    places = counts(0, F.col("seen").isNotNull() & F.col("rule").isNull())
    for place, rule in enumerate(RULES, start=1):
        places += counts(place, F.col("rule") == rule)
    counted = (
        required.unionByName(observed, allowMissingColumns=True)
        .groupBy(*KEY[:3], "known", "other")
        .agg(total("required").alias("required_assertions"), *places)
    )

    def check(place: int, rule: Column) -> Column:
        return F.struct(F.lit(place).alias("place"), rule.alias("assertion_id"))

    def found(name: str) -> Column:
        """A counter of the check at hand: nothing is pruned out of a generator, so counters stay beside it."""
        chosen = F.when(F.col("c.place") == 0, F.col(f"{name}0"))
        for place in range(1, len(RULES) + 1):
            chosen = chosen.when(F.col("c.place") == place, F.col(f"{name}{place}"))
        return chosen

    of_rules = F.array(*[check(place, F.lit(rule)) for place, rule in enumerate(RULES, start=1)])
    checks = F.when(F.col("known"), of_rules).otherwise(F.array(check(0, F.col("other"))))
    read = [found(name) for name in ("seen", *STATUSES)]
    invalid = reduce(lambda a, b: a - b, read)
    return (
        counted.withColumn("c", F.explode(checks))
        .select(*KEY[:3], "c.assertion_id", "required_assertions", *[v.alias(n) for v, n in zip([*read, invalid], COUNTED)])
        .where("required_assertions > 0 OR assertion_rows > 0")
        .withColumn(
            "missing_assertions",
            ((F.col("required_assertions") == 1) & (F.col("assertion_rows") == 0)).cast("bigint"),
        )
        .withColumn("duplicate_assertion_keys", (F.col("assertion_rows") > 1).cast("bigint"))
        .withColumn(
            "unexpected_assertions",
            F.when(F.col("required_assertions") == 0, F.col("assertion_rows")).otherwise(F.lit(0)),
        )
    )


def _key_problems() -> dict[str, Column]:
    return {
        "MISSING_ASSERTION": F.col("missing_assertions") > 0,
        "DUPLICATE_ASSERTION": F.col("duplicate_assertion_keys") > 0,
        "UNEXPECTED_ASSERTION": F.col("unexpected_assertions") > 0,
        "INVALID_STATUS": F.col("invalid_assertions") > 0,
        "FAILED_ASSERTION": F.col("failed_assertions") > 0,
        "BLOCKED_ASSERTION": F.col("blocked_assertions") > 0,
    }


def missing_assertions(keys: DataFrame) -> DataFrame:
    return keys.where("missing_assertions > 0").select(*KEY)


def unexpected_assertions(keys: DataFrame) -> DataFrame:
    return keys.where("unexpected_assertions > 0").select(*KEY, "unexpected_assertions")


def _by_release(keys: DataFrame) -> DataFrame:
    """Counts per (run, role), unknown roles included, and each role's first problem."""
    first = F.coalesce(
        *[F.when(found, F.lit(KINDS[kind])) for kind, found in _key_problems().items()]
    )
    reference = F.struct(
        first.alias("priority"), F.col("release_role"), F.col("session_id"), F.col("assertion_id")
    )
    # A minimum of structs alone is found by sorting all checks; beside a collection, which is empty here, by hash.
    none = F.collect_set(F.lit(None).cast("int"))
    return keys.groupBy("run_id", "release_role").agg(
        *[total(name).alias(name) for name in COUNTS],
        F.when(F.size(none) == 0, F.min(F.when(first.isNotNull(), reference))).alias("first_problem"),
    )


def _by_run(
    manifests: DataFrame,
    expected: DataFrame,
    sessions: DataFrame,
    actual: DataFrame,
    keys: DataFrame,
) -> DataFrame:
    """One row per run named anywhere: manifest, both releases, totals and first problem.

    Release counts, manifests and bare run ids are stacked and grouped once, so runs
    without manifest, sessions or results keep a row and nothing has to be joined.
    Inputs are reduced to their distinct run ids before they are stacked.
    """
    counted = F.struct(*COUNTS)
    stacked = _by_release(keys).select(
        "run_id", "release_role", counted.alias("counts"), "first_problem"
    )
    provenance = manifests.select("run_id", F.struct(*PROVENANCE).alias("provenance"))
    stacked = stacked.unionByName(provenance, allowMissingColumns=True)
    for frame in (expected, sessions, actual):
        stacked = stacked.unionByName(frame.select("run_id").distinct(), allowMissingColumns=True)
    grouped = stacked.groupBy("run_id").agg(
        F.count("provenance").alias("manifest_rows"),
        F.when(F.count("provenance") == 1, F.max("provenance")).alias("provenance"),
        *[F.max(F.when(F.col("release_role") == role, F.col("counts"))).alias(role) for role in ROLES],
        *[total(f"counts.{name}").alias(name) for name in COUNTS],
        F.min("first_problem").alias("key_problem"),
    )
    return grouped.withColumns({role: _release(role) for role in ROLES})


def _release(role: str) -> Column:
    """Counts of one release, zeros when it has none, with its verdict in front."""
    counts = {name: F.coalesce(f"{role}.{name}", F.lit(0)) for name in COUNTS}
    clean = reduce(
        lambda a, b: a & b,
        [counts[name] == 0 for name in ("failed_assertions", "blocked_assertions", *DEFECTS)],
    )
    passed = (
        (F.col("manifest_rows") == 1)
        & (counts["required_assertions"] > 0)
        & (counts["passed_assertions"] == counts["required_assertions"])
        & clean
    )
    return F.struct(
        F.when(passed, "PASS").otherwise("FAIL").alias("verdict"),
        *[value.alias(name) for name, value in counts.items()],
    )


def _counts(by_run: DataFrame) -> DataFrame:
    releases = F.array(*[F.struct(F.lit(r).alias("release_role"), F.col(r).alias("c")) for r in ROLES])
    return by_run.select("run_id", "manifest_rows", F.explode(releases).alias("r")).select(
        "run_id",
        "r.release_role",
        "manifest_rows",
        *[F.col(f"r.c.{name}").alias(name) for name in COUNTS],
        F.col("r.c.verdict").alias("release_verdict"),
    )


def release_counts(
    manifests: DataFrame,
    expected: DataFrame,
    sessions: DataFrame,
    actual: DataFrame,
    keys: DataFrame,
) -> DataFrame:
    """Both releases of every run with their counts and verdict."""
    return _counts(_by_run(manifests, expected, sessions, actual, keys))


def problem_union(
    manifests: DataFrame,
    expected: DataFrame,
    sessions: DataFrame,
    actual: DataFrame,
    keys: DataFrame,
) -> DataFrame:
    """Every problem of every run as a row."""
    counts = release_counts(manifests, expected, sessions, actual, keys)
    nobody = F.lit(None).cast("string")
    of_run = (
        counts.where("manifest_rows <> 1")
        .select("run_id")
        .distinct()
        .select("run_id", F.lit("MANIFEST_COUNT").alias("problem_type"))
    )
    of_release = counts.where("required_assertions = 0").select(
        "run_id", F.lit("NO_REQUIRED_CHECKS").alias("problem_type"), "release_role"
    )
    kinds = broken_rules({kind: ~found for kind, found in _key_problems().items()})
    of_key = keys.select("run_id", F.explode(kinds).alias("problem_type"), *KEY[1:])
    stacked = of_key.unionByName(of_release, allowMissingColumns=True).unionByName(
        of_run.withColumn("release_role", nobody), allowMissingColumns=True
    )
    priority = F.try_element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), "problem_type")
    return stacked.withColumn("priority", priority).withColumn("message", _problem_text(priority, 2))


def _first_problem() -> Column:
    """The run's own problems come before those of its checks; NULL when there is none."""

    def run_level(priority: int, role: str | None) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(
            F.lit(priority).alias("priority"),
            (none if role is None else F.lit(role)).alias("release_role"),
            none.alias("session_id"),
            none.alias("assertion_id"),
        )

    return F.coalesce(
        F.when(F.col("manifest_rows") != 1, run_level(1, None)),
        *[F.when(F.col(f"{role}.required_assertions") == 0, run_level(2, role)) for role in ROLES],
        F.col("key_problem"),
    )


def first_problem(
    manifests: DataFrame,
    expected: DataFrame,
    sessions: DataFrame,
    actual: DataFrame,
    keys: DataFrame,
) -> DataFrame:
    """The first problem of each run: by priority, then release, session and rule, NULLs first.

    A minimum over a struct replaces ranking a run's problems in one task.
    """
    return (
        _by_run(manifests, expected, sessions, actual, keys)
        .select("run_id", _first_problem().alias("p"))
        .where(F.col("p").isNotNull())
        .select("run_id", "p.*")
        .withColumn("problem_type", _problem_text(F.col("priority"), 1))
        .withColumn("message", _problem_text(F.col("priority"), 2))
    )


def release_verdict(
    manifests: DataFrame,
    expected: DataFrame,
    sessions: DataFrame,
    actual: DataFrame,
    assertions: DataFrame,
    evaluated_at: Column | None = None,
) -> DataFrame:
    """One fail-closed decision per run, counting results of unknown releases as well."""
    keys = checked_keys(expected, sessions, actual, assertions)
    clean = reduce(
        lambda a, b: a & b,
        [F.col(n) == 0 for n in ("unexpected_assertions", "invalid_assertions", "duplicate_assertion_keys")],
    )
    both = reduce(lambda a, b: a & b, [F.col(f"{role}.verdict") == "PASS" for role in ROLES])
    found = F.col("p").isNotNull()
    kind, message = (_problem_text(F.col("p.priority"), i) for i in (1, 2))
    problem = F.struct(
        kind.alias("problem_type"),
        F.col("run_id"),
        F.col("p.release_role").alias("release_role"),
        F.col("p.session_id").alias("session_id"),
        F.col("p.assertion_id").alias("assertion_id"),
        message.alias("message"),
    )
    return (
        _by_run(manifests, expected, sessions, actual, keys)
        .withColumn("p", _first_problem())
        .select(
            "run_id",
            *[F.col(f"provenance.{name}").alias(name) for name in PROVENANCE],
            *COUNTS,
            *[F.col(f"{role}.verdict").alias(f"{role}_verdict") for role in ROLES],
            F.when(both & clean, "PASS").otherwise("FAIL").alias("verdict"),
            F.when(found, F.concat(kind, F.lit(": "), message))
            .otherwise(F.lit(ALL_PASSED))
            .alias("reason"),
            F.when(found, F.to_json(problem)).alias("first_problem"),
            F.to_json(
                F.struct(F.lit(RULE_VERSION).alias("rule_version"), "manifest_rows", *ROLES)
            ).alias("evidence"),
            (evaluated_at if evaluated_at is not None else F.current_timestamp()).alias("evaluated_at"),
        )
    )
