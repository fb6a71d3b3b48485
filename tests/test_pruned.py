"""What the readers of check results do not compute, as their plans show."""

from meterproof.operators import assertions, reports, verdict
from tests.scenario import Case, cdr


def _stored(case):
    """Layers as rows: the plans of their readers hold the readers' own work only."""
    r = case.results
    return [case.spark.createDataFrame(f.collect(), f.schema) for f in (r.expected_ledger, r.session_lifecycle, r.actual_ledger)]


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_readers_of_the_status_compute_no_evidence(spark):
    """F6, F16, F17, F18, F19, F25: neither digests nor evidence nor texts for who reads a status or a grid."""
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    layers = _stored(Case(spark, cdrs=[cdr(), cdr(role="candidate", amount="6.50")]))
    checks = assertions.assertion_result(*layers)
    costly = ("sha2(", "rule_version", "Require exactly one final CDR")
    assert all(text in _plan(checks) for text in costly)
    for reader in (reports.status_counts(checks), assertions.release_grid(*layers), verdict.checked_keys(*layers, checks)):
        assert not any(text in _plan(reader) for text in costly)
    counted = {}
    for row in checks.collect():
        key = (row.release_role, row.assertion_id, row.status)
        counted[key] = counted.get(key, 0) + 1
    found = {(r.release_role, r.assertion_id, r.status): r.assertion_rows for r in reports.status_counts(checks).collect()}
    assert found == counted and sum(found.values()) == 14 and found["candidate", "amount_match", "FAIL"] == 1
