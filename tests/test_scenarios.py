"""Outcomes of the known scenarios and the negative cases around them."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterproof.operators import assertions, ledger, verdict
from meterproof.schemas import KEYS, TABLES
from tests.scenario import TARIFF, Case, cdr, event, session_events


def counts(v):
    return v.passed_assertions, v.failed_assertions, v.blocked_assertions


def test_healthy(spark):
    case = Case(spark)
    v = case.verdict()
    assert (v.verdict, counts(v), v.first_problem) == ("PASS", (14, 0, 0), None)
    charge = case.results.expected_ledger.collect()[0]
    assert (charge.expected_amount_unrounded, charge.expected_amount) == (
        Decimal("5.625000000000"),
        Decimal("5.63"),
    )
    assert case.checks()["amount_match"].expected_value == "5.630000"


def test_declared_schemas(spark):
    results = Case(spark).results
    for name in ("session_lifecycle", "tariff_history", "expected_ledger", "actual_ledger", "assertion_result", "release_verdict"):
        found = getattr(results, name)
        assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in TABLES[name]], name
        assert found.groupBy(*KEYS[name]).count().where("count > 1").count() == 0


def test_wrong_amount(spark):
    case = Case(spark, cdrs=[cdr(), cdr(role="candidate", amount="6.50")])
    v = case.verdict()
    assert (v.baseline_verdict, v.candidate_verdict, v.verdict, counts(v)) == ("PASS", "FAIL", "FAIL", (13, 1, 0))
    row = case.checks()["amount_match"]
    assert (row.status, row.difference) == ("FAIL", Decimal("0.870000"))
    assert '"assertion_id":"amount_match"' in v.first_problem


def test_missing_record(spark):
    case = Case(spark, cdrs=[cdr()])
    v = case.verdict()
    assert counts(v) == (8, 1, 5)
    checks = case.checks()
    assert checks["final_cdr_count"].difference == Decimal("-1.000000")
    assert checks["final_cdr_count"].message.startswith("MISSING_CDR")
    assert all(checks[r].actual_value is None and checks[r].status == "BLOCKED" for r in ("energy_match", "amount_match"))


def test_duplicate_records_are_never_summed(spark):
    halves = [cdr(role="candidate", cdr_id="a", amount="2.63"), cdr(role="candidate", cdr_id="b", amount="3.00")]
    case = Case(spark, cdrs=[cdr(), *halves])
    checks = case.checks()
    assert checks["final_cdr_count"].difference == Decimal("1.000000")
    assert checks["amount_match"].status == "BLOCKED"
    assert '"cdr_count":2' in checks["final_cdr_count"].evidence
    records = assertions.assertion_records(case.results.actual_ledger)
    assert records.where("release_role = 'candidate'").count() == 2


def test_currency_blocks_the_amount(spark):
    checks = Case(spark, cdrs=[cdr(), cdr(role="candidate", currency="USD")]).checks()
    assert checks["currency_match"].status == "FAIL"
    assert (checks["amount_match"].status, checks["amount_match"].actual_value) == ("BLOCKED", "5.630000")


def test_tariff_alone_fails(spark):
    checks = Case(spark, cdrs=[cdr(), cdr(role="candidate", tariff="t2")]).checks()
    assert {rule for rule, row in checks.items() if row.status == "FAIL"} == {"tariff_match"}


def test_actual_only_session_is_checked_for_its_own_release(spark):
    case = Case(spark, events=[], registry=[], cdrs=[cdr(role="candidate")])
    assert case.checks("baseline") == {}
    checks = case.checks()
    assert checks["oracle_available"].status == "FAIL"
    assert sum(row.status == "BLOCKED" for row in checks.values()) == 6


def test_unfinished_session(spark):
    case = Case(spark, events=session_events()[:2])
    assert case.results.expected_ledger.count() == 0
    assert case.checks()["oracle_available"].status == "FAIL"


def test_empty_run_fails(spark):
    v = Case(spark, events=[], registry=[], cdrs=[]).verdict()
    assert (v.verdict, v.required_assertions) == ("FAIL", 0)
    assert v.reason.startswith("NO_REQUIRED_CHECKS")


@pytest.mark.parametrize("manifests", [0, 2])
def test_manifest_must_be_unique(spark, manifests):
    v = Case(spark, manifests=manifests).verdict()
    assert (v.verdict, v.scenario_id) == ("FAIL", None)
    assert v.reason.startswith("MANIFEST_COUNT")


def test_damaged_results_fail_closed(spark):
    case = Case(spark)
    r = case.results
    rows = r.assertion_result
    inputs = (case.manifests, r.expected_ledger, r.session_lifecycle, r.actual_ledger)
    rule = F.col("assertion_id") == "energy_match"
    damaged = {
        "MISSING_ASSERTION": rows.where(~rule),
        "DUPLICATE_ASSERTION": rows.unionByName(rows.where(rule)),
        "UNEXPECTED_ASSERTION": rows.unionByName(
            rows.where(rule & (F.col("release_role") == "baseline")).withColumn("release_role", F.lit("shadow"))
        ),
        "INVALID_STATUS": rows.withColumn("status", F.when(rule, "ODD").otherwise(F.col("status"))),
    }
    for kind, changed in damaged.items():
        v = verdict.release_verdict(*inputs, changed).collect()[0]
        assert v.verdict == "FAIL" and v.reason.startswith(kind), kind


def test_half_cent_ties(spark):
    wh = {"a": (3300, "1.49"), "b": (58300, "26.24"), "c": (16500, "7.43")}
    events = [e for s, (used, _) in wh.items() for e in session_events(session=s, start=0, end=used)]
    case = Case(spark, events=events, registry=[("r", s, "t1") for s in wh], cdrs=[])
    found = {row.session_id: str(row.expected_amount) for row in case.results.expected_ledger.collect()}
    assert found == {s: amount for s, (_, amount) in wh.items()}


def test_duration_tie(spark):
    from meterproof.functions.columns import hours

    rows = spark.createDataFrame([(1800,), (1799,), (3_600_000_000,)], "us BIGINT").select(hours(F.col("us")).alias("h"))
    assert [str(r.h) for r in rows.collect()] == ["0.000001", "0.000000", "1.000000"]


def test_reading_belongs_to_the_chosen_event(spark):
    events = [event("r", "s", "Started", 0, 9), event("r", "s", "Started", 5, 1000, 7), event("r", "s", "Ended", 60, 20)]
    row = Case(spark, events=events).results.session_lifecycle.collect()[0]
    assert (row.meter_start_wh, row.meter_end_wh) == (9, 20)


def test_session_must_fit_one_period(spark):
    t = lambda a, b: ("r", "t1", a, b, "EUR", TARIFF % ("t1", "0.45"))
    start, middle = datetime(2026, 1, 1), datetime(2026, 8, 22, 10, 30)
    for periods in ([], [t(start, middle), t(middle, None)], [t(start, None), t(datetime(2026, 2, 1), None)]):
        assert Case(spark, tariffs=periods).results.expected_ledger.count() == 0


@pytest.mark.parametrize(
    "amount, ok",
    [("5.63", True), ("5.630000", True), ("5.6300001", False), ("563e-2", False), ("-1", False), ('"5.63"', True), ("null", False)],
)
def test_exact_amounts(spark, amount, ok):
    row = ledger.cdr_validate(Case(spark, cdrs=[cdr(amount=amount)]).cdrs).collect()[0]
    assert row.ok is ok


def test_equivalent_payloads_collapse_and_conflicts_are_quarantined(spark):
    run, role, payload = cdr(cdr_id="c1")
    spaced = payload.replace('{"country', '{ "country').replace('"c1"', '"C1"')
    case = Case(spark, cdrs=[(run, role, payload), (run, role, payload), (run, role, spaced)])
    row = case.results.actual_ledger.collect()[0]
    assert row.source_payloads == 2 and ledger.cdr_sources(case.cdrs).count() == 2
    other = Case(spark, cdrs=[cdr(), cdr(amount="5.64")]).cdrs
    assert ledger.actual_ledger(other).count() == 0
    assert ledger.cdr_conflicts(other).count() == 1
    assert [r.reasons for r in ledger.cdr_quarantine(other).collect()] == [["conflicting_charge"]] * 2


def test_unknown_role_hash_and_repeated_json_key(spark):
    bad = [("r", "shadow", cdr()[2]), ("r", "baseline", cdr()[2].replace('"id"', '"id":"x","id"'))]
    rows = ledger.cdr_validate(Case(spark, cdrs=bad).cdrs).collect()
    assert sorted(r.reasons[0] for r in rows) == ["malformed_document", "unknown_role"]
    changed = Case(spark).cdrs.withColumn("payload_hash", F.lit("x"))
    assert {tuple(r.reasons) for r in ledger.cdr_validate(changed).collect()} == {("hash_mismatch",)}


def test_rated_sessions_reproduce_both_outcomes(spark):
    case = Case(spark, cdrs=[])
    r = case.results
    for extra, outcome in (({}, "PASS"), ({"candidate": "0.87"}, "FAIL")):
        bills = ledger.rate_sessions(r.session_lifecycle, case.registry, r.tariff_history, extra)
        rows = [(b.run_id, b.release_role, b.payload) for b in bills.collect()]
        assert Case(spark, cdrs=rows).verdict().verdict == outcome


def test_thousands_of_copies_lose_nothing(spark):
    run, role, payload = cdr(cdr_id="c1")
    copies = [(run, role, payload.replace('{"country', "{" + " " * n + '"country')) for n in range(1, 5001)]
    case = Case(spark, cdrs=[*copies, cdr(role="candidate")])
    row = case.results.actual_ledger.where("release_role = 'baseline'").collect()[0]
    assert row.source_payloads == 5000 == ledger.cdr_sources(case.cdrs).where("release_role = 'baseline'").count()
    assert case.verdict().verdict == "PASS"


def test_evidence_digest_follows_the_records_not_their_order(spark):
    pair = [cdr(role="candidate", cdr_id=i, amount=a) for i, a in (("a", "2.63"), ("b", "3.00"))]
    digest = lambda cdrs: Case(spark, cdrs=[cdr(), *cdrs]).checks()["amount_match"].evidence
    assert digest(pair) == digest(pair[::-1]) != digest([pair[0], cdr(role="candidate", cdr_id="b", amount="3.01")])


def test_second_registration_under_an_unknown_tariff_is_not_priced(spark):
    case = Case(spark, registry=[("r", "s", "t1"), ("r", "s", "nowhere")])
    assert case.results.expected_ledger.count() == 0
    assert case.verdict().verdict == "FAIL"
    assert Case(spark, registry=[("r", "s", "t1"), ("r", "s", " ")]).results.expected_ledger.count() == 0
