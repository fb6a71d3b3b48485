"""What the ledger does not sort, as its plan shows."""

from meterproof.operators import ledger
from tests.scenario import Case, cdr


def test_copies_of_a_payload_are_removed_without_a_sort(spark):
    """payloads are counted by hash; only the charges of an identity are folded by a sort."""
    again = cdr(cdr_id="C1")
    case = Case(spark, cdrs=[cdr(), cdr(), again, cdr(role="candidate"), cdr(role="candidate", amount="6.50")])
    found = ledger.actual_ledger(case.cdrs)
    # One fold per identity, in two steps, and no other.
    assert found._jdf.queryExecution().executedPlan().toString().count("SortAggregate") == 2
    rows = [(r.release_role, r.cdr_id, r.source_payloads) for r in found.collect()]
    assert rows == [("baseline", "c1", 2)]
    assert [r.release_role for r in ledger.cdr_conflicts(case.cdrs).collect()] == ["candidate"]
