"""Merges, gates, joins, tables, streams and grouping on small fixtures."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterproof.operators import batch, dml, evidence, expectations, joins, reports, tariffs
from meterproof.schemas import TABLES
from meterproof.sources.publish import publish_once
from meterproof.sources.tables import append_immutable, append_new, ensure_table, sync_runs, upsert
from meterproof.streaming.landing import landing_stream


def test_merges_are_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    source = spark.createDataFrame([(2, "x"), (3, "c")], "k INT, v STRING")
    inserted = dml.merge_insert_only(target, source, ["k"])
    upserted = dml.merge_upsert(target, source, ["k"])
    for once, again in (
        (inserted, dml.merge_insert_only(inserted, source, ["k"])),
        (upserted, dml.merge_upsert(upserted, source, ["k"])),
    ):
        assert sorted(once.collect()) == sorted(again.collect())
    assert sorted(inserted.collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted(upserted.collect()) == [(1, "a"), (2, "x"), (3, "c")]


def test_immutable_diff_statuses(spark):
    stored = spark.createDataFrame([(1, None, 5), (2, "b", 5), (4, "d", 5), (5, "e", 5), (5, "e", 5)], "k INT, v STRING, t INT")
    wanted = spark.createDataFrame([(1, None, 6), (2, "x", 5), (3, "c", 5), (5, "e", 5)], "k INT, v STRING, t INT")
    found = {r.k: r.status for r in dml.immutable_diff(stored, wanted, ["k"], ["t"]).collect()}
    assert found == {1: "unchanged", 2: "conflict", 3: "missing", 4: "unexpected", 5: "duplicate"}


def test_gates_raise(spark):
    df = spark.range(3)
    expectations.enforce(df, {"three": F.count(F.lit(1)) == 3})
    with pytest.raises(expectations.ExpectationFailed, match="four"):
        expectations.enforce(df, {"four": F.count(F.lit(1)) == 4})


@pytest.mark.parametrize("bucket", [None, "year", "month", "day"])
def test_validity_join_against_brute_force(spark, bucket):
    rnd = random.Random(7)
    t0 = datetime(2020, 1, 1)
    periods = []
    for i in range(60):
        a = t0 + timedelta(hours=rnd.randrange(20000))
        periods.append((i % 3, i, a, None if i % 7 == 0 else a + timedelta(hours=rnd.randrange(0, 3000))))
    facts = [(i % 4, i, t0 + timedelta(hours=rnd.randrange(25000))) for i in range(150)]
    # Boundaries: exactly at a start and exactly at an end.
    facts += [(k, 1000 + i, a) for k, i, a, _ in periods] + [(k, 2000 + i, b) for k, i, _, b in periods if b]
    p = spark.createDataFrame(periods, "k INT, pid INT, valid_from TIMESTAMP, valid_to TIMESTAMP")
    f = spark.createDataFrame(facts, "k INT, fid INT, at TIMESTAMP")
    found = joins.join_validity(f, p, ["k"], "at", bucket=bucket).select("fid", "pid").collect()
    wanted = [(fid, pid) for k, fid, t in facts for j, pid, a, b in periods if k == j and a <= t and (b is None or t < b)]
    assert sorted(map(tuple, found)) == sorted(wanted)


def test_overlaps_against_brute_force(spark):
    rnd = random.Random(3)
    t0 = datetime(2020, 1, 1)
    rows = set()
    for i in range(80):
        a = t0 + timedelta(hours=rnd.randrange(400))
        rows.add(("r", f"t{i % 4}", a, None if i % 9 == 0 else a + timedelta(hours=rnd.randrange(1, 60)), "EUR", f"p{i}", f"h{i}"))
    df = spark.createDataFrame(
        sorted(rows, key=str), "run_id STRING, tariff_id STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, currency STRING, payload STRING, payload_hash STRING"
    )
    wanted = set()
    for t in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == t), key=lambda r: (r[2], r[3] or datetime.max, r[6]))
        wanted |= {a[6] for a, b in zip(own, own[1:]) if a[3] is None or a[3] > b[2]}
    assert {r.payload_hash for r in tariffs.tariff_overlaps(df.unionByName(df)).collect()} == wanted


def _sessions(spark, rows):
    return spark.createDataFrame(
        [(r, s, datetime(2026, 1, 1), None, wh, None, "In Progress") for r, s, wh in rows], TABLES["session_lifecycle"]
    )


def test_tables_on_disk(spark, tmp_path):
    root, name = str(tmp_path), "session_lifecycle"

    def stored():
        return sorted((r.run_id, r.session_id, r.meter_start_wh) for r in ensure_table(spark, root, name).collect())

    first = _sessions(spark, [("a", "1", 1), ("b", "1", 1)])
    for _ in range(2):
        append_new(spark, root, name, first)
    assert stored() == [("a", "1", 1), ("b", "1", 1)]
    upsert(spark, root, name, _sessions(spark, [("a", "1", 5), ("a", "2", 5)]))
    assert stored() == [("a", "1", 5), ("a", "2", 5), ("b", "1", 1)]
    sync_runs(spark, root, name, _sessions(spark, [("a", "2", 6)]), ["a", "b"])
    assert stored() == [("a", "2", 6)]
    with pytest.raises(expectations.ExpectationFailed):
        append_new(spark, root, name, first.unionByName(first))


def test_landing_is_incremental(spark, tmp_path):
    source, state, out = (tmp_path / n for n in ("in", "state", "out"))
    source.mkdir()

    def land():
        landing_stream(spark, str(source), str(state), str(out))
        return spark.read.parquet(str(out)).count()

    (source / "one.jsonl").write_text('{"a":1}\n{broken\n  {"a":1}  \n')
    assert [land(), land()] == [3, 3]
    (source / "two.jsonl").write_text('{"a":1}\n{"a":2}\n{"a":3}\n')
    (source / "note.txt").write_text("not landed\n")
    assert [land(), land()] == [6, 6]
    lines = {r.raw_record for r in spark.read.parquet(str(out)).collect()}
    assert {"{broken", '  {"a":1}  '} <= lines
    with pytest.raises(ValueError):
        landing_stream(spark, str(source), str(source / "state"), str(out))


def test_publish_once(spark, tmp_path):
    path = str(tmp_path / "batch")
    lines = spark.createDataFrame([("a",), ("b",), ("b",)], "v STRING")
    assert publish_once(lines, path).count() == publish_once(lines, path).count() == 3
    for other in ([("a",), ("b",)], [("a",), ("a",), ("b",)]):
        with pytest.raises(expectations.ExpectationFailed):
            publish_once(spark.createDataFrame(other, "v STRING"), path)


def test_fingerprint_ignores_order_and_notices_loss(spark):
    rows = spark.range(500).select(F.lit("b").alias("k"), F.col("id").cast("string").alias("doc"))
    one = lambda df: batch.content_fingerprint(df, ["k"], F.col("doc")).collect()[0].input_hash
    assert one(rows) == one(rows.orderBy(F.rand()).repartition(5))
    assert one(rows) != one(rows.where("doc <> '7'")) != one(rows.unionByName(rows.where("doc = '7'")))


def test_frozen_text_becomes_rows(spark):
    text = '[{"run_id":"r","session_id":"s","release_role":"baseline","assertion_id":"energy_match","status":"PASS","difference":"0.000000"}]'
    rows = evidence.exploded_snapshots(spark.createDataFrame([("e", text)], "execution_id STRING, assertions_snapshot STRING")).collect()
    assert [(r.execution_id, r.status, r.expected_value) for r in rows] == [("e", "PASS", None)]


def test_failed_receipts_stay_failed(spark):
    at = lambda h: F.lit(datetime(2026, 1, 1, h))
    attempts = spark.createDataFrame([(1, 1, 0, "[]"), (1, 2, 1, "[]"), (0, 3, 0, "[]")], "job_id INT, job_run_id INT, repair_count INT, expected_run_ids_json STRING")
    receipts = evidence.receipt_register(spark.createDataFrame([], TABLES["job_execution"]), attempts, at(1))
    assert evidence.receipt_register(receipts, attempts, at(2)).count() == 2
    outcomes = spark.createDataFrame([("1:1:0", "SUCCEEDED", "ok"), ("1:2:1", "SUCCEEDED", "ok")], "execution_id STRING, new_status STRING, new_reason STRING")
    done = {r.execution_id: r for r in evidence.receipt_transition(receipts, outcomes, at(3)).collect()}
    assert (done["1:1:0"].status, done["1:1:0"].finished_at.hour) == ("SUCCEEDED", 3)
    assert (done["1:2:1"].status, done["1:2:1"].finished_at.hour) == ("FAILED", 1)


def test_merges_refuse_repeated_keys_and_rows_outside_their_scope(spark):
    target = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    twice = spark.createDataFrame([(2, "b"), (2, "c")], "k INT, v STRING")
    for merge in (dml.merge_insert_only, dml.merge_upsert):
        with pytest.raises(Exception, match="repeated key"):
            merge(target, twice, ["k"]).collect()
    with pytest.raises(Exception, match="outside the scope"):
        dml.merge_sync_scope(target, twice, F.col("k") == 1).collect()


def test_equal_stream_paths_are_refused():
    from meterproof.streaming.landing import check_paths

    same = "/data/in"
    for paths in ((same, same, "/data/out"), ("/data/in", "/data/state", "/data/in/out"), ("", "/a", "/b")):
        with pytest.raises(ValueError):
            check_paths(*paths)


def test_a_period_without_a_start_overlaps_the_next(spark):
    rows = [("r", "t", None, datetime(2026, 2, 1), "EUR", "{}", "h1"), ("r", "t", datetime(2026, 1, 1), None, "EUR", "{}", "h2")]
    periods = spark.createDataFrame(
        rows, "run_id STRING, tariff_id STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, currency STRING, payload STRING, payload_hash STRING"
    )
    found = tariffs.tariff_overlaps(periods).collect()
    assert [(r.valid_from, r.next_valid_from) for r in found] == [(None, datetime(2026, 1, 1))]


def test_immutable_tables_are_completed_but_never_changed(spark, tmp_path):
    root, name = str(tmp_path), "session_lifecycle"
    rows = [("a", "1", 1), ("a", "2", 1), ("b", "1", 1)]
    stored = lambda: sorted((r.run_id, r.session_id, r.meter_start_wh) for r in ensure_table(spark, root, name).collect())
    append_immutable(spark, root, name, _sessions(spark, rows[:1]), ["a"])
    for _ in range(2):
        append_immutable(spark, root, name, _sessions(spark, rows), ["a", "b"])
        assert stored() == rows
    for other, why in ((rows[:1] + [("a", "2", 5)], "conflict"), (rows[:1], "unexpected"), (rows + rows[:1], "repeated"), ([("c", "1", 1)], "outside")):
        with pytest.raises(expectations.ExpectationFailed, match=why):
            append_immutable(spark, root, name, _sessions(spark, other), ["a"] if len(other) < 3 else ["a", "b"])
    assert stored() == rows
    _sessions(spark, rows[:1]).write.mode("append").partitionBy("run_id").parquet(f"{root}/{name}")
    with pytest.raises(expectations.ExpectationFailed, match="duplicate"):
        append_immutable(spark, root, name, _sessions(spark, rows), ["a", "b"])


def test_upsert_of_listed_runs(spark, tmp_path):
    root, name = str(tmp_path), "session_lifecycle"
    append_new(spark, root, name, _sessions(spark, [("a", "1", 1), ("b", "1", 1)]))
    upsert(spark, root, name, _sessions(spark, [("a", "1", 5)]), ["a"])
    found = sorted((r.run_id, r.meter_start_wh) for r in ensure_table(spark, root, name).collect())
    assert found == [("a", 5), ("b", 1)]
    with pytest.raises(expectations.ExpectationFailed, match="outside"):
        upsert(spark, root, name, _sessions(spark, [("b", "1", 5)]), ["a"])


def test_drift_counts_lost_and_extra_copies(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, None)], "k INT, v STRING")
    copies = spark.createDataFrame(
        [("r", 1, "a"), ("r", 2, "b"), ("r", None, None), ("s", 1, "x"), ("s", 2, "b"), ("s", 2, "b"), ("s", 3, "c"), ("s", None, None), ("t", 1, "a")],
        "run_id STRING, k INT, v STRING",
    )
    found = dml.replay_drift(copies, source, ["r", "s", "u"], ["k"], {"v": F.col("v")}).collect()
    counts = {r.run_id: (r.source_rows, r.replayed_rows, r.faithful_rows, r.drifted_rows, r.missing_rows) for r in found}
    assert counts == {"r": (4, 3, 3, 0, 1), "s": (4, 5, 3, 2, 0), "u": (4, 0, 0, 0, 4)}


def test_table_counts_name_empty_tables(spark):
    found = reports.table_counts({"some": spark.range(3), "none": spark.range(0)}).collect()
    assert {r.table_name: r.row_count for r in found} == {"some": 3, "none": 0}


@pytest.mark.parametrize("bucket", ["year", "month", "day"])
def test_sentinel_ends_are_not_cut_into_buckets(spark, bucket):
    periods = spark.createDataFrame([(1, 7, datetime(2020, 1, 1), datetime(9999, 12, 31))], "k INT, pid INT, valid_from TIMESTAMP, valid_to TIMESTAMP")
    facts = spark.createDataFrame([(1, 1, datetime(2019, 1, 1)), (1, 2, datetime(2026, 1, 1))], "k INT, fid INT, at TIMESTAMP")
    found = joins.join_validity(facts, periods, ["k"], "at", bucket=bucket)
    assert [(r.fid, r.pid) for r in found.collect()] == [(2, 7)]


def test_one_key_may_own_most_rows(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("k"), "id")
    few = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "k STRING, v INT")
    joined = joins.spread_join(rows, few, ["k"], "id")
    assert sorted(map(tuple, joined.groupBy("k", "v").count().collect())) == [("a", 1, 1800), ("a", 2, 1800), ("b", 3, 200)]
    assert joined.columns == ["k", "id", "v"]


def test_unreadable_lists_of_runs_name_none(spark):
    receipts = spark.createDataFrame([("1", '["a","b","a"]'), ("2", "[broken"), ("3", None)], "execution_id STRING, expected_run_ids_json STRING")
    assert sorted(map(tuple, evidence.expected_runs(receipts).collect())) == [("1", "a"), ("1", "b")]


def test_checks_are_counted_per_session_and_releases_without_sorting(spark):
    """Counts per session and release are shuffled, not one row per check; first problems sort no checks."""
    from meterproof.operators import verdict

    rows = [
        ("r", "candidate", "s", "energy_match", "PASS"), ("r", "candidate", "s", "energy_match", "ODD"), ("r", "candidate", "s", None, "FAIL"),
        ("r", "shadow", "s", "amount_match", None), ("r", "candidate", None, "new", "BLOCKED"),
    ]
    results = spark.createDataFrame(rows, "run_id STRING, release_role STRING, session_id STRING, assertion_id STRING, status STRING")
    none = spark.createDataFrame([], "run_id STRING, session_id STRING, expected_energy_kwh DECIMAL(18,6), expected_amount DECIMAL(18,2), currency STRING, tariff_id STRING, tariff_valid_from TIMESTAMP, tariff_payload_hash STRING")
    sessions = spark.createDataFrame([("r", "s", "Completed", None, None)], "run_id STRING, session_id STRING, status STRING, started_at TIMESTAMP, ended_at TIMESTAMP")
    records = "run_id STRING, session_id STRING, release_role STRING, cdr_type STRING, country_code STRING, party_id STRING, cdr_id STRING, actual_energy_kwh DECIMAL(18,6), actual_duration_hours DECIMAL(18,6), actual_amount DECIMAL(18,6), currency STRING, tariff_id STRING, source_digest STRING"
    keys = verdict.checked_keys(none, sessions, spark.createDataFrame([], records), results)
    counted = ("required_assertions", "assertion_rows", "passed_assertions", "failed_assertions", "blocked_assertions", "invalid_assertions")
    found = {(k.release_role, k.session_id, k.assertion_id): tuple(k[n] for n in counted) for k in keys.collect()}
    assert len(found) == 17 and found["candidate", "s", "energy_match"] == (1, 2, 1, 0, 0, 1) and found["baseline", "s", "energy_match"] == (1, 0, 0, 0, 0, 0)
    assert found["candidate", "s", None] == (0, 1, 0, 1, 0, 0) and found["shadow", "s", "amount_match"] == (0, 1, 0, 0, 0, 1)
    assert found["candidate", None, "new"] == (0, 1, 0, 0, 1, 0)
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(CASE WHEN") < plan.index("Aggregate [")
    stored = spark.createDataFrame(keys.collect(), keys.schema)
    assert "SortAggregate" not in verdict._by_release(stored)._jdf.queryExecution().executedPlan().toString()
