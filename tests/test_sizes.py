"""What plans hold, store and sort, so that they grow with the input; every test builds its own rows."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from meterproof.functions.columns import packed, unpacked
from meterproof.operators import assertions, evidence, joins, ledger
from meterproof.operators.ranges import in_ranges
from testkit import queries
from tests.scenario import Case, cdr


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_keys_of_many_rows_are_repeated(spark, monkeypatch):
    """with known sizes a key is repeated once per SHARE of its rows, and gets every row once."""
    monkeypatch.setattr(joins, "SHARE", 500)
    rows = spark.range(2000).select(F.when(F.col("id") % 10 == 0, "b").when(F.col("id") == 1, None).otherwise("a").alias("k"), "id")
    few = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5)], "k STRING, v INT")
    joined = joins.spread_join(rows, few, ["k"], "id", rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")))
    assert sorted(map(tuple, joined.groupBy("k", "v").count().collect())) == [("a", 1, 1799), ("a", 2, 1799), ("b", 3, 200)]
    assert joined.columns == ["k", "id", "v"]


def test_results_are_not_broadcast_to_be_frozen(spark, tmp_path):
    """a stored table that is small on disk only must not be sent to the driver and to every task."""
    columns = "run_id STRING, session_id STRING, release_role STRING, assertion_id STRING, status STRING, expected_value STRING, actual_value STRING, difference DECIMAL(38,6)"
    rows = [(f"r{i % 3}", f"s{i}", "baseline", "energy_match", "PASS", None, None, None) for i in range(30)]
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/results")
    results = spark.read.parquet(f"{tmp_path}/results")
    at = datetime(2026, 1, 1)
    checks = spark.createDataFrame([("r0", 10, True), ("r1", 10, True), ("r2", 10, False)], "run_id STRING, session_count BIGINT, ok BOOLEAN")
    attempts = spark.createDataFrame(
        [("1", "r0", "i", "p", at), ("2", "r0", "i", "p", at), ("3", "r1", "i", "p", datetime(2026, 1, 3)), ("4", "r2", "i", "p", at)],
        "execution_id STRING, run_id STRING, input_hash STRING, pipeline_hash STRING, started_at TIMESTAMP",
    )
    verdicts = spark.createDataFrame([(r, "PASS", "PASS", "PASS", datetime(2026, 1, 2)) for r in ("r0", "r1", "r2")], "run_id STRING, baseline_verdict STRING, candidate_verdict STRING, verdict STRING, evaluated_at TIMESTAMP")
    snapshots, frozen = evidence.capture_snapshot(checks, attempts, verdicts, results, F.lit(at))
    assert "SortMergeJoin [run_id" in plan_of(frozen).replace("#", "") and "_salt" in plan_of(frozen)
    # Only keys of many rows are told to all tasks: once to either side.
    assert plan_of(frozen).count("BroadcastHashJoin") == 2 and "BroadcastHashJoin" not in plan_of(snapshots)
    assert sorted((r.execution_id, r.run_id, r["count"]) for r in frozen.groupBy("execution_id", "run_id").count().collect()) == [("1", "r0", 10), ("2", "r0", 10)]
    assert sorted(r.execution_id for r in snapshots.collect()) == ["1", "2"]


def test_texts_come_back_from_bytes(spark):
    texts = ["", "ab", "AB", "abc", "é", "00" * 32, "x" + "0" * 63, None, "\x01", " ab"]
    found = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", packed("t").alias("p")).select("t", unpacked("p").alias("u"), F.length("p").alias("n")).collect()
    assert [r.u for r in found] == texts and {r.t: r.n for r in found}["00" * 32] == 33


def test_short_histories_are_joined_without_ranges(spark, monkeypatch):
    """F4-F8, F17: pricing wrote all sessions and periods in ranges and shuffled them four times; keys of long histories still are."""
    pick = random.Random(4)

    def day(n):
        return None if n is None else datetime(2026, 1, 1) + timedelta(days=n)

    facts = [("r", pick.choice(["hot", "hot", "long", "t1", None]), pick.choice([None, *range(60)]), i) for i in range(300)] + [("r", "gone", 3, 900), ("r", "hot", 3, 0)]
    spans = [("hot", 0, 20), ("hot", 20, None), ("hot", 10, 12), ("t1", 5, 5), ("t1", None, 9), (None, 0, None)] + [("long", i, i + 5) for i in range(50)]
    periods = [("r", t, a, b, f"p{i}") for i, (t, a, b) in enumerate(spans)]
    f = spark.createDataFrame([(r, t, day(a), i) for r, t, a, i in facts], "run_id STRING, tariff_id STRING, at TIMESTAMP, fact LONG")
    p = spark.createDataFrame([(r, t, day(a), day(b), n) for r, t, a, b, n in periods], "run_id STRING, tariff_id STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, payload STRING")
    wanted = []
    for r, t, a, i in facts:
        hits = [n for q, u, b, e, n in periods if t is not None and (q, u) == (r, t) and None not in (a, b) and b <= a and (e is None or a < e)]
        wanted += [(i, n) for n in hits or [None]]
    keys, written = ["tariff_id", "run_id"], []
    ranges = joins.in_ranges
    monkeypatch.setattr(joins, "in_ranges", lambda *a: written.append(1) or ranges(*a))
    monkeypatch.setattr(joins, "SHARE", 50)
    for short, swept in ((64, 0), (10, 1)):
        monkeypatch.setattr(joins, "SHORT", short)
        got = joins.mixed_validity(f, p, keys, "at", "fact", f.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
        assert sorted(((x.fact, x.payload) for x in got.collect()), key=str) == sorted(wanted, key=str)
        assert sorted(got.columns) == sorted(["run_id", "tariff_id", "at", "fact", "valid_from", "valid_to", "payload"]) and len(written) == swept


def test_records_are_built_once_to_be_validated(spark):
    """F3, F8: the hash was compared in a filter, below which whatever builds the payload was repeated."""
    built = spark.range(3).select(
        F.lit("r").alias("run_id"), F.lit("baseline").alias("release_role"), F.concat(F.lit("{"), F.reverse(F.col("id").cast("string")), F.lit("}")).alias("payload"), F.lit("h").alias("payload_hash")
    )
    plan = ledger._normalised(built)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "reverse" in line] and plan.count("reverse(") == 1


def test_verdicts_read_a_ledger_without_digests(spark):
    """its copies are told by charges alone, so what tells payloads apart is neither shuffled nor stored."""
    case = Case(spark, cdrs=[cdr(), cdr(), cdr(role="candidate"), cdr(cdr_id="C2", role="candidate")])
    r = case.results
    whole = ledger.actual_ledger(case.cdrs)
    plain = whole.drop("source_payloads", "source_digest")
    assert "sha2" not in plain._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")[0]
    found = [assertions.assertion_result(r.expected_ledger, r.session_lifecycle, a) for a in (whole, plain)]
    rows = [sorted(map(str, x.drop("evidence").collect())) for x in found]
    assert rows[0] == rows[1] and len(rows[0]) == 14
    digests = [{row[0] for row in x.select(F.get_json_object("evidence", "$.actual_cdrs_digest")).collect()} for x in found]
    assert digests[1] == {None} and None not in digests[0]


def test_landed_lines_are_gzipped_and_not_written_twice(spark, tmp_path):
    """F16: the projection wrote all lines as plain text, and the landing table before."""
    spark.createDataFrame([(k, k % 3, datetime(1997, 1, 1)) for k in range(20)], "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(c, c) for c in range(3)], "c_custkey BIGINT, c_nationkey INT").write.parquet(f"{tmp_path}/customer.parquet")
    chain = queries.Chain(spark, str(tmp_path))
    found = queries._landing_projection(chain)
    assert found.inputFiles() and all(name.endswith(".txt.gz") for name in found.inputFiles())
    assert "landing" not in chain.d._frames
    wanted = chain.d.landing.select("raw_record", F.sha2("raw_record", 256).alias("record_hash"))
    assert found.count() >= 60 and found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_ranges_are_stored_with_zstd(spark):
    """the sweep's ranges were the only stored layer without it."""
    stored = in_ranges(spark.range(100).withColumn("t", F.col("id") % 7), ["t", "id"], 3)
    assert stored.count() == 100 and all(name.endswith(".zstd.parquet") for name in stored.inputFiles())
