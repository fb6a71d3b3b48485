"""One callable per operator: (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterproof.functions.columns import text_at
from meterproof.operators import (
    assertions as asr,
    attempts as att,
    batch as bat,
    dml,
    evidence as evi,
    expectations as exp,
    fingerprint as fin,
    joins,
    landing as lan,
    ledger as led,
    reports as rep,
    sessions as ses,
    tariffs as tar,
    verdict as ver,
)
from meterproof.plans import batches as bap
from meterproof.schemas import COUNTS, TABLES
from meterproof.session import shared_dir
from meterproof.sources import publish as pub
from meterproof.sources.publish import publish_once
from meterproof.sources.tables import stored_under
from meterproof.streaming import events as sev
from meterproof.streaming.landing import audited_landing_stream, landing_stream
from testkit.derive import Derived



def at():
    """The clock of the queries."""
    return F.lit("2026-06-01 00:00:00").cast("timestamp")


CODE = "code"
OLD_CREDIT, NEW_CREDIT = '"credit":false', '"credit":true'


def times(df: DataFrame) -> DataFrame:
    """Instants as microseconds, so that both engines compare the same integers."""
    return df.select(
        *[
            F.unix_micros(f.name).alias(f"{f.name}_us") if f.dataType.typeName() == "timestamp" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def joined(column: str):
    return F.array_join(column, ",").alias(column)


class Chain:
    """The pipeline over the derived inputs of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.d = Derived(spark, sf_dir)
        self.spark = spark

    # Results of a layer are stored before the next layer reads them, as its jobs would.

    @cached_property
    def sessions(self):
        return self.d.store("sessions", self.compute_sessions)

    @cached_property
    def history(self):
        return self.d.store("history", self.compute_history)

    @cached_property
    def expected(self):
        return self.d.store("expected", self.compute_expected)

    @cached_property
    def actual(self):
        return self.d.store("actual", self.compute_actual)

    @cached_property
    def reported(self):
        """The reported ledger as verdicts read it: without the digests of its sources."""
        return self.d.store("reported", lambda: self.compute_actual().drop("source_payloads", "source_digest"))

    @cached_property
    def checked(self):
        return self.d.store("checked", lambda: led.cdr_validate(self.d.cdrs_raw).drop("payload"))

    @cached_property
    def assertions(self):
        return self.d.store("assertions", self.compute_assertions)

    def compute_sessions(self):
        return ses.session_lifecycle(self.d.events_raw)

    def compute_history(self):
        return tar.tariff_history(self.d.tariffs_raw)

    def compute_expected(self):
        return led.expected_ledger(self.d.input_session, self.sessions, self.history)

    def compute_actual(self):
        # Raw records are scanned once for the ledger, so they are validated in that scan and not stored before.
        return led.actual_ledger(self.d.cdrs_raw)

    def compute_assertions(self):
        return asr.assertion_result(self.expected, self.sessions, self.actual)

    @property
    def passing(self):
        """Ledgers for a query that reads each of them once: they are not stored before."""
        return self.compute_expected(), self.sessions, self.compute_actual()

    @cached_property
    def damaged(self):
        """Check results after loss, doubling, an unknown release and an odd status.

        They are read once, so they are not stored before. They lie by run and session already: joined by
        hash, the fourteen results of a session are neither shuffled nor sorted again, at any size.
        """
        rows = asr.assertion_result(*self.verdict_inputs[1:]).drop("evidence").join(self.d.damage.hint("shuffle_hash"), ["run_id", "session_id"])
        kind, rule = F.col("kind"), F.col("assertion_id")
        copies = F.when((kind == "double") & (rule == "energy_match"), 2).otherwise(1)
        return (
            rows.where(~((kind == "drop") & (rule == "tariff_match")))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
            .withColumn("release_role", F.when(kind == "shadow", "shadow").otherwise(F.col("release_role")))
            .withColumn(
                "status",
                F.when((kind == "odd") & (rule == "duration_match"), "ODD").otherwise(F.col("status")),
            )
            .drop("_copy", "kind")
        )

    @cached_property
    def keys(self):
        return self.d.store("checked_keys", self.compute_keys)

    def compute_keys(self):
        return ver.checked_keys(*self.verdict_inputs[1:], self.damaged)

    @property
    def verdict_inputs(self):
        return self.d.run_manifest, self.expected, self.sessions, self.reported

    @cached_property
    def verdicts(self):
        return self.d.store("verdicts", lambda: ver.release_verdict(*self.verdict_inputs, self.damaged, at()))

    @cached_property
    def results(self):
        return self.d.store("session_results", lambda: rep.session_results(*self.attempt))

    @cached_property
    def lines(self):
        return self.d.store("lines", lambda: bat.stored_lines(self.d.passing("landing")))

    @cached_property
    def events(self):
        return self.d.store("deduplicated", lambda: bat.event_dedup(self.lines))

    @cached_property
    def clean(self):
        return bat.batch_clean_events(self.events)

    @cached_property
    def gate(self):
        violations = bat.batch_violations(self.lines, self.events)
        return self.d.store("gate", lambda: bat.batch_gate(self.lines, self.events, violations))

    @property
    def attempt(self):
        d = self.d
        return d.requested, d.receipts, d.batch_snapshots, d.frozen

    @cached_property
    def split_sessions(self):
        """An older target and a newer source of sessions that overlap in part."""
        key = F.regexp_replace("session_id", "^txn-", "").cast("bigint")
        s = self.sessions
        target = s.where(key % 3 != 0).withColumn("meter_end_wh", F.col("meter_end_wh") - 1)
        return target, s.where(key % 3 != 1)


def _landing_stream(c: Chain) -> DataFrame:
    root = f"{shared_dir(c.spark)}/meterproof-{uuid.uuid4().hex}"
    line = F.concat_ws("|", F.col("event_id").cast("string"), "event_type", "props")
    c.d.events.select(line.alias("value")).write.text(f"{root}/in")
    for _ in range(2):  # the second run finds nothing new
        landing_stream(c.spark, f"{root}/in", f"{root}/state", f"{root}/out", pattern="part-*")
    return c.spark.read.parquet(f"{root}/out").select("raw_record", "record_hash")


def _publish_once(c: Chain) -> DataFrame:
    path = f"{shared_dir(c.spark)}/meterproof-{uuid.uuid4().hex}/batch"
    lines = c.d.landing.select("raw_record")
    publish_once(lines, path)
    return publish_once(lines, path).groupBy(F.sha2("value", 256).alias("record_hash")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _landing_audit_stream(c: Chain) -> DataFrame:
    """Counts kept by the stream, and how many files it counts otherwise than a scan of all that landed."""
    root = f"{shared_dir(c.spark)}/meterproof-{uuid.uuid4().hex}"
    line = F.concat_ws("|", F.col("event_id").cast("string"), "event_type", "props")
    c.d.events.select(line.alias("value")).write.text(f"{root}/in")
    for _ in range(2):  # the second run finds nothing new
        audited_landing_stream(c.spark, f"{root}/in", f"{root}/state", f"{root}/out", f"{root}/audit", pattern="part-*", max_files=3)
    kept = c.spark.read.parquet(f"{root}/audit/files").drop("batch_id")
    whole = lan.landing_audit(c.spark.read.parquet(f"{root}/out"))
    differing = whole.exceptAll(kept.select(*whole.columns)).unionByName(kept.select(*whole.columns).exceptAll(whole))
    sums = c.spark.read.parquet(f"{root}/audit/batches").agg(
        *[F.sum(n).alias(n) for n in ("landed_rows", "invalid_record_hashes", "missing_source_metadata")]
    )
    files = kept.agg(F.sum("distinct_record_hashes").alias("distinct_record_hashes"))
    return sums.crossJoin(files).crossJoin(differing.agg(F.count(F.lit(1)).alias("differing_files")))


def _publish_resume(c: Chain) -> DataFrame:
    """States of a publication that stopped after some parts, and of all its parts once resumed."""
    path = f"{shared_dir(c.spark)}/meterproof-{uuid.uuid4().hex}/batch"
    lines = c.d.landing.select("raw_record")
    pub.write_manifest(lines, path, 16)
    pub.write_parts(lines, path, [0, 3, 5], 16)
    before = c.d.store(f"states-{uuid.uuid4().hex}", lambda: pub.part_states(lines, path, 16))
    pub.publish_parts(lines, path, 16)
    after = pub.part_states(lines, path, 16).select("part", F.col("state").alias("after"))
    return before.withColumnRenamed("state", "before").join(after, "part")


def _stream_dedup(c: Chain) -> DataFrame:
    """Events delivered twice, some with other contents, in two deliveries."""
    root = f"{shared_dir(c.spark)}/meterproof-{uuid.uuid4().hex}"
    events = c.d.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "props")
    again = events.where("event_id % 7 = 1")
    torn = events.where("event_id % 11 = 3").withColumn("props", F.concat("props", F.lit(" ")))
    for delivery in (events, again.unionByName(torn)):
        delivery.write.mode("append").parquet(f"{root}/in")
        # Longer than the events span: no copy is too far from its first.
        sev.dedup_stream(c.spark, f"{root}/in", f"{root}/state", f"{root}/out", events.schema, "event_id", "ts", "400 days")
    kept = c.spark.read.parquet(f"{root}/out")
    clean = sev.deduplicated(kept, "event_id").select("event_id", F.lit(1).cast("bigint").alias("contents"), F.lit(False).alias("conflict"))
    torn = sev.conflicting(kept, "event_id").groupBy("event_id").agg(F.count(F.lit(1)).alias("contents"), F.lit(True).alias("conflict"))
    return clean.unionByName(torn)


def _session_stream(c: Chain) -> DataFrame:
    """Sessions rolled up from two deliveries in many micro-batches, some of them compacted and merged twice."""
    root = f"{shared_dir(c.spark)}/meterproof-{uuid.uuid4().hex}"
    events = c.d.events_raw
    early = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    for delivery in (events.where(early), events.where(~early)):
        delivery.write.mode("append").parquet(f"{root}/in")
        sev.session_stream(c.spark, f"{root}/in", f"{root}/state", f"{root}/partials", events.schema, max_files=3)
    compacted = sev.compact_partials(c.spark, f"{root}/partials", f"{root}/compacted")
    both = sev.read_partials(c.spark, f"{root}/partials").drop("batch_id").unionByName(compacted)
    return times(sev.sessions_of(both))


def _fingerprints(c: Chain) -> tuple[str, str]:
    """Two sets of landed lines: the second lacks one file and holds another one twice."""
    root = f"{shared_dir(c.spark)}/meterproof-{uuid.uuid4().hex}"
    left = c.d.landing
    name = F.col("source_file_name")
    right = left.where(name != "events-b3-1.jsonl").unionByName(left.where(name == "events-b5-1.jsonl"))
    fin.store_fingerprints(left, F.col("raw_record"), f"{root}/left")
    fin.store_fingerprints(right, F.col("raw_record"), f"{root}/right")
    return f"{root}/left", f"{root}/right"


def _observed(c: Chain) -> DataFrame:
    path = f"{shared_dir(c.spark)}/meterproof-{uuid.uuid4().hex}/observed"
    return exp.observed_write(
        c.sessions, path,
        {
            "has_sessions": F.count(F.lit(1)) > 0,
            "all_completed": F.count_if(F.col("status") != "Completed") == 0,
            "all_started": F.count_if(F.col("started_at").isNull()) == 0,
            "unknown_is_false": F.max(F.lit(None).cast("int")) > 0,
        },
        strict=False,
    )


def _landing_projection(c: Chain) -> DataFrame:
    path = f"{shared_dir(c.spark)}/meterproof-{uuid.uuid4().hex}/lines"
    # The lines are read once and landed as files of gzipped text: nothing is written twice.
    c.d.passing("landing").select("raw_record").write.option("compression", "gzip").text(path)
    return lan.landing_projection(c.spark.read.text(path)).select("raw_record", "record_hash")


def _replayed(c: Chain) -> DataFrame:
    return dml.scenario_replay(
        c.d.cdrs_raw, "run-0", ["replay-bad", "replay-fixed"], "replay-bad", "candidate",
        F.lit(OLD_CREDIT), F.lit(NEW_CREDIT),
    )


def _replay_drift(c: Chain) -> DataFrame:
    """Copies whose text was changed, and copies lost on the way."""
    changed = (F.col("run_id") == "replay-bad") & (F.col("release_role") == "candidate")
    original = F.when(changed, F.replace(F.col("payload"), F.lit(NEW_CREDIT), F.lit(OLD_CREDIT))).otherwise(F.col("payload"))
    source = c.d.cdrs_raw.where("run_id = 'run-0'").withColumn("source_hash", F.sha2("payload", 256))
    copy = _replayed(c).withColumn("source_hash", F.sha2(original, 256))
    arrived = copy.where(~((F.col("run_id") == "replay-fixed") & F.col("source_hash").startswith("0")))
    same = {name: F.col(name) for name in ("ingest_time", "payload")}
    return dml.replay_drift(arrived, source, ["replay-bad", "replay-fixed"], ["release_role", "source_hash"], same)


def _immutable_diff(c: Chain) -> DataFrame:
    target, source = c.split_sessions
    key = F.regexp_replace("session_id", "^txn-", "").cast("bigint")
    stored = target.withColumn(
        "meter_end_wh", F.when(key % 2 == 0, F.col("meter_end_wh") + 1).otherwise(F.col("meter_end_wh"))
    )
    return dml.immutable_diff(stored, source, ["run_id", "session_id"])


def _expectations(c: Chain) -> DataFrame:
    return exp.expectations(
        c.sessions,
        {
            "has_sessions": F.count(F.lit(1)) > 0,
            "all_completed": F.count_if(F.col("status") != "Completed") == 0,
            "one_row_per_session": F.count(F.lit(1)) == F.count_distinct("run_id", "session_id"),
            "unknown_is_false": F.max(F.lit(None).cast("int")) > 0,
        },
    )


def _lineitem_validity(c: Chain) -> DataFrame:
    orders = c.d.orders.select("o_custkey", F.col("o_orderdate").cast("timestamp").alias("valid_from"), "o_orderkey")
    shipped = c.d.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").cast("timestamp").alias("valid_to"))
    periods = orders.join(shipped, orders.o_orderkey == shipped.l_orderkey).select(
        "o_custkey", "o_orderkey", "valid_from", "valid_to"
    )
    facts = c.d.orders.select(
        "o_custkey", F.col("o_orderkey").alias("at_order"), F.col("o_orderdate").cast("timestamp").alias("at")
    )
    return joins.join_validity(facts, periods, ["o_custkey"], "at", bucket="month").select(
        "o_custkey", "at_order", "o_orderkey"
    )


def _validity(c: Chain) -> DataFrame:
    started = c.sessions.join(c.d.input_session, ["run_id", "session_id"])
    return times(
        joins.join_validity(started, c.history, ["run_id", "tariff_id"], "started_at").select(
            "run_id", "session_id", "tariff_id", "valid_from"
        )
    )


def _sweep(c: Chain) -> DataFrame:
    """Sessions that run while another one starts under the same tariff; some starts name no tariff that exists."""
    tariff = F.when(F.col("k") % 101 == 3, "tariff-none").otherwise(F.col("tariff_id"))
    facts = c.d.layered.select("run_id", tariff.alias("tariff_id"), F.col("k").alias("started"), F.col("valid_from").alias("at"))
    periods = c.d.layered.select("run_id", "tariff_id", F.col("k").alias("running"), "valid_from", "valid_to")
    return joins.sweep_validity(facts, periods, ["run_id", "tariff_id"], "at", how="left").select("started", "tariff_id", "running")


def _key_set_diff(c: Chain) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    wanted = c.d.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"))
    return joins.key_set_diff(wanted, c.d.lineitem, keys).select(
        *keys, F.col("wanted_rows").cast("bigint"), F.col("found_rows").cast("bigint"), "difference"
    )


def _key_check(c: Chain) -> DataFrame:
    return dml.merge_key_check(c.d.lineitem, ["l_orderkey", "l_linenumber"])


def _attempt_columns(c: Chain) -> DataFrame:
    return c.d.receipts.select(
        "execution_id", F.split("execution_id", ":")[0].alias("job_id"),
        F.split("execution_id", ":")[1].alias("job_run_id"), F.lit(0).alias("repair_count"), "status",
        F.lit("[]").alias("expected_run_ids_json"), "started_at", "finished_at",
        F.lit(None).cast("string").alias("task_states_json"), "reason",
    )


def _receipt_register(c: Chain) -> DataFrame:
    known = _attempt_columns(c)
    parts = F.split("execution_id", ":")
    attempts = c.d.requested.select(
        parts[0].cast("bigint").alias("job_id"), parts[1].cast("bigint").alias("job_run_id"),
        (parts[1].cast("bigint") % 2).alias("repair_count"), F.lit("[]").alias("expected_run_ids_json"),
    )
    return times(evi.receipt_register(known, attempts, at())).drop("task_states_json")


def _receipt_transition(c: Chain) -> DataFrame:
    outcomes = c.d.requested.select(
        "execution_id", F.lit("SUCCEEDED").alias("new_status"), F.lit("Finished.").alias("new_reason")
    ).where(F.split("execution_id", ":")[1].cast("bigint") % 2 == 0)
    return times(
        evi.receipt_transition(c.d.receipts, outcomes, at()).select(
            "execution_id", "status", "reason", "finished_at"
        )
    )


def _tracked(c: Chain) -> DataFrame:
    listed = F.to_json(F.array(F.concat(F.lit("exec-run-"), F.split("execution_id", ":")[1])))
    receipts = c.d.receipts.withColumns({"repair_count": F.lit(0), "expected_run_ids_json": listed})
    return evi.finish_status(
        receipts, evi.expected_runs(receipts), c.d.batch_snapshots, c.d.task_states, [f"task-{i}" for i in range(1, 5)]
    )


def _capture(c: Chain) -> DataFrame:
    """A capture per customer's run: the frozen rows stand in for current results."""
    d = c.d
    registry = d.sess.select(F.concat(F.lit("exec-run-"), F.col("c").cast("string")).alias("run_id"), "session_id")
    manifests = d.attempts.select(
        "run_id", F.lit("s").alias("scenario_id"), F.lit(1).cast("bigint").alias("seed"),
        F.lit("b").alias("baseline_sha"), F.lit("c").alias("candidate_sha"), F.lit("t").alias("tariff_hash"),
    )
    verdicts = d.batch_snapshots.select(
        "run_id", F.lit("s").alias("scenario_id"), F.lit(1).cast("bigint").alias("seed"),
        F.lit("b").alias("baseline_sha"), F.lit("c").alias("candidate_sha"),
        F.when(F.col("pipeline_hash") == "older", "u").otherwise("t").alias("tariff_hash"),
        *COUNTS, "baseline_verdict", "candidate_verdict", "verdict", "evaluated_at",
    )
    return registry, manifests, verdicts


def _capture_check(c: Chain) -> DataFrame:
    return evi.capture_check(*_capture(c), c.d.frozen)


def _capture_snapshot(c: Chain) -> DataFrame:
    registry, manifests, verdicts = _capture(c)
    checks = evi.capture_check(registry, manifests, verdicts, c.d.frozen)
    executions = c.d.receipts.where("status = 'SUCCEEDED'").select(
        "execution_id", "run_id", F.lit("input").alias("input_hash"), "pipeline_hash", "started_at"
    ).distinct()
    snapshots, frozen = evi.capture_snapshot(checks, executions, verdicts, c.d.frozen, at())
    rows = frozen.groupBy("execution_id").agg(F.count(F.lit(1)).alias("frozen_rows"))
    return snapshots.drop("captured_at").join(rows, "execution_id")


def _lineage(c: Chain) -> DataFrame:
    """History rows against the raw evidence of another delivery, in which some tariffs changed."""
    return times(tar.lineage_check(c.history, c.d.tariffs_faulty))


def _rated(c: Chain) -> DataFrame:
    bills = led.rate_sessions(c.sessions, c.d.input_session, c.history, {"candidate": "0.87"})
    doc = F.try_parse_json("payload")
    return times(
        bills.select(
            "run_id", "release_role", text_at(doc, "$.id").alias("cdr_id"),
            *[
                text_at(doc, path).cast(kind).alias(name)
                for name, path, kind in (
                    ("energy", "$.total_energy", "decimal(18,6)"),
                    ("duration", "$.total_time", "decimal(18,6)"),
                    ("amount", "$.total_cost.excl_vat", "decimal(18,2)"),
                )
            ],
            text_at(doc, "$.charging_periods[0].tariff_id").alias("tariff_id"),
            "ingest_time",
        )
    )


def _adapted(name: str, drop: tuple[str, ...] = ()):
    def build(c: Chain) -> DataFrame:
        return times(bat.batch_adapt(c.clean, c.gate, CODE)[name].drop(*drop))

    return build


def _evaluated(c: Chain) -> DataFrame:
    """From landed lines to the verdicts of a candidate that overcharges."""
    root = f"{shared_dir(c.spark)}/meterproof-{uuid.uuid4().hex}"
    done = bap.evaluate_batches(c.d.landing, CODE, "amount_error", at(), stored_under(root))
    return done.results.release_verdict.select(
        "scenario_id", "required_assertions", "passed_assertions", "failed_assertions", "blocked_assertions",
        "baseline_verdict", "candidate_verdict", "verdict",
    )


def _actual(c: Chain) -> DataFrame:
    return times(c.compute_actual())


def _evidence_rows(c: Chain) -> DataFrame:
    return asr.actual_evidence(c.actual)


def _assertion_columns(c: Chain) -> DataFrame:
    return asr.assertion_result(*c.passing).withColumn(
        "evidence_cdrs", F.get_json_object("evidence", "$.cdr_count").cast("bigint")
    ).withColumn("evidence_digest", F.get_json_object("evidence", "$.actual_cdrs_digest")).drop("evidence")


def _verdict_columns(c: Chain) -> DataFrame:
    first = [
        F.get_json_object("first_problem", f"$.{name}").alias(f"first_{name}")
        for name in ("problem_type", "release_role", "session_id", "assertion_id")
    ]
    return times(
        c.verdicts.select(
            *[n for n in c.verdicts.columns if n not in ("first_problem", "evidence", "evaluated_at")], *first
        )
    )


def _problems(c: Chain) -> DataFrame:
    return ver.problem_union(*c.verdict_inputs, c.keys).select(
        "run_id", "priority", "problem_type", "release_role", "session_id", "assertion_id"
    )


def _registry(c: Chain) -> DataFrame:
    """The registry with some sessions registered twice and some without a tariff."""
    key = F.regexp_replace("session_id", "^txn-", "").cast("bigint")
    damaged = c.d.input_session.withColumn(
        "tariff_id", F.when((F.col("run_id") == "run-2") & (key % 59 == 2), " ").otherwise(F.col("tariff_id"))
    )
    twice = damaged.where((F.col("run_id") == "run-1") & (key % 61 == 1))
    return led.registry_check(damaged.unionByName(twice))


def _registered_twice(c: Chain) -> DataFrame:
    """The registry, with some sessions registered once more under a tariff nobody knows."""
    key = F.regexp_replace("session_id", "^txn-", "").cast("bigint")
    again = c.d.input_session.where(key % 61 == 1).withColumn("tariff_id", F.lit("unknown"))
    return c.d.input_session.unionByName(again)


def _conformance(c: Chain) -> DataFrame:
    return exp.schema_conformance(c.sessions, TABLES["session_lifecycle"])


_BUILDERS: dict[str, Callable[[Chain], DataFrame]] = {
    "landing_stream": _landing_stream,
    "landing_projection": _landing_projection,
    "landing_batch_slice": lambda c: lan.landing_batch_slice(
        c.d.landing, "events-b3-0.jsonl", "generated-v1-b3", "b3"
    ).select("source_file_name", "record_hash"),
    "landing_audit": lambda c: times(lan.landing_audit(c.d.landing)),
    "landing_integrity": lambda c: lan.landing_integrity(c.d.landing),
    "landing_duplicates": lambda c: lan.landing_duplicates(c.d.landing),
    "landing_preview": lambda c: lan.landing_preview(c.d.landing),
    "publish_once": _publish_once,
    "landing_audit_stream": _landing_audit_stream,
    "publish_resume": _publish_resume,
    "observed_gates": _observed,
    "stream_dedup": _stream_dedup,
    "session_stream": _session_stream,
    "fingerprint_diff": lambda c: fin.fingerprint_diff(c.spark, *_fingerprints(c)),
    "fingerprint_tree": lambda c: fin.fingerprint_tree(fin.fingerprint_documents(c.d.landing, F.col("raw_record"))).where(
        "level < 2"
    ).select("prefix", "documents"),
    "schema_conformance": _conformance,
    "expectations": _expectations,
    "merge_key_check": _key_check,
    "merge_insert_only": lambda c: times(dml.merge_insert_only(*c.split_sessions, ["run_id", "session_id"])),
    "merge_upsert": lambda c: times(dml.merge_upsert(*c.split_sessions, ["run_id", "session_id"])),
    "merge_sync_scope": lambda c: times(
        dml.merge_sync_scope(
            c.split_sessions[0], c.split_sessions[1].where(F.col("run_id").isin("run-0", "run-3")), F.col("run_id").isin("run-0", "run-3")
        )
    ),
    "immutable_diff": _immutable_diff,
    "scenario_replay": lambda c: times(_replayed(c).drop("payload")),
    "replay_drift": _replay_drift,
    "receipt_register": _receipt_register,
    "receipt_transition": _receipt_transition,
    "select_attempt": lambda c: evi.select_attempt(
        c.d.receipts,
        c.d.requested.select(
            F.when(F.col("execution_id").startswith("1:"), "latest")
            .when(F.col("execution_id").startswith("2:"), "  ")
            .otherwise(F.col("execution_id"))
            .alias("selector")
        ),
    ),
    "session_lifecycle": lambda c: times(c.compute_sessions()),
    "tariff_validate": lambda c: times(
        tar.tariff_validate(c.d.tariffs_faulty).select(
            "run_id", "tariff_id", "valid_from", "ok", joined("reasons")
        )
    ),
    "tariff_overlaps": lambda c: times(
        tar.tariff_overlaps(c.d.tariffs_raw).select("run_id", "tariff_id", "valid_from", "valid_to", "next_valid_from")
    ),
    "tariff_overlaps_all": lambda c: times(
        tar.tariff_overlaps_all(c.d.layered).select("run_id", "tariff_id", "valid_from", "valid_to", "payload", "overlaps_earlier", "overlaps_later")
    ),
    "tariff_history": lambda c: times(
        c.compute_history().withColumn("price", F.col("price_components")[0]["price"])
        .withColumn("components", F.size("price_components").cast("bigint"))
        .drop("price_components")
    ),
    "lineage_check": _lineage,
    "registry_check": _registry,
    "pricing_preconditions": lambda c: led.pricing_preconditions(
        _registered_twice(c), c.sessions, c.history
    ),
    "expected_ledger": lambda c: times(c.compute_expected()),
    "join_inner": lambda c: c.sessions.join(c.d.input_session, ["run_id", "session_id"]).select(
        "run_id", "session_id", "tariff_id", "status"
    ),
    "join_validity": _validity,
    "join_validity_bucketed": _lineitem_validity,
    "join_validity_sweep": _sweep,
    "cdr_land": lambda c: times(
        led.cdr_land(c.d.responses.select("run_id", "release_role", "payload", "ingest_time")).drop("payload")
    ),
    "cdr_validate": lambda c: led.cdr_validate(c.d.cdrs_raw).select(
        "run_id", "release_role", "payload_hash", "ok", joined("reasons")
    ),
    "cdr_quarantine": lambda c: led.cdr_quarantine(c.checked).select(
        "run_id", "release_role", "payload_hash", joined("reasons")
    ),
    "cdr_conflicts": lambda c: led.cdr_conflicts(c.checked),
    "cdr_sources": lambda c: led.cdr_sources(c.checked),
    "actual_ledger": _actual,
    "actual_evidence": _evidence_rows,
    "assertion_records": lambda c: asr.assertion_records(c.actual),
    "rate_sessions": _rated,
    "release_grid": lambda c: asr.release_grid(*c.passing),
    "assertion_result": _assertion_columns,
    "missing_assertions": lambda c: ver.missing_assertions(c.compute_keys()),
    "unexpected_assertions": lambda c: ver.unexpected_assertions(c.compute_keys()),
    "release_counts": lambda c: ver.release_counts(*c.verdict_inputs, c.compute_keys()),
    "problem_union": _problems,
    "first_problem": lambda c: ver.first_problem(*c.verdict_inputs, c.compute_keys()).drop("message"),
    "release_verdict": _verdict_columns,
    "singleton_value": lambda c: ver.singleton_value(
        c.d.run_manifest, ["run_id"], ["scenario_id", "seed"]
    ),
    "status_counts": lambda c: rep.status_counts(asr.assertion_result(*c.passing)),
    "cdr_zero_fill": lambda c: rep.cdr_zero_fill(
        c.d.run_manifest.unionByName(c.d.run_manifest.withColumn("run_id", F.concat(F.lit("empty-"), "run_id"))), c.d.cdrs_raw
    ),
    "role_summary": lambda c: rep.role_summary(c.verdicts),
    "table_counts": lambda c: rep.table_counts({
        "run_manifest": c.d.run_manifest, "input_session": c.d.input_session, "events_raw": c.d.events_raw, "tariffs_raw": c.d.tariffs_raw,
        "cdrs_raw": c.d.cdrs_raw, "session_lifecycle": c.sessions, "tariff_history": c.history, "expected_ledger": c.expected,
        "actual_ledger": c.actual, "assertion_result": c.assertions,
    }),
    "evaluate_batches": _evaluated,
    "batch_outcomes": lambda c: bap.batch_outcomes(c.gate, bat.batch_violations(c.lines, c.events)).select("batch_id", "new_status"),
    "event_dedup": lambda c: times(
        bat.event_dedup(c.lines).select("batch_id", "event_id", "ingested_at", "copies", "conflict")
    ),
    "sequence_violations": lambda c: bat.sequence_violations(c.clean),
    "inventory_gap": lambda c: bat.inventory_gap(c.clean),
    "batch_violations": lambda c: bat.batch_violations(c.lines, c.events),
    "batch_gate": lambda c: bat.batch_gate(c.lines, c.events, bat.batch_violations(c.lines, c.events)),
    "batch_lines": lambda c: bat.batch_lines(c.d.landing).select(
        "source_file_name", F.sha2("raw_record", 256).alias("line_hash"), "batch_id", "event_id", "session_id", "sequence_number",
        "meter_wh", "ok", joined("reasons"),
    ),
    "batch_clean_events": lambda c: times(
        c.clean.select("batch_id", "event_id", "session_id", "event_type", "event_time", "meter_wh", "ingested_at")
    ),
    "batch_adapt_manifest": _adapted("run_manifest"),
    "batch_adapt_registry": _adapted("input_session"),
    "batch_adapt_events": _adapted("events_raw"),
    "batch_adapt_tariffs": _adapted("tariffs_raw"),
    "content_fingerprint": lambda c: bat.content_fingerprint(
        c.d.landing, ["source_file_name"], F.col("raw_record")
    ),
    "attempt_log": lambda c: times(att.attempt_receipts(c.d.attempt_log)),
    "frozen_digest_check": lambda c: att.frozen_digest_check(att.frozen_evidence(c.d.frozen), c.d.tampered).select(
        "execution_id", "run_id", "state", "bound_rows", "bound_digest", "frozen_rows", "frozen_digest",
        F.coalesce("passed_rows", F.lit(0)).alias("passed_rows"), F.coalesce("covered", F.lit(False)).alias("covered"),
    ),
    "capture_check": _capture_check,
    "capture_snapshot": _capture_snapshot,
    "finish_status": _tracked,
    "check_execution": lambda c: evi.check_execution(c.d.requested, c.d.receipts, c.d.batch_snapshots),
    "check_batch_execution": lambda c: evi.check_batch_execution(c.d.requested, c.d.receipts, c.d.batch_snapshots),
    "snapshot_session_verdicts": lambda c: evi.snapshot_session_verdicts(*c.attempt),
    "execution_summary": lambda c: times(rep.execution_summary(*c.attempt, c.results)),
    "session_bills": lambda c: rep.session_bills(*c.attempt, c.results),
    "bills_ranked": lambda c: rep.bills_ranked(rep.session_bills(*c.attempt, c.results)),
    "bills_pivot": lambda c: rep.bills_pivot(c.d.frozen),
    "bills_complete": lambda c: rep.bills_complete(
        rep.execution_summary(*c.attempt, c.results), rep.session_bills(*c.attempt, c.results)
    ),
    "bills_filter": lambda c: rep.bills_filter(rep.session_bills(*c.attempt, c.results), "candidate", "FAIL"),
    "execution_choices": lambda c: rep.execution_choices(c.d.receipts),
    "recent_attempts": lambda c: times(rep.recent_attempts(c.d.receipts.distinct())),
    "key_set_diff": _key_set_diff,
}


def build(name: str) -> Callable[[SparkSession, str], DataFrame]:
    builder = _BUILDERS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return builder(Chain(spark, sf_dir))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: build(name) for name in _BUILDERS}
