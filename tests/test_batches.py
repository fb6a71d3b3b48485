"""Batch rules, gate and adaptation on small hand-made batches."""

import hashlib
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterproof.operators import batch, reports
from meterproof.plans.batches import batch_outcomes, evaluate_batches
from meterproof.sources.tables import stored_under

T0 = datetime(2026, 8, 22, 10)
LANDING = "raw_record STRING, record_hash STRING, source_file_name STRING, ingested_at TIMESTAMP"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lines(batch_id="b", declared=3, delivered=None, change=None, body_change=None, file="f.jsonl"):
    """Landed lines of a batch; `change` and `body_change` edit the first event's documents."""
    rows = []
    for index in range(declared if delivered is None else delivered):
        ident = sha(f"sessions-v1:{batch_id}:{index}")[:24]
        for seq, kind in enumerate(("Started", "Updated", "Ended")):
            at = (T0 + timedelta(minutes=30 * seq)).strftime("%Y-%m-%dT%H:%M:%SZ")
            sample = {
                "value": 1000 * seq, "measurand": "Energy.Active.Import.Register", "location": "Outlet",
                "unitOfMeasure": {"unit": "Wh", "multiplier": 0},
            }
            body = {
                "eventType": kind, "timestamp": at, "seqNo": seq,
                "transactionInfo": {"transactionId": f"txn-{ident}", **({"timeSpentCharging": 1800 * seq} if seq else {})},
                "meterValue": [{"timestamp": at, "sampledValue": [sample]}],
            }
            first = not rows
            if first and body_change:
                body_change(body)
            envelope = {
                "schema_version": 1, "run_id": f"generated-v1-{batch_id}", "event_id": f"msg-{ident}-{kind.lower()}",
                "charging_station_id": f"cs-{ident}", "payload": json.dumps(body),
                "generator": {
                    "version": "sessions-v1", "batch_id": batch_id, "session_count": declared, "seed": 42,
                    "tariff": {"id": "generated-energy-v1", "currency": "EUR", "price_per_kwh": "0.45"},
                },
            }
            if first and change:
                change(envelope)
            text = json.dumps(envelope)
            rows.append((text, sha(text), file, T0))
    return rows


def checked(spark, rows):
    found = batch.batch_lines(spark.createDataFrame(rows, LANDING))
    events = batch.event_dedup(found)
    violations = batch.batch_violations(found, events)
    gate = batch.batch_gate(found, events, violations)
    return found, events, violations, gate


def accepted(gate):
    return {r.batch_id for r in gate.where("accepted").collect()}


def at(document, *path):
    for key in path:
        document = document[key]
    return document


def setting(value, *path):
    def edit(document):
        at(document, *path[:-1])[path[-1]] = value

    return edit


SAMPLE = ("meterValue", 0, "sampledValue", 0)
ENVELOPE_FAULTS = [
    (setting("1", "schema_version"), "schema_version"), (setting(1.0, "schema_version"), "schema_version"),
    (setting(True, "schema_version"), "schema_version"), (setting("3", "generator", "session_count"), "generator"),
    (setting(0, "generator", "session_count"), "generator"), (setting(4294967296, "generator", "seed"), "generator"),
    (setting("x", "generator", "note"), "generator"), (setting(0.45, "generator", "tariff", "price_per_kwh"), "generator"),
    (setting("x", "generator", "tariff", "vat"), "generator"), (setting("c", "cdr_id"), "mixed_record"), (setting("c", "more"), "unexpected_fields"),
    (setting("other", "run_id"), "run_id"), (setting("cs-x", "charging_station_id"), "identity"), (setting({}, "payload"), "malformed_event"),
    (setting("{} x", "payload"), "malformed_event"), (setting('{"seqNo":0,"seqNo":0}', "payload"), "malformed_event"),
]
BODY_FAULTS = [
    (setting("0", "seqNo"), "sequence_type"), (setting(9_000_000_000_000_000_000, "seqNo"), "sequence_type"), (setting(1, "seqNo"), "sequence_type"),
    (setting("2026-08-22T10:00:00", "timestamp"), "meter_time"), (setting("2026-08-22 10:00:00Z", "timestamp"), "meter_time"),
    (setting("2026-08-22T10:00:01Z", "meterValue", 0, "timestamp"), "meter_time"), (setting("5", *SAMPLE, "value"), "meter_value"),
    (setting(5.5, *SAMPLE, "value"), "meter_value"), (setting(-1, *SAMPLE, "value"), "meter_value"), (setting(9223372036854775808, *SAMPLE, "value"), "meter_value"),
    (setting("kWh", *SAMPLE, "unitOfMeasure", "unit"), "register"), (setting("0", *SAMPLE, "unitOfMeasure", "multiplier"), "register"),
    (setting([], "meterValue"), "one_sample"), (setting("txn-other", "transactionInfo", "transactionId"), "identity"),
]


def test_a_line_fault_names_its_rule_and_keeps_its_batch_out(spark):
    faults = [(kind, edit, rule) for kind, group in (("change", ENVELOPE_FAULTS), ("body_change", BODY_FAULTS)) for edit, rule in group]
    rows = lines("whole", file="whole.jsonl")
    for i, (kind, edit, _) in enumerate(faults):
        rows += lines(f"b{i}", file=f"{i}.jsonl", **{kind: edit})
    found, _, _, gate = checked(spark, rows)
    reasons = {r.source_file_name: set(r.reasons) for r in found.where("NOT ok").collect()}
    assert "whole.jsonl" not in reasons
    for i, (_, _, rule) in enumerate(faults):
        assert rule in reasons[f"{i}.jsonl"], (i, rule, reasons[f"{i}.jsonl"])
    assert accepted(gate) == {"whole"}


def test_an_incomplete_batch_is_not_adapted(spark):
    rows = lines("whole", 3) + lines("short", 3, delivered=1, file="g.jsonl") + lines("absurd", 10_000_001, delivered=2, file="h.jsonl")
    _, events, violations, gate = checked(spark, rows)
    counts = {(r.batch_id, r.violation): r.occurrences for r in violations.collect()}
    assert counts == {("short", "missing_session"): 2, ("absurd", "generator"): 6}
    assert accepted(gate) == {"whole"}
    adapted = batch.batch_adapt(batch.batch_clean_events(events), gate, "code")
    assert {name: df.count() for name, df in adapted.items()} == {"run_manifest": 1, "input_session": 3, "events_raw": 9, "tariffs_raw": 1}


def test_a_batch_that_lacks_most_sessions_is_listed_in_full(spark):
    rows = lines("large", 50_000, delivered=3)
    found = spark.createDataFrame(rows, LANDING)
    clean = batch.batch_clean_events(batch.event_dedup(batch.batch_lines(found)))
    extra = clean.where("batch_id = 'large'").limit(1).withColumn("session_id", F.lit("txn-nobody"))
    gaps = batch.inventory_gap(clean.unionByName(extra))
    counts = {(r.batch_id, r.gap): (r["count"], r.ids) for r in gaps.groupBy("batch_id", "gap").agg(F.count("*").alias("count"), F.countDistinct("session_id").alias("ids")).collect()}
    assert counts == {("large", "missing"): (49_997, 49_997), ("large", "undeclared"): (1, 1)}
    known = {r.batch_id: (r.n, r.seen, r.missing) for r in batch.declared_sessions(clean).collect()}
    assert known == {"large": (50_000, 3, 49_997)}
    with pytest.raises(Exception, match="too many sessions: large"):
        batch.inventory_gap(clean.withColumn("session_count", F.lit(9 * 10**18))).count()


@pytest.mark.parametrize("bad", ["{broken", "", None])
def test_a_line_without_a_batch_counts_against_its_file(spark, bad):
    rows = lines("whole", file="f.jsonl") + lines("other", file="g.jsonl") + [(bad, bad and sha(bad), "g.jsonl", T0)]
    assert accepted(checked(spark, rows)[3]) == {"whole"}


def test_copies_agree_or_keep_the_batch_out(spark):
    rows = lines("b")
    spaced = json.dumps(json.loads(rows[0][0]), separators=(",", ":"), sort_keys=True)
    again = rows + [(spaced, sha(spaced), "g.jsonl", T0 - timedelta(hours=1))]
    _, events, _, gate = checked(spark, again)
    assert accepted(gate) == {"b"} and events.agg(F.min("ingested_at")).first()[0] == T0 - timedelta(hours=1)
    other = lines("b", body_change=setting(5, *SAMPLE, "value"), file="g.jsonl")[:1]
    assert accepted(checked(spark, rows + other)[3]) == set()


def test_one_batch_holds_most_events(spark):
    rows = lines("big", 300) + lines("small", 2, file="g.jsonl")
    _, events, _, gate = checked(spark, rows)
    adapted = batch.batch_adapt(batch.batch_clean_events(events), gate, "code", "amount_error")
    counts = {r.run_id.split("-")[3]: r["count"] for r in adapted["events_raw"].groupBy("run_id").count().collect()}
    assert counts == {"big": 900, "small": 6}


@pytest.mark.parametrize("mode, passed, failed, verdict", [("healthy", 28, 0, "PASS"), ("amount_error", 26, 2, "FAIL")])
def test_batches_are_evaluated_whole_or_not_at_all(spark, tmp_path, mode, passed, failed, verdict):
    rows = lines("a", 2, file="a.jsonl") + lines("b", 3, delivered=1, file="b.jsonl")
    done = evaluate_batches(spark.createDataFrame(rows, LANDING), "code", mode, F.lit(T0), stored_under(str(tmp_path)))
    found = done.results.release_verdict.collect()
    assert [(v.required_assertions, v.passed_assertions, v.failed_assertions, v.verdict) for v in found] == [(28, passed, failed, verdict)]
    assert {(r.release_role, r.passed_assertions, r.verdict) for r in reports.role_summary(done.results.release_verdict).collect()} == {
        ("baseline", 14, "PASS"), ("candidate", passed - 14, verdict)
    }
    outcomes = {r.batch_id: (r.new_status, r.new_reason) for r in batch_outcomes(done.gate, done.violations).collect()}
    assert outcomes == {"a": ("SUCCEEDED", "Captured."), "b": ("FAILED", "2 violations, first kind: missing_session")}


def test_stored_lines_hold_no_text_twice_and_payloads_come_back_whole(spark):
    def odd(body):
        body["note"] = 'ä "quoted" \\ \n   \U0001f600'

    rows = lines(declared=2, body_change=odd)
    found = batch.stored_lines(spark.createDataFrame(rows, LANDING))
    assert not {"raw_record", "payload", "keys"} & set(found.columns)
    events = batch.event_dedup(found)
    assert "payload" not in events.columns
    gate = batch.batch_gate(found, events, batch.batch_violations(found, events))
    adapted = batch.batch_adapt(batch.batch_clean_events(events), gate, "code")["events_raw"]
    wanted = {json.loads(text)["event_id"]: json.loads(text)["payload"] for text, *_ in rows}
    assert {r.event_id: r.payload for r in adapted.collect()} == wanted


def test_every_way_of_reading_a_line_gives_the_same_fields(spark, monkeypatch):
    [(text, _, _, _), (later, _, _, _)] = lines(declared=1)[:2]

    def written(document, body=None, **how):
        body = json.loads(document["payload"]) if body is None else body
        body = body if isinstance(body, str) else json.dumps(body, separators=(",", ":"))
        return json.dumps({**document, "payload": body}, separators=(",", ":"), **how)

    usual = [json.loads(text), json.loads(later)]
    texts = [text, later, *[written(d, **how) for d in usual for how in ({}, {"sort_keys": True})]]
    body = json.loads(usual[1]["payload"])
    by_name = json.dumps(body, sort_keys=True, separators=(",", ":"))
    texts += [written(usual[1], by_name), written(usual[1], by_name, sort_keys=True), text.replace('"seed": 42, ', "")]
    texts += [written({**usual[1], "event_id": x}) for x in ("é", "a/b", "\x01\t\n", " ", "\x7f", "😀", "\\", '"', "", None, 7)]
    texts += [written({**usual[1], "event_id": x}, ensure_ascii=False) for x in ("é", " ", "\x7f", "😀", "a\\u0001")]
    plain = written(usual[1])
    texts += [plain.replace('version":1', f'version":{x}') for x in ('"1"', "1.0", "1e0", "-0", "9" * 19, "9" * 40, "null", "[1]", "true")]
    texts += [plain + x for x in (" ", "]", "}", ",", "\x00", '{"a":1}')] + [" " + plain, "﻿" + plain, plain[:-1], "", "[]", "1", "{}", None]
    texts += [plain.replace('"run_id"', '"schema_version":1,"run_id"'), plain.replace("msg-", "\\u006dsg-"), plain.replace("msg-", "\\ud800"), plain.replace('"run_id"', "'run_id'")]
    compact = json.dumps(body, separators=(",", ":"))
    sample = body["meterValue"][0]["sampledValue"][0]
    bodies = [
        compact.replace(':500,', f":{x},") for x in ("null", '"5"', "5.0", "-5")
    ] + [compact.replace('"value":1000', f'"value":{x}') for x in ("null", '"5"', "5.0", "-5", "1e3", "9" * 30)]
    bodies += [compact.replace("00Z", x) for x in ("00.5Z", "00", "00+02:00", "00.1234567Z", "99Z")]
    bodies += [compact + "]", compact.replace('"seqNo":1', '"seqNo":1,"seqNo":2'), compact.replace('"seqNo":1,', ""), "[]", "", "null", "7"]
    for meters in ([], [{}], None, [{"timestamp": None, "sampledValue": [sample]}], *[
        [{"timestamp": "2026-08-22T10:30:00Z", "sampledValue": found}]
        for found in ([], None, [{}, sample], [sample, {}], [sample, sample], [{**sample, "value": None}, sample], [sample, {**sample, "value": 1.5}])
    ]):
        bodies.append({**body, "meterValue": meters})
    texts += [written(usual[1], b) for b in bodies] + [written({**usual[1], "payload": 1}, compact).replace(json.dumps(compact), "1")]
    landed = spark.createDataFrame([(t, sha(t or ""), f"{i}", T0) for i, t in enumerate(texts)], LANDING)
    read = lambda: sorted(map(str, batch.batch_lines(landed).collect()))
    quick = read()
    paths = batch.batch_lines(landed).where("ok").count()
    monkeypatch.setattr(batch, "LONG_DOCUMENT", 0)
    by_kind = read()
    monkeypatch.setattr(batch, "ENVELOPE_KIND", "none")
    monkeypatch.setattr(batch, "EVENT_KINDS", ("none",))
    assert quick == by_kind == read()
    assert paths >= 8
