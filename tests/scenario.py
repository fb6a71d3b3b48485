"""Small hand-made inputs: one hour, 12.5 kWh at EUR 0.45, so 5.625 rounds to 5.63."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from meterproof.operators.ledger import cdr_land
from meterproof.plans.assurance import Raw, assure

T0 = datetime(2026, 8, 22, 10)
EVENTS = (
    "run_id STRING, event_id STRING, charging_station_id STRING, transaction_id STRING, event_type STRING, "
    "sequence_number BIGINT, event_time TIMESTAMP, ingest_time TIMESTAMP, payload STRING"
)
TARIFF = (
    '{"id":"%s","currency":"EUR","elements":[{"price_components":[{"type":"ENERGY","price":%s,"step_size":1}]}]}'
)
CDR = (
    '{"country_code":"FR","party_id":"CAS","id":"%s","session_id":"%s","start_date_time":"2026-08-22T10:00:00Z",'
    '"end_date_time":"2026-08-22T11:00:00Z","currency":"%s","charging_periods":[{"tariff_id":"%s"}],'
    '"total_cost":{"excl_vat":%s},"total_energy":%s,"total_time":%s,"credit":false}'
)


def event(run, session, kind, minutes, wh, seq=None):
    seq = ("Started", "Updated", "Ended").index(kind) if seq is None else seq
    at = T0 + timedelta(minutes=minutes)
    payload = '{"meterValue":[{"sampledValue":[{"value":%s}]}]}' % wh
    return (run, f"{session}-{seq}-{minutes}", "cs", session, kind, seq, at, at, payload)


def session_events(run="r", session="s", start=100000, end=112500):
    return [
        event(run, session, "Started", 0, start),
        event(run, session, "Updated", 30, (start + end) // 2),
        event(run, session, "Ended", 60, end),
    ]


def cdr(run="r", role="baseline", cdr_id="c1", session="s", amount="5.63", energy="12.5", hours="1.0",
        currency="EUR", tariff="t1"):
    return (run, role, CDR % (cdr_id, session, currency, tariff, amount, energy, hours))


class Case:
    def __init__(self, spark, events=None, cdrs=None, registry=None, tariffs=None, manifests=1, runs=("r",)):
        self.spark = spark
        events = session_events() if events is None else events
        cdrs = [cdr(role="baseline"), cdr(role="candidate")] if cdrs is None else cdrs
        registry = [("r", "s", "t1")] if registry is None else registry
        tariffs = [("r", "t1", datetime(2026, 1, 1), None, "EUR", TARIFF % ("t1", "0.4500"))] if tariffs is None else tariffs
        hashed = F.sha2("payload", 256)
        self.events = spark.createDataFrame(events, EVENTS).withColumn("payload_hash", hashed)
        self.tariffs = spark.createDataFrame(
            tariffs, "run_id STRING, tariff_id STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, currency STRING, payload STRING"
        ).withColumn("payload_hash", hashed)
        self.registry = spark.createDataFrame(registry, "run_id STRING, session_id STRING, tariff_id STRING")
        self.cdrs = cdr_land(
            spark.createDataFrame(cdrs, "run_id STRING, release_role STRING, payload STRING").withColumn(
                "ingest_time", F.lit(T0)
            )
        )
        self.manifests = spark.createDataFrame(
            [(run, "scenario", 42, "b", "c", "t", T0) for run in runs for _ in range(manifests)],
            "run_id STRING, scenario_id STRING, seed BIGINT, baseline_sha STRING, candidate_sha STRING, tariff_hash STRING, created_at TIMESTAMP",
        )
        self.results = assure(
            Raw(self.manifests, self.registry, self.events, self.tariffs, self.cdrs), evaluated_at=F.lit(T0)
        )

    def checks(self, role="candidate"):
        rows = self.results.assertion_result.where(F.col("release_role") == role).collect()
        return {row.assertion_id: row for row in rows}

    def verdict(self):
        return self.results.release_verdict.collect()[0]
