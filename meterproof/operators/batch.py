"""Validation of landed event batches and their adaptation to pipeline inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterproof.functions.columns import (
    INSTANT,
    broken_rules,
    document_within,
    holds,
    instant_at,
    items_at,
    keeps_all,
    kind_at,
    marked,
    once,
    sha256,
    text_at,
    whole_at,
)
from meterproof.operators.joins import spread_join
from meterproof.schemas import EVENT_TYPES

# Fixed values of the supported envelope.
FIELDS = ("charging_station_id", "event_id", "generator", "payload", "run_id", "schema_version")
FOREIGN_FIELDS = ("cdr_id", "release_role", "tariff_id")
VERSION = "sessions-v1"
RUN_PREFIX = "generated-v1-"
TARIFF = {"id": "generated-energy-v1", "currency": "EUR", "price_per_kwh": "0.45"}
TARIFF_PAYLOAD = (
    '{"currency":"EUR","elements":[{"price_components":[{"price":0.45,"step_size":1,"type":"ENERGY"}]}],'
    '"id":"generated-energy-v1"}'
)
# Kinds of the generator's fields, as the engine prints them: nothing else may be there.
GENERATOR = (
    "OBJECT<batch_id: STRING, seed: BIGINT, session_count: BIGINT, "
    "tariff: OBJECT<currency: STRING, id: STRING, price_per_kwh: STRING>, version: STRING>"
)
# The usual shape of an envelope and of the events inside it, as the engine prints and casts them.
ENVELOPE_KIND = (
    f"OBJECT<charging_station_id: STRING, event_id: STRING, generator: {GENERATOR}, payload: STRING, "
    "run_id: STRING, schema_version: BIGINT>"
)
ENVELOPE = (
    "STRUCT<charging_station_id: STRING, event_id: STRING, generator: STRUCT<batch_id: STRING, seed: BIGINT, session_count: BIGINT, "
    "tariff: STRUCT<currency: STRING, id: STRING, price_per_kwh: STRING>, version: STRING>, payload: STRING, "
    "run_id: STRING, schema_version: BIGINT>"
)
EVENT_KINDS = tuple(
    "OBJECT<eventType: STRING, meterValue: ARRAY<OBJECT<sampledValue: ARRAY<OBJECT<location: STRING, measurand: STRING, "
    "unitOfMeasure: OBJECT<multiplier: BIGINT, unit: STRING>, value: BIGINT>>, timestamp: STRING>>, seqNo: BIGINT, "
    f"timestamp: STRING, transactionInfo: OBJECT<{spent}transactionId: STRING>>"
    for spent in ("", "timeSpentCharging: BIGINT, ")
)
EVENT = (
    "STRUCT<eventType: STRING, meterValue: ARRAY<STRUCT<sampledValue: ARRAY<STRUCT<location: STRING, measurand: STRING, "
    "unitOfMeasure: STRUCT<multiplier: BIGINT, unit: STRING>, value: BIGINT>>, timestamp: STRING>>, seqNo: BIGINT, "
    "timestamp: STRING, transactionInfo: STRUCT<timeSpentCharging: BIGINT, transactionId: STRING>>"
)
# Orders in which fields are delivered, besides that of their names.
WRITTEN_ENVELOPE = {
    "schema_version": None, "run_id": None, "event_id": None, "charging_station_id": None, "payload": None,
    "generator": {
        "version": None, "batch_id": None, "session_count": None, "seed": None,
        "tariff": {"id": None, "currency": None, "price_per_kwh": None},
    },
}
WRITTEN_EVENT = {
    "eventType": None, "timestamp": None, "seqNo": None, "transactionInfo": {"transactionId": None, "timeSpentCharging": None},
    "meterValue": [{
        "timestamp": None,
        "sampledValue": [{"value": None, "measurand": None, "location": None, "unitOfMeasure": {"unit": None, "multiplier": None}}],
    }],
}
#: Characters from which on a document is always parsed as a variant, whose size has a limit.
LONG_DOCUMENT = 1_000_000
CHUNK = 10_000
#: Sessions that a batch may declare; a line that declares more breaks the rule of its generator.
MOST_DECLARED = 10_000_000


def _written(read: Column, order: dict) -> Column:
    """The fields of a document in another order, those inside them too; a list stands for lists of its member."""

    def part(name: str, inner) -> Column:
        if isinstance(inner, list):
            return F.transform(read[name], lambda member: _written(member, inner[0]))
        return _written(read[name], inner) if inner else read[name]

    return F.when(read.isNotNull(), F.struct(*[part(name, inner).alias(name) for name, inner in order.items()]))


def _leaves(read: Column, order: dict) -> list[Column]:
    return [c for k, v in order.items() for c in (_leaves(read[k], v) if v else [read[k]])]


def _reproduced(df: DataFrame, text: str, fields: str, order: dict, whole: bool = False) -> DataFrame:
    """Adds `_same`: the typed fields of a document that they reproduce to the byte, else NULL.

    Such a document holds no field but these, each once and in its type, and nothing after them.
    A field may be missing, unless it is asked for as a `whole`.
    """
    own = F.col("_read")
    same = F.when(F.to_json(_written(own, order)) == F.col(text), True).otherwise(F.to_json(own) == F.col(text))
    for leaf in _leaves(own, order) if whole else []:
        same = same & leaf.isNotNull()
    read = F.when(F.length(text) < LONG_DOCUMENT, F.from_json(text, fields))
    return df.withColumn("_read", once(read)).withColumn("_same", once(F.when(holds(same), own))).drop("_read")


def _usual(document: Column, kinds: tuple[str, ...], fields: str) -> Column:
    """`_same`, or the fields of a document whose kinds are all as usual, in whatever order, or NULL.

    Kinds are asked of the whole document: under these, no text can stand for a number.
    """
    by_kind = F.when(F.schema_of_variant(document).isin(*kinds), F.try_variant_get(document, "$", fields))
    return once(F.coalesce(F.col("_same"), by_kind))


def _opened(landing: DataFrame) -> DataFrame:
    """Landed lines with the envelope and the event inside it, each parsed once.

    Documents that their fields reproduce are read without a search, others of the usual shape in
    one step; any other is asked field by field. The three give the same fields.
    """
    envelope, body = F.col("_envelope"), F.col("_body")
    usual, event = F.col("_usual"), F.col("_event")

    def outer(fast: Column, slow: Column) -> Column:
        return F.when(usual.isNotNull(), fast).otherwise(slow)

    def inner(fast: Column, slow: Column) -> Column:
        return F.when(event.isNotNull(), fast).otherwise(slow)

    def instant(text: Column) -> Column:
        return F.when(text.rlike(INSTANT), text.try_cast("timestamp"))

    def listed(texts: list[Column]) -> Column:
        return F.concat_ws("|", *[F.coalesce(text, F.lit("")) for text in texts])

    opened = {
        # Its fields in the order of their names, as the parsed document prints them.
        "canonical": outer(F.to_json(usual), F.to_json(envelope)),
        "parsed": usual.isNotNull() | envelope.isNotNull(),
        "usual": usual.isNotNull(),
        "schema_version": outer(usual["schema_version"], whole_at(envelope, "$.schema_version")),
        "run_id": outer(usual["run_id"], text_at(envelope, "$.run_id")),
        "event_id": outer(usual["event_id"], text_at(envelope, "$.event_id")),
        "station": outer(usual["charging_station_id"], text_at(envelope, "$.charging_station_id")),
        "payload": outer(
            usual["payload"], F.when(kind_at(envelope, "$.payload") == "STRING", text_at(envelope, "$.payload"))
        ),
        "generator": outer(F.lit(GENERATOR), kind_at(envelope, "$.generator")),
        "version": outer(usual["generator"]["version"], text_at(envelope, "$.generator.version")),
        "batch_id": outer(usual["generator"]["batch_id"], text_at(envelope, "$.generator.batch_id")),
        "session_count": outer(usual["generator"]["session_count"], whole_at(envelope, "$.generator.session_count")),
        "seed": outer(usual["generator"]["seed"], whole_at(envelope, "$.generator.seed")),
        "tariff": outer(
            listed([usual["generator"]["tariff"][name] for name in TARIFF]),
            listed([text_at(envelope, f"$.generator.tariff.{name}") for name in TARIFF]),
        ),
    }
    kept = ["raw_record", "record_hash", "source_file_name", "ingested_at"]
    lines = (
        _reproduced(landing.select(*kept), "raw_record", ENVELOPE, WRITTEN_ENVELOPE, whole=True)
        .withColumn("_marked", F.when(F.col("_same").isNull(), marked("raw_record")))
        .withColumn("_envelope", document_within(F.col("_marked"), "raw_record"))
        .withColumn("_usual", _usual(envelope, (ENVELOPE_KIND,), ENVELOPE))
        .withColumn("_e", once(F.struct(*[v.alias(k) for k, v in opened.items()])))
        .select(*kept, "_e.*")
    )
    meter = event["meterValue"]
    sample, at = F.col("_sample"), "$.meterValue[0].sampledValue[0]"
    read = {
        "body_parsed": inner(F.lit(True), kind_at(body, "$").startswith("OBJECT")),
        "session_id": inner(event["transactionInfo"]["transactionId"], text_at(body, "$.transactionInfo.transactionId")),
        "event_type": inner(event["eventType"], text_at(body, "$.eventType")),
        "sequence_number": inner(event["seqNo"], whole_at(body, "$.seqNo")),
        "event_time": inner(instant(event["timestamp"]), instant_at(body, "$.timestamp")),
        "spent": inner(
            event["transactionInfo"]["timeSpentCharging"], whole_at(body, "$.transactionInfo.timeSpentCharging")
        ),
        "meter_time": inner(instant(F.col("_meter")["timestamp"]), instant_at(body, "$.meterValue[0].timestamp")),
        "meters": inner(F.size(meter), items_at(body, "$.meterValue")),
        "samples": inner(F.size(F.col("_meter")["sampledValue"]), items_at(body, "$.meterValue[0].sampledValue")),
        "meter_wh": inner(sample["value"], whole_at(body, f"{at}.value")),
        "multiplier": inner(sample["unitOfMeasure"]["multiplier"], whole_at(body, f"{at}.unitOfMeasure.multiplier")),
        "register": inner(
            listed([sample["measurand"], sample["location"], sample["unitOfMeasure"]["unit"]]),
            listed([text_at(body, f"{at}.{part}") for part in ("measurand", "location", "unitOfMeasure.unit")]),
        ),
    }
    return (
        _reproduced(lines, "payload", EVENT, WRITTEN_EVENT)
        .withColumn("_marked", F.when(F.col("_same").isNull(), marked("payload")))
        .withColumn("_body", document_within(F.col("_marked"), "payload"))
        .withColumn("_event", _usual(body, EVENT_KINDS, EVENT))
        .withColumn("_meter", F.try_element_at(meter, F.lit(1)))
        .withColumn("_sample", F.try_element_at(F.col("_meter")["sampledValue"], F.lit(1)))
        .withColumn("_i", once(F.struct(*[v.alias(k) for k, v in read.items()])))
        # Behind the parsing, so that it is read for the lines and the queries that ask for it only.
        .select(*kept, F.json_object_keys("raw_record").alias("keys"), *[c for c in lines.columns if c not in kept], "_i.*")
    )


def _line_rules() -> dict[str, Column]:
    identity = F.regexp_replace("session_id", "^txn-", "")
    place = F.when(F.col("sequence_number").between(0, 2), F.col("sequence_number").cast("int") + 1)
    kind = F.try_element_at(F.array(*[F.lit(name) for name in EVENT_TYPES]), place)
    wanted = F.array(*[F.lit(name) for name in FIELDS])
    foreign = F.array(*[F.lit(name) for name in FOREIGN_FIELDS])
    keys = F.json_object_keys("raw_record")
    return {
        "record_hash": F.col("record_hash") == sha256("raw_record"),
        "malformed_line": F.col("parsed"),
        # An envelope of the usual shape has the wanted fields and no other.
        "mixed_record": F.when(~F.col("usual"), ~F.coalesce(F.arrays_overlap(keys, foreign), F.lit(False))).otherwise(True),
        "unexpected_fields": F.when(~F.col("usual"), F.sort_array(keys) == wanted).otherwise(True),
        "schema_version": F.col("schema_version") == 1,
        "run_id": F.col("run_id") == F.concat(F.lit(RUN_PREFIX), "batch_id"),
        "generator": (F.col("generator") == GENERATOR)
        & (F.col("version") == VERSION)
        & F.col("batch_id").rlike("^[a-z][a-z0-9_-]{0,31}$")
        & F.col("session_count").between(1, MOST_DECLARED)
        & F.col("seed").between(0, 4294967295)
        & (F.col("tariff") == "|".join(TARIFF.values())),
        "malformed_event": F.col("body_parsed"),
        "sequence_type": F.col("event_type") == kind,
        "identity": F.col("session_id").startswith("txn-")
        & (F.col("event_id") == F.concat(F.lit("msg-"), identity, F.lit("-"), F.lower("event_type")))
        & (F.col("station") == F.concat(F.lit("cs-"), identity)),
        "meter_time": F.col("meter_time") == F.col("event_time"),
        "one_sample": (F.col("meters") == 1) & (F.col("samples") == 1),
        "register": (F.col("register") == "Energy.Active.Import.Register|Outlet|Wh") & (F.col("multiplier") == 0),
        "meter_value": F.col("meter_wh") >= 0,
        "elapsed": (F.col("sequence_number") == 0) | (F.col("spent") > 0),
    }


def batch_lines(landing: DataFrame) -> DataFrame:
    """Every landed line with its fields and the envelope or event rules it breaks. No shuffle."""
    rules = _line_rules()
    return _opened(landing).withColumns({"reasons": broken_rules(rules), "ok": keeps_all(rules)}).drop("usual")


#: What `event_dedup`, `batch_violations` and `batch_gate` read of a line, so what a job stores of it.
KEPT = (
    "batch_id", "event_id", "run_id", "source_file_name", "ingested_at", "canonical", "station", "session_id", "event_type",
    "sequence_number", "event_time", "spent", "meter_wh", "session_count", "seed", "reasons", "ok",
)


def stored_lines(landing: DataFrame) -> DataFrame:
    """`batch_lines` without what a valid line holds twice: its text and its payload are both in `canonical`."""
    return batch_lines(landing).select(*KEPT)


def event_dedup(lines: DataFrame) -> DataFrame:
    """One row per event of the valid lines: earliest arrival, and whether copies disagree.

    Copies agree when their documents are equal, whatever the spacing or key order. The payload
    stays inside `canonical`, from which `payload_of` takes it: rows are sorted and shuffled here.
    """
    content = F.struct(
        "canonical", "run_id", "station", "session_id", "event_type", "sequence_number", "event_time",
        "spent", "meter_wh", "session_count", "seed",
    )
    return (
        lines.where("ok")
        .groupBy("batch_id", "event_id")
        .agg(
            F.min(content).alias("content"),
            F.max("canonical").alias("_last"),
            F.min("ingested_at").alias("ingested_at"),
            F.count(F.lit(1)).alias("copies"),
        )
        .withColumn("conflict", F.col("content.canonical") != F.col("_last"))
        .select("batch_id", "event_id", "ingested_at", "copies", "conflict", "content.*")
    )


def payload_of(canonical: str) -> Column:
    """The event document inside the envelope of a valid line."""
    return F.get_json_object(canonical, "$.payload")


def batch_clean_events(events: DataFrame) -> DataFrame:
    """The events of `event_dedup` whose copies agree."""
    return events.where(~F.col("conflict")).drop("conflict")


def sequence_violations(events: DataFrame) -> DataFrame:
    """Sessions whose three events are incomplete or out of order.

    The three positions are picked by conditional aggregates instead of ordering a
    session's rows, so state stays fixed-size.
    """

    def at(position: int, column: str) -> Column:
        return F.max(F.when(F.col("sequence_number") == position, F.col(column)))

    picked = events.groupBy("batch_id", "session_id").agg(
        F.count(F.lit(1)).alias("event_rows"),
        *[at(i, "event_time").alias(f"t{i}") for i in range(3)],
        *[at(i, "meter_wh").alias(f"m{i}") for i in range(3)],
        *[at(i, "spent").alias(f"s{i}") for i in (1, 2)],
    )
    # As decimals: an absurd number of seconds must not overflow.
    elapsed = [
        F.unix_micros(f"t{i}") - F.unix_micros("t0") == F.col(f"s{i}").cast("decimal(20,0)") * 1_000_000 for i in (1, 2)
    ]
    complete = F.col("t0").isNotNull() & F.col("t1").isNotNull() & F.col("t2").isNotNull()
    rules = {
        "incomplete_sequence": complete & (F.col("event_rows") == 3),
        "times_not_increasing": ~complete | ((F.col("t0") < F.col("t1")) & (F.col("t1") < F.col("t2"))),
        "meter_decreased": ~complete | ((F.col("m0") <= F.col("m1")) & (F.col("m1") <= F.col("m2"))),
        "elapsed_differs": ~complete | (elapsed[0] & elapsed[1]),
    }
    return picked.select(
        "batch_id", "session_id", F.explode(broken_rules(rules)).alias("violation")
    )


def declared_sessions(events: DataFrame) -> DataFrame:
    """Per batch: sessions declared (n) and seen, and the least number missing."""
    found = events.groupBy("batch_id", "session_id").agg(F.max("session_count").alias("n"))
    declared = found.groupBy("batch_id").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("seen"))
    return declared.withColumn("missing", F.greatest(F.col("n") - F.col("seen"), F.lit(0)))


def inventory_gap(events: DataFrame) -> DataFrame:
    """Declared sessions without events, and sessions nobody declared, of every batch in full.

    Declared ids are generated in two steps, so that a batch declaring millions of sessions is
    spread over tasks before it becomes rows. `batch_lines` lets no declaration over
    MOST_DECLARED through; running this on events that hold one fails.
    """
    found = events.select("batch_id", "session_id").distinct()
    broken = F.raise_error(F.concat(F.lit("declares too many sessions: "), "batch_id"))
    declared = declared_sessions(events).withColumn("n", F.when(F.col("n") <= MOST_DECLARED, F.col("n")).otherwise(broken))
    last_chunk = F.floor((F.col("n") - 1) / CHUNK)
    chunks = declared.select("batch_id", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)).alias("chunk")).repartition("batch_id", "chunk")
    first = F.col("chunk") * CHUNK
    index = F.explode(F.sequence(first, F.least(first + CHUNK, F.col("n")) - 1)).alias("index")
    seed = F.concat(F.lit(f"{VERSION}:"), "batch_id", F.lit(":"), F.col("index").cast("string"))
    wanted = chunks.select("batch_id", index).select(
        "batch_id",
        F.concat(F.lit("txn-"), F.substring(sha256(seed), 1, 24)).alias("session_id"),
        F.lit(1).alias("declared"),
    )
    listed = found.select("batch_id", "session_id", F.lit(1).alias("seen"))
    return (
        wanted.unionByName(listed, allowMissingColumns=True)
        .groupBy("batch_id", "session_id")
        .agg(F.max("declared").alias("declared"), F.max("seen").alias("seen"))
        .where(F.col("declared").isNull() | F.col("seen").isNull())
        .select("batch_id", "session_id", F.when(F.col("seen").isNull(), "missing").otherwise("undeclared").alias("gap"))
    )


def batch_violations(lines: DataFrame, events: DataFrame) -> DataFrame:
    """Per batch and kind of violation, how many lines, events, sessions or settings break it.

    Takes the results of `batch_lines` and `event_dedup`, which a job stores first:
    both are read several times here and the lines are costly to parse.
    """
    clean = batch_clean_events(events)
    settings = (
        events.groupBy("batch_id")
        .agg(
            F.min(F.struct("session_count", "seed")).alias("lo"),
            F.max(F.struct("session_count", "seed")).alias("hi"),
        )
        .where(F.col("lo") != F.col("hi"))
    )
    found = (
        lines.select("batch_id", F.explode("reasons").alias("violation")),
        events.where("conflict").select("batch_id", F.lit("conflicting_event").alias("violation")),
        sequence_violations(clean).select("batch_id", "violation"),
        inventory_gap(clean).select("batch_id", F.concat(F.col("gap"), F.lit("_session")).alias("violation")),
        settings.select("batch_id", F.lit("conflicting_settings").alias("violation")),
    )
    stacked = found[0]
    for frame in found[1:]:
        stacked = stacked.unionByName(frame)
    return stacked.groupBy("batch_id", "violation").agg(F.count(F.lit(1)).alias("occurrences"))


def batch_gate(lines: DataFrame, events: DataFrame, violations: DataFrame) -> DataFrame:
    """Per batch with valid events: whether all of it may be adapted.

    One violation keeps the whole batch out. A line that names no batch counts against the
    batches of its file, and one whose run id names another batch counts against that as well.
    """
    named = F.regexp_extract("run_id", f"^{RUN_PREFIX}(.*)$", 1)
    bad = lines.where(F.size("reasons") > 0)
    nameless = bad.where(F.col("batch_id").isNull()).select("source_file_name").distinct()
    of_files = lines.where("ok").select("batch_id", "source_file_name").distinct().join(nameless, "source_file_name", "left_semi")
    rejected = (
        violations.select("batch_id")
        .unionByName(bad.select(named.alias("batch_id")))
        .unionByName(of_files.select("batch_id"))
        .where(F.col("batch_id").isNotNull())
        .distinct()
        .withColumn("_rejected", F.lit(True))
    )
    return (
        events.select("batch_id").distinct().join(rejected, "batch_id", "left")
        .select("batch_id", F.col("_rejected").isNull().alias("accepted"))
    )


def content_fingerprint(rows: DataFrame, keys: list[str], content: Column) -> DataFrame:
    """Identity of a set of documents that ignores order, arrival and partitioning.

    The 32-bit words of each document's SHA-256 are summed and the sums hashed with
    the document count. Sums combine before the shuffle, so no task has to sort the
    hashes of a large set.
    """
    digest = F.sha2(content, 256)
    words = [
        F.conv(F.substring("_digest", 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"w{i}") for i in range(8)
    ]
    # As decimals: a sum of 64-bit integers would overflow beyond some four billion documents.
    sums = [F.sum(F.col(f"w{i}").cast("decimal(20,0)")).cast("string") for i in range(8)]
    return (
        rows.select(*keys, digest.alias("_digest"))
        .select(*keys, *words)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums), 256).alias("input_hash"),
        )
    )


def batch_identity(clean: DataFrame, code_hash: str, mode: str) -> DataFrame:
    """Per batch: input hash, and the run id bound to input, code and mode."""
    suffix = F.substring(F.sha2(F.concat("input_hash", F.lit(code_hash)), 256), 1, 16)
    return content_fingerprint(clean, ["batch_id"], F.col("canonical")).withColumn(
        "run_id", F.concat(F.lit("generated-check-v1-"), "batch_id", F.lit(f"-{mode}-"), suffix)
    )


def batch_adapt(clean: DataFrame, gate: DataFrame, code_hash: str, mode: str = "healthy") -> dict[str, DataFrame]:
    """Manifest, registry, events and tariff rows of each batch that the gate accepts.

    An accepted batch is complete, so its sessions are those declared. A batch may hold most
    of the events, so the join that attaches run ids is spread by event.
    """
    accepted = gate.where("accepted").select("batch_id")
    per_batch = (
        batch_identity(clean, code_hash, mode)
        .join(clean.groupBy("batch_id").agg(F.min("event_time").alias("earliest"), F.max("seed").alias("seed")), "batch_id")
        .join(accepted, "batch_id", "left_semi")
    )
    tariff = F.lit(TARIFF_PAYLOAD)
    tariff_hash = F.sha2(tariff, 256)
    runs = per_batch.select("batch_id", F.col("run_id").alias("check_run"))
    events = spread_join(clean, runs, ["batch_id"], "event_id").withColumn("run_id", F.col("check_run"))
    return {
        "run_manifest": per_batch.select(
            "run_id",
            F.concat(F.lit(f"generated-mock-v1-{mode}-"), "batch_id").alias("scenario_id"),
            "seed",
            F.sha1(F.lit(code_hash + "healthy-v1")).alias("baseline_sha"),
            F.sha1(F.lit(code_hash + ("amount-error-v1" if mode == "amount_error" else "healthy-v1"))).alias(
                "candidate_sha"
            ),
            tariff_hash.alias("tariff_hash"),
            F.col("earliest").alias("created_at"),
        ),
        "input_session": events.select(
            "run_id", "session_id", F.lit(TARIFF["id"]).alias("tariff_id")
        ).distinct(),
        "events_raw": events.select(
            "run_id",
            "event_id",
            F.col("station").alias("charging_station_id"),
            F.col("session_id").alias("transaction_id"),
            "event_type",
            "sequence_number",
            "event_time",
            F.col("ingested_at").alias("ingest_time"),
            payload_of("canonical").alias("payload"),
            sha256(payload_of("canonical")).alias("payload_hash"),
        ),
        "tariffs_raw": per_batch.select(
            "run_id",
            F.lit(TARIFF["id"]).alias("tariff_id"),
            F.col("earliest").alias("valid_from"),
            F.lit(None).cast("timestamp").alias("valid_to"),
            F.lit(TARIFF["currency"]).alias("currency"),
            tariff.alias("payload"),
            tariff_hash.alias("payload_hash"),
        ),
    }
