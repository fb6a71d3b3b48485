"""Domain inputs derived from the TPC-H-ish test tables.

The recipes only use integer arithmetic and string concatenation, and each is
written once as SQL with a few dialect placeholders, so Spark and DuckDB build the
same rows and byte-identical payloads. Faults are spread over the sessions by
remainders of the order key: they vary the data, and no row is left out by them
except where a missing record is the fault.

`k` is the order key, `c` the customer key.
"""

from __future__ import annotations

FAULT_MODES = {
    # (modulus, remainder): fault of the candidate, first match wins
    "candidate": [
        (11, 3, "amount"), (13, 5, "missing"), (17, 4, "second_id"), (19, 6, "tariff"),
        (23, 7, "energy"), (29, 8, "currency"), (31, 9, "duration"), (37, 2, "retry"),
    ],
    "baseline": [
        (211, 1, "amount"), (223, 3, "conflict"), (227, 4, "precision"), (229, 5, "hash"),
        (233, 6, "credit"), (239, 7, "country"), (241, 8, "cut"), (37, 2, "retry"),
    ],
}


def _fault(role: str) -> str:
    cases = " ".join(f"WHEN k % {m} = {r} THEN '{name}'" for m, r, name in FAULT_MODES[role])
    return f"CASE {cases} ELSE 'none' END"


def dialect(name: str) -> dict[str, str]:
    if name == "spark":
        return {
            "div": "div",
            "plus_minutes": "timestampadd(MINUTE, {n}, {t})",
            "plus_seconds": "timestampadd(SECOND, {n}, {t})",
            "ts": "CAST({t} AS TIMESTAMP)",
            "iso": "date_format({t}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
            "sha256": "sha2({t}, 256)",
            "sha1": "sha1({t})",
            "quote": "chr(34)",
            "backslash": "chr(92)",
            "unnest": "explode(sequence({a}, {b}))",
            "text": "STRING",
        }
    return {
        "div": "//",
        "plus_minutes": "({t} + to_minutes(CAST({n} AS BIGINT)))",
        "plus_seconds": "({t} + to_seconds(CAST({n} AS BIGINT)))",
        "ts": "CAST({t} AS TIMESTAMP)",
        "iso": "strftime({t}, '%Y-%m-%dT%H:%M:%SZ')",
        "sha256": "sha256({t})",
        "sha1": "sha1({t})",
        "quote": "chr(34)",
        "backslash": "chr(92)",
        "unnest": "unnest(generate_series({a}, {b}))",
        "text": "VARCHAR",
    }


def recipes(engine: str) -> dict[str, str]:
    """Name to SELECT text; later recipes name earlier ones as relations."""
    d = dialect(engine)
    div = d["div"]

    def minutes(t, n):
        return d["plus_minutes"].format(t=t, n=n)

    def seconds(t, n):
        return d["plus_seconds"].format(t=t, n=n)

    def ts(text):
        return d["ts"].format(t=f"'{text}'")

    def iso(t):
        return d["iso"].format(t=t)

    def sha(t):
        return d["sha256"].format(t=t)

    def s(expr):
        return f"CAST({expr} AS {d['text']})"

    def numbers(a, b):
        return d["unnest"].format(a=a, b=b)

    def text(expr, width):
        """expr is an integer number of 10^-width units, printed as a plain decimal."""
        unit = 10**width
        return f"{s(f'({expr}) {div} {unit}')} || '.' || lpad({s(f'({expr}) % {unit}')}, {width}, '0')"

    r: dict[str, str] = {}
    r["sess"] = f"""
      SELECT k, c, nk, 'run-' || {s('k % 5')} AS run_id, 'txn-' || {s('k')} AS session_id,
        'tariff-' || {s('c')} AS tariff_id, start_ts, dmin, m0, wh,
        {minutes('start_ts', 'dmin')} AS end_ts,
        20 + nk + CASE WHEN start_ts >= {ts('1998-01-01 00:00:00')} THEN 5 ELSE 0 END AS price_c
      FROM (
        SELECT o_orderkey AS k, o_custkey AS c, c_nationkey AS nk,
          CASE WHEN o_orderkey % 103 = 11 THEN {ts('1997-12-31 23:50:00')}
            ELSE {minutes('CAST(o_orderdate AS TIMESTAMP)', 'o_orderkey % 1440')} END AS start_ts,
          20 + (o_orderkey * 7) % 161 AS dmin,
          10000 + (o_orderkey * 7919) % 990000 AS m0,
          60 * (1 + o_orderkey % 5) * (20 + (o_orderkey * 7) % 161) AS wh
        FROM orders JOIN customer ON c_custkey = o_custkey) x"""

    event_payload = f"""'{{"eventType":"' || event_type || '","timestamp":"' || {iso('event_time')}
        || '","seqNo":' || {s('seq')} || ',"transactionInfo":{{"transactionId":"' || session_id || '"'
        || CASE WHEN seq = 0 THEN '' ELSE ',"timeSpentCharging":' || {s('spent')} END
        || '}},"meterValue":[{{"timestamp":"' || {iso('event_time')}
        || '","sampledValue":[{{"value":' || {s('meter')}
        || ',"measurand":"Energy.Active.Import.Register","location":"Outlet","unitOfMeasure":{{"unit":"Wh","multiplier":0}}}}]}}]}}'"""
    r["meter_events"] = f"""
      SELECT *, CASE seq WHEN 0 THEN 'Started' WHEN 1 THEN 'Updated' ELSE 'Ended' END AS event_type,
        {seconds('start_ts', 'seq * dmin * 30')} AS event_time,
        seq * dmin * 30 AS spent,
        CASE WHEN seq = 2 AND k % 89 = 5 THEN m0 - 10 ELSE m0 + (wh {div} 2) * seq END AS meter
      FROM (SELECT *, {numbers(0, 2)} AS seq FROM sess) x"""
    r["events_raw"] = f"""
      SELECT *, {sha('payload')} AS payload_hash FROM (
        SELECT run_id, 'msg-' || {s('k')} || '-' || {s('seq')} AS event_id, 'cs-' || {s('k')} AS charging_station_id,
          session_id AS transaction_id, event_type, CAST(seq AS BIGINT) AS sequence_number, event_time,
          {seconds('event_time', '1')} AS ingest_time, {event_payload} AS payload
        FROM meter_events WHERE NOT (seq = 2 AND k % 97 = 13)) x"""
    r["input_session"] = "SELECT run_id, session_id, tariff_id FROM sess"

    tariff_payload = f"""'{{"id":"' || tariff_id || '","currency":"EUR","elements":[{{"price_components":[{{"type":"ENERGY","price":'
        || {text('price_c', 2)} || ',"step_size":1}}]}}]}}'"""
    r["tariff_periods"] = f"""
      SELECT c, nk, p, 'run-' || {s('r')} AS run_id, 'tariff-' || {s('c')} AS tariff_id,
        CASE WHEN p = 0 THEN {ts('1990-01-01 00:00:00')} WHEN nk = 23 THEN {ts('1997-06-01 00:00:00')}
          ELSE {ts('1998-01-01 00:00:00')} END AS valid_from,
        CASE WHEN p = 0 THEN {ts('1998-01-01 00:00:00')} END AS valid_to,
        20 + nk + 5 * p AS price_c
      FROM (SELECT c_custkey AS c, c_nationkey AS nk, r, {numbers(0, 1)} AS p
            FROM (SELECT *, {numbers(0, 4)} AS r FROM customer) y) x
      WHERE NOT (nk = 24 AND p = 1)"""
    # One customer in 31 has its first period delivered twice.
    r["tariffs_raw"] = f"""
      SELECT run_id, tariff_id, valid_from, valid_to, 'EUR' AS currency, payload, {sha('payload')} AS payload_hash
      FROM (SELECT *, {tariff_payload} AS payload FROM (
        SELECT * FROM tariff_periods
        UNION ALL SELECT * FROM tariff_periods WHERE c % 31 = 5 AND p = 0) y) x"""
    # Sessions as periods of a few tariffs, one of which has nine tenths of them; some never end.
    r["layered"] = f"""
      SELECT k, 'run-0' AS run_id, CASE WHEN c % 10 = 0 THEN tariff_id ELSE 'tariff-hot' END AS tariff_id, start_ts AS valid_from,
        CASE WHEN k % 49999 <> 1 THEN end_ts END AS valid_to, 'EUR' AS currency, {s('k')} AS payload, {sha(s('k'))} AS payload_hash
      FROM sess"""
    # Contract faults, each in its own group of customers.
    r["tariffs_faulty"] = f"""
      SELECT run_id, tariff_id, valid_from,
        CASE WHEN c % 29 = 1 THEN valid_from ELSE valid_to END AS valid_to,
        CASE WHEN c % 29 = 2 THEN 'USD' ELSE currency END AS currency, payload,
        CASE WHEN c % 29 = 3 THEN 'x' || {sha('payload')} ELSE {sha('payload')} END AS payload_hash
      FROM (SELECT c, run_id, tariff_id, valid_from, valid_to, 'EUR' AS currency,
        CASE c % 29
          WHEN 4 THEN replace(payload, 'ENERGY', 'TIME')
          WHEN 5 THEN replace(payload, '"price":', '"price":-')
          WHEN 6 THEN replace(payload, '"step_size":1', '"step_size":60')
          WHEN 7 THEN replace(payload, '"step_size":1', '"step_size":1,"vat":20')
          WHEN 8 THEN replace(payload, '"elements":', '"max_price":9,"elements":')
          WHEN 9 THEN replace(payload, '"elements":', '"start_date_time":"1990-01-01T00:00:00Z","elements":')
          WHEN 10 THEN replace(payload, '"price_components"', '"restrictions":{{"day_of_week":["MONDAY"]}},"price_components"')
          WHEN 11 THEN replace(payload, '}}]}}]}}', '}},{{"type":"FLAT","price":1,"step_size":1}}]}}]}}')
          WHEN 12 THEN replace(payload, '"id":"tariff', '"id":"other')
          WHEN 13 THEN replace(payload, '}}', '')
          ELSE payload END AS payload
        FROM (SELECT *, {tariff_payload} AS payload FROM tariff_periods) y) x"""

    r["bills"] = f"""
      SELECT *, (wh * price_c + 500) {div} 1000 AS cents, (dmin * 2000000 + 60) {div} 120 AS dmic,
        CASE WHEN release_role = 'baseline' THEN {_fault('baseline')} ELSE {_fault('candidate')} END AS fault
      FROM (SELECT *, 'baseline' AS release_role FROM sess UNION ALL SELECT *, 'candidate' AS release_role FROM sess) x"""
    # copy 1 is the extra record of the faults that send two.
    r["bill_copies"] = """
      SELECT *, 0 AS copy FROM bills WHERE fault <> 'missing'
      UNION ALL SELECT *, 1 AS copy FROM bills WHERE fault IN ('second_id', 'retry', 'conflict')"""
    r["responses"] = f"""
      SELECT k, run_id, release_role, fault, {seconds('end_ts', '2')} AS ingest_time,
        '{{' || CASE WHEN fault = 'retry' AND copy = 1 THEN ' ' ELSE '' END || '"country_code":"'
        || CASE WHEN fault = 'country' THEN 'FRA' ELSE 'FR' END || '","party_id":"CAS","id":"'
        || CASE WHEN fault = 'retry' AND copy = 1 THEN 'CDR-' ELSE 'cdr-' END || {s('k')}
        || CASE WHEN fault = 'second_id' AND copy = 1 THEN '-b' ELSE '' END
        || '","session_id":"' || session_id || '","start_date_time":"' || {iso('start_ts')}
        || '","end_date_time":"' || {iso('end_ts')} || '","currency":"'
        || CASE WHEN fault = 'currency' THEN 'USD' ELSE 'EUR' END
        || '","charging_periods":[{{"tariff_id":"' || tariff_id || CASE WHEN fault = 'tariff' THEN '-x' ELSE '' END
        || '"}}],"total_cost":{{"excl_vat":'
        || {text("cents + CASE WHEN fault = 'amount' THEN 87 WHEN fault = 'conflict' THEN 100 * copy ELSE 0 END", 2)}
        || CASE WHEN fault = 'precision' THEN '00001' ELSE '' END || '}},"total_energy":'
        || {text("wh + CASE WHEN fault = 'energy' THEN 1 ELSE 0 END", 3)}
        || ',"total_time":' || {text("dmic + CASE WHEN fault = 'duration' THEN 1 ELSE 0 END", 6)}
        || ',"credit":' || CASE WHEN fault = 'credit' THEN 'true' ELSE 'false' END
        || CASE WHEN fault = 'cut' THEN '' ELSE '}}' END AS payload
      FROM bill_copies"""
    r["cdrs_raw"] = f"""
      SELECT run_id, release_role,
        CASE WHEN fault = 'cut' THEN NULL WHEN fault = 'country' THEN 'FRA' ELSE 'FR' END AS country_code,
        CASE WHEN fault = 'cut' THEN NULL ELSE 'CAS' END AS party_id,
        payload, ingest_time,
        CASE WHEN fault = 'hash' THEN 'x' || {sha('payload')} ELSE {sha('payload')} END AS payload_hash
      FROM responses"""
    r["run_manifest"] = f"""
      SELECT run_id, 'derived-v1' AS scenario_id, CAST(42 AS BIGINT) AS seed, {d['sha1'].format(t="'baseline'")} AS baseline_sha,
        {d['sha1'].format(t="'candidate'")} AS candidate_sha, {sha("'tariffs-' || run_id")} AS tariff_hash,
        min(start_ts) AS created_at
      FROM sess GROUP BY run_id
      UNION ALL
      SELECT run_id, 'derived-v2', CAST(43 AS BIGINT), 'b', 'c', 't', min(start_ts) FROM sess WHERE run_id = 'run-3' GROUP BY run_id"""
    # Damage to check results, by session: dropped, doubled, moved to an unknown release, odd status.
    r["damage"] = """
      SELECT run_id, session_id, CASE WHEN k % 41 = 1 THEN 'drop' WHEN k % 43 = 2 THEN 'double'
        WHEN k % 47 = 3 THEN 'shadow' WHEN k % 53 = 4 THEN 'odd' ELSE 'none' END AS kind
      FROM sess"""

    # Landed event lines of seven batches; a batch declares its own number of sessions. Faults are
    # told by `f`, which is 0, hence none, in two of the batches.
    r["batch_sizes"] = "SELECT o_orderkey % 7 AS b, count(*) AS n FROM orders GROUP BY o_orderkey % 7"
    r["batch_events"] = f"""
      SELECT k, f, seq, dmin, batch_id, n, 'txn-' || ident AS session_id, ident, event_type, event_time,
        spent + CASE WHEN f % 167 = 10 AND seq = 2 THEN 1 ELSE 0 END AS spent,
        CASE WHEN f % 173 = 11 AND seq = 1 THEN m0 - 5 ELSE m0 + (wh {div} 2) * seq END AS meter
      FROM (SELECT *, 'b' || {s('k % 7')} AS batch_id, CASE WHEN k % 7 < 5 THEN k ELSE 0 END AS f,
          substr({sha("'sessions-v1:b' || " + s('k % 7') + " || ':' || " + s(f'k {div} 7'))}, 1, 24) AS ident
        FROM meter_events JOIN batch_sizes ON b = k % 7 WHERE NOT (k % 7 < 5 AND k % 149 = 3 AND seq = 2)) x"""
    # copy 0 is the first delivery; re-delivered (of even keys in the same file) and contradicting events arrive once more.
    r["batch_copies"] = """
      SELECT *, 0 AS copy FROM batch_events
      UNION ALL SELECT *, 1 AS copy FROM batch_events WHERE k % 53 = 7 OR (f % 101 = 9 AND seq = 1)"""
    escaped = f"replace(payload, {d['quote']}, {d['backslash']} || {d['quote']})"
    # Each rule of an event's body is broken by one group.
    faults = "".join(
        f" WHEN {i} THEN replace(whole, '{old}', '{new}')"
        for i, (old, new) in enumerate(
            [
                ('"seqNo":1', '"seqNo":"1"'), ('"eventType":"Ended"', '"eventType":"Updated"'), ('"timestamp":"', '"timestamp":"x'),
                ('Z","seqNo"', '","seqNo"'), ('Z","sampledValue"', '.5Z","sampledValue"'), ('"value":', '"value":-'),
                (',"measurand"', '.0,"measurand"'), ('"location":"Outlet"', '"location":"Inlet"'), ('"multiplier":0', '"multiplier":"0"'),
                ('}}]}]}', '}},{}]}]}'), ('"timeSpentCharging":', '"timeSpentCharging":-'), ('"eventType"', 'eventType'),
                ('"transactionId":"txn', '"transactionId":"trn'), ('"eventType"', '"seqNo":9,"eventType"'), ('}]}', '}]}]}'),
            ],
            start=20,
        )
    )
    r["landing"] = f"""
      SELECT raw_record, CASE WHEN f % 151 = 5 AND seq = 1 THEN 'x' || {sha('raw_record')} ELSE {sha('raw_record')} END AS record_hash,
        '/in/' || file_name AS source_file_path, file_name AS source_file_name,
        {ts('2026-01-01 00:00:00')} AS source_file_modification_time, ingested_at
      FROM (SELECT k, f, seq, 'events-' || batch_id || '-' || CASE WHEN k % 2 = 0 THEN '0' ELSE {s('copy')} END || '.jsonl' AS file_name,
          {seconds('event_time', '60 + 3600 * copy')} AS ingested_at,
          '{{"schema_version":' || CASE WHEN f % 163 = 9 THEN '2' WHEN f % 199 = 16 THEN '"1"' ELSE '1' END
          || ',"run_id":"' || CASE WHEN f % 191 = 14 THEN 'other' ELSE 'generated-v1-' || batch_id END
          || '","event_id":"msg-' || ident || '-' || lower(event_type)
          || '","charging_station_id":"' || CASE WHEN f % 199 = 19 THEN 'no-' ELSE 'cs-' END || ident || '","payload":"' || {escaped}
          || '","generator":{{"version":"sessions-v1","batch_id":"' || batch_id || '","session_count":' || CASE WHEN f % 199 = 17 THEN {d['quote']} || {s('n')} || {d['quote']} ELSE {s('n')} END
          || ',"seed":' || CASE WHEN f % 193 = 15 THEN '43' ELSE '42' END
          || ',"tariff":{{"id":"generated-energy-v1","currency":"EUR","price_per_kwh":"0.45"}}' || CASE WHEN f % 199 = 18 THEN ',"note":1' ELSE '' END || '}}'
          || CASE WHEN f % 157 = 8 THEN ',"cdr_id":"c"' ELSE '' END
          || CASE WHEN f % 179 = 12 THEN '' ELSE '}}' END AS raw_record
        FROM (SELECT *, CASE f % 199{faults} ELSE whole END AS payload
          FROM (SELECT *, {event_payload.replace("|| " + s('meter'), "|| " + s("meter + CASE WHEN copy = 1 AND f % 101 = 9 THEN 1 ELSE 0 END"))} AS whole
            FROM batch_copies) z) y) x"""

    # One evaluation attempt per customer, with the frozen results of the customer's sessions.
    r["attempts"] = f"""
      SELECT c_custkey AS c, {s('1 + c_custkey % 3')} || ':' || {s('c_custkey')} || ':0' AS execution_id,
        'b' || {s('c_custkey')} AS batch_id, 'exec-run-' || {s('c_custkey')} AS run_id,
        {minutes(ts('2026-01-01 00:00:00'), 'c_custkey')} AS started_at
      FROM customer"""
    r["receipts"] = f"""
      SELECT execution_id, batch_id, CASE WHEN c % 2 = 0 THEN 'healthy' ELSE 'amount_error' END AS candidate_mode,
        'code' AS pipeline_hash, CASE WHEN c % 7 = 1 THEN 'FAILED' WHEN c % 11 = 2 THEN 'RUNNING' ELSE 'SUCCEEDED' END AS status,
        CASE WHEN c % 7 = 1 THEN 'ValueError: damaged input' WHEN c % 11 = 2 THEN 'Validating generated inputs.' ELSE 'Captured.' END AS reason,
        run_id, started_at, CASE WHEN c % 11 = 2 THEN NULL ELSE {minutes('started_at', '5')} END AS finished_at
      FROM (SELECT * FROM attempts WHERE c % 17 <> 4 UNION ALL SELECT * FROM attempts WHERE c % 13 = 3 AND c % 17 <> 4) x"""
    names = "'oracle_available', 'final_cdr_count', 'energy_match', 'duration_match', 'currency_match', 'tariff_match', 'amount_match'"
    rule_names = names.split(", ")
    by_number = " ".join(f"WHEN {i} THEN {name}" for i, name in enumerate(rule_names))
    r["whole_frozen"] = f"""
      SELECT c, k, '1' AS one, {s('1 + c % 3')} || ':' || {s('c')} || ':0' AS execution_id, 'exec-run-' || {s('c')} AS run_id,
        session_id, release_role, CASE i {by_number} END AS assertion_id, cents,
        CASE WHEN fault = 'missing' AND i > 1 THEN 'BLOCKED' WHEN fault = 'missing' AND i = 1 THEN 'FAIL'
          WHEN fault = 'amount' AND i = 6 THEN 'FAIL' ELSE 'PASS' END AS status,
        CASE WHEN i = 4 THEN 'EUR' WHEN i = 6 THEN {text('cents', 2)} || '0000' END AS expected_value,
        CASE WHEN fault = 'missing' THEN NULL WHEN i = 4 THEN 'EUR'
          WHEN i = 6 THEN {text("cents + CASE WHEN fault = 'amount' THEN 87 ELSE 0 END", 2)} || '0000' END AS actual_value,
        CASE WHEN fault = 'missing' OR i <> 6 THEN NULL WHEN fault = 'amount' THEN CAST('0.870000' AS DECIMAL(38,6))
          ELSE CAST('0.000000' AS DECIMAL(38,6)) END AS difference
      FROM (SELECT *, {numbers(0, 6)} AS i FROM bills) x"""
    # Some results were lost, doubled, renamed or moved to another run after capture.
    columns = "execution_id, session_id, release_role, assertion_id, status, expected_value, actual_value, difference"
    r["frozen"] = f"""
      SELECT {columns}, CASE WHEN c % 47 = 11 THEN 'elsewhere' ELSE run_id END AS run_id FROM whole_frozen
      WHERE NOT (k % 61 = 5 AND assertion_id = 'tariff_match')
      UNION ALL SELECT {columns}, run_id FROM whole_frozen WHERE k % 67 = 6 AND assertion_id = 'energy_match'
      UNION ALL SELECT execution_id, session_id, release_role, 'new_rule', status, expected_value, actual_value, difference, run_id
        FROM whole_frozen WHERE k % 71 = 7 AND assertion_id = 'energy_match'"""
    r["whole_snapshots"] = """
      SELECT c, execution_id, run_id, count(DISTINCT session_id) AS session_count, count(*) AS required_assertions,
        sum(CASE WHEN status = 'PASS' THEN 1 ELSE 0 END) AS passed_assertions,
        sum(CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END) AS failed_assertions,
        sum(CASE WHEN status = 'BLOCKED' THEN 1 ELSE 0 END) AS blocked_assertions,
        min(CASE WHEN release_role = 'candidate' OR status = 'PASS' THEN 'PASS' ELSE 'FAIL' END) AS baseline_verdict,
        min(CASE WHEN release_role = 'baseline' OR status = 'PASS' THEN 'PASS' ELSE 'FAIL' END) AS candidate_verdict,
        min(CASE WHEN status = 'PASS' THEN 'PASS' ELSE 'FAIL' END) AS verdict
      FROM whole_frozen GROUP BY c, execution_id, run_id"""
    r["batch_snapshots"] = f"""
      SELECT execution_id, run_id, 'input' AS input_hash, CASE WHEN c % 19 = 5 THEN 'older' ELSE 'code' END AS pipeline_hash,
        CAST(session_count AS BIGINT) AS session_count, CAST(14 * session_count AS BIGINT) AS assertion_count,
        baseline_verdict, candidate_verdict, CASE WHEN c % 31 = 8 THEN 'PASS' ELSE verdict END AS verdict,
        CAST(required_assertions AS BIGINT) AS required_assertions, CAST(passed_assertions AS BIGINT) AS passed_assertions,
        CAST(failed_assertions AS BIGINT) AS failed_assertions, CAST(blocked_assertions AS BIGINT) AS blocked_assertions,
        CAST(CASE WHEN c % 37 = 9 THEN 1 ELSE 0 END AS BIGINT) AS missing_assertions, CAST(0 AS BIGINT) AS duplicate_assertion_keys,
        CAST(0 AS BIGINT) AS unexpected_assertions, CAST(0 AS BIGINT) AS invalid_assertions,
        'Snapshot of ' || run_id AS reason,
        {minutes(ts('2026-01-01 00:00:00'), 'c + CASE WHEN c % 43 = 10 THEN -60 ELSE 3 END')} AS evaluated_at,
        {minutes(ts('2026-01-01 00:00:00'), 'c + 4')} AS captured_at
      FROM (SELECT * FROM whole_snapshots WHERE c % 29 <> 7
        UNION ALL SELECT * FROM whole_snapshots WHERE c % 23 = 6 AND c % 29 <> 7) x"""
    r["task_states"] = f"""
      SELECT execution_id, 'task-' || {s('t')} AS task_key, CASE WHEN c % 41 = 3 AND t = 2 THEN 'failed' ELSE 'success' END AS state
      FROM (SELECT *, {numbers(1, 4)} AS t FROM attempts) x WHERE NOT (c % 53 = 4 AND t = 3)"""
    # The log of the attempts: told twice, told again with other contents, repairs, failures before
    # and after a success, a finish that nobody began.
    null = f"CAST(NULL AS {d['text']})"

    def told(phase, status, reason, after, where, listed="run_id"):
        begun = phase == "begin"
        contents = [
            (s("1 + c % 3"), "job_id"), (s("c"), "job_run_id"), ("CASE WHEN c % 19 = 6 THEN 1 ELSE 0 END", "repair_count"),
            (f"'[' || {d['quote']} || {listed} || {d['quote']} || ']'", "expected_run_ids_json"),
        ]
        fields = ", ".join(f"CAST({value if begun else 'NULL'} AS {'INT' if name == 'repair_count' else d['text']}) AS {name}" for value, name in contents)
        states = null if begun else f"'after ' || {s(after)}"
        return f"""SELECT execution_id, '{phase}' AS phase, {minutes('started_at', after)} AS event_at, {status} AS status,
          '{reason}' AS reason, {fields}, {states} AS task_states_json FROM attempts WHERE {where}"""

    born = "CASE WHEN c % 19 = 6 THEN 'FAILED' ELSE 'RUNNING' END"
    r["attempt_log"] = " UNION ALL ".join([
        told("begin", born, "registered", 0, "c % 17 <> 4"),
        told("begin", born, "registered again", 1, "c % 17 <> 4 AND c % 13 = 3"),
        told("begin", born, "registered otherwise", 2, "c % 17 <> 4 AND c % 29 = 8", "'other-' || run_id"),
        told("capture", "'RUNNING'", "captured", 3, "c % 5 <> 0"),
        told("finish", "'FAILED'", "a task failed", 4, "c % 7 = 1"),
        told("finish", "'SUCCEEDED'", "complete", 5, "c % 11 <> 2"),
        told("finish", "'SUCCEEDED'", "complete", 6, "c % 31 = 9"),
        told("finish", "'FAILED'", "changed evidence", 9, "c % 23 = 8"),
    ])
    # Frozen rows after capture: changed, lost, added, all gone or moved to another run.
    mark = "CAST(split_part(execution_id, ':', 2) AS INT) % 6"
    kept = "execution_id, session_id, release_role, assertion_id, status"
    r["tampered"] = f"""
      SELECT {kept}, CASE WHEN {mark} = 1 AND assertion_id = 'amount_match' THEN expected_value || '1' ELSE expected_value END AS expected_value,
        actual_value, difference, CASE WHEN {mark} = 5 THEN 'moved' ELSE run_id END AS run_id FROM frozen
      WHERE NOT ({mark} = 2 AND assertion_id = 'energy_match' AND release_role = 'baseline') AND {mark} <> 4
      UNION ALL SELECT {kept}, expected_value, actual_value, difference, run_id FROM frozen WHERE {mark} = 3 AND assertion_id = 'duration_match'"""
    r["requested"] = "SELECT execution_id, run_id, execution_id AS selector FROM attempts"
    return {name: body.strip() for name, body in r.items()}
