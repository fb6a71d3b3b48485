"""DuckDB counterparts of the queries, written from the operators' definitions.

All share one prefix of CTEs: the input recipes and the tables of the chain.
"""

from __future__ import annotations

import re

from meterproof.operators import assertions as a, attempts as at, evidence as e, reports as r, verdict as v
from meterproof.schemas import RULES
from testkit.recipes import recipes

_RULE_LIST = "['" + "', '".join(RULES) + "']"
_BIG = "CAST({} AS BIGINT)"


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def us(name: str) -> str:
    return f"epoch_us({name}) AS {name}_us"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def set_digest(members: str, digest: str, having: str = "TRUE") -> str:
    """Digest of a set: its size and the sums of the four 60-bit words of its members' SHA-256."""
    word = "coalesce(sum(CAST(('0x' || substr({}, {}, 15)) AS BIGINT)) FILTER ({}), 0)"
    sums = " || ':' || ".join(f"CAST(CAST({word.format(digest, 1 + 15 * i, having)} AS HUGEINT) AS VARCHAR)" for i in range(4))
    return f"sha256(CAST({members} AS VARCHAR) || ':' || {sums})"


_DOMAIN: dict[str, str] = {}
_DOMAIN["lifecycle"] = """
  SELECT run_id, session_id, min(t) FILTER (kind = 'Started') AS started_at, max(t) FILTER (kind = 'Ended') AS ended_at,
    arg_min(wh, t) FILTER (kind = 'Started') AS meter_start_wh, arg_max(wh, t) FILTER (kind = 'Ended') AS meter_end_wh,
    CASE WHEN count(*) FILTER (kind = 'Ended') > 0 THEN 'Completed' ELSE 'In Progress' END AS status
  FROM (SELECT run_id, transaction_id AS session_id, event_type AS kind, event_time AS t,
      CAST(json_extract_string(payload, '$.meterValue[0].sampledValue[0].value') AS BIGINT) AS wh FROM events_raw)
  GROUP BY ALL"""
_DOMAIN["history"] = """
  SELECT DISTINCT run_id, tariff_id, valid_from, valid_to, currency,
    CAST(json_extract_string(payload, '$.elements[0].price_components[0].price') AS DECIMAL(18,6)) AS price,
    payload_hash AS source_payload_hash FROM tariffs_raw"""
_DOMAIN["pre"] = """
  SELECT m.run_id, m.session_id, count(DISTINCT s.session_id) AS session_rows,
    count(DISTINCT s.session_id) FILTER (s.status = 'Completed' AND s.ended_at >= s.started_at AND s.meter_start_wh >= 0
      AND s.meter_end_wh >= s.meter_start_wh) AS valid_session_rows,
    count(t.tariff_id) AS tariff_rows,
    count(t.tariff_id) FILTER (t.valid_to IS NULL OR s.ended_at <= t.valid_to) AS valid_tariff_rows,
    any_value(t.tariff_id) AS tariff_id, max(t.valid_from) AS valid_from, any_value(t.source_payload_hash) AS hash,
    max(t.price) AS price, max(s.meter_end_wh - s.meter_start_wh) AS wh
  FROM input_session m LEFT JOIN lifecycle s USING (run_id, session_id)
    LEFT JOIN history t ON t.run_id = m.run_id AND t.tariff_id = m.tariff_id AND s.started_at >= t.valid_from
      AND (t.valid_to IS NULL OR s.started_at < t.valid_to)
  GROUP BY m.run_id, m.session_id"""
_DOMAIN["registry_twice"] = """
  SELECT run_id, session_id, tariff_id FROM input_session
  UNION ALL SELECT run_id, session_id, 'unknown' FROM input_session WHERE CAST(substr(session_id, 5) AS BIGINT) % 61 = 1"""
_DOMAIN["pre_twice"] = _DOMAIN["pre"].replace("FROM input_session m", "FROM registry_twice m")
_DOMAIN["expected"] = """
  SELECT run_id, session_id, tariff_id, valid_from AS tariff_valid_from, hash AS tariff_payload_hash, 'EUR' AS currency,
    CAST(wh * 0.001 AS DECIMAL(18,6)) AS expected_energy_kwh, price AS price_per_kwh,
    CAST(CAST(wh * 0.001 AS DECIMAL(18,6)) * price AS DECIMAL(37,12)) AS expected_amount_unrounded,
    CAST(((wh * CAST(price * 100 AS BIGINT) + 500) // 1000) * 0.01 AS DECIMAL(18,2)) AS expected_amount
  FROM pre WHERE session_rows = 1 AND valid_session_rows = 1 AND tariff_rows = 1 AND valid_tariff_rows = 1"""
_DOMAIN["read_cdrs"] = """
  SELECT run_id, release_role, payload_hash, payload_hash = sha256(payload) AS intact, doc IS NOT NULL AS parsed,
    doc->>'$.country_code' AS country, doc->>'$.party_id' AS party, doc->>'$.id' AS id, doc->>'$.session_id' AS session_id,
    CAST(replace(replace(doc->>'$.start_date_time', 'T', ' '), 'Z', '') AS TIMESTAMP) AS started_at,
    CAST(replace(replace(doc->>'$.end_date_time', 'T', ' '), 'Z', '') AS TIMESTAMP) AS ended_at,
    doc->>'$.currency' AS currency, doc->>'$.credit' AS credit, doc->>'$.charging_periods[0].tariff_id' AS tariff,
    CASE WHEN parsed THEN regexp_extract(payload, '"total_energy":([^,}]+)', 1) END AS energy,
    CASE WHEN parsed THEN regexp_extract(payload, '"total_time":([^,}]+)', 1) END AS duration,
    CASE WHEN parsed THEN regexp_extract(payload, '"excl_vat":([^,}]+)', 1) END AS amount
  FROM (SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS doc FROM cdrs_raw)"""
_CDR_RULES = {
    "malformed_document": "parsed",
    "hash_mismatch": "intact",
    "invalid_country": "regexp_full_match(country, '[A-Za-z]{2}')",
    "invalid_party": "regexp_full_match(party, '[A-Za-z0-9]{3}')",
    "invalid_id": "length(id) BETWEEN 1 AND 36",
    "invalid_session": "length(session_id) BETWEEN 1 AND 36",
    "invalid_times": "ended_at >= started_at",
    "invalid_currency": "regexp_full_match(currency, '[A-Z]{3}')",
    "invalid_energy": r"regexp_full_match(energy, '[0-9]+([.][0-9]{1,6})?')",
    "invalid_duration": r"regexp_full_match(duration, '[0-9]+([.][0-9]{1,6})?')",
    "invalid_amount": r"regexp_full_match(amount, '[0-9]+([.][0-9]{1,6})?')",
    "credit_record": "credit = 'false' OR credit IS NULL",
    "not_one_period": "tariff IS NOT NULL",
    "invalid_tariff": "length(tariff) BETWEEN 1 AND 36",
}


def reasons(rules: dict[str, str]) -> str:
    parts = ", ".join(f"CASE WHEN coalesce({rule}, FALSE) THEN NULL ELSE '{code}' END" for code, rule in rules.items())
    return f"list_filter([{parts}], lambda x: x IS NOT NULL)"


_DOMAIN["checked_cdrs"] = f"SELECT *, {reasons(_CDR_RULES)} AS reasons FROM read_cdrs"
_DOMAIN["norm"] = """
  SELECT run_id, release_role, upper(country) AS country_code, upper(party) AS party_id, lower(id) AS cdr_id, session_id,
    started_at, ended_at, currency, CAST(energy AS DECIMAL(18,6)) AS actual_energy_kwh,
    CAST(duration AS DECIMAL(18,6)) AS actual_duration_hours, CAST(amount AS DECIMAL(18,6)) AS actual_amount,
    lower(tariff) AS tariff_id, payload_hash
  FROM checked_cdrs WHERE len(reasons) = 0"""
_DOMAIN["variants"] = """
  SELECT *, count(*) OVER (PARTITION BY run_id, release_role, country_code, party_id, cdr_id) AS versions
  FROM (SELECT * EXCLUDE (payload_hash, h), count(*) AS source_payloads, """ + set_digest("count(*)", "h") + """ AS source_digest
    FROM (SELECT DISTINCT *, sha256(payload_hash) AS h FROM norm) GROUP BY ALL)"""
_DOMAIN["actual"] = "SELECT * EXCLUDE (versions), 'FINAL' AS cdr_type FROM variants WHERE versions = 1"
_DOMAIN["conflicts"] = "SELECT DISTINCT run_id, release_role, country_code, party_id, cdr_id FROM variants WHERE versions > 1"
_DOMAIN["grid"] = """
  SELECT run_id, session_id, role AS release_role FROM (
    SELECT run_id, session_id FROM expected UNION SELECT run_id, session_id FROM lifecycle WHERE status = 'Completed')
    CROSS JOIN (VALUES ('baseline'), ('candidate')) roles(role)
  UNION SELECT run_id, session_id, release_role FROM actual WHERE release_role IN ('baseline', 'candidate')"""
_DOMAIN["digested"] = """
  SELECT *, sha256(concat_ws('|', country_code, party_id, cdr_id, CAST(actual_energy_kwh AS VARCHAR), CAST(actual_duration_hours AS VARCHAR),
    CAST(actual_amount AS VARCHAR), currency, tariff_id, source_digest)) AS h FROM actual"""
_DOMAIN["cmp"] = """
  SELECT g.run_id, g.session_id, g.release_role,
    coalesce(x.session_id IS NOT NULL AND s.status = 'Completed' AND s.ended_at >= s.started_at, FALSE) AS oracle,
    coalesce(n, 0) AS n, coalesce(dg, sha256('0:0:0:0:0')) AS dg, x.expected_energy_kwh AS xe, x.expected_amount AS xa, x.currency AS xc, lower(x.tariff_id) AS xt,
    CAST(((epoch_us(s.ended_at) - epoch_us(s.started_at) + 1800) // 3600) * 0.000001 AS DECIMAL(18,6)) AS xd, ae, ad, aa, ac, art
  FROM grid g LEFT JOIN expected x USING (run_id, session_id) LEFT JOIN lifecycle s USING (run_id, session_id)
    LEFT JOIN (SELECT run_id, session_id, release_role, count(*) AS n, max(actual_energy_kwh) AS ae, max(actual_duration_hours) AS ad,
        max(actual_amount) AS aa, max(currency) AS ac, max(tariff_id) AS art, """ + set_digest("count(*)", "h") + """ AS dg FROM digested GROUP BY ALL) r
      USING (run_id, session_id, release_role)"""
_WIDE = "CAST({} AS DECIMAL(26,6))"
_DOMAIN["asserted"] = f"""
  SELECT run_id, release_role, session_id, assertion_id, n AS evidence_cdrs, dg AS evidence_digest,
    CASE WHEN assertion_id = 'oracle_available' THEN 'AVAILABLE' WHEN NOT oracle THEN NULL
      WHEN assertion_id = 'currency_match' THEN xc WHEN assertion_id = 'tariff_match' THEN xt ELSE CAST(xn AS VARCHAR) END AS expected_value,
    CASE WHEN assertion_id = 'oracle_available' THEN CASE WHEN oracle THEN 'AVAILABLE' ELSE 'UNAVAILABLE' END
      WHEN assertion_id = 'final_cdr_count' THEN CAST(an AS VARCHAR) WHEN n <> 1 THEN NULL
      WHEN assertion_id = 'currency_match' THEN ac WHEN assertion_id = 'tariff_match' THEN art ELSE CAST(an AS VARCHAR) END AS actual_value,
    CASE WHEN able THEN CAST(an - xn AS DECIMAL(38,6)) END AS difference,
    CASE WHEN NOT able THEN 'BLOCKED' WHEN coalesce(CASE assertion_id WHEN 'oracle_available' THEN oracle
      WHEN 'currency_match' THEN ac = xc WHEN 'tariff_match' THEN art = xt ELSE an = xn END, FALSE) THEN 'PASS' ELSE 'FAIL' END AS status,
    'ERROR' AS severity,
    CASE WHEN assertion_id <> 'oracle_available' AND NOT oracle THEN {q(a.NO_ORACLE)}
      WHEN assertion_id NOT IN ('oracle_available', 'final_cdr_count') AND n <> 1 THEN {q(a.NOT_ONE_CDR)}
      WHEN assertion_id = 'amount_match' AND ac <> xc THEN {q(a.OTHER_CURRENCY)}
      WHEN assertion_id = 'final_cdr_count' AND n = 0 THEN {q(a.MISSING_CDR)}
      WHEN assertion_id = 'final_cdr_count' AND n > 1 THEN {q(a.DUPLICATE_CDR)}
      ELSE CASE assertion_id {' '.join(f'WHEN {q(k)} THEN {q(t)}' for k, t in a.DESCRIPTIONS.items())} END END AS message
  FROM (SELECT *, CASE assertion_id WHEN 'oracle_available' THEN TRUE WHEN 'final_cdr_count' THEN oracle
        WHEN 'amount_match' THEN oracle AND n = 1 AND coalesce(ac = xc, TRUE) ELSE oracle AND n = 1 END AS able,
      CASE WHEN oracle THEN CASE assertion_id WHEN 'final_cdr_count' THEN {_WIDE.format(1)} WHEN 'energy_match' THEN {_WIDE.format('xe')}
        WHEN 'duration_match' THEN {_WIDE.format('xd')} WHEN 'amount_match' THEN {_WIDE.format('xa')} END END AS xn,
      CASE WHEN assertion_id = 'final_cdr_count' THEN {_WIDE.format('n')} WHEN n = 1 THEN CASE assertion_id
        WHEN 'energy_match' THEN {_WIDE.format('ae')} WHEN 'duration_match' THEN {_WIDE.format('ad')}
        WHEN 'amount_match' THEN {_WIDE.format('aa')} END END AS an
    FROM cmp CROSS JOIN (SELECT unnest({_RULE_LIST}) AS assertion_id))"""
_DOMAIN["damaged"] = """
  SELECT a.run_id, CASE WHEN kind = 'shadow' THEN 'shadow' ELSE release_role END AS release_role, session_id, assertion_id,
    CASE WHEN kind = 'odd' AND assertion_id = 'duration_match' THEN 'ODD' ELSE status END AS status
  FROM asserted a JOIN damage USING (run_id, session_id)
    CROSS JOIN (VALUES (1), (2)) copies(i)
  WHERE NOT (kind = 'drop' AND assertion_id = 'tariff_match') AND (i = 1 OR (kind = 'double' AND assertion_id = 'energy_match'))"""
_DOMAIN["required"] = f"SELECT run_id, release_role, session_id, unnest({_RULE_LIST}) AS assertion_id FROM grid"
_DOMAIN["seen"] = """
  SELECT run_id, release_role, session_id, assertion_id, count(*) AS n, count(*) FILTER (status = 'PASS') AS p,
    count(*) FILTER (status = 'FAIL') AS f, count(*) FILTER (status = 'BLOCKED') AS b,
    count(*) FILTER (status NOT IN ('PASS', 'FAIL', 'BLOCKED')) AS i FROM damaged GROUP BY ALL"""
_DOMAIN["checks_both"] = """
  SELECT run_id, release_role, session_id, assertion_id, r.k IS NOT NULL AS req, coalesce(n, 0) AS n, coalesce(p, 0) AS p,
    coalesce(f, 0) AS f, coalesce(b, 0) AS b, coalesce(i, 0) AS i
  FROM (SELECT *, 1 AS k FROM required) r FULL JOIN seen USING (run_id, release_role, session_id, assertion_id)"""
_SUMS = """sum(req::INT) AS required_assertions, sum(p) AS passed_assertions, sum(f) AS failed_assertions, sum(b) AS blocked_assertions,
    count(*) FILTER (req AND n = 0) AS missing_assertions, count(*) FILTER (n > 1) AS duplicate_assertion_keys,
    coalesce(sum(n) FILTER (NOT req), 0) AS unexpected_assertions, sum(i) AS invalid_assertions"""
_NAMES = [
    "required_assertions", "passed_assertions", "failed_assertions", "blocked_assertions", "missing_assertions",
    "duplicate_assertion_keys", "unexpected_assertions", "invalid_assertions",
]
_DOMAIN["manifests"] = "SELECT run_id, count(*) AS manifest_rows FROM run_manifest GROUP BY run_id"
_DOMAIN["counted"] = f"""
  SELECT run_id, release_role, coalesce(manifest_rows, 0) AS manifest_rows, {', '.join(f'coalesce({n}, 0) AS {n}' for n in _NAMES)}
  FROM (SELECT DISTINCT run_id FROM checks_both) CROSS JOIN (VALUES ('baseline'), ('candidate')) roles(release_role)
    LEFT JOIN manifests USING (run_id) LEFT JOIN (SELECT run_id, release_role, {_SUMS} FROM checks_both GROUP BY ALL) USING (run_id, release_role)"""
_DOMAIN["decided"] = f"""
  SELECT *, CASE WHEN manifest_rows = 1 AND required_assertions > 0 AND passed_assertions = required_assertions
    AND failed_assertions + blocked_assertions + missing_assertions + duplicate_assertion_keys + unexpected_assertions
      + invalid_assertions = 0 THEN 'PASS' ELSE 'FAIL' END AS release_verdict FROM counted"""
_DOMAIN["problems"] = """
  SELECT DISTINCT run_id, 1 AS priority, 'MANIFEST_COUNT' AS problem_type, NULL AS release_role, NULL AS session_id, NULL AS assertion_id
    FROM counted WHERE manifest_rows <> 1
  UNION ALL SELECT run_id, 2, 'NO_REQUIRED_CHECKS', release_role, NULL, NULL FROM counted WHERE required_assertions = 0
  UNION ALL SELECT run_id, 3, 'MISSING_ASSERTION', release_role, session_id, assertion_id FROM checks_both WHERE req AND n = 0
  UNION ALL SELECT run_id, 4, 'DUPLICATE_ASSERTION', release_role, session_id, assertion_id FROM checks_both WHERE n > 1
  UNION ALL SELECT run_id, 5, 'UNEXPECTED_ASSERTION', release_role, session_id, assertion_id FROM checks_both WHERE NOT req
  UNION ALL SELECT run_id, 6, 'INVALID_STATUS', release_role, session_id, assertion_id FROM checks_both WHERE i > 0
  UNION ALL SELECT run_id, 7, 'FAILED_ASSERTION', release_role, session_id, assertion_id FROM checks_both WHERE f > 0
  UNION ALL SELECT run_id, 8, 'BLOCKED_ASSERTION', release_role, session_id, assertion_id FROM checks_both WHERE b > 0"""
_DOMAIN["first"] = """
  SELECT run_id, priority, release_role, session_id, assertion_id, problem_type FROM (SELECT *, row_number() OVER (PARTITION BY run_id
    ORDER BY priority, release_role NULLS FIRST, session_id NULLS FIRST, assertion_id NULLS FIRST) AS place FROM problems) WHERE place = 1"""

# Landed batches.
def _whole(document: str, path: str) -> str:
    return f"CASE WHEN json_type({document}, '{path}') IN ('UBIGINT', 'BIGINT') THEN TRY_CAST(json_extract_string({document}, '{path}') AS BIGINT) END"


def _instant(path: str) -> str:
    """All valid instants of the recipes are in UTC."""
    form = "[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?Z"
    text = f"json_extract_string(body, '{path}')"
    return f"CASE WHEN regexp_full_match({text}, '{form}') THEN TRY_CAST(replace(replace({text}, 'T', ' '), 'Z', '') AS TIMESTAMP) END"


_SAMPLE = "$.meterValue[0].sampledValue[0]"
_ENVELOPE = {
    "record_hash": "record_hash = sha256(raw_record)",
    "malformed_line": "doc IS NOT NULL",
    "mixed_record": "NOT coalesce(list_has_any(json_keys(doc), ['cdr_id', 'release_role', 'tariff_id']), FALSE)",
    "unexpected_fields": "list_sort(json_keys(doc)) = ['charging_station_id', 'event_id', 'generator', 'payload', 'run_id', 'schema_version']",
    "schema_version": f"({_whole('doc', '$.schema_version')}) = 1",
    "run_id": "json_extract_string(doc, '$.run_id') = 'generated-v1-' || batch_id",
    "generator": "list_sort(json_keys(doc, '$.generator')) = ['batch_id', 'seed', 'session_count', 'tariff', 'version'] "
    "AND json_extract_string(doc, '$.generator.version') = 'sessions-v1' AND regexp_full_match(batch_id, '[a-z][a-z0-9_-]{0,31}') "
    "AND session_count BETWEEN 1 AND 10000000 AND seed BETWEEN 0 AND 4294967295 AND list_sort(json_keys(doc, '$.generator.tariff')) = ['currency', 'id', 'price_per_kwh'] "
    "AND json_extract(doc, '$.generator.tariff.id') = '\"generated-energy-v1\"' AND json_extract(doc, '$.generator.tariff.currency') = '\"EUR\"' "
    "AND json_extract(doc, '$.generator.tariff.price_per_kwh') = '\"0.45\"'",
    "malformed_event": "json_type(body) = 'OBJECT'",
    "sequence_type": "event_type = ['Started', 'Updated', 'Ended'][seq + 1]",
    "identity": "starts_with(session_id, 'txn-') AND event_id = 'msg-' || substr(session_id, 5) || '-' || lower(event_type) "
    "AND station = 'cs-' || substr(session_id, 5)",
    "meter_time": f"({_instant('$.meterValue[0].timestamp')}) = event_time",
    "one_sample": "json_array_length(body, '$.meterValue') = 1 AND json_array_length(body, '$.meterValue[0].sampledValue') = 1",
    "register": f"json_extract_string(body, '{_SAMPLE}.measurand') = 'Energy.Active.Import.Register' AND json_extract_string(body, '{_SAMPLE}.location') = 'Outlet' "
    f"AND json_extract_string(body, '{_SAMPLE}.unitOfMeasure.unit') = 'Wh' AND ({_whole('body', _SAMPLE + '.unitOfMeasure.multiplier')}) = 0",
    "meter_value": "meter_wh >= 0",
    "elapsed": "seq = 0 OR spent > 0",
}
_DOMAIN["opened"] = f"""
  SELECT *, {reasons(_ENVELOPE)} AS reasons FROM (
    SELECT *, {_whole('body', '$.seqNo')} AS seq, json_extract_string(body, '$.transactionInfo.transactionId') AS session_id,
      {_whole('body', _SAMPLE + '.value')} AS meter_wh, {_whole('body', '$.transactionInfo.timeSpentCharging')} AS spent,
      {_instant('$.timestamp')} AS event_time, json_extract_string(body, '$.eventType') AS event_type
    FROM (SELECT *, CASE WHEN len(json_keys(loose)) = len(list_distinct(json_keys(loose))) THEN loose END AS body
      FROM (SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS loose
        FROM (SELECT *, json_extract_string(doc, '$.generator.batch_id') AS batch_id, {_whole('doc', '$.generator.session_count')} AS session_count,
            {_whole('doc', '$.generator.seed')} AS seed, json_extract_string(doc, '$.payload') AS payload,
            json_extract_string(doc, '$.event_id') AS event_id, json_extract_string(doc, '$.charging_station_id') AS station
          FROM (SELECT *, CASE WHEN json_valid(raw_record) THEN CAST(raw_record AS JSON) END AS doc FROM landing)))))"""
_DOMAIN["dedup"] = """
  SELECT batch_id, event_id, min(ingested_at) AS ingested_at, count(*) AS copies, count(DISTINCT raw_record) > 1 AS conflict,
    min(session_id) AS session_id, min(event_type) AS event_type, min(seq) AS seq, min(event_time) AS event_time, min(spent) AS spent,
    min(meter_wh) AS meter_wh, min(session_count) AS session_count, min(seed) AS seed, min(payload) AS payload, min(station) AS station
  FROM opened WHERE len(reasons) = 0 GROUP BY batch_id, event_id"""
_DOMAIN["clean"] = "SELECT * EXCLUDE (conflict) FROM dedup WHERE NOT conflict"
_DOMAIN["ordered"] = """
  SELECT batch_id, session_id, seq, event_time, meter_wh, spent, lag(event_time) OVER w AS before_time, lag(meter_wh) OVER w AS before_wh,
    first_value(event_time) OVER w AS first_time, count(*) OVER (PARTITION BY batch_id, session_id) AS n
  FROM clean WINDOW w AS (PARTITION BY batch_id, session_id ORDER BY seq)"""
_DOMAIN["seqviol"] = """
  SELECT DISTINCT batch_id, session_id, 'incomplete_sequence' AS violation FROM ordered WHERE n <> 3
  UNION SELECT batch_id, session_id, 'times_not_increasing' FROM ordered WHERE n = 3 AND event_time <= before_time
  UNION SELECT batch_id, session_id, 'meter_decreased' FROM ordered WHERE n = 3 AND meter_wh < before_wh
  UNION SELECT batch_id, session_id, 'elapsed_differs' FROM ordered WHERE n = 3 AND seq > 0
    AND epoch_us(event_time) - epoch_us(first_time) <> spent * 1000000"""
_DOMAIN["sizes"] = """
  SELECT batch_id, max(session_count) AS n FROM clean GROUP BY batch_id"""
_DOMAIN["declared"] = """
  SELECT batch_id, 'txn-' || substr(sha256('sessions-v1:' || batch_id || ':' || CAST(i AS VARCHAR)), 1, 24) AS session_id
  FROM (SELECT batch_id, unnest(generate_series(0, n - 1)) AS i FROM sizes)"""
_DOMAIN["gaps"] = """
  SELECT batch_id, session_id, 'missing' AS gap FROM declared ANTI JOIN clean USING (batch_id, session_id)
  UNION SELECT batch_id, session_id, 'undeclared' FROM clean ANTI JOIN declared USING (batch_id, session_id)"""
_DOMAIN["violated"] = """
  SELECT batch_id, unnest(reasons) AS violation FROM opened
  UNION ALL SELECT batch_id, 'conflicting_event' FROM dedup WHERE conflict UNION ALL SELECT batch_id, violation FROM seqviol
  UNION ALL SELECT batch_id, gap || '_session' FROM gaps
  UNION ALL SELECT batch_id, 'conflicting_settings' FROM dedup GROUP BY batch_id HAVING count(DISTINCT (session_count, seed)) > 1"""
_DOMAIN["gated"] = """
  SELECT DISTINCT batch_id, NOT EXISTS (SELECT 1 FROM violated v WHERE v.batch_id = d.batch_id)
    AND NOT EXISTS (SELECT 1 FROM opened o WHERE len(o.reasons) > 0 AND json_extract_string(o.doc, '$.run_id') = 'generated-v1-' || d.batch_id)
    AND NOT EXISTS (SELECT 1 FROM opened o JOIN opened n ON n.batch_id IS NULL AND n.source_file_name = o.source_file_name
      WHERE o.batch_id = d.batch_id AND len(o.reasons) = 0) AS accepted
  FROM dedup d"""


def fingerprint(source: str, keys: str, content: str) -> str:
    word = "CAST(('0x' || substr(h, {}, 8)) AS BIGINT)"
    sums = " || ':' || ".join(f"CAST(CAST(sum({word.format(1 + 8 * i)}) AS HUGEINT) AS VARCHAR)" for i in range(8))
    return (
        f"SELECT {keys}, count(*) AS documents, sha256(CAST(count(*) AS VARCHAR) || ':' || {sums}) AS input_hash "
        f"FROM (SELECT {keys}, sha256({content}) AS h FROM {source}) GROUP BY {keys}"
    )


# Canonical text of an envelope: keys sorted, as a JSON document prints them.
_CANONICAL = """'{"charging_station_id":"' || station || '","event_id":"' || event_id || '","generator":{"batch_id":"' || batch_id
  || '","seed":' || CAST(seed AS VARCHAR) || ',"session_count":' || CAST(session_count AS VARCHAR)
  || ',"tariff":{"currency":"EUR","id":"generated-energy-v1","price_per_kwh":"0.45"},"version":"sessions-v1"},"payload":"'
  || replace(payload, chr(34), chr(92) || chr(34)) || '","run_id":"generated-v1-' || batch_id || '","schema_version":1}'"""
_DOMAIN["identity"] = f"""
  SELECT *, 'generated-check-v1-' || batch_id || '-healthy-' || substr(sha256(input_hash || 'code'), 1, 16) AS run_id
  FROM ({fingerprint('clean', 'batch_id', _CANONICAL)})
    JOIN (SELECT batch_id, min(event_time) AS earliest, max(seed) AS seed FROM clean GROUP BY batch_id) USING (batch_id)
  WHERE batch_id IN (SELECT batch_id FROM gated WHERE accepted)"""

# Attempts.
_DOMAIN["e1"] = """
  SELECT execution_id, count(*) AS receipt_rows, max(batch_id) AS batch_id, max(candidate_mode) AS candidate_mode, max(started_at) AS started_at,
    max(finished_at) AS finished_at, max(status) AS status, max(reason) AS reason, max(run_id) AS run_id, max(pipeline_hash) AS code
  FROM receipts GROUP BY execution_id"""
_DOMAIN["s1"] = """
  SELECT execution_id, count(*) AS snapshot_rows, max(run_id) AS snapshot_run, max(pipeline_hash) AS snapshot_code, max(session_count) AS session_count,
    max(assertion_count) AS assertion_count, max(baseline_verdict) AS baseline_verdict, max(candidate_verdict) AS candidate_verdict,
    max(verdict) AS verdict, max(captured_at) AS captured_at, max(reason) AS snapshot_reason, max(passed_assertions) AS passed_assertions,
    max(failed_assertions) AS failed_assertions, max(blocked_assertions) AS blocked_assertions,
    max(missing_assertions) AS missing_assertions, max(required_assertions) AS required_assertions
  FROM batch_snapshots GROUP BY execution_id"""
_DOMAIN["context"] = """
  SELECT *, coalesce(receipt_rows = 1 AND status = 'SUCCEEDED' AND snapshot_rows = 1 AND run_id = snapshot_run AND code = snapshot_code
    AND session_count > 0 AND assertion_count = 14 * session_count, FALSE) AS fit
  FROM (SELECT execution_id FROM requested) LEFT JOIN e1 USING (execution_id) LEFT JOIN s1 USING (execution_id)"""
_DOMAIN["frozen_sessions"] = """
  SELECT execution_id, session_id, release_role, count(*) FILTER (status = 'PASS') AS passed_checks,
    count(*) FILTER (status = 'FAIL') AS failed_checks, count(*) FILTER (status = 'BLOCKED') AS blocked_checks, count(*) AS n,
    count(DISTINCT assertion_id) AS rules, count(*) FILTER (assertion_id = 'new_rule') AS unknown, min(run_id) AS lo, max(run_id) AS hi,
    max(CASE WHEN assertion_id = 'currency_match' THEN expected_value END) AS currency,
    max(CASE WHEN assertion_id = 'amount_match' THEN expected_value END) AS expected_amount,
    max(CASE WHEN assertion_id = 'amount_match' THEN actual_value END) AS actual_amount,
    max(CASE WHEN assertion_id = 'amount_match' THEN difference END) AS difference,
    max(CASE WHEN assertion_id = 'amount_match' THEN status END) AS amount_status
  FROM frozen GROUP BY ALL"""
_DOMAIN["totals"] = """
  SELECT execution_id, count(*) AS pairs, count(DISTINCT session_id) AS sessions, sum(n) AS checks, sum(passed_checks) AS passed_checks,
    sum(failed_checks) AS failed_checks, sum(blocked_checks) AS blocked_checks,
    bool_and(n = 7 AND rules = 7 AND unknown = 0 AND lo = c.run_id AND hi = c.run_id) AS covered,
    bool_and(passed_checks = 7 OR release_role <> 'baseline') AS b, bool_and(passed_checks = 7 OR release_role <> 'candidate') AS k,
    bool_and(passed_checks = 7) AS w
  FROM frozen_sessions JOIN context c USING (execution_id) WHERE fit GROUP BY execution_id"""
_DOMAIN["trusted"] = """
  SELECT c.*, t.passed_checks, t.failed_checks, t.blocked_checks, coalesce(fit AND covered AND pairs = 2 * session_count AND sessions = session_count
    AND checks = assertion_count AND (b = (baseline_verdict = 'PASS')) AND (k = (candidate_verdict = 'PASS')) AND (w = (verdict = 'PASS')), FALSE) AS usable
  FROM context c LEFT JOIN totals t USING (execution_id)"""
_DOMAIN["bills_out"] = """
  SELECT execution_id, session_id, release_role, f.currency, CAST(f.expected_amount AS DECIMAL(38,6)) AS expected_amount,
    CAST(f.actual_amount AS DECIMAL(38,6)) AS actual_amount, CAST(f.difference AS DECIMAL(38,6)) AS difference, amount_status,
    CASE WHEN f.passed_checks = 7 THEN 'PASS' ELSE 'FAIL' END AS verdict, f.passed_checks, f.failed_checks, f.blocked_checks
  FROM frozen_sessions f JOIN trusted USING (execution_id) WHERE usable"""
_DOMAIN["captures"] = """
  SELECT g.run_id, g.session_count, coalesce(missing_keys, 0) AS missing_keys, coalesce(extra_keys, 0) AS extra_keys,
    coalesce(duplicate_keys, 0) AS duplicate_keys, coalesce(missing_keys, 0) + coalesce(extra_keys, 0) + coalesce(duplicate_keys, 0) = 0 AS coverage_ok,
    coalesce(n_v = 1 AND NOT older, FALSE) AS provenance_ok,
    coalesce(n_v = 1 AND s.required_assertions = 14 * g.session_count AND s.passed_assertions = p AND s.failed_assertions = f
      AND s.blocked_assertions = b AND s.missing_assertions = 0, FALSE) AS counts_ok,
    coalesce(n_v = 1 AND (s.baseline_verdict = 'PASS') = bp AND (s.candidate_verdict = 'PASS') = cp AND (s.verdict = 'PASS') = (bp AND cp), FALSE) AS verdicts_ok,
    s.verdict, s.baseline_verdict, s.candidate_verdict, s.evaluated_at
  FROM (SELECT 'exec-run-' || CAST(c AS VARCHAR) AS run_id, count(*) AS session_count FROM sess GROUP BY ALL) g
  LEFT JOIN (SELECT run_id, count(*) FILTER (w > 0 AND n = 0) AS missing_keys, count(*) FILTER (w = 0) AS extra_keys,
      count(*) FILTER (w > 0 AND n > 1) AS duplicate_keys
    FROM (SELECT run_id, session_id, release_role, assertion_id, sum(w) AS w, sum(n) AS n FROM (
        SELECT 'exec-run-' || CAST(c AS VARCHAR) AS run_id, session_id, release_role, unnest(RULE_LIST) AS assertion_id, 1 AS w, 0 AS n FROM bills
        UNION ALL SELECT run_id, session_id, release_role, assertion_id, 0, 1 FROM frozen) GROUP BY ALL) GROUP BY run_id) d USING (run_id)
  LEFT JOIN (SELECT run_id, count(*) FILTER (status = 'PASS') AS p, count(*) FILTER (status = 'FAIL') AS f, count(*) FILTER (status = 'BLOCKED') AS b,
      bool_and(status = 'PASS' OR release_role <> 'baseline') AS bp, bool_and(status = 'PASS' OR release_role <> 'candidate') AS cp
    FROM frozen GROUP BY run_id) r USING (run_id)
  LEFT JOIN (SELECT run_id, count(*) AS n_v, max(required_assertions) AS required_assertions, max(passed_assertions) AS passed_assertions,
      max(failed_assertions) AS failed_assertions, max(blocked_assertions) AS blocked_assertions, max(missing_assertions) AS missing_assertions,
      max(baseline_verdict) AS baseline_verdict, max(candidate_verdict) AS candidate_verdict, max(verdict) AS verdict,
      bool_or(pipeline_hash = 'older') AS older, max(evaluated_at) AS evaluated_at
    FROM batch_snapshots GROUP BY run_id) s USING (run_id)""".replace("RULE_LIST", _RULE_LIST)
_DOMAIN["captures_ok"] = "SELECT *, coverage_ok AND provenance_ok AND counts_ok AND verdicts_ok AS ok FROM captures"
_WORDS = ", ".join(f"CAST(('0x' || substr(digest, {1 + 15 * i}, 15)) AS BIGINT) AS w{i}" for i in range(4))
_CONTENT = " || '|' || ".join(
    f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("session_id", "release_role", "assertion_id", "status", "expected_value", "actual_value", "difference")
)


def _evidence(table: str) -> str:
    """Rows, digest, passes and coverage of frozen rows per attempt and run."""
    return f"""
  SELECT execution_id, run_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(p) AS BIGINT) AS passed, bool_and(n = 7 AND rules = 7 AND unknown = 0) AS covered,
    sha256(CAST(sum(n) AS VARCHAR) || ':' || {" || ':' || ".join(f"CAST(sum(w{i}) AS VARCHAR)" for i in range(4))}) AS digest
  FROM (SELECT execution_id, run_id, session_id, release_role, count(*) AS n, count(*) FILTER (status = 'PASS') AS p, count(DISTINCT assertion_id) AS rules,
      count(*) FILTER (assertion_id = 'new_rule') AS unknown, {", ".join(f"sum(w{i}) AS w{i}" for i in range(4))}
    FROM (SELECT *, {_WORDS} FROM (SELECT *, sha256({_CONTENT}) AS digest FROM {table})) GROUP BY execution_id, run_id, session_id, release_role)
  GROUP BY execution_id, run_id"""


_DOMAIN["bound_evidence"] = _evidence("frozen")
_DOMAIN["found_evidence"] = _evidence("tampered")
_DOMAIN["sets"] = """
  SELECT *, CAST(substr(session_id, 5) AS BIGINT) AS k FROM lifecycle"""
_DOMAIN["replayed"] = """
  SELECT run, release_role, ingest_time, payload AS original,
    CASE WHEN run = 'replay-bad' AND release_role = 'candidate' THEN replace(payload, '"credit":false', '"credit":true') ELSE payload END AS payload
  FROM cdrs_raw CROSS JOIN (VALUES ('replay-bad'), ('replay-fixed')) runs(run) WHERE run_id = 'run-0'"""
_DOMAIN["older"] = "SELECT * EXCLUDE (k) REPLACE (meter_end_wh - 1 AS meter_end_wh) FROM sets WHERE k % 3 <> 0"
_DOMAIN["newer"] = "SELECT * EXCLUDE (k) FROM sets WHERE k % 3 <> 1"

_SESSION = f"run_id, session_id, {us('started_at')}, {us('ended_at')}, meter_start_wh, meter_end_wh, status"
_TARIFF_RULES = {
    "hash_mismatch": "payload_hash = sha256(payload)",
    "malformed_document": "doc IS NOT NULL",
    "id_mismatch": "doc->>'$.id' = tariff_id",
    "currency_mismatch": "doc->>'$.currency' = currency",
    "currency_not_eur": "currency = 'EUR'",
    "invalid_period": "valid_to IS NULL OR valid_to > valid_from",
    "not_one_element": "json_array_length(doc->'$.elements') = 1",
    "not_one_component": "json_array_length(doc->'$.elements[0].price_components') = 1",
    "not_energy": "doc->>'$.elements[0].price_components[0].type' = 'ENERGY'",
    "invalid_price": "CAST(doc->>'$.elements[0].price_components[0].price' AS DECIMAL(18,6)) >= 0",
    "step_size_not_one": "doc->>'$.elements[0].price_components[0].step_size' = '1'",
    "has_vat": "doc->>'$.elements[0].price_components[0].vat' IS NULL",
    "has_restrictions": "doc->>'$.elements[0].restrictions' IS NULL",
    "has_price_bounds": "doc->>'$.min_price' IS NULL AND doc->>'$.max_price' IS NULL",
    "has_document_dates": "doc->>'$.start_date_time' IS NULL AND doc->>'$.end_date_time' IS NULL",
}
_COUNTS = ", ".join(big(n, n) for n in _NAMES)
# Projections of a landed record, beside run, role and arrival.
_LANDED = """doc->>'$.country_code' AS country_code, doc->>'$.party_id' AS party_id, doc->>'$.id' AS cdr_id, doc->>'$.session_id' AS session_id,
      CASE WHEN doc->>'$.credit' = 'true' THEN 'CREDIT' ELSE 'FINAL' END AS cdr_type, doc->>'$.currency' AS currency,
      CASE WHEN doc IS NOT NULL THEN CAST(CAST(regexp_extract(payload, '"excl_vat":([^,}]+)', 1) AS DECIMAL(38,9)) AS DECIMAL(18,6)) END AS total_cost,
      sha256(payload) AS payload_hash"""
_TWICE = "(SELECT execution_id FROM requested)"


def _unit(x: str) -> str:
    return f"CASE WHEN u THEN {x} END AS {x}"


_FINALS: dict[str, str] = {
    "landing_stream": "SELECT v AS raw_record, sha256(v) AS record_hash FROM (SELECT concat_ws('|', CAST(event_id AS VARCHAR), event_type, props) AS v FROM events)",
    "landing_projection": "SELECT raw_record, sha256(raw_record) AS record_hash FROM landing",
    "landing_batch_slice": """SELECT source_file_name, record_hash FROM landing WHERE source_file_name = 'events-b3-0.jsonl'
      OR (json_valid(raw_record) AND (raw_record LIKE '%"run_id":"generated-v1-b3"%' OR raw_record LIKE '%"batch_id":"b3"%'))""",
    "landing_audit": f"""SELECT source_file_path, source_file_name, {big('count(*)', 'landed_rows')}, {big('count(DISTINCT record_hash)', 'distinct_record_hashes')},
      epoch_us(min(ingested_at)) AS first_ingested_at_us, epoch_us(max(ingested_at)) AS last_ingested_at_us FROM landing GROUP BY ALL""",
    "landing_integrity": f"""SELECT {big('count(*) FILTER (record_hash <> sha256(raw_record))', 'invalid_record_hashes')}, CAST(0 AS BIGINT) AS missing_source_metadata FROM landing""",
    "landing_duplicates": f"SELECT source_file_path, record_hash, {big('count(*)', 'occurrences')} FROM landing GROUP BY ALL HAVING count(*) > 1",
    "landing_preview": """SELECT doc->>'$.schema_version' AS schema_version, doc->>'$.run_id' AS run_id, event_id, station AS charging_station_id, session_id, event_type,
      CASE WHEN json_type(body, '$.seqNo') IN ('UBIGINT', 'BIGINT', 'VARCHAR') THEN TRY_CAST(json_extract_string(body, '$.seqNo') AS INT) END AS sequence_number,
      body->>'$.timestamp' AS event_time, CASE WHEN json_type(body, '$.meterValue[0].sampledValue[0].value') IN ('UBIGINT', 'BIGINT', 'VARCHAR')
        THEN TRY_CAST(json_extract_string(body, '$.meterValue[0].sampledValue[0].value') AS BIGINT) END AS meter_wh,
      doc->>'$.generator.seed' AS seed, doc->>'$.generator.tariff.price_per_kwh' AS price_per_kwh FROM opened""",
    "publish_once": f"SELECT sha256(raw_record) AS record_hash, {big('count(*)', 'n')} FROM landing GROUP BY ALL",
    "schema_conformance": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {big(f'count(*) FILTER ({c} IS NULL)', 'null_rows')} FROM lifecycle"
        for c in ("run_id", "session_id", "started_at", "meter_start_wh", "status")
    ),
    "expectations": """SELECT 'has_sessions' AS name, count(*) > 0 AS ok FROM lifecycle UNION ALL SELECT 'all_completed', count(*) FILTER (status <> 'Completed') = 0 FROM lifecycle
      UNION ALL SELECT 'one_row_per_session', count(*) = (SELECT count(*) FROM (SELECT DISTINCT run_id, session_id FROM lifecycle)) FROM lifecycle
      UNION ALL SELECT 'unknown_is_false', FALSE""",
    "merge_key_check": f"SELECT l_orderkey, l_linenumber, {big('count(*)', 'key_rows')} FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "merge_insert_only": f"SELECT {_SESSION} FROM (FROM older UNION ALL (FROM newer ANTI JOIN older USING (run_id, session_id)))",
    "landing_audit_stream": f"""SELECT {big('count(*)', 'landed_rows')}, {big('0', 'invalid_record_hashes')}, {big('0', 'missing_source_metadata')},
      {big("count(DISTINCT CAST(event_id AS VARCHAR) || '|' || event_type || '|' || props)", 'distinct_record_hashes')}, {big('0', 'differing_files')} FROM events""",
    "publish_resume": f"""SELECT part, count(*) AS lines, {set_digest('count(*)', 'h')} AS digest,
      CASE WHEN part IN (0, 3, 5) THEN 'complete' ELSE 'missing' END AS before, 'complete' AS "after"
      FROM (SELECT *, CAST(('0x' || substr(h, 1, 4)) AS INT) % 16 AS part FROM (SELECT sha256(raw_record) AS h FROM landing)) GROUP BY part""",
    "observed_gates": """SELECT unnest(['has_sessions', 'all_completed', 'all_started', 'unknown_is_false']) AS name,
      unnest([count(*) > 0, count(*) FILTER (status <> 'Completed') = 0, count(*) FILTER (started_at IS NULL) = 0, FALSE]) AS ok FROM lifecycle""",
    "stream_dedup": """SELECT event_id, count(DISTINCT props) AS contents, count(DISTINCT props) > 1 AS conflict FROM (
      SELECT event_id, props FROM events UNION ALL SELECT event_id, props || ' ' FROM events WHERE event_id % 11 = 3) GROUP BY event_id""",
    "session_stream": f"SELECT {_SESSION} FROM lifecycle",
    "fingerprint_diff": """SELECT digest, CAST(sum(l) AS BIGINT) AS left_copies, CAST(sum(r) AS BIGINT) AS right_copies FROM (
      SELECT sha256(raw_record) AS digest, 1 AS l, CASE WHEN source_file_name = 'events-b3-1.jsonl' THEN 0 WHEN source_file_name = 'events-b5-1.jsonl' THEN 2 ELSE 1 END AS r FROM landing)
      GROUP BY digest HAVING sum(l) <> sum(r)""",
    "fingerprint_tree": f"""SELECT documents, branch AS prefix FROM (SELECT count(*) AS documents, substr(sha256(raw_record), 1, 2) AS branch FROM landing GROUP BY branch)
      UNION ALL SELECT count(*), '' FROM landing""",
    "tariff_overlaps_all": f"""SELECT run_id, tariff_id, {us('valid_from')}, {us('valid_to')}, payload, coalesce(reach > valid_from, FALSE) AS overlaps_earlier, coalesce(following < e, FALSE) AS overlaps_later
      FROM (SELECT *, max(e) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach, lead(valid_from) OVER w AS following
        FROM (SELECT *, coalesce(valid_to, TIMESTAMP '9999-12-31 00:00:00') AS e FROM layered)
        WINDOW w AS (PARTITION BY run_id, tariff_id ORDER BY valid_from, e, payload_hash)) WHERE coalesce(reach > valid_from, FALSE) OR coalesce(following < e, FALSE)""",
    "join_validity_sweep": """SELECT f.k AS started, f.tariff AS tariff_id, p.k AS running
      FROM (SELECT *, CASE WHEN k % 101 = 3 THEN 'tariff-none' ELSE tariff_id END AS tariff FROM layered) f
      LEFT JOIN layered p ON p.tariff_id = f.tariff AND p.run_id = f.run_id AND f.valid_from >= p.valid_from AND (p.valid_to IS NULL OR f.valid_from < p.valid_to)""",
    "merge_upsert": f"SELECT {_SESSION} FROM (FROM newer UNION ALL (FROM older ANTI JOIN newer USING (run_id, session_id)))",
    "merge_sync_scope": f"""SELECT {_SESSION} FROM ((SELECT * FROM older WHERE run_id NOT IN ('run-0', 'run-3')) UNION ALL (SELECT * FROM newer WHERE run_id IN ('run-0', 'run-3')))""",
    "immutable_diff": """SELECT run_id, session_id, CASE WHEN o.k IS NULL THEN 'missing' WHEN n.k IS NULL THEN 'unexpected'
      WHEN o.started_at IS NOT DISTINCT FROM n.started_at AND o.ended_at IS NOT DISTINCT FROM n.ended_at AND o.meter_start_wh IS NOT DISTINCT FROM n.meter_start_wh
        AND o.wh IS NOT DISTINCT FROM n.meter_end_wh AND o.status = n.status THEN 'unchanged' ELSE 'conflict' END AS status
      FROM (SELECT *, 1 AS k, meter_end_wh + CASE WHEN CAST(substr(session_id, 5) AS BIGINT) % 2 = 0 THEN 1 ELSE 0 END AS wh FROM older) o
      FULL JOIN (SELECT *, 1 AS k FROM newer) n USING (run_id, session_id)""",
    "scenario_replay": f"""SELECT run AS run_id, release_role, {_LANDED}, {us('ingest_time')}
      FROM (SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS doc FROM replayed)""",
    "replay_drift": f"""SELECT run AS run_id, {big('count(*)', 'source_rows')}, {big('count(*) FILTER (NOT lost)', 'replayed_rows')},
        {big('count(*) FILTER (NOT lost AND NOT changed)', 'faithful_rows')}, {big('count(*) FILTER (NOT lost AND changed)', 'drifted_rows')},
        {big('count(*) FILTER (lost)', 'missing_rows')}
      FROM (SELECT run, original <> payload AS changed, run = 'replay-fixed' AND starts_with(sha256(original), '0') AS lost FROM replayed) GROUP BY run""",
    "receipt_register": f"""SELECT execution_id, split_part(execution_id, ':', 1) AS job_id, split_part(execution_id, ':', 2) AS job_run_id, CAST(0 AS INT) AS repair_count, status,
        '[]' AS expected_run_ids_json, {us('started_at')}, {us('finished_at')}, reason FROM receipts
      UNION ALL SELECT id, j, r, CAST(rep AS INT), CASE WHEN rep > 0 THEN 'FAILED' ELSE 'RUNNING' END, '[]', now_us, CASE WHEN rep > 0 THEN now_us END,
        CASE WHEN rep > 0 THEN {q(e.REPAIR)} ELSE {q(e.REGISTERED)} END
      FROM (SELECT j || ':' || r || ':' || CAST(rep AS VARCHAR) AS id, * FROM (SELECT split_part(execution_id, ':', 1) AS j, split_part(execution_id, ':', 2) AS r,
          CAST(split_part(execution_id, ':', 2) AS BIGINT) % 2 AS rep, epoch_us(TIMESTAMP '2026-06-01') AS now_us FROM requested))
      WHERE CAST(r AS BIGINT) >= 1 AND id NOT IN (SELECT execution_id FROM receipts)""",
    "receipt_transition": f"""SELECT execution_id, CASE WHEN t AND status <> 'FAILED' THEN 'SUCCEEDED' ELSE status END AS status,
      CASE WHEN t AND status <> 'FAILED' THEN 'Finished.' ELSE reason END AS reason,
      epoch_us(CASE WHEN t THEN coalesce(finished_at, TIMESTAMP '2026-06-01') ELSE finished_at END) AS finished_at_us
      FROM (SELECT *, CAST(split_part(execution_id, ':', 2) AS BIGINT) % 2 = 0 AS t FROM receipts)""",
    "select_attempt": """SELECT selector, CASE WHEN trim(selector) IN ('', 'latest') THEN (SELECT execution_id FROM receipts ORDER BY started_at DESC, execution_id DESC LIMIT 1)
      ELSE selector END AS execution_id FROM (SELECT CASE WHEN execution_id LIKE '1:%' THEN 'latest' WHEN execution_id LIKE '2:%' THEN '  ' ELSE execution_id END AS selector FROM requested)""",
    "session_lifecycle": f"SELECT {_SESSION} FROM lifecycle",
    "tariff_validate": f"""SELECT run_id, tariff_id, {us('valid_from')}, len(x) = 0 AS ok, array_to_string(x, ',') AS reasons FROM (SELECT *, {reasons(_TARIFF_RULES)} AS x
      FROM (SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS doc FROM tariffs_faulty))""",
    "tariff_overlaps": f"""SELECT run_id, tariff_id, {us('valid_from')}, {us('valid_to')}, {us('next_valid_from')} FROM (SELECT *, lead(valid_from) OVER (PARTITION BY run_id, tariff_id
      ORDER BY valid_from, valid_to NULLS LAST) AS next_valid_from FROM (SELECT DISTINCT * FROM tariffs_raw)) WHERE next_valid_from IS NOT NULL AND (valid_to IS NULL OR valid_to > next_valid_from)""",
    "tariff_history": f"SELECT run_id, tariff_id, {us('valid_from')}, {us('valid_to')}, currency, source_payload_hash, price, CAST(1 AS BIGINT) AS components FROM history",
    "lineage_check": f"""SELECT h.run_id, h.tariff_id, {us('h.valid_from').replace('h.valid_from_us', 'valid_from_us')}, h.source_payload_hash, coalesce(f.ok, FALSE) AS traced
      FROM history h LEFT JOIN (SELECT DISTINCT run_id, tariff_id, valid_from, payload_hash, payload_hash = sha256(payload) AS ok FROM tariffs_faulty) f
      ON f.run_id = h.run_id AND f.tariff_id = h.tariff_id AND f.valid_from = h.valid_from AND f.payload_hash = h.source_payload_hash""",
    "registry_check": f"""SELECT run_id, {big('count(*)', 'session_rows')}, {big('count(DISTINCT session_id)', 'distinct_sessions')}, {big('count(*) FILTER (good)', 'complete_rows')},
      count(*) = count(DISTINCT session_id) AND count(*) = count(*) FILTER (good) AS ok FROM (
        SELECT run_id, session_id, NOT (run_id = 'run-2' AND k % 59 = 2) AS good FROM sess UNION ALL SELECT run_id, session_id, TRUE FROM sess WHERE run_id = 'run-1' AND k % 61 = 1) GROUP BY run_id""",
    "pricing_preconditions": """SELECT run_id, session_id, registration_rows, named_rows, session_rows, valid_session_rows, tariff_rows, valid_tariff_rows,
      registration_rows = 1 AND named_rows = 1 AND session_rows = 1 AND valid_session_rows = 1 AND tariff_rows = 1 AND valid_tariff_rows = 1 AS ok
      FROM pre_twice JOIN (SELECT run_id, session_id, count(*) AS registration_rows, count(*) FILTER (trim(tariff_id) <> '') AS named_rows
        FROM registry_twice GROUP BY ALL) USING (run_id, session_id)""",
    "expected_ledger": f"SELECT * EXCLUDE (tariff_valid_from), {us('tariff_valid_from')} FROM expected",
    "join_inner": "SELECT run_id, session_id, tariff_id, status FROM lifecycle JOIN input_session USING (run_id, session_id)",
    "join_validity": f"""SELECT s.run_id, s.session_id, m.tariff_id, epoch_us(h.valid_from) AS valid_from_us FROM lifecycle s JOIN input_session m USING (run_id, session_id)
      JOIN history h ON h.run_id = s.run_id AND h.tariff_id = m.tariff_id AND s.started_at >= h.valid_from AND (h.valid_to IS NULL OR s.started_at < h.valid_to)""",
    "join_validity_bucketed": """SELECT f.o_custkey, f.o_orderkey AS at_order, p.o_orderkey FROM orders f JOIN (
      SELECT o_custkey, o_orderkey, o_orderdate AS valid_from, valid_to FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS valid_to FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey) p
      ON p.o_custkey = f.o_custkey AND f.o_orderdate >= p.valid_from AND f.o_orderdate < p.valid_to""",
    "cdr_land": f"""SELECT run_id, release_role, {_LANDED}, {us('ingest_time')}
      FROM (SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS doc FROM responses)""",
    "cdr_validate": "SELECT run_id, release_role, payload_hash, len(reasons) = 0 AS ok, array_to_string(reasons, ',') AS reasons FROM checked_cdrs",
    "cdr_quarantine": """SELECT run_id, release_role, payload_hash, array_to_string(reasons, ',') AS reasons FROM checked_cdrs WHERE len(reasons) > 0
      UNION ALL SELECT n.run_id, n.release_role, n.payload_hash, 'conflicting_charge' FROM norm n SEMI JOIN conflicts USING (run_id, release_role, country_code, party_id, cdr_id)""",
    "cdr_conflicts": "SELECT * FROM conflicts",
    "cdr_sources": "SELECT DISTINCT run_id, release_role, country_code, party_id, cdr_id, payload_hash FROM norm",
    "actual_ledger": f"SELECT * EXCLUDE (started_at, ended_at), {us('started_at')}, {us('ended_at')} FROM actual",
    "actual_evidence": f"SELECT run_id, release_role, session_id, count(*) AS cdr_count, {set_digest('count(*)', 'h')} AS records_digest FROM digested GROUP BY ALL",
    "assertion_records": """SELECT run_id, release_role, session_id, country_code, party_id, cdr_id, actual_energy_kwh, actual_duration_hours, actual_amount, currency,
      tariff_id, source_payloads, source_digest FROM actual""",
    "rate_sessions": f"""SELECT run_id, role AS release_role, 'cdr-' || substr(session_id, 5) AS cdr_id, expected_energy_kwh AS energy,
      CAST(((epoch_us(ended_at) - epoch_us(started_at) + 1800) // 3600) * 0.000001 AS DECIMAL(18,6)) AS duration,
      CAST(expected_amount + CASE WHEN role = 'candidate' THEN 0.87 ELSE 0 END AS DECIMAL(18,2)) AS amount, tariff_id, epoch_us(ended_at) + 2000000 AS ingest_time_us
      FROM expected JOIN lifecycle USING (run_id, session_id) CROSS JOIN (VALUES ('baseline'), ('candidate')) roles(role)""",
    "release_grid": "SELECT run_id, release_role, session_id FROM grid",
    "assertion_result": f"SELECT * REPLACE (CAST(evidence_cdrs AS BIGINT) AS evidence_cdrs) FROM asserted",
    "missing_assertions": "SELECT run_id, release_role, session_id, assertion_id FROM checks_both WHERE req AND n = 0",
    "unexpected_assertions": f"SELECT run_id, release_role, session_id, assertion_id, {big('n', 'unexpected_assertions')} FROM checks_both WHERE NOT req",
    "release_counts": f"SELECT run_id, release_role, {big('manifest_rows', 'manifest_rows')}, {_COUNTS}, release_verdict FROM decided",
    "problem_union": "SELECT run_id, priority, problem_type, release_role, session_id, assertion_id FROM problems",
    "first_problem": "SELECT run_id, priority, release_role, session_id, assertion_id, problem_type FROM first",
    "release_verdict": f"""SELECT run_id, scenario_id, seed, baseline_sha, candidate_sha, tariff_hash, {_COUNTS}, baseline_verdict, candidate_verdict,
      CASE WHEN baseline_verdict = 'PASS' AND candidate_verdict = 'PASS' AND unexpected_assertions + invalid_assertions + duplicate_assertion_keys = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict,
      problem_type || ': ' || CASE problem_type {' '.join(f"WHEN {q(kind)} THEN {q(text)}" for _, kind, text in v.PROBLEMS)} END AS reason,
      problem_type AS first_problem_type, release_role AS first_release_role, session_id AS first_session_id, assertion_id AS first_assertion_id
      FROM (SELECT run_id, {_SUMS} FROM checks_both GROUP BY run_id)
      JOIN (SELECT run_id, max(CASE WHEN release_role = 'baseline' THEN release_verdict END) AS baseline_verdict, max(CASE WHEN release_role = 'candidate' THEN release_verdict END) AS candidate_verdict FROM decided GROUP BY run_id) USING (run_id)
      LEFT JOIN (SELECT run_id, max(scenario_id) AS scenario_id, max(seed) AS seed, max(baseline_sha) AS baseline_sha, max(candidate_sha) AS candidate_sha, max(tariff_hash) AS tariff_hash
        FROM run_manifest GROUP BY run_id HAVING count(*) = 1) USING (run_id) LEFT JOIN first USING (run_id)""",
    "singleton_value": f"SELECT run_id, {big('count(*)', 'key_rows')}, CASE WHEN count(*) = 1 THEN max(scenario_id) END AS scenario_id, CASE WHEN count(*) = 1 THEN max(seed) END AS seed FROM run_manifest GROUP BY run_id",
    "status_counts": f"SELECT run_id, release_role, assertion_id, status, {big('count(*)', 'assertion_rows')} FROM asserted GROUP BY ALL",
    "event_dedup": f"SELECT batch_id, event_id, {us('ingested_at')}, copies, conflict FROM dedup",
    "sequence_violations": "SELECT batch_id, session_id, violation FROM seqviol",
    "inventory_gap": "SELECT batch_id, session_id, gap FROM gaps",
    "batch_violations": f"SELECT batch_id, violation, {big('count(*)', 'occurrences')} FROM violated GROUP BY ALL",
    "batch_gate": "SELECT batch_id, accepted FROM gated",
    "batch_lines": """SELECT source_file_name, sha256(raw_record) AS line_hash, batch_id, event_id, session_id, seq AS sequence_number, meter_wh,
      len(reasons) = 0 AS ok, coalesce(array_to_string(reasons, ','), '') AS reasons FROM opened""",
    "batch_clean_events": f"SELECT batch_id, event_id, session_id, event_type, {us('event_time')}, meter_wh, {us('ingested_at')} FROM clean",
    "batch_adapt_manifest": f"""SELECT run_id, 'generated-mock-v1-healthy-' || batch_id AS scenario_id, seed, sha1('codehealthy-v1') AS baseline_sha, sha1('codehealthy-v1') AS candidate_sha,
      sha256('TARIFF') AS tariff_hash, epoch_us(earliest) AS created_at_us FROM identity""",
    "batch_adapt_registry": "SELECT DISTINCT run_id, session_id, 'generated-energy-v1' AS tariff_id FROM clean JOIN identity USING (batch_id)",
    "batch_adapt_events": f"""SELECT run_id, event_id, station AS charging_station_id, session_id AS transaction_id, event_type, seq AS sequence_number, {us('event_time')},
      epoch_us(ingested_at) AS ingest_time_us, payload, sha256(payload) AS payload_hash FROM clean JOIN identity USING (batch_id)""",
    "batch_adapt_tariffs": f"""SELECT run_id, 'generated-energy-v1' AS tariff_id, epoch_us(earliest) AS valid_from_us, CAST(NULL AS BIGINT) AS valid_to_us, 'EUR' AS currency,
      'TARIFF' AS payload, sha256('TARIFF') AS payload_hash FROM identity""",
    "content_fingerprint": fingerprint("landing", "source_file_name", "raw_record"),
    "attempt_log": f"""SELECT execution_id, coalesce(any_value(job_id) FILTER (nth = 1), split_part(execution_id, ':', 1)) AS job_id,
      coalesce(any_value(job_run_id) FILTER (nth = 1), split_part(execution_id, ':', 2)) AS job_run_id,
      coalesce(any_value(repair_count) FILTER (nth = 1), CAST(split_part(execution_id, ':', 3) AS INT)) AS repair_count,
      CASE WHEN lost THEN 'FAILED' WHEN count(*) FILTER (status = 'SUCCEEDED') > 0 THEN 'SUCCEEDED' ELSE 'RUNNING' END AS status,
      coalesce(any_value(expected_run_ids_json) FILTER (nth = 1), '[]') AS expected_run_ids_json,
      epoch_us(coalesce(any_value(event_at) FILTER (nth = 1), min(event_at))) AS started_at_us,
      epoch_us(coalesce(min(event_at) FILTER (status <> 'RUNNING'), CASE WHEN lost THEN min(event_at) END)) AS finished_at_us,
      arg_max(task_states_json, event_at) FILTER (task_states_json IS NOT NULL) AS task_states_json,
      CASE WHEN NOT begun THEN {q(at.UNREGISTERED)} WHEN contents > 1 THEN {q(at.CONTRADICTED)}
        ELSE coalesce(arg_min(reason, event_at) FILTER (status = 'FAILED'), arg_max(reason, event_at) FILTER (status = 'SUCCEEDED'), any_value(reason) FILTER (nth = 1)) END AS reason,
      count(*) AS events
      FROM (SELECT *, NOT begun OR contents > 1 OR bool_or(status = 'FAILED') OVER (PARTITION BY execution_id) AS lost
        FROM (SELECT *, CASE WHEN phase = 'begin' THEN row_number() OVER (PARTITION BY execution_id, phase ORDER BY event_at) END AS nth,
            bool_or(phase = 'begin') OVER (PARTITION BY execution_id) AS begun,
            count(DISTINCT expected_run_ids_json) OVER (PARTITION BY execution_id) AS contents FROM attempt_log))
      GROUP BY execution_id, lost, begun, contents""",
    "frozen_digest_check": """SELECT execution_id, run_id, CASE WHEN b.n IS NULL THEN 'unbound' WHEN f.n IS NULL THEN 'missing' WHEN f.n < b.n THEN 'lost' WHEN f.n > b.n THEN 'added'
        WHEN b.digest = f.digest THEN 'intact' ELSE 'changed' END AS state,
      b.n AS bound_rows, b.digest AS bound_digest, f.n AS frozen_rows, f.digest AS frozen_digest, coalesce(f.passed, 0) AS passed_rows, coalesce(f.covered, FALSE) AS covered
      FROM bound_evidence b FULL JOIN found_evidence f USING (execution_id, run_id)""",
    "capture_check": """SELECT run_id, session_count, missing_keys, extra_keys, duplicate_keys, coverage_ok, provenance_ok, counts_ok, verdicts_ok, ok FROM captures_ok""",
    "capture_snapshot": f"""SELECT execution_id, c.run_id, 'input' AS input_hash, pipeline_hash, c.session_count, 14 * c.session_count AS assertion_count, baseline_verdict, candidate_verdict, verdict,
      {big('14 * c.session_count', 'frozen_rows')} FROM captures_ok c JOIN (SELECT DISTINCT execution_id, run_id, pipeline_hash, started_at FROM receipts WHERE status = 'SUCCEEDED') x USING (run_id)
      WHERE ok AND evaluated_at >= started_at""",
    "finish_status": """SELECT execution_id, CASE WHEN reason = 'complete' THEN 'SUCCEEDED' ELSE 'FAILED' END AS status, reason FROM (
      SELECT execution_id, CASE WHEN receipt_rows <> 1 THEN 'duplicate_receipt' WHEN status NOT IN ('RUNNING', 'SUCCEEDED') THEN 'already_failed' WHEN coalesce(good, 0) <> 4 THEN 'tasks_incomplete'
        WHEN coalesce(n, 0) <> 1 THEN 'snapshot_inventory' WHEN NOT (oldest >= started_at) THEN 'stale_snapshot' WHEN NOT fine THEN 'inconsistent_snapshot' ELSE 'complete' END AS reason
      FROM e1 LEFT JOIN (SELECT execution_id, count(*) FILTER (state = 'success') AS good FROM task_states GROUP BY execution_id) USING (execution_id)
      LEFT JOIN (SELECT execution_id, count(*) AS n, min(evaluated_at) AS oldest, bool_and(missing_assertions = 0 AND (verdict = 'FAIL' OR passed_assertions = required_assertions)) AS fine
        FROM batch_snapshots GROUP BY execution_id) USING (execution_id))""",
    "check_execution": f"""SELECT execution_id, run_id, execution_status, {_unit('baseline_verdict')}, {_unit('candidate_verdict')}, CASE WHEN u THEN verdict ELSE 'BLOCKED' END AS verdict,
      {_unit('passed_assertions')}, {_unit('failed_assertions')}, CASE WHEN coalesce(receipt_rows, 0) <> 1 THEN {q(e.NO_REGISTRATION)} WHEN status <> 'SUCCEEDED' THEN {q(e.INCOMPLETE)} || e_reason
        WHEN coalesce(snapshot_rows, 0) <> 1 THEN {q(e.NO_SNAPSHOT)} WHEN NOT u THEN {q(e.INVALID_SNAPSHOT)} ELSE snapshot_reason END AS reason
      FROM (SELECT r.execution_id, r.run_id, e.reason AS e_reason, e.status, e.receipt_rows, s1.*,
          CASE WHEN e.receipt_rows IS NULL THEN 'MISSING' WHEN e.receipt_rows <> 1 THEN 'INVALID' ELSE e.status END AS execution_status,
          coalesce(e.receipt_rows = 1 AND e.status = 'SUCCEEDED' AND snapshot_rows = 1 AND (verdict <> 'PASS' OR (baseline_verdict = 'PASS' AND candidate_verdict = 'PASS'
            AND passed_assertions = required_assertions AND failed_assertions = 0 AND blocked_assertions = 0 AND missing_assertions = 0)), FALSE) AS u
        FROM requested r LEFT JOIN e1 e USING (execution_id) LEFT JOIN (SELECT execution_id AS sx, * EXCLUDE (execution_id) FROM s1) s1 ON sx = r.execution_id)""",
    "check_batch_execution": """SELECT execution_id, coalesce(status, 'MISSING') AS job_status, snapshot_run AS run_id, CASE WHEN fit THEN baseline_verdict ELSE 'BLOCKED' END AS baseline_verdict,
      CASE WHEN fit THEN candidate_verdict ELSE 'BLOCKED' END AS candidate_verdict, CASE WHEN fit THEN verdict ELSE 'BLOCKED' END AS verdict, session_count, assertion_count, reason FROM context""",
    "snapshot_session_verdicts": """SELECT execution_id, session_id, release_role, CASE WHEN n <> 7 OR rules <> 7 THEN 'BLOCKED' WHEN f.passed_checks = 7 THEN 'PASS' ELSE 'FAIL' END AS verdict,
      f.passed_checks, f.failed_checks, f.blocked_checks FROM frozen_sessions f JOIN context c USING (execution_id) WHERE receipt_rows = 1 AND status = 'SUCCEEDED' AND snapshot_rows = 1 AND code = snapshot_code AND c.run_id = snapshot_run""",
    "execution_summary": f"""SELECT execution_id, batch_id, candidate_mode, {us('started_at')}, {us('finished_at')}, coalesce(status, 'MISSING') AS evaluation_status,
      CASE WHEN receipt_rows IS NULL THEN {q(r.NO_RECEIPT)} WHEN receipt_rows <> 1 THEN {q(r.DUPLICATE_RECEIPTS)} WHEN status <> 'SUCCEEDED' THEN reason WHEN NOT usable THEN {q(r.INCONSISTENT)} ELSE reason END AS reason,
      usable, {us('captured_at')}, CASE WHEN usable THEN session_count END AS session_count, CASE WHEN usable THEN assertion_count END AS assertion_count,
      {big('CASE WHEN usable THEN passed_checks END', 'passed_checks')}, {big('CASE WHEN usable THEN failed_checks END', 'failed_checks')}, {big('CASE WHEN usable THEN blocked_checks END', 'blocked_checks')},
      CASE WHEN usable THEN baseline_verdict ELSE 'BLOCKED' END AS baseline_verdict, CASE WHEN usable THEN candidate_verdict ELSE 'BLOCKED' END AS candidate_verdict,
      CASE WHEN usable THEN verdict ELSE 'BLOCKED' END AS verdict FROM trusted""",
    "session_bills": "SELECT * FROM bills_out",
    "bills_ranked": "SELECT * FROM bills_out ORDER BY failed_checks DESC, blocked_checks DESC, session_id, release_role",
    "bills_pivot": "SELECT execution_id, session_id, release_role, currency, expected_amount, actual_amount, difference, amount_status FROM frozen_sessions",
    "bills_complete": f"""SELECT execution_id, CAST(1 AS BIGINT) AS summary_rows, {big('coalesce(n, 0)', 'bill_rows')}, coalesce(n, 0) = CASE WHEN usable THEN 2 * session_count ELSE 0 END AS complete
      FROM trusted LEFT JOIN (SELECT execution_id, count(*) AS n FROM bills_out GROUP BY execution_id) USING (execution_id)""",
    "bills_filter": "SELECT * FROM bills_out WHERE release_role = 'candidate' AND verdict = 'FAIL'",
    "execution_choices": "SELECT 'latest' AS execution_id UNION SELECT execution_id FROM receipts",
    "recent_attempts": f"SELECT * EXCLUDE (started_at, finished_at), {us('started_at')}, {us('finished_at')} FROM (SELECT DISTINCT * FROM receipts ORDER BY started_at DESC, execution_id DESC LIMIT 20)",
    "key_set_diff": f"""SELECT l_orderkey, l_linenumber, {big('w', 'wanted_rows')}, {big('n', 'found_rows')}, CASE WHEN n = 0 THEN 'missing' WHEN w = 0 THEN 'extra' ELSE 'duplicate' END AS difference
      FROM (SELECT l_orderkey, l_linenumber, sum(w) AS w, sum(n) AS n FROM (SELECT o_orderkey AS l_orderkey, 1 AS l_linenumber, 1 AS w, 0 AS n FROM orders UNION ALL SELECT l_orderkey, l_linenumber, 0, 1 FROM lineitem) GROUP BY ALL)
      WHERE NOT (w = 1 AND n = 1)""",
}
_RAW_TABLES = ("run_manifest", "input_session", "events_raw", "tariffs_raw", "cdrs_raw")
_LAYERS = {"session_lifecycle": "lifecycle", "tariff_history": "history", "expected_ledger": "expected", "actual_ledger": "actual", "assertion_result": "asserted"}
_FINALS |= {
    "cdr_zero_fill": """SELECT run_id, role AS release_role, count(x.p) AS cdr_rows
      FROM (SELECT DISTINCT run_id FROM run_manifest UNION SELECT 'empty-' || run_id FROM run_manifest) m
      CROSS JOIN (VALUES ('baseline'), ('candidate')) roles(role)
      LEFT JOIN (SELECT run_id AS r, release_role AS o, 1 AS p FROM cdrs_raw) x ON r = m.run_id AND o = role GROUP BY ALL""",
    "role_summary": f"SELECT run_id, release_role, {_COUNTS}, release_verdict AS verdict FROM decided",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}" for name, table in ({t: t for t in _RAW_TABLES} | _LAYERS).items()
    ),
    # An accepted batch is whole, so all its sessions are checked and every candidate bill is too high.
    "evaluate_batches": f"""SELECT 'generated-mock-v1-amount_error-' || batch_id AS scenario_id, {big('14 * n', 'required_assertions')}, {big('13 * n', 'passed_assertions')},
      {big('n', 'failed_assertions')}, {big('0', 'blocked_assertions')}, 'PASS' AS baseline_verdict, 'FAIL' AS candidate_verdict, 'FAIL' AS verdict
      FROM (SELECT batch_id, count(DISTINCT session_id) AS n FROM clean GROUP BY batch_id) WHERE batch_id IN (SELECT batch_id FROM gated WHERE accepted)""",
    "batch_outcomes": "SELECT batch_id, CASE WHEN accepted THEN 'SUCCEEDED' ELSE 'FAILED' END AS new_status FROM gated",
}


def oracle_sql() -> dict[str, str]:
    from meterproof.operators.batch import TARIFF_PAYLOAD

    ctes = {**recipes("duckdb"), **_DOMAIN}
    names = list(ctes)

    def needed(text: str, seen: set[str]) -> set[str]:
        for name in names:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                needed(ctes[name], seen)
        return seen

    result = {}
    for key, final in _FINALS.items():
        final = final.replace("'TARIFF'", q(TARIFF_PAYLOAD))
        used = needed(final, set())
        prefix = ",\n".join(f"{name} AS ({ctes[name]})" for name in names if name in used)
        result[key] = f"WITH {prefix}\n{final}" if prefix else final
    return result
