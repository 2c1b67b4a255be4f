"""Reference SQL of the registered queries, written against the driver tables alone."""

from __future__ import annotations

from eventloom.plans import derived as d

SECONDS = "(epoch_us(ts) // 1000000)"
UUID = "CAST(event_id AS VARCHAR)"
TIME_TEXT = "strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S')"
ADDRESS = f"({d.ADDRESS_SQL})"
DOTTED = (
    f"concat({ADDRESS} // 16777216, '.', {ADDRESS} // 65536 % 256, '.', "
    f"{ADDRESS} // 256 % 256, '.', {ADDRESS} % 256)"
)

ORACLES: dict[str, str] = {}


def _literals(literals: list[str]) -> str:
    """Rows with the JSON literal, its unquoted text and whether it was quoted."""
    return (
        "WITH raw AS (SELECT *, " + d.pick_sql(literals, "event_id") + " AS lit FROM events), "
        "lits AS (SELECT *, lit LIKE '\"%' AS quoted, "
        "CASE WHEN lit LIKE '\"%' THEN substr(lit, 2, length(lit) - 2) ELSE lit END AS txt FROM raw) "
    )


ORACLES["decode_roundtrip"] = f"""
SELECT {UUID} AS uuid, event_type AS event, {SECONDS} AS event_time, '10.0.0.1' AS client_ip,
       'Test Browser' AS user_agent, 'internal' AS edge_type, 0 AS failure,
       CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
FROM events"""

ORACLES["explode_multi_event"] = f"""
SELECT CASE WHEN event_id % 3 = 0 THEN {UUID} ELSE concat(event_id, '-', i) END AS uuid, event_type AS event, i
FROM (SELECT event_id, event_type, unnest(range(0, event_id % 3 + 1)) AS i FROM events)"""

ORACLES["quarantine_rows"] = f"""
SELECT 'Unknown' AS event, uuid, event_time, edge_type, 1 AS failure, count(*) AS n FROM (
  SELECT CASE WHEN event_id % 5 = 0 OR event_id % 3 < 2 THEN 'error' ELSE concat('u', event_id) END AS uuid,
         CASE WHEN event_id % 5 = 0 THEN 0 ELSE {SECONDS} END AS event_time,
         CASE WHEN event_id % 5 = 0 THEN '' ELSE 'internal' END AS edge_type
  FROM events) GROUP BY uuid, event_time, edge_type"""

ORACLES["fragment_prefilter"] = """
SELECT event_id FROM (
  SELECT event_id, to_base64(encode(concat('{"event":"', event_type, '","properties":', props, '}'))) AS b FROM events)
WHERE contains(b, to_base64(encode(substr('purchase', 1, 6))))
   OR contains(b, to_base64(encode(substr('purchase', 2, 6))))
   OR contains(b, to_base64(encode(substr('purchase', 3, 6))))"""

ORACLES["cast_int_bigint"] = _literals(d.INT_LITERALS) + f"""
, nums AS (SELECT *, CASE WHEN regexp_full_match(txt, '[+-]?[0-9]+')
                          THEN TRY_CAST(regexp_replace(txt, '^[+]', '') AS BIGINT) END AS b FROM lits)
SELECT {UUID} AS uuid,
       CASE WHEN b BETWEEN -2147483648 AND 2147483647 THEN 0 ELSE 6 END AS status,
       CASE WHEN b BETWEEN -2147483648 AND 2147483647 THEN CAST(b AS VARCHAR) END AS int_text,
       CAST(b AS VARCHAR) AS bigint_text
FROM nums"""

ORACLES["cast_float"] = _literals(d.FLOAT_LITERALS) + f"""
, nums AS (SELECT *, CASE WHEN regexp_full_match(txt, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
                               AND txt NOT LIKE '%e400' THEN TRY_CAST(txt AS DOUBLE) END AS f FROM lits)
SELECT {UUID} AS uuid, CASE WHEN f IS NULL AND txt <> 'nan' THEN 6 ELSE 0 END AS status,
       CASE WHEN abs(f) < 1e-299 THEN 0.0 ELSE f END AS value,
       CASE WHEN txt = 'nan' THEN true WHEN f IS NOT NULL THEN false END AS is_empty
FROM nums"""

ORACLES["cast_bool"] = _literals(d.BOOL_LITERALS) + f"""
SELECT {UUID} AS uuid, CASE WHEN lit IN ('true', 'false', '1', '0') THEN 0 ELSE 6 END AS status,
       CASE WHEN lit IN ('true', '1') THEN 'true' WHEN lit IN ('false', '0') THEN 'false' END AS bool_text
FROM lits"""

ORACLES["cast_varchar"] = _literals(d.VARCHAR_LITERALS) + f"""
SELECT {UUID} AS uuid, CASE WHEN quoted THEN 0 ELSE 6 END AS status,
       CASE WHEN quoted THEN replace(replace(txt, concat(chr(92), 't'), chr(9)), concat(chr(92), 'n'), chr(10)) END AS varchar_text
FROM lits"""


def _unix(shown: str) -> str:
    return f"""
WITH m AS (SELECT event_id, epoch_us(ts) + (event_id % 12) * 2592000000000 AS us FROM events),
d AS (SELECT event_id, CAST(concat(us // 1000000, '.', lpad(CAST(us % 1000000 AS VARCHAR), 6, '0')) AS DOUBLE) AS d FROM m),
p AS (SELECT event_id, CAST(trunc(d) AS BIGINT) AS s, CAST(trunc((d - trunc(d)) * 1e9) AS BIGINT) // 1000000 AS ms FROM d)
SELECT {UUID} AS uuid, 0 AS status,
       concat(strftime({shown}, '%Y-%m-%d %H:%M:%S'),
              CASE WHEN ms = 0 THEN '' ELSE rtrim(concat('.', lpad(CAST(ms AS VARCHAR), 3, '0')), '0') END) AS time_text
FROM p"""


ORACLES["cast_unix_utc"] = _unix("make_timestamp(s * 1000000)")
ORACLES["cast_unix_wall_clock"] = _unix(
    "(make_timestamp(s * 1000000) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles'"
)

ORACLES["cast_layout_ts"] = f"""
SELECT {UUID} AS uuid, 6 AS status, {TIME_TEXT} AS iso,
       strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS short,
       strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS named, CAST(NULL AS VARCHAR) AS rejected
FROM events"""

ORACLES["server_overrides"] = f"""
SELECT {UUID} AS uuid, CASE WHEN event_id % 3 = 1 THEN 0 ELSE 6 END AS status, {TIME_TEXT} AS time_text,
       CASE event_id % 3 WHEN 1 THEN '2013-10-01 00:00:02' WHEN 2 THEN '2013-10-01 00:00:03' END AS client_time_text,
       CASE event_id % 3 WHEN 0 THEN {DOTTED} WHEN 1 THEN '9.9.9.9' END AS ip,
       CASE WHEN event_id % 3 = 1 THEN 'own' WHEN event_id % 2 = 0 THEN 'Test Browser' END AS user_agent
FROM events"""

ORACLES["typed_table"] = f"""
SELECT {UUID} AS uuid, {TIME_TEXT} AS time_utc, user_id, value, event_type AS kind, event_id % 2 = 0 AS even,
       CASE WHEN event_id % 7 <> 0 THEN CAST(regexp_extract(props, '[0-9]+') AS INTEGER) END AS k, '10.0.0.1' AS ip,
       event_type AS event
FROM events"""

MIXED = """
WITH mixed AS (SELECT *,
  CASE WHEN event_id % 9 = 0 THEN 1 WHEN event_id % 9 = 1 THEN 5
       WHEN event_type NOT IN ('view', 'click', 'purchase') THEN 2
       WHEN event_id % 9 = 2 THEN 8 WHEN event_id % 9 = 3 THEN 5 WHEN event_id % 9 = 4 THEN 6 ELSE 0 END AS status,
  CASE WHEN event_id % 9 = 0 THEN 'Unknown' WHEN event_id % 9 = 1 THEN '' ELSE event_type END AS event,
  CASE WHEN event_id % 10 < 8 THEN 'internal' WHEN event_id % 10 = 8 THEN 'external' ELSE 'odd' END AS edge_type
  FROM events),
filed AS (SELECT *, CASE WHEN status IN (1, 5, 8) THEN 'Unknown' ELSE event END AS category FROM mixed) """

ORACLES["classify_status"] = MIXED + f"""
SELECT CASE WHEN status = 8 THEN 'error' ELSE {UUID} END AS uuid, event, category,
       CASE WHEN status IN (0, 6) OR (status = 5 AND event <> '') THEN 3 ELSE 0 END AS version, status
FROM filed"""

ORACLES["stream_classify_status"] = ORACLES["classify_status"]

ORACLES["status_counts"] = MIXED + """
SELECT CASE status WHEN 0 THEN 'Success' WHEN 1 THEN 'Malformed Data' WHEN 2 THEN 'Untracked Event'
                   WHEN 5 THEN 'Empty Request' WHEN 6 THEN 'Missing One or More Columns'
                   WHEN 8 THEN 'Panicked in Processing' END AS status_text, count(*) AS n
FROM filed GROUP BY 1"""

ORACLES["event_success_fail"] = MIXED + """
SELECT category, count(*) FILTER (status IN (0, 6)) AS success, count(*) FILTER (status NOT IN (0, 6)) AS fail
FROM filed GROUP BY category"""

ORACLES["column_outcomes"] = MIXED + """
SELECT event, outcome, count(*) AS n FROM (
  SELECT event, 'success' AS outcome FROM filed WHERE status IN (0, 6)
  UNION ALL SELECT event, CASE WHEN status = 0 THEN 'success' ELSE 'skippedColumn' END FROM filed WHERE status IN (0, 6))
GROUP BY event, outcome"""

ORACLES["edge_type_counts"] = MIXED + """
SELECT event, edge_type, count(*) AS n FROM filed
WHERE status IN (0, 6, 8) AND edge_type IN ('internal', 'external') GROUP BY event, edge_type"""

ORACLES["edge_type_mismatch"] = MIXED + """
SELECT event, edge_type, 'internal' AS expected, count(*) AS n FROM filed
WHERE status IN (0, 6, 8) AND edge_type <> 'internal' AND event <> 'purchase' GROUP BY event, edge_type"""

ORACLES["untracked_events"] = MIXED + f"""
SELECT {UUID} AS uuid, concat('{{"event":"', event_type, '","properties":',
       CASE event_id % 9 WHEN 2 THEN 'null' WHEN 3 THEN '[1]' WHEN 4 THEN '{{}}' ELSE replace(props, ' ', '') END, '}}') AS dump
FROM filed WHERE status = 2"""

ORACLES["event_age"] = f"""
WITH a AS (SELECT epoch_us(TIMESTAMP '2024-02-01 00:00:00') // 1000000 - {SECONDS} AS a FROM events),
r AS (SELECT a, row_number() OVER (ORDER BY a) AS i, count(*) OVER () AS n FROM a)
SELECT count(*) AS n, min(a) AS min_age, max(a) AS max_age, min(a) FILTER (i >= n * 0.5) AS median_age, min(a) FILTER (i >= n * 0.99) AS p99_age
FROM r"""

ORACLES["duration_by_status"] = """
WITH d AS (SELECT CAST(event_id % 4 AS INTEGER) AS status, event_id % 977 AS ms FROM events),
r AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY status) AS n FROM d WINDOW w AS (PARTITION BY status ORDER BY ms))
SELECT status, avg(ms) AS avg_ms, max(ms) AS max_ms, min(ms) FILTER (i >= n * 0.5) AS p50_ms, min(ms) FILTER (i >= n * 0.99) AS p99_ms
FROM r GROUP BY status"""

FIELDS = f"""
WITH f AS (SELECT event_id, {TIME_TEXT} AS time_utc, CAST(user_id AS VARCHAR) AS user_id,
  regexp_replace(CAST(value AS VARCHAR), '[.]0$', '') AS value, event_type AS kind,
  CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS even,
  CASE WHEN event_id % 7 <> 0 THEN regexp_extract(props, '[0-9]+') END AS k, '10.0.0.1' AS ip FROM events) """

ORACLES["tsv_line"] = FIELDS + f"""
SELECT {UUID} AS uuid, concat('"', time_utc, '"', chr(9), '"', user_id, '"', chr(9), '"', value, '"', chr(9),
  '"', kind, '"', chr(9), '"', even, '"', chr(9), '"', coalesce(k, ''), '"', chr(9), '"', ip, '"') AS line
FROM f"""

ORACLES["record_fields"] = FIELDS + " UNION ALL ".join(
    f"SELECT {UUID} AS uuid, '{c}' AS name, {c} AS value FROM f WHERE {c} IS NOT NULL"
    for c in ("time_utc", "user_id", "value", "kind", "even", "k", "ip")
)

ORACLES["tsv_text_roundtrip"] = "SELECT doc_id, md5(text) AS text_md5, false AS breaks_line FROM documents"

ORACLES["file_names"] = """
SELECT event_id, event_type AS table_name, CAST(user_id AS INTEGER) AS table_version FROM events"""

BLOCKS = f"WITH blocks AS ({d.BLOCKS_SQL}), addressed AS (SELECT *, {ADDRESS} AS ip_number FROM events) "

ORACLES["geo_enrich"] = BLOCKS + f"""
SELECT {UUID} AS uuid, 0 AS status, coalesce(city, '') AS city, coalesce(country, '') AS country, coalesce(region, '') AS region
FROM addressed LEFT JOIN blocks ON ip_number BETWEEN start_ip AND end_ip"""

ORACLES["asn_enrich"] = BLOCKS + f"""
SELECT {UUID} AS uuid, CASE WHEN asn LIKE 'AS%' THEN 0 ELSE 6 END AS status, coalesce(asn, '') AS asn,
       CASE WHEN asn LIKE 'AS%' THEN regexp_extract(asn, '[0-9]+') END AS asn_number
FROM addressed LEFT JOIN blocks ON ip_number BETWEEN start_ip AND end_ip"""

RESOLVE = f"""
WITH dim AS (SELECT c_name AS login, CASE WHEN c_custkey % 10 <> 9 THEN c_custkey END AS user_id FROM customer),
rows AS (SELECT event_id, CASE WHEN event_id % 5 >= 3
           THEN concat('Customer#', lpad(CAST(user_id * 11 AS VARCHAR), 9, '0')) END AS login FROM events),
found AS (SELECT event_id, rows.login, dim.login IS NOT NULL AS hit, dim.user_id AS found_id
          FROM rows LEFT JOIN dim ON rows.login = dim.login),
told AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN 'id_set' WHEN event_id % 5 = 1 THEN 'bad_lookup_value'
           WHEN event_id % 5 = 2 THEN 'empty_lookup_value' WHEN hit THEN 'hit' ELSE 'fetch_failure' END AS outcome FROM found)
SELECT {UUID} AS uuid, CASE WHEN outcome IN ('id_set', 'hit') THEN 0 ELSE 6 END AS status,
       CASE outcome WHEN 'id_set' THEN {UUID} WHEN 'hit' THEN coalesce(CAST(found_id AS VARCHAR), '') END AS id_text,
       outcome
FROM told"""
ORACLES["resolve_user_id"] = RESOLVE
ORACLES["resolve_user_id_shuffled"] = RESOLVE

ORACLES["login_dimension"] = """
SELECT c_name AS login, CASE WHEN c_custkey % 4 <> 1 THEN c_custkey END AS user_id FROM customer WHERE c_custkey % 4 <> 0"""

RECORDS = """
WITH r AS (SELECT event_id, event_type, CASE WHEN event_id % 3 = 0 THEN 'US' ELSE 'CA' END AS country,
  CASE WHEN event_id % 2 = 0 THEN '' ELSE concat('d', user_id) END AS device, CAST(event_id AS VARCHAR) AS other FROM events),
j AS (SELECT *, concat('"country":"', country, '"') AS jc, concat('"device":"', device, '"') AS jd,
  concat('"other":"', other, '"') AS jo, concat('"event":"', event_type, '"') AS je FROM r) """

ORACLES["project_fields"] = RECORDS + """
SELECT event_type AS event, CASE WHEN event_type = 'view' THEN concat('{', jd, ',', je, ',', jo, '}')
       ELSE concat('{', jc, ',', jd, ',', je, ',', jo, '}') END AS entry
FROM j WHERE event_type IN ('view', 'click')"""

ORACLES["project_rename"] = RECORDS + """
SELECT event_type AS event, CASE WHEN event_type IN ('view', 'signup') THEN concat('{', jo, ',"renamed":"', country, '"}')
       WHEN event_type IN ('click', 'error') THEN concat('{"country":"', other, '","other":"', country, '"}')
       ELSE concat('{"device":"', country, '",', jo, '}') END AS entry FROM j"""

ORACLES["project_exclude_empty"] = RECORDS + """
SELECT event_type AS event, concat('{', jd, '}') AS entry FROM j WHERE device <> ''"""

ORACLES["project_all_fields"] = RECORDS + """
SELECT event_type AS event, concat('{', jc, ',', CASE WHEN device <> '' THEN concat(jd, ',') ELSE '' END, je, ',', jo, '}') AS entry
FROM j"""

ORACLES["stream_filters"] = RECORDS + """
SELECT event_type AS event, concat('{', jo, '}') AS entry FROM j
WHERE (event_type = 'view' AND country = 'US') OR event_type = 'click'
   OR (event_type = 'purchase' AND device IN ('d1', 'd2', 'd3', 'd4', 'd5', ''))"""

ORACLES["wrap_stream_records"] = RECORDS + """
, m AS (SELECT other, concat('{', jc, ',', jd, ',', jo, '}') AS fields FROM j)
SELECT other AS partition_key, concat('{"UUID":"', other, '","Version":1,"Data":', fields, ',"CreatedAt":"2024-01-01 00:00:00.12"}') AS value FROM m
UNION ALL SELECT other, concat('{"UUID":"', other, '","Version":1,"Data":', fields, ',"CreatedAt":""}', chr(10)) FROM m
UNION ALL SELECT other, concat(fields, chr(10)) FROM m"""

ORACLES["pack_glob_roundtrip"] = RECORDS + "SELECT event_type AS event, other, country, device FROM r"

ORACLES["dedupe_by_user"] = """
SELECT event_id, user_id FROM (
  SELECT event_id, user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events)
WHERE before IS NULL OR epoch_us(ts) - epoch_us(before) > 21600000000"""

ORACLES["glob_totals"] = """
WITH g AS (SELECT event_id % 11 <> 0 AS ok, ts, user_id FROM events),
d AS (SELECT ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM g WHERE ok)
SELECT (SELECT count(*) FROM g WHERE ok) AS read, (SELECT count(*) FROM g WHERE NOT ok) AS failed,
       (SELECT count(*) FROM d WHERE epoch_us(ts) - epoch_us(before) <= 21600000000) AS duplicate"""

ORACLES["batch_entries"] = """
SELECT event_type, event_id, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 50 AS batch_no FROM events"""

ORACLES["replace_window_orders"] = """
SELECT o_orderkey, CASE WHEN o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-28'
       THEN o_totalprice + 1000 ELSE o_totalprice END AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_day
FROM orders"""

ORACLES["snapshot_actions"] = """
WITH o AS (SELECT s_suppkey AS k, s_suppkey % 4 AS v FROM supplier),
n AS (SELECT s_suppkey + 20 AS k, (s_suppkey + 20) % 3 AS v FROM supplier)
SELECT coalesce(o.k, n.k) AS s_suppkey, o.v AS old_version, n.v AS new_version,
       CASE WHEN o.k IS NULL THEN 'ADD' WHEN n.k IS NULL THEN 'DROP' WHEN o.v = n.v THEN 'KEEP'
            WHEN o.v > n.v THEN 'REJECT' ELSE 'REPLACE' END AS action
FROM o FULL JOIN n ON o.k = n.k"""

ORACLES["dedupe_sessions"] = ORACLES["dedupe_by_user"]

ORACLES["table_files_roundtrip"] = f"""
SELECT {TIME_TEXT} AS time_utc, user_id, value, event_type AS kind, event_id % 2 = 0 AS even,
       CASE WHEN event_id % 7 <> 0 THEN CAST(regexp_extract(props, '[0-9]+') AS INTEGER) END AS k, '10.0.0.1' AS ip,
       event_type AS event
FROM events"""

ORACLES["manifest_rows"] = """
SELECT event_type AS table_name, 3 AS table_version, count(*) AS n_rows FROM events GROUP BY event_type"""

ORACLES["routed_rows"] = MIXED + """
SELECT CASE WHEN status IN (0, 6) THEN 'tables' WHEN status = 2 THEN 'untracked' ELSE 'failed' END AS route,
       concat(category, '.v', CASE WHEN status IN (0, 6) OR (status = 5 AND event <> '') THEN 3 ELSE 0 END) AS filed_as,
       count(*) AS n
FROM filed GROUP BY 1, 2"""
