"""Reference SQL of the queries that run whole jobs."""

from __future__ import annotations

from eventloom.plans.oracles import RECORDS

ORACLES: dict[str, str] = {}

ORACLES["stream_dedupe"] = """
SELECT concat('u', user_id) AS uuid, event_type AS event, epoch_us(ts) AS received_at FROM (
  SELECT user_id, event_type, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events)
WHERE before IS NULL OR epoch_us(ts) - epoch_us(before) > 21600000000"""

ALL_FIELDS = "concat('{{', jc, ',', CASE WHEN device <> '' THEN concat(jd, ',') ELSE '' END, CASE WHEN {named} THEN concat(je, ',') ELSE '' END, jo, '}}')"

ORACLES["stream_runtime_sinks"] = RECORDS + f"""
, b AS (SELECT *, event_id % 4 AS batch_id FROM j)
SELECT batch_id, 'alpha' AS stream, concat('{{"land":"', country, '",', jo, '}}') AS data FROM b WHERE batch_id = 0 AND event_type = 'view'
UNION ALL SELECT batch_id, 'alpha', concat('{{', CASE WHEN device <> '' THEN concat(jd, ',') ELSE '' END, jo, '}}') FROM b
  WHERE batch_id > 0 AND event_type = 'view'
UNION ALL SELECT batch_id, 'alpha', concat('{{', jo, '}}') FROM b WHERE batch_id > 0 AND event_type = 'purchase'
UNION ALL SELECT batch_id, 'beta', {ALL_FIELDS.format(named="true")} FROM b WHERE batch_id < 2 AND event_type = 'click'
UNION ALL SELECT batch_id, 'beta', concat('{{', jc, '}}') FROM b WHERE batch_id = 3 AND event_type = 'error'
UNION ALL SELECT batch_id, 'gamma', concat('{{', jc, ',', jo, '}}') FROM b WHERE batch_id > 0 AND event_type = 'signup'"""

ORACLES["fan_out_streams"] = RECORDS + f"""
, n AS (SELECT n_name AS stream, n_nationkey AS k, n_nationkey % 2 = 0 AS named FROM nation),
p AS (SELECT * FROM j, n)
SELECT stream, CASE WHEN k % 5 = 4 THEN {ALL_FIELDS.format(named="named")}
       ELSE concat('{{', jc, ',', CASE WHEN named THEN concat(je, ',') ELSE '' END, '"o', k, '":"', other, '"}}') END AS data
FROM p WHERE event_type = 'view'
UNION ALL SELECT stream, concat('{{', CASE WHEN k % 4 = 0 AND device = '' THEN je WHEN named THEN concat(jd, ',', je) ELSE jd END, '}}')
FROM p WHERE event_type = 'click' AND k % 3 = 0
UNION ALL SELECT stream, {ALL_FIELDS.format(named="named")} FROM p WHERE event_type = 'error' AND k % 3 <> 0"""

WINDOW = "o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-28'"
EMPTIED = "o_orderdate BETWEEN TIMESTAMP '1998-01-15' AND TIMESTAMP '1998-03-10'"

ORACLES["replace_window_versions"] = f"""
SELECT o_orderkey, CASE WHEN {WINDOW} THEN o_totalprice + 1000 ELSE o_totalprice END AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_day
FROM orders WHERE NOT ({EMPTIED})"""

ORACLES["replaced_counts"] = f"""
WITH o AS (SELECT o_orderkey % 2 = 1 AS odd, {WINDOW} AS inside, {EMPTIED} AS emptied FROM orders),
n AS (SELECT count(*) FILTER (inside) AS every, count(*) FILTER (inside AND odd) AS odd, count(*) FILTER (emptied) AS emptied FROM o)
SELECT 'odd' AS run, every AS deleted, odd AS inserted FROM n
UNION ALL SELECT 'again', odd, odd FROM n
UNION ALL SELECT 'none', emptied, 0 FROM n"""

ORACLES["batch_bytes"] = """
WITH RECURSIVE e AS (SELECT event_type, event_id, length(props) + event_id % 90 AS size FROM events),
r AS (SELECT *, row_number() OVER w AS i, sum(size) OVER w AS through FROM e WINDOW w AS (PARTITION BY event_type ORDER BY event_id)),
following AS (
  SELECT a.event_type, a.i, min(b.i) AS j FROM r a JOIN r b
  ON a.event_type = b.event_type AND b.i > a.i AND b.i <= a.i + 500
     AND ((a.event_type <> 'error' AND b.i = a.i + 40) OR b.through - (a.through - a.size) > 500)
  GROUP BY a.event_type, a.i),
starts AS (
  SELECT DISTINCT event_type, CAST(1 AS BIGINT) AS i, CAST(0 AS BIGINT) AS batch_no FROM r
  UNION ALL SELECT s.event_type, f.j, s.batch_no + 1 FROM starts s JOIN following f ON s.event_type = f.event_type AND s.i = f.i)
SELECT r.event_type, r.event_id, r.size, s.batch_no FROM r ASOF JOIN starts s ON r.event_type = s.event_type AND r.i >= s.i"""

ORACLES["stream_age_groups"] = """
WITH RECURSIVE e AS (
  SELECT event_type AS stream, epoch_ms(date_trunc('second', ts)) AS t, concat(lpad(CAST(event_id AS VARCHAR), 9, '0'), repeat('x', event_id % 97)) AS entry,
    CASE event_type WHEN 'view' THEN 21600000 WHEN 'click' THEN 5400000 WHEN 'purchase' THEN 5400000 WHEN 'signup' THEN 86400000 ELSE 3600000 END AS age
  FROM events),
r AS (SELECT *, row_number() OVER w AS i, sum(length(entry)) OVER w AS through FROM e WINDOW w AS (PARTITION BY stream ORDER BY t, entry)),
following AS (
  SELECT a.stream, a.i, min(b.i) AS j, arg_min(b.t >= a.t + a.age, b.i) AS aged FROM r a JOIN r b
  ON a.stream = b.stream AND b.i > a.i AND b.i <= a.i + 9
     AND (b.i = a.i + 9 OR b.through - (a.through - length(a.entry)) > 400 OR b.t >= a.t + a.age)
  GROUP BY a.stream, a.i),
starts AS (
  SELECT DISTINCT stream, CAST(1 AS BIGINT) AS i FROM r
  UNION ALL SELECT s.stream, f.j FROM starts s JOIN following f ON s.stream = f.stream AND s.i = f.i),
latest AS (SELECT max(t) AS t FROM e),
n AS (SELECT stream, max(i) AS n FROM r GROUP BY stream)
SELECT r.stream, coalesce(f.j, n.n + 1) - r.i AS entries,
  (SELECT max(x.through) FROM r x WHERE x.stream = r.stream AND x.i = coalesce(f.j, n.n + 1) - 1) - (r.through - length(r.entry)) AS bytes,
  CASE WHEN f.j IS NULL OR f.aged THEN 'age' ELSE 'size' END AS closed_by, r.entry AS first_entry
FROM starts s JOIN r ON s.stream = r.stream AND s.i = r.i JOIN n ON n.stream = r.stream
LEFT JOIN following f ON f.stream = r.stream AND f.i = r.i, latest
WHERE f.j IS NOT NULL OR r.t + r.age <= latest.t"""

ORACLES["replay_tables"] = """
WITH e AS (SELECT event_type AS event, event_id AS id, ts, date_trunc('second', ts) - INTERVAL 8 HOUR AS wall FROM events),
w AS (SELECT *, wall BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-13' AS inside,
        ts >= TIMESTAMP '2024-01-10 08:00:00' AND ts < TIMESTAMP '2024-01-13 08:00:00' AS logged FROM e)
SELECT event, id, CASE WHEN inside THEN id + 1000 ELSE id END AS v, strftime(wall, '%Y-%m-%d %H:%M:%S') AS time
FROM w WHERE NOT inside OR logged"""

ORACLES["config_tables"] = """
SELECT 'table' AS kind, n_name AS name, concat(n_nationkey % 4, ',', n_name, ',', n_name, '_b') AS value FROM nation
UNION ALL SELECT 'event', n_name, '' FROM nation
UNION ALL SELECT 'metadata', n_name, concat(CASE WHEN n_nationkey % 4 = 0 THEN 'comment' ELSE 'edge_type' END, ':v', n_nationkey % 4) FROM nation"""

ORACLES["sink_configs"] = """
SELECT n_nationkey * 11 AS account, CASE WHEN n_nationkey % 3 = 0 THEN 'firehose' ELSE 'stream' END AS stream_type, n_name AS stream_name,
       CASE WHEN n_nationkey % 2 = 0 THEN 'reader' ELSE '' END AS stream_role, CAST(n_nationkey % 7 AS INTEGER) AS version
FROM nation WHERE n_name NOT IN ('NATION_2', 'NATION_3')"""

ORACLES["payload_forms"] = """
SELECT CAST(event_id AS VARCHAR) AS uuid, event_type AS event, concat('~~~>>>???ÿþ', event_id) AS s FROM events"""

ORACLES["untracked_files"] = """
SELECT event_type AS event, count(*) AS n, CAST(sum(CAST(regexp_extract(props, '[0-9]+') AS BIGINT)) AS BIGINT) AS k
FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1"""

ORACLES["tagged_tables"] = "SELECT -event_id AS n, event_type AS event FROM events"

ORACLES["own_conversions"] = """
SELECT CAST(event_id AS VARCHAR) AS uuid, concat('W', upper(event_type)) AS word,
       CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) ELSE CAST(n_nationkey + 500 AS VARCHAR) END AS id
FROM events LEFT JOIN nation ON n_name = concat('NATION_', user_id % 30)"""

ORACLES["warehouse_records"] = """
SELECT 'w' AS stream, concat('{"other":"a', event_id, '"}') AS data FROM events"""

ORACLES["geo_both_families"] = """
WITH a AS (SELECT event_id, user_id % 30 AS k, event_id % 256 AS b, event_id % 3 = 0 AS four FROM events),
f AS (SELECT a.*, n_name FROM a LEFT JOIN nation ON k = n_nationkey)
SELECT CAST(event_id AS VARCHAR) AS uuid,
  CASE WHEN four AND n_name IS NULL THEN ''
       WHEN four AND k % 2 = 0 AND b BETWEEN 64 AND 200 THEN concat(n_name, '_in')
       WHEN four THEN n_name
       WHEN n_name IS NULL THEN 'ALL'
       WHEN b >= 128 THEN concat(n_name, '_deep')
       ELSE concat(n_name, '_six') END AS city,
  (SELECT count(*) FROM nation WHERE n_nationkey % 2 = 1) AS unreadable
FROM f"""
