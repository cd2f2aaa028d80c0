"""The registered queries as plain SQL over the given tables, written on their own terms."""

from __future__ import annotations

from logtables.plans.catalogue import (
    DAY, DOCUMENT_BATCH_BYTES, EVENT_BATCH_BYTES, FINISHED_BACKUP, HOUR, JAN_1, JAN_5, JAN_12,
    LOG_BATCH_BYTES, MAX_ROW_BYTES, MINUTE, RUN_ID, UNFINISHED_BACKUP)
from logtables.plans.inputs import BUCKET, OTHER_HASH

ORACLE: dict[str, str] = {}

CORE = """
core AS (
  SELECT event_id, cast(event_id AS varchar) AS request_id, epoch_us(ts) AS start_time_usec,
         epoch_us(ts) + ((event_id * 7) % 180) * 1000000 AS arrival_usec,
         CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 201 ELSE 200 END AS http_status,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
         'HTTP/1.1' AS http_version, concat('i', user_id % 7) AS instance_key, value AS cost,
         event_id % 1000 AS mcycles, (event_id % 100 = 0) AS loading_request,
         (event_id % 13) * 1000 AS pending_time_usec,
         cast(round(value * 1000) AS bigint) AS latency_usec,
         CASE WHEN user_id % 5 = 0 THEN '' ELSE concat('user', user_id) END AS nickname,
         concat('10.0.', user_id % 256, '.', event_id % 256) AS ip,
         concat('ua', user_id % 11) AS user_agent, concat('v', user_id % 3) AS version_id,
         CASE WHEN event_id % 2 = 0 THEN 'default' ELSE 'worker' END AS module_id,
         list_slice([{'level': event_id % 5, 'message': event_type},
                     {'level': (event_id * 3) % 5, 'message': props}], 1, event_id % 3) AS app_logs
  FROM events)"""

LOGS = CORE + """,
logs AS (
  SELECT core.*, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
         regexp_extract(url, '^https?://[^/]+(.*)$', 1) AS resource,
         cast(length(html) AS bigint) AS response_size
  FROM core JOIN pages ON page_id = event_id % (SELECT count(*) FROM pages))"""

HTTP = ('cast(http_status AS bigint) AS "httpStatus", method, http_version AS "httpVersion", '
        'request_id AS "requestId"')
INSTANCE = 'instance_key AS "instanceKey"'
PERFORMANCE = ('cost, response_size AS "responseSize", mcycles, '
               'loading_request AS "loadingRequest", pending_time_usec AS "pendingTimeUsec", '
               'latency_usec AS "latencyUsec"')
TIMESTAMP = 'start_time_usec AS "timestamp"'
PATH = "split_part(resource, '?', 1)"
URL = f"host, {PATH} AS path, resource"
USER = 'nickname, ip, user_agent AS "userAgent"'
VERSION = 'version_id AS "versionId", module_id AS "moduleId"'
BASIC = ", ".join([HTTP, INSTANCE, PERFORMANCE, TIMESTAMP, URL, USER, VERSION])
NO_PAGE = ", ".join([HTTP, INSTANCE, TIMESTAMP, USER, VERSION])


def window(ms: int) -> str:
    return f"start_time_usec // 1000 // {ms} * {ms}"


def core(sql: str) -> str:
    return f"WITH {CORE}\n{sql}"


def logs(sql: str) -> str:
    return f"WITH {LOGS}\n{sql}"


ORACLE["scan_log_range"] = core(f"""
SELECT request_id, start_time_usec, http_status, method, cost FROM core
WHERE start_time_usec >= {JAN_5}000 AND start_time_usec < {JAN_12}000""")

ORACLE["app_log_lines"] = core("""
SELECT request_id, line, entry.level AS level, entry.message AS message FROM (
  SELECT request_id, unnest(range(len(app_logs))) AS line, unnest(app_logs) AS entry FROM core)
UNION ALL
SELECT request_id, NULL, NULL, NULL FROM core WHERE len(app_logs) = 0""")

# Field extraction.

ORACLE["fields_http"] = core(f"SELECT {HTTP} FROM core")
ORACLE["fields_instance"] = core(f"SELECT request_id, {INSTANCE} FROM core")
ORACLE["fields_performance"] = logs(f"SELECT request_id, {PERFORMANCE} FROM logs")
ORACLE["fields_timestamp"] = core(f"SELECT request_id, {TIMESTAMP} FROM core")
ORACLE["fields_url"] = logs(f"SELECT request_id, {URL} FROM logs")
ORACLE["fields_user"] = core(f"SELECT request_id, {USER} FROM core")
ORACLE["fields_version"] = core(f"SELECT request_id, {VERSION} FROM core")
ORACLE["fields_basic"] = logs(f"SELECT {BASIC} FROM logs")

KEPT = """len([x FOR x IN app_logs IF x.level >= 1]) > 0
  AND http_status <> 500 AND (nickname = '' OR nickname <> 'user3')"""
ORACLE["export_rows"] = logs(f"SELECT {window(DAY)} AS window_start, {BASIC} FROM logs WHERE {KEPT}")

ORACLE["format_values"] = core("""
SELECT cast(event_id AS varchar) AS "idText", cast(cost AS varchar) AS "costText",
       CASE WHEN loading_request THEN 'true' ELSE 'false' END AS "loadingText",
       start_time_usec // 1000 AS "startedAt",
       start_time_usec // 86400000000 * 86400000 AS "startedOn",
       cast(http_status AS bigint) AS status, cast(mcycles AS double) AS "mcyclesFloat",
       latency_usec > 100000 AS "isSlow" FROM core""")

ORACLE["custom_fields"] = core("""
SELECT request_id, upper(user_agent) || '@' || left(ip, 4) AS sign, ip AS "clientIp", user_agent AS "clientAgent",
       array_to_string([cast(x.level AS varchar) FOR x IN app_logs], ',') AS levels,
       latency_usec > 100000 AS slow, app_logs[1].message AS "firstMessage",
       cast(substring(user_agent, 3) AS bigint) AS "agentNumber" FROM core""")

# Filters.

ORACLE["min_level"] = core("""
SELECT request_id, len(app_logs) AS line_count FROM core
WHERE len([x FOR x IN app_logs IF x.level >= 3]) > 0""")

ORACLE["stored_min_level"] = core(f"""
SELECT request_id, start_time_usec FROM core
WHERE len([x FOR x IN app_logs IF x.level >= 3]) > 0
  AND start_time_usec >= {JAN_5}000 AND start_time_usec < {JAN_12}000""")
ORACLE["version_filter"] = core("""
SELECT request_id, version_id, module_id FROM core
WHERE (version_id = 'v0' AND module_id = 'default') OR (version_id = 'v2' AND module_id = 'worker')
""")

ORACLE["skip_predicate"] = core("""
SELECT request_id, http_status, nickname FROM core
WHERE http_status <> 500 AND nickname <> 'user3'""")

ORACLE["required_ok"] = core(f"""
SELECT request_id, {USER}, app_logs[1].message AS "firstMessage" FROM core""")

# Windows.

ORACLE["align_time"] = core(f"""
SELECT request_id, offset_ms, cast(trunc(offset_ms / {HOUR}) AS bigint) * {HOUR} AS aligned_ms
FROM (SELECT request_id, start_time_usec // 1000 - {JAN_1 + 15 * DAY} AS offset_ms FROM core)""")

ORACLE["assign_window"] = core(f"""
SELECT request_id, {window(MINUTE)} AS window_start, {window(MINUTE)} + {MINUTE} AS window_end
FROM core""")

PLANNED = f"""
planned AS (
  SELECT DISTINCT first + i * {MINUTE} AS window_start
  FROM (SELECT epoch_ms(ts) // {MINUTE} * {MINUTE} - {MINUTE} AS first FROM events), range(60) t(i))"""
RUNS = f"""
counted AS (
  SELECT epoch_us(ts) // 1000 // {MINUTE} * {MINUTE} AS window_start, count(*) AS row_count
  FROM events GROUP BY 1),
runs AS (
  SELECT concat(config, '_', window_start, '_', window_start + {MINUTE}) AS run_id, config,
         window_start, window_start + {MINUTE} AS window_end, row_count, status
  FROM (SELECT *, CASE WHEN window_start // {MINUTE} % 7 = 0 THEN 'jobs' ELSE 'web' END AS config,
               CASE WHEN window_start // {MINUTE} % 5 = 0 THEN 'failed' ELSE 'done' END AS status
        FROM counted))"""
WINDOW_COLUMNS = (f"window_start, window_start + {MINUTE} AS window_end, "
                  f"window_start + {MINUTE} + 60000 AS runnable_ms")
ORACLE["plan_windows"] = f"WITH {PLANNED} SELECT {WINDOW_COLUMNS} FROM planned"
ORACLE["pending_windows"] = f"""WITH {PLANNED}, {RUNS} SELECT {WINDOW_COLUMNS} FROM planned
WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.window_start = planned.window_start
                  AND config = 'web' AND status = 'done')"""
RECORDED = f"""
recorded AS (
  SELECT concat('daily_', w, '_', w + {DAY}) AS run_id, 'daily' AS config, w AS window_start,
         w + {DAY} AS window_end, count(began) AS row_count, 'done' AS status
  FROM (SELECT unnest(range(min(began), max(began) + {DAY}, {DAY})) AS w
        FROM (SELECT {window(DAY)} AS began FROM core))
       LEFT JOIN (SELECT {window(DAY)} AS began FROM core) ON began = w GROUP BY w
  UNION ALL
  SELECT concat('load_', kind, '_{JAN_5}'), kind, {JAN_5}, {JAN_5}, n, 'done'
  FROM (SELECT 'customer' AS kind, count(*) AS n FROM customer
        UNION ALL SELECT 'supplier', count(*) FROM supplier
        UNION ALL SELECT 'part', count(*) FROM part))"""
ORACLE["run_list"] = f"WITH {CORE}, {RECORDED} SELECT * FROM recorded"
ORACLE["run_lookup"] = f"WITH {CORE}, {RECORDED} SELECT * FROM recorded WHERE run_id = '{RUN_ID}'"

ORACLE["rows_per_window"] = core(f"""
SELECT {window(HOUR)} AS window_start, count(*) AS row_count FROM core GROUP BY 1""")

ON_TIME = f"arrival_usec <= ({window(MINUTE)} + {MINUTE} + 60000) * 1000"
ORACLE["on_time_rows"] = core(f"""
SELECT request_id, start_time_usec, arrival_usec FROM core WHERE {ON_TIME}""")
ORACLE["late_rows"] = core(f"""
SELECT request_id, start_time_usec, arrival_usec FROM core WHERE NOT {ON_TIME}""")

# Duplicates, sizes, rejects, batches.

ORACLE["dedup_insert_id"] = core("""
SELECT request_id, attempt, arrival_usec + attempt * 1000000 AS arrival_usec, http_status, nickname
FROM (SELECT *, unnest(range(event_id % 3 + 1)) AS attempt FROM core)
QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY attempt) = 1""")

FIELDS = [("httpStatus", "http_status"), ("method", "method"), ("httpVersion", "http_version"),
          ("requestId", "request_id"), ("instanceKey", "instance_key"), ("cost", "cost"),
          ("responseSize", "response_size"), ("mcycles", "mcycles"),
          ("loadingRequest", "loading_request"), ("pendingTimeUsec", "pending_time_usec"),
          ("latencyUsec", "latency_usec"), ("timestamp", "start_time_usec"), ("host", "host"),
          ("path", PATH), ("resource", "resource"), ("nickname", "nickname"), ("ip", "ip"),
          ("userAgent", "user_agent"), ("versionId", "version_id"), ("moduleId", "module_id")]
PAGE = r"regexp_extract(resource, '^/[a-z]+/([^/?#]*)', 1)"


def row_text(fields: list[tuple[str, str]]) -> str:
    return "concat('{', concat_ws(', ', " + ", ".join(
        f"concat('{n}=', coalesce(cast({e} AS varchar), 'null'))" for n, e in fields) + "), '}')"


BYTES = f"cast(strlen({row_text(FIELDS)}) + 1 AS bigint)"
ORACLE["row_bytes"] = logs(f'SELECT request_id AS "requestId", {BYTES} AS row_bytes FROM logs')

WITH_PAGE = [*FIELDS, ("pageNumber", PAGE)]
CHECKED = f"""
checked AS (
  SELECT {window(DAY)} AS window_start, {BASIC}, {PAGE} AS page_text,
         cast(strlen({row_text(WITH_PAGE)}) + 1 AS bigint) AS row_bytes FROM logs),
rejected AS (
  SELECT *, 'bad_type' AS reason, 'Value of pageNumber is not of type integer' AS message
  FROM checked WHERE NOT regexp_full_match(page_text, '[0-9]+')
  UNION ALL
  SELECT *, 'oversize', 'Maximum allowed row size exceeded'
  FROM checked WHERE row_bytes > {MAX_ROW_BYTES})"""


def checked(sql: str) -> str:
    return f"WITH {LOGS}, {CHECKED}\n{sql}"


ORACLE["valid_rows"] = checked(f"""
SELECT * EXCLUDE (page_text, row_bytes), cast(page_text AS bigint) AS "pageNumber" FROM checked
WHERE regexp_full_match(page_text, '[0-9]+') AND row_bytes <= {MAX_ROW_BYTES}""")
ORACLE["reject_rows"] = checked("""
SELECT window_start, "requestId" AS request_id, path, row_bytes, reason, message FROM rejected""")
ORACLE["reject_reason_counts"] = checked("""
SELECT reason || '~' || message AS reason, count(*) AS error_count FROM rejected GROUP BY 1""")
ORACLE["oversize_field_lengths"] = checked(
    "SELECT request_id, path, field, chars FROM (" + "\nUNION ALL\n".join(
        f"""SELECT "requestId" AS request_id, path, '{name}' AS field,
        length(cast({'page_text' if name == 'pageNumber' else f'"{name}"'} AS varchar)) AS chars
        FROM rejected WHERE reason = 'oversize'""" for name, _ in WITH_PAGE) + ")")


def batches(keyed: str, group: str, columns: str, limit: int, result: str) -> str:
    """Greedy batches row by row: a recursive walk over each group."""
    return f"""WITH RECURSIVE {keyed},
walk AS (
  SELECT *, cast(2 + row_bytes > {limit} AS bigint) AS batch,
         CASE WHEN 2 + row_bytes > {limit} THEN row_bytes ELSE 2 + row_bytes END AS running
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.*, w.batch + cast(w.running + n.row_bytes > {limit} AS bigint),
         CASE WHEN w.running + n.row_bytes > {limit} THEN n.row_bytes
              ELSE w.running + n.row_bytes END
  FROM walk w JOIN numbered n ON n.{group} = w.{group} AND n.rn = w.rn + 1),
batched AS (SELECT {columns}, row_bytes, batch FROM walk)
{result}"""


DOCUMENTS = """numbered AS (
  SELECT doc_id, lang, cast(strlen(text) + 1 AS bigint) AS row_bytes,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents)"""
ORACLE["byte_batches"] = batches(DOCUMENTS, "lang", "doc_id, lang", DOCUMENT_BATCH_BYTES,
                                 "SELECT * FROM batched")
ORACLE["byte_batch_sizes"] = batches(
    DOCUMENTS, "lang", "doc_id, lang", DOCUMENT_BATCH_BYTES, """
SELECT lang, batch, count(*) AS row_count, cast(sum(row_bytes) AS bigint) AS total_bytes
FROM batched GROUP BY lang, batch""")
ORACLE["byte_batches_by_time"] = batches("""numbered AS (
  SELECT event_id // 50 AS at_usec, event_id, cast(strlen(props) + 1 AS bigint) AS row_bytes,
         row_number() OVER (PARTITION BY event_id // 50 ORDER BY event_id) AS rn FROM events)""",
    "at_usec", "at_usec, event_id", EVENT_BATCH_BYTES, "SELECT * FROM batched")
ORACLE["export_batches"] = batches(LOGS + f""",
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY "timestamp", "requestId") AS rn
  FROM (SELECT {window(DAY)} AS window_start, {TIMESTAMP}, request_id AS "requestId",
               {BYTES} AS row_bytes FROM logs))""", "window_start",
    'window_start, "timestamp", "requestId"', LOG_BATCH_BYTES, "SELECT * FROM batched")

# Keys, text, schemas.

NAMES_AND_TYPES = [
    ("httpStatus", "integer"), ("method", "string"), ("httpVersion", "string"),
    ("requestId", "string"), ("instanceKey", "string"), ("cost", "float"),
    ("responseSize", "integer"), ("mcycles", "integer"), ("loadingRequest", "boolean"),
    ("pendingTimeUsec", "integer"), ("latencyUsec", "integer"), ("timestamp", "integer"),
    ("host", "string"), ("path", "string"), ("resource", "string"), ("nickname", "string"),
    ("ip", "string"), ("userAgent", "string"), ("versionId", "string"), ("moduleId", "string")]
BASIC_HASH = "left(md5('" + "".join(n + t for n, t in NAMES_AND_TYPES) + "'), 6)"
MINUTES = f"""
minutes AS (
  SELECT start_ms, start_ms + {MINUTE} AS end_ms, schema_hash
  FROM (SELECT DISTINCT epoch_ms(ts) // {MINUTE} * {MINUTE} AS start_ms FROM events),
       (SELECT {BASIC_HASH} AS schema_hash UNION ALL SELECT '{OTHER_HASH}')),
keyed AS (
  SELECT *, printf('log_%s_%020d_%020d', schema_hash, start_ms, end_ms) AS key FROM minutes)"""
ORACLE["log_keys"] = f"""WITH {MINUTES}
SELECT key AS log_key, key || '.schema' AS schema_key FROM keyed"""
ORACLE["key_end_ms"] = f"""WITH {MINUTES}
SELECT concat(key, repeat('_', length(key) % 2 + ascii(key[5:5]) % 2)) AS key, end_ms FROM keyed"""
ORACLE["manifest_range"] = f"""WITH {MINUTES}
SELECT key, 'gs://{BUCKET}/' || key AS uri FROM keyed
WHERE schema_hash = {BASIC_HASH} AND start_ms >= {JAN_5} AND start_ms < {JAN_12}"""
ORACLE["manifest_schemas"] = f"""WITH {MINUTES}
SELECT key || '.schema' AS key, 'gs://{BUCKET}/' || key AS uri FROM keyed
WHERE schema_hash = '{OTHER_HASH}' AND start_ms >= {JAN_5} AND start_ms < {JAN_12}"""


def quoted(value: str) -> str:
    return (f"'\"' || replace(replace(replace({value}, '\"', '\"\"'), chr(13) || chr(10), chr(13)), "
            "chr(10), chr(13)) || '\"'")


ORACLE["csv_lines"] = "SELECT doc_id, " + " || ',' || ".join(
    quoted(c) for c in ("cast(doc_id AS varchar)", "lang", "source", "text")
) + " AS line FROM documents"

FIELD_TABLE = """
defaults(ord, name, type) AS (VALUES """ + ", ".join(
    f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(NAMES_AND_TYPES)) + """),
field_table AS (
  SELECT c_name AS set_name, cast(ord AS bigint) AS ord, name,
         CASE WHEN c_nationkey % 3 = 0 THEN upper(type) ELSE type END AS type, false AS repeated
  FROM customer, defaults
  UNION ALL
  SELECT c_name, 20, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'path' ELSE lower(c_mktsegment) END,
         'string', c_nationkey % 2 = 0 FROM customer)"""
ORACLE["schema_hash"] = f"""WITH {FIELD_TABLE}
SELECT set_name, left(md5(string_agg(name || type, '' ORDER BY ord)), 6) AS schema_hash
FROM field_table GROUP BY set_name"""
ORACLE["duplicate_fields"] = f"""WITH {FIELD_TABLE}
SELECT set_name, name, count(*) AS uses FROM field_table GROUP BY 1, 2 HAVING count(*) > 1"""
ORACLE["schema_fields"] = f"""WITH {FIELD_TABLE}
SELECT set_name, ord, name, lower(type) AS type,
       CASE WHEN repeated THEN 'REPEATED' ELSE 'NULLABLE' END AS mode FROM field_table"""

# Backups.

BACKUPS = """
backup_info AS (
  SELECT concat('nightly', epoch_ms(o_orderdate), '_',
                CASE o_orderstatus WHEN 'F' THEN 'x' ELSE '' END,
                strftime(o_orderdate, '%Y_%m_%d'), '_', o_orderkey) AS name,
         CASE WHEN o_orderkey % 3 <> 0 THEN epoch_ms(o_orderdate) + 300000 END AS complete_time,
         CASE WHEN o_orderpriority <> '5-LOW'
              THEN concat('/gs/bucket/gs/', o_orderkey, '.backup_info') END AS gs_handle
  FROM orders)"""


def first_backup(at: int) -> str:
    return f"""WITH {BACKUPS}, found AS (
SELECT * FROM backup_info WHERE name >= 'nightly{at}_' AND name <= 'nightly{at}_Z'
ORDER BY name LIMIT 1)"""


ORACLE["backup_lookup"] = first_backup(UNFINISHED_BACKUP) + " SELECT * FROM found"
ORACLE["backup_ready"] = (first_backup(FINISHED_BACKUP)
                          + " SELECT * FROM found WHERE gs_handle IS NOT NULL")
ORACLE["backup_lookups"] = f"""WITH {BACKUPS},
days AS (SELECT DISTINCT concat('nightly', epoch_ms(o_orderdate), '_') AS p FROM orders),
prefixes AS (SELECT p AS prefix FROM days UNION SELECT p || 'x' FROM days UNION SELECT left(p, 11) FROM days
             UNION SELECT p || '~' FROM days),
-- A name lies in the range of a prefix only if it begins with it.
cut AS (SELECT DISTINCT length(prefix) AS n FROM prefixes),
found AS (SELECT prefix, name, complete_time, gs_handle FROM backup_info, cut
          JOIN prefixes ON left(name, n) = prefix AND length(prefix) = n WHERE name <= prefix || 'Z'
          QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY name, complete_time NULLS FIRST, gs_handle NULLS FIRST) = 1)
SELECT prefix, name, complete_time, gs_handle FROM prefixes LEFT JOIN found USING (prefix)"""
ORACLE["kind_uris"] = f"""WITH {BACKUPS}, kinds(kind) AS (VALUES ('customer'), ('supplier'), ('part'))
SELECT name, kind,
       replace(replace(gs_handle, '/gs/', 'gs://'), 'backup_info', kind || '.backup_info') AS uri,
       kind || '{FINISHED_BACKUP}' AS table_name
FROM backup_info, kinds WHERE gs_handle IS NOT NULL"""

# Tables.

MONTH = "strftime(make_timestamp(start_time_usec), '%Y%m')"
ORACLE["export_table"] = logs(f"""
SELECT {BASIC}, {MONTH} AS table_id, {window(DAY)} AS window_start FROM logs WHERE {KEPT}""")
ORACLE["export_ledger"] = checked(f"""
SELECT concat('checked_', w, '_', w + {DAY}) AS run_id, 'checked' AS config, w AS window_start,
       w + {DAY} AS window_end, count(window_start) AS row_count, 'done' AS status
FROM (SELECT unnest(range(min(began), max(began) + {DAY}, {DAY})) AS w
      FROM (SELECT {window(DAY)} AS began FROM core)) LEFT JOIN checked ON window_start = w
     AND regexp_full_match(page_text, '[0-9]+') AND row_bytes <= {MAX_ROW_BYTES}
GROUP BY w""")
ORACLE["route_tables"] = core(f"""
SELECT strftime(make_timestamp(start_time_usec), '%Y%m%d') AS table_id,
       {window(DAY)} AS window_start, request_id AS "requestId" FROM core""")
LONG = f"core AS (SELECT * REPLACE ({JAN_1 * 1000} + (start_time_usec - {JAN_1 * 1000}) * 4 AS start_time_usec) FROM short)"
ORACLE["create_tables"] = f"""WITH {CORE.replace("core AS", "short AS", 1)}, {LONG}
SELECT {MONTH} AS table_id, {NO_PAGE}, {window(DAY)} AS window_start FROM core"""
ORACLE["export_gaps"] = core(f"""
SELECT {window(DAY)} AS window_start, request_id AS "requestId" FROM core
WHERE {window(DAY)} // {DAY} % 2 = 0""")
ARRIVED = window(DAY).replace("start_time_usec", "arrival_usec")
ORACLE["export_other_time"] = core(
    f'SELECT {ARRIVED} AS window_start, request_id AS "requestId" FROM core')
ORACLE["export_rerun"] = core(f"""
SELECT {window(DAY)} AS window_start, request_id AS "requestId" FROM core
WHERE http_status <> 500 AND nickname <> 'user3'""")

ORACLE["export_concurrent"] = core(f"""
SELECT {window(DAY)} AS window_start, request_id AS "requestId" FROM core""")
ORACLE["export_takeover"] = core(f"""
SELECT {window(DAY)} AS window_start, request_id AS "requestId" FROM core
WHERE {window(DAY)} // {DAY} % 3 <> 0""")
ORACLE["export_null_ids"] = core(f"""
SELECT {window(DAY)} AS window_start, start_time_usec AS "timestamp",
       CASE WHEN event_id % 2 = 0 THEN request_id END AS "requestId" FROM core
CROSS JOIN range(0, 3) attempts(n) WHERE n <= CASE event_id % 2 WHEN 0 THEN 0 ELSE event_id % 3 END""")
ORACLE["export_vacuum"] = core(f"""
SELECT {window(DAY)} AS window_start, count(*) AS row_count, cast(1 AS bigint) AS removed
FROM core GROUP BY 1""")
ORACLE["ledger_compacted"] = core(f"""
SELECT concat('hourly_', w, '_', w + {HOUR}) AS run_id, 'hourly' AS config, w AS window_start,
       w + {HOUR} AS window_end, count(*) AS row_count, 'done' AS status
FROM (SELECT {window(HOUR)} AS w FROM core) GROUP BY w""")

ORACLE["snapshot_backup"] = """
SELECT 'customer' AS kind, count(*) AS row_count FROM customer
UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'part', count(*) FROM part"""
ORACLE["snapshot_read"] = "SELECT * FROM customer"


def entity_rows(suffix: str = "") -> str:
    return f"""
SELECT 'customer{suffix}' AS table_name, c_custkey AS entity_key, c_name AS entity_name,
       c_acctbal AS amount FROM customer
UNION ALL SELECT 'supplier{suffix}', s_suppkey, s_name, s_acctbal FROM supplier
UNION ALL SELECT 'part{suffix}', p_partkey, p_name, p_retailprice FROM part"""


ORACLE["snapshot_replace"] = entity_rows()
ORACLE["snapshot_history"] = f"{entity_rows(str(JAN_1))} UNION ALL {entity_rows(str(JAN_5))}"

# Streams.

ORACLE["stream_dedup"] = core("SELECT request_id, start_time_usec, http_status, ip FROM core")
ORACLE["stream_export"] = core(f"""
SELECT {NO_PAGE}, cast(nickname[5:] AS bigint) AS "userNumber", {MONTH} AS table_id,
       {window(DAY)} AS window_start FROM core WHERE nickname <> '' AND event_id % 11 <> 0""")
ORACLE["stream_rejects"] = core(f"""
SELECT {window(DAY)} AS window_start, request_id, 'bad_type' AS reason,
       'Value of userNumber is not of type integer' AS message FROM core WHERE nickname = ''
UNION ALL
SELECT {window(DAY)}, request_id, 'oversize', 'Maximum allowed row size exceeded'
FROM core WHERE event_id % 11 = 0""")

# Nested values.

ORACLE["nested_fields"] = core("""
SELECT request_id AS "requestId", ip, user_agent AS "userAgent",
       cast(nickname[5:] AS bigint) AS number, replace(ip, '.', ',') AS octets,
       event_id // 2 AS half
FROM core WHERE nickname <> '' AND event_id % 7 <> 0 AND event_id % 2 = 0""")
ORACLE["nested_rejects"] = core("""
SELECT request_id, 'bad_type' AS reason, 'Value of ' || what AS message FROM (
  SELECT request_id, 'client is not of type record' AS what FROM core WHERE nickname = ''
  UNION ALL SELECT request_id, 'octets is not of type integer' FROM core WHERE event_id % 7 = 0
  UNION ALL SELECT request_id, 'half is not of type integer' FROM core WHERE event_id % 2 = 1)""")

# Streams whose windows close.

ARRIVED = f"""{CORE},
windowed AS (SELECT *, {window(DAY)} AS w, ({window(DAY)} + {DAY + MINUTE}) * 1000 AS closes FROM core),
closed AS (SELECT w, request_id FROM windowed
           WHERE arrival_usec <= closes AND closes < (SELECT max(arrival_usec) FROM core))"""
ORACLE["stream_windows"] = f"""WITH {ARRIVED}
SELECT concat('daily_', w, '_', w + {DAY}) AS run_id, w AS window_start, count(*) AS row_count
FROM closed GROUP BY w"""
ORACLE["stream_closed_rows"] = f"""WITH {ARRIVED}
SELECT w AS window_start, request_id AS "requestId" FROM closed"""
ORACLE["stream_late"] = f"""WITH {ARRIVED}
SELECT request_id, w AS window_start, (arrival_usec - closes) // 1000 AS late_by_ms,
       'arrived_late' AS reason FROM windowed WHERE arrival_usec > closes"""
ORACLE["stream_batches"] = ORACLE["byte_batches"]
