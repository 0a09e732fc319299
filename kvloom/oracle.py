"""The registered queries in plain SQL, for a second engine to check.

Written against the test tables themselves, not against what Spark derives.
"""

from __future__ import annotations

from kvloom.fixtures import (
    AS_OF,
    JOB_SECONDS,
    MONTHS_APART,
    OTHER_KEY,
    OTHER_NAME,
    PHASE1_START,
    SAMPLE_ENTITY,
    SECOND_LANDING,
    START_WATERMARK,
)
from kvloom.model import RunOptions

_PAGE = RunOptions().batch_size
_LAG = RunOptions().lag_threshold_ms
_VALUES = "bool_v, str_v, long_v, dbl_v, json_v"
_SOURCE = f"entity_id, key, ts, {_VALUES}"
_HISTORY = f"entity_type, entity_id, key, partition, ts, {_VALUES}"
_LATEST = f"entity_type, entity_id, key, ts, {_VALUES}"


def _uuid(column: str) -> str:
    return f"'00000000-0000-1000-8000-' || lpad(CAST({column} AS VARCHAR), 12, '0')"


_VIEWS = f"""
ts_kv AS (
  SELECT {_uuid("user_id")} AS entity_id,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2
                              WHEN 'purchase' THEN 3 WHEN 'view' THEN 4 ELSE 5 END AS INTEGER) AS key,
         CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts,
         CASE WHEN event_type NOT IN ('click', 'error', 'purchase', 'view') THEN value > 20 END AS bool_v,
         CASE WHEN event_type = 'error' THEN
              CASE event_id % 8 WHEN 0 THEN '42' WHEN 1 THEN '-100' WHEN 2 THEN '3.14'
                   WHEN 3 THEN 'hello' WHEN 4 THEN '' WHEN 5 THEN '9223372036854775808'
                   WHEN 6 THEN '1e5' ELSE '1d' END END AS str_v,
         CASE WHEN event_type = 'view' THEN CAST(floor(value) AS BIGINT) END AS long_v,
         CASE WHEN event_type = 'click' THEN value END AS dbl_v,
         CASE WHEN event_type = 'purchase' THEN props END AS json_v
  FROM events),
ts_kv_latest AS (
  SELECT {_SOURCE} FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_id, key ORDER BY ts DESC) AS n FROM ts_kv)
  WHERE n = 1),
device AS (SELECT {_uuid("c_custkey")} AS id FROM customer WHERE c_custkey % 7 <> 3),
asset AS (SELECT {_uuid("s_suppkey")} AS id FROM supplier),
entity_map AS (
  SELECT id AS entity_id, 'ASSET' AS entity_type FROM asset
  UNION
  SELECT id, 'DEVICE' FROM device WHERE id NOT IN (SELECT id FROM asset)),
key_map AS (
  SELECT DISTINCT CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2
                            WHEN 'purchase' THEN 3 ELSE 4 END AS INTEGER) AS key_id,
         event_type AS key
  FROM events WHERE event_type IN ('click', 'error', 'purchase', 'view')),
named AS (
  SELECT t.entity_id, coalesce(k.key, CAST(t.key AS VARCHAR)) AS key, t.ts, {_VALUES}
  FROM ts_kv t LEFT JOIN key_map k ON t.key = k.key_id),
known AS (SELECT m.entity_type, n.* FROM named n JOIN entity_map m USING (entity_id)),
completed AS (
  SELECT DISTINCT {_uuid("user_id")} AS entity_id FROM events WHERE user_id % 3 = 0)
"""

_MONTH = "CAST(epoch_ms(date_trunc('month', make_timestamp(ts * 1000))) AS BIGINT)"
_INT = r"^[ \t\n\r\f\x0B]*[+-]?[0-9]+[ \t\n\r\f\x0B]*$"
_FLOAT = (
    r"^[ \t\n\r\f\x0B]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t\n\r\f\x0B]*$"
)
_AS_LONG = f"CASE WHEN regexp_matches(str_v, '{_INT}') THEN try_cast(trim(str_v) AS BIGINT) END"
_AS_DOUBLE = (
    f"CASE WHEN {_AS_LONG} IS NULL AND regexp_matches(str_v, '{_FLOAT}')"
    " THEN try_cast(trim(str_v) AS DOUBLE) END"
)
_RETYPED = (
    f"bool_v, CASE WHEN {_AS_LONG} IS NULL AND {_AS_DOUBLE} IS NULL THEN str_v END AS str_v,"
    f" coalesce({_AS_LONG}, long_v) AS long_v, coalesce({_AS_DOUBLE}, dbl_v) AS dbl_v, json_v"
)


def _with(sql: str) -> str:
    return f"WITH {_VIEWS} {sql}"


def _bucket(unit: str, ts: str = "ts") -> str:
    return f"CAST(epoch_ms(date_trunc('{unit}', make_timestamp({ts} * 1000))) AS BIGINT)"


def _bucket_query(expression: str) -> str:
    return _with(f"SELECT entity_id, key, ts, {expression} AS partition FROM ts_kv")


def _history(condition: str = "true") -> str:
    return (
        f"SELECT entity_type, entity_id, key, {_MONTH} AS partition, ts, {_VALUES} "
        f"FROM known WHERE {condition}"
    )


_NEWER = _VALUES.replace("str_v", "coalesce(str_v, '') || '!' AS str_v", 1)


def _refused(condition: str = "true", values: str = _VALUES) -> str:
    return (
        f"SELECT entity_id, CAST(key AS VARCHAR) AS key, ts, {values},"
        " 'UNKNOWN_ENTITY' AS reason FROM ts_kv"
        f" WHERE entity_id NOT IN (SELECT entity_id FROM entity_map) AND {condition}"
    )


def _changed_history() -> str:
    """History whose live part came with other values than the rows before."""
    changed = f"CASE WHEN ts > {START_WATERMARK} THEN coalesce(str_v, '') || '!' ELSE str_v END"
    values = _VALUES.replace("str_v", f"{changed} AS str_v", 1)
    return f"SELECT entity_type, entity_id, key, {_MONTH} AS partition, ts, {values} FROM known"


def _levels(rows: str = "known") -> str:
    """Values after three live batches over the start watermark and one over the second landing."""
    changed = (
        f"CASE WHEN ts > {SECOND_LANDING} THEN coalesce(str_v, '') || '?'"
        f" WHEN ts > {START_WATERMARK} THEN coalesce(str_v, '') || '!' ELSE str_v END"
    )
    values = _VALUES.replace("str_v", f"{changed} AS str_v", 1)
    return f"(SELECT entity_type, entity_id, key, ts, {values} FROM {rows})"


def _late_history() -> str:
    """Keys of several months; the rows of the key without a name came again with other values."""
    number = "CASE key WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'view' THEN 3"
    shift = f"{number} WHEN '{OTHER_KEY}' THEN 4 ELSE 0 END * {MONTHS_APART}"
    changed = f"CASE WHEN key = '{OTHER_KEY}' THEN coalesce(str_v, '') || '!' ELSE str_v END"
    values = _VALUES.replace("str_v", f"{changed} AS str_v", 1)
    return (
        f"SELECT entity_type, entity_id, key, {_MONTH} AS partition, ts, {_VALUES} FROM"
        f" (SELECT entity_type, entity_id, key, ts - {shift} AS ts, {values} FROM known)"
    )


_LAST_KNOWN = f"""
  SELECT {_LATEST} FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_id, key ORDER BY ts DESC) AS n
    FROM known {{where}}) WHERE n = 1"""

_LATEST_OF_KNOWN = f"({_LAST_KNOWN.format(where='')})"

# The type that an id had when there were devices only.
_DEVICE_FIRST = "CASE WHEN entity_id IN (SELECT id FROM device) THEN 'DEVICE' ELSE entity_type END AS entity_type"

_SERIES_TYPES = "entity_type:string entity_id:string key:string"
_VALUE_TYPES = "bool_v:boolean str_v:string long_v:bigint dbl_v:double json_v:string"
_TABLES = {
    "ts_kv_cf": (f"{_SERIES_TYPES} partition:bigint ts:bigint {_VALUE_TYPES}", "SELECT count(*) FROM known"),
    "ts_kv_partitions_cf": (
        f"{_SERIES_TYPES} partition:bigint",
        f"SELECT count(*) FROM (SELECT DISTINCT entity_id, key, {_MONTH} FROM known)",
    ),
    "ts_kv_latest_cf": (
        f"{_SERIES_TYPES} ts:bigint {_VALUE_TYPES}",
        "SELECT count(*) FROM (SELECT DISTINCT entity_id, key FROM known)",
    ),
}
_TARGET_SCHEMA = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, CAST({position} AS INTEGER) AS position,"
    f" '{column.split(':')[0]}' AS column_name, '{column.split(':')[1]}' AS data_type,"
    f" CAST(({count}) AS BIGINT) AS stored_rows"
    for table, (columns, count) in _TABLES.items()
    for position, column in enumerate(columns.split(), 1)
)

_STATUS = f""", totals AS (
  SELECT (SELECT count(*) FROM ts_kv) AS n, (SELECT count(*) FROM known) AS migrated,
    (SELECT count(*) FROM ({_refused()})) AS skipped,
    (SELECT count(DISTINCT entity_id) FROM ({_refused()})) AS skipped_entities,
    (SELECT count(DISTINCT entity_id) FROM known) AS complete,
    (SELECT max(entity_id) FROM known) AS last)
  SELECT CAST(position AS INTEGER) AS position, field, value FROM totals, LATERAL (VALUES
    (1, 'Phase', 'live_sync'),
    (2, 'Started at', strftime(make_timestamp({PHASE1_START} * 1000), '%Y-%m-%d %H:%M:%S') || ' UTC'),
    (3, 'Partitioning', 'MONTHS'),
    (4, 'Cast strings', 'False'),
    (5, 'Total rows', format('{{:,}}', n)),
    (6, 'Migrated rows', format('{{:,}}', migrated)),
    (7, 'Skipped rows', format('{{:,}}', skipped)),
    (8, 'Skipped entities', format('{{:,}}', skipped_entities)),
    (9, 'Completed entities', format('{{:,}}', complete)),
    (10, 'Last entity ID', last),
    (11, 'Done', format('{{:.1f}}', (migrated + skipped) * 100.0 / n) || '%'),
    (12, 'Rows per second', format('{{:,}}', CAST(round_even((migrated + skipped) / {JOB_SECONDS}.0, 0) AS BIGINT))),
    (13, 'Seconds left', '0')) t(position, field, value)"""

_ORDER_TS = "CAST(epoch_us(o_orderdate) // 1000 AS BIGINT)"


def oracle_queries() -> dict[str, str]:
    entity = SAMPLE_ENTITY
    middle = 1_705_276_800_000
    live = f"ts > {START_WATERMARK}"
    refused = _with(_refused())
    pending = "entity_id NOT IN (SELECT entity_id FROM completed)"
    progress = _with(
        "SELECT CAST(count(*) AS BIGINT) AS total_entities,"
        f" CAST(count(*) FILTER ({pending}) AS BIGINT) AS pending_entities,"
        f" CAST(count(*) FILTER (NOT {pending}) AS BIGINT) AS done_entities"
        " FROM (SELECT DISTINCT entity_id FROM ts_kv)"
    )
    page = _with(
        f"SELECT {_SOURCE} FROM ts_kv WHERE entity_id = '{entity}'"
        f" AND (key, ts) > (2, {middle}) ORDER BY key, ts LIMIT {_PAGE}"
    )
    return {
        "entity_progress_bitmaps": progress,
        "stored_entity_page": page,
        "stored_entity_key_page": _with(
            f"SELECT {_SOURCE} FROM ts_kv WHERE entity_id = '{entity}' AND key = 1"
            f" AND ts > {middle} ORDER BY ts LIMIT {_PAGE}"
        ),
        "stored_entities_after": _with(
            f"SELECT DISTINCT entity_id FROM ts_kv WHERE entity_id > '{entity}' ORDER BY entity_id"
        ),
        "entity_map": _with("SELECT entity_id, entity_type FROM entity_map"),
        "key_map": _with("SELECT key_id, key FROM key_map"),
        "key_map_fallback": _with("SELECT key_id, key FROM key_map"),
        "preload_summary": _with(
            "SELECT (SELECT count(*) FROM entity_map) AS entity_count,"
            " (SELECT count(*) FROM key_map) AS key_count,"
            " (SELECT count(*) FROM ts_kv) AS row_count"
        ),
        "source_count": "SELECT count(*) AS row_count FROM events",
        "history_scan": _with(f"SELECT {_SOURCE} FROM ts_kv"),
        "latest_scan": _with(f"SELECT {_SOURCE} FROM ts_kv_latest"),
        "distinct_entities": _with("SELECT DISTINCT entity_id FROM ts_kv_latest"),
        "distinct_entities_fallback": _with("SELECT DISTINCT entity_id FROM ts_kv"),
        "entity_keys": _with(
            "SELECT DISTINCT entity_id, CAST(key AS VARCHAR) AS key FROM ts_kv_latest"
        ),
        "keys_of_entity": _with(
            f"SELECT DISTINCT CAST(key AS VARCHAR) AS key FROM ts_kv_latest"
            f" WHERE entity_id = '{entity}'"
        ),
        "entity_page": _with(
            f"SELECT {_SOURCE} FROM ts_kv WHERE entity_id = '{entity}'"
            f" AND (key, ts) > (2, {middle}) ORDER BY key, ts LIMIT {_PAGE}"
        ),
        "entity_page_min_ts": _with(
            f"SELECT {_SOURCE} FROM ts_kv WHERE entity_id = '{entity}'"
            f" AND ts > {middle} ORDER BY key, ts LIMIT {_PAGE}"
        ),
        "entity_page_by_ts": _with(
            f"SELECT {_SOURCE} FROM ts_kv WHERE entity_id = '{entity}'"
            f" AND ts > {middle} ORDER BY ts, key LIMIT {_PAGE}"
        ),
        "entity_key_page": _with(
            f"SELECT {_SOURCE} FROM ts_kv WHERE entity_id = '{entity}' AND key = 1"
            f" AND ts > {middle} ORDER BY ts LIMIT {_PAGE}"
        ),
        "changed_since": _with(f"SELECT {_SOURCE} FROM ts_kv WHERE {live}"),
        "changed_page": _with(
            f"SELECT {_SOURCE} FROM ts_kv WHERE {live}"
            f" AND (ts, entity_id, key) > ({middle + 500_000_000}, '{entity}', 2)"
            f" ORDER BY ts, entity_id, key LIMIT {_PAGE}"
        ),
        "changed_page_cut": _with(
            f"SELECT {_SOURCE} FROM ts_kv WHERE {live}"
            f" AND (ts, entity_id, key) > ({middle}, '{entity}', 2)"
            " ORDER BY ts, entity_id, key LIMIT 100"
        ),
        "entity_page_cut": _with(
            f"SELECT {_SOURCE} FROM ts_kv WHERE entity_id = '{entity}'"
            f" AND (key, ts) > (1, {middle}) ORDER BY key, ts LIMIT 20"
        ),
        "entities_after": _with(
            f"SELECT DISTINCT entity_id FROM ts_kv WHERE entity_id > '{entity}' ORDER BY entity_id"
        ),
        "latest_for_entities": _with(
            f"SELECT {_SOURCE} FROM ts_kv_latest"
            f" WHERE entity_id IN (SELECT entity_id FROM ts_kv WHERE {live})"
        ),
        "bucket_minutes": _bucket_query("ts - ts % 60000"),
        "bucket_hours": _bucket_query("ts - ts % 3600000"),
        "bucket_days": _bucket_query("ts - ts % 86400000"),
        "bucket_months": _bucket_query(_bucket("month")),
        "bucket_years": _bucket_query(_bucket("year")),
        "bucket_indefinite": _bucket_query("CAST(0 AS BIGINT)"),
        "bucket_orders": (
            f"SELECT o_orderkey, ts, {_bucket('minute')} AS minutes, {_bucket('hour')} AS hours,"
            f" {_bucket('day')} AS days, {_bucket('month')} AS months, {_bucket('year')} AS years,"
            f" CAST(0 AS BIGINT) AS indefinite"
            f" FROM (SELECT o_orderkey, {_ORDER_TS} AS ts FROM orders)"
        ),
        "cast_strings": _with(f"SELECT entity_id, key, ts, {_RETYPED} FROM ts_kv"),
        "key_names_dictionary": _with(f"SELECT {_SOURCE} FROM named"),
        "key_names_raw": _with(
            f"SELECT entity_id, CAST(key AS VARCHAR) AS key, ts, {_VALUES} FROM ts_kv"
        ),
        "key_names_hybrid": _with(
            f"SELECT entity_id, CASE WHEN key = '{OTHER_KEY}' AND ts % 3 = 1 THEN '0{OTHER_KEY}'"
            f" WHEN key = '{OTHER_KEY}' AND ts % 3 = 2 THEN '{OTHER_NAME}' ELSE key END AS key,"
            f" ts, {_VALUES} FROM named"
        ),
        "canonical_ids": (
            f"SELECT DISTINCT upper({_uuid('user_id')}) AS given, {_uuid('user_id')} AS entity_id,"
            " true AS time_based FROM events"
        ),
        "history_rows": _with(_history()),
        "history_rows_large_lookup": _with(_history()),
        "history_rows_days": _with(
            f"SELECT entity_type, entity_id, key, ts - ts % 86400000 AS partition, ts, {_VALUES}"
            " FROM known"
        ),
        "history_rows_cast": _with(
            f"SELECT entity_type, entity_id, key, {_MONTH} AS partition, ts, {_RETYPED} FROM known"
        ),
        "partition_index": _with(
            f"SELECT DISTINCT entity_type, entity_id, key, {_MONTH} AS partition FROM known"
        ),
        "partition_index_hours": _with(
            "SELECT DISTINCT entity_type, entity_id, key, ts - ts % 3600000 AS partition FROM known"
        ),
        "latest_rows": _with(_LAST_KNOWN.format(where="")),
        "latest_from_history": _with(_LAST_KNOWN.format(where="")),
        "rejected_rows": _with(
            f"SELECT {_SOURCE}, 'UNKNOWN_ENTITY' AS reason FROM ts_kv"
            " WHERE entity_id NOT IN (SELECT entity_id FROM entity_map)"
        ),
        "skipped_counts": _with(
            "SELECT 'UNKNOWN_ENTITY' AS reason,"
            " CAST(count(DISTINCT entity_id) AS BIGINT) AS skipped_entities,"
            " CAST(count(*) AS BIGINT) AS skipped_rows FROM ts_kv"
            " WHERE entity_id NOT IN (SELECT entity_id FROM entity_map) HAVING count(*) > 0"
        ),
        "pending_entities": _with(f"SELECT DISTINCT entity_id FROM ts_kv WHERE {pending}"),
        "entity_progress": _with(
            "SELECT CAST(count(*) AS BIGINT) AS total_entities,"
            f" CAST(count(*) FILTER ({pending}) AS BIGINT) AS pending_entities,"
            f" CAST(count(*) FILTER (NOT {pending}) AS BIGINT) AS done_entities"
            " FROM (SELECT DISTINCT entity_id FROM ts_kv)"
        ),
        "migrated_counts": _with(
            "SELECT entity_type, CAST(count(DISTINCT entity_id) AS BIGINT) AS entities,"
            " CAST(count(DISTINCT entity_id || ' ' || key) AS BIGINT) AS series,"
            " CAST(count(*) AS BIGINT) AS migrated_rows FROM known GROUP BY entity_type"
        ),
        "watermark_advance": _with(
            f"SELECT greatest({START_WATERMARK}, max(ts)) AS watermark_ts FROM known WHERE {live}"
        ),
        "lag_report": _with(
            f"SELECT wm AS watermark_ts, {AS_OF} AS as_of_ts, {AS_OF} - wm AS lag_ms,"
            f" {AS_OF} - wm < {_LAG} AS ready"
            f" FROM (SELECT greatest({START_WATERMARK}, max(ts)) AS wm FROM known WHERE {live})"
        ),
        "sync_once": _with(_history(live)),
        "live_history": _with(_history(live)),
        "live_latest": _with(_LAST_KNOWN.format(where=f"WHERE {live}")),
        "live_index": _with(
            f"SELECT DISTINCT entity_type, entity_id, key, {_MONTH} AS partition"
            f" FROM known WHERE {live}"
        ),
        "job_history": _with(_history()),
        "job_index": _with(
            f"SELECT DISTINCT entity_type, entity_id, key, {_MONTH} AS partition FROM known"
        ),
        "job_latest": _with(_LAST_KNOWN.format(where="")),
        "job_rejected": refused,
        "upsert_replay": _with(_changed_history()),
        "live_out_of_order": _with(_history(live)),
        "live_out_of_order_latest": _with(_LAST_KNOWN.format(where=f"WHERE {live}")),
        "live_from_cursor": _with(_history(live)),
        "stream_latest_state": _with(_LAST_KNOWN.format(where=f"WHERE {live}")),
        "live_from_zero": _with(_history()),
        "job_latest_from_history": _with(_LAST_KNOWN.format(where="")),
        "late_upsert_history": _with(_late_history()),
        "compacted_levels": _with(
            f"SELECT entity_type, entity_id, key, {_MONTH} AS partition, ts, {_VALUES} FROM {_levels()}"
        ),
        "compacted_levels_latest": _with(_levels(_LATEST_OF_KNOWN)[1:-1]),
        "compacted_levels_index": _with(
            f"SELECT DISTINCT entity_type, entity_id, key, {_MONTH} AS partition FROM known"
        ),
        "compacted_history": _with(_changed_history()),
        "compacted_rejected": _with(f"{_refused()} UNION ALL {_refused(live, _NEWER)}"),
        "job_rejected_cast": refused,
        "rejected_replay": _with(f"SELECT {_DEVICE_FIRST}, entity_id, key, {_MONTH} AS partition, ts, {_VALUES} FROM known"),
        "rejected_replay_latest": _with(
            f"SELECT {_DEVICE_FIRST}, entity_id, key, ts, {_VALUES} FROM {_LATEST_OF_KNOWN}"
        ),
        "rejected_replay_left": refused,
        "resume_by_entity": _with(_history()),
        "resume_history": _with(_history(pending)),
        "status_report": _with(_STATUS),
        "target_schema": _with(_TARGET_SCHEMA),
        "target_columns": _with(
            "SELECT 'ts_kv_cf' AS table_name, column_name, CAST(n AS BIGINT) AS filled FROM ("
            "UNPIVOT (SELECT count(entity_type) AS entity_type, count(entity_id) AS entity_id,"
            f" count(key) AS key, count({_MONTH}) AS partition, count(ts) AS ts,"
            " count(bool_v) AS bool_v, count(str_v) AS str_v, count(long_v) AS long_v,"
            " count(dbl_v) AS dbl_v, count(json_v) AS json_v FROM known)"
            " ON COLUMNS(*) INTO NAME column_name VALUE n)"
        ),
    }
