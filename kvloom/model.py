"""Schemas, fixed values and run options."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, fields, replace

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Source entity tables, in the order in which they are read, and the type each
# one stands for. An id found in two tables takes the type of the later one.
ENTITY_TABLES: dict[str, str] = {
    "device": "DEVICE",
    "customer": "CUSTOMER",
    "tenant": "TENANT",
    "asset": "ASSET",
    "alarm": "ALARM",
    "dashboard": "DASHBOARD",
    "rule_chain": "RULE_CHAIN",
    "rule_node": "RULE_NODE",
    "tb_user": "USER",
    "entity_view": "ENTITY_VIEW",
    "widgets_bundle": "WIDGETS_BUNDLE",
    "widget_type": "WIDGET_TYPE",
    "tenant_profile": "TENANT_PROFILE",
    "device_profile": "DEVICE_PROFILE",
    "api_usage_state": "API_USAGE_STATE",
    "edge": "EDGE",
    "ota_package": "OTA_PACKAGE",
    "rpc": "RPC",
}

# Key dictionary tables, tried in this order.
KEY_TABLES = ("key_dictionary", "ts_kv_dictionary")

# Time bucket strategies.
STRATEGIES = ("MINUTES", "HOURS", "DAYS", "MONTHS", "YEARS", "INDEFINITE")

# Job phases, in order.
PHASES = ("init", "phase0", "phase1", "live_sync")

# The live phase starts this long before the historical phase did.
LIVE_START_MARGIN_MS = 60_000
# ----------------------------------------------------------------------------

UNKNOWN_ENTITY = "UNKNOWN_ENTITY"
BAD_UUID = "BAD_UUID"
BAD_TS = "BAD_TS"
LATE = "LATE"

VALUE_FIELDS = [
    T.StructField("bool_v", T.BooleanType()),
    T.StructField("str_v", T.StringType()),
    T.StructField("long_v", T.LongType()),
    T.StructField("dbl_v", T.DoubleType()),
    T.StructField("json_v", T.StringType()),
]
VALUE_COLUMNS = [f.name for f in VALUE_FIELDS]
SOURCE_COLUMNS = ["entity_id", "key", "ts", *VALUE_COLUMNS]


def source_schema(key_type: T.DataType | None = None) -> T.StructType:
    """Schema of ``ts_kv`` and ``ts_kv_latest``; keys are ids or plain text."""
    return T.StructType(
        [
            T.StructField("entity_id", T.StringType()),
            T.StructField("key", key_type or T.IntegerType()),
            T.StructField("ts", T.LongType()),
            *VALUE_FIELDS,
        ]
    )


ENTITY_MAP_SCHEMA = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("entity_type", T.StringType()),
    ]
)
KEY_MAP_SCHEMA = T.StructType(
    [T.StructField("key_id", T.IntegerType()), T.StructField("key", T.StringType())]
)

_SERIES = [
    T.StructField("entity_type", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("key", T.StringType()),
]
HISTORY_SCHEMA = T.StructType(
    [
        *_SERIES,
        T.StructField("partition", T.LongType()),
        T.StructField("ts", T.LongType()),
        *VALUE_FIELDS,
    ]
)
INDEX_SCHEMA = T.StructType([*_SERIES, T.StructField("partition", T.LongType())])
LATEST_SCHEMA = T.StructType(
    [*_SERIES, T.StructField("ts", T.LongType()), *VALUE_FIELDS]
)

HISTORY_COLUMNS = HISTORY_SCHEMA.fieldNames()
INDEX_COLUMNS = INDEX_SCHEMA.fieldNames()
LATEST_COLUMNS = LATEST_SCHEMA.fieldNames()

# Primary keys of the three target tables.
HISTORY_KEY = ["entity_type", "entity_id", "key", "partition", "ts"]
LATEST_KEY = ["entity_type", "entity_id", "key"]


def check_strategy(name: str) -> str:
    """Return the strategy name, or raise for one that does not exist."""
    if name not in STRATEGIES:
        raise ValueError(f"unknown partitioning {name!r}; one of {', '.join(STRATEGIES)}")
    return name


def entity_literal(entity_id) -> str:
    """Canonical text of one entity id given by the caller."""
    return str(uuid.UUID(str(entity_id)))


@dataclass(frozen=True)
class RunOptions:
    """Options of one run.

    ``batch_size`` is the page size of page queries and the fetch size of JDBC
    reads, ``workers`` the number of parallel JDBC reads; file sources take
    their parallelism from Spark.
    """

    batch_size: int = 5000
    workers: int = 4
    live_sync_interval: float = 5.0
    lag_threshold_ms: int = 30_000
    partitioning: str = "MONTHS"
    cast_strings: bool = False
    # Accept only version-1 (time based) ids; others become BAD_UUID rejects.
    time_uuid_only: bool = False
    # A dimension is broadcast only if its measured size is below both bounds.
    broadcast_max_rows: int = 1_000_000
    broadcast_max_bytes: int = 128 << 20
    # Text keys that read like an id of the key dictionary get its name.
    hybrid_keys: bool = True
    # The historical phase is cut into this many slices, each of them a restart
    # point: ranges of ts, each read from the source ("ts"), or hash ranges of
    # the entity, staged by one pass over the source ("entity").
    slices: int = 1
    slice_by: str = "ts"
    # Rows that one file of the history table should have, roughly.
    rows_per_file: int = 5_000_000
    # Entities that one file is expected to have, and bytes of a row group: for
    # the bloom filters that pages of an entity are looked up by.
    entities_per_file: int = 100_000
    row_group_bytes: int = 32 << 20
    # Live micro-batches re-read this much behind the watermark.
    overlap_ms: int = 0
    # Streamed rows at or below the start watermark are kept as LATE rejects.
    keep_late: bool = False

    def __post_init__(self):
        check_strategy(self.partitioning)
        if self.slice_by not in ("ts", "entity"):
            raise ValueError("slice_by must be ts or entity")
        for name in ("batch_size", "workers", "slices", "rows_per_file", "entities_per_file", "row_group_bytes"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")

    def override(self, **given) -> RunOptions:
        """Options with the given values in place of these; None keeps one."""
        known = {f.name for f in fields(self)}
        unknown = set(given) - known
        if unknown:
            raise ValueError(f"unknown options: {', '.join(sorted(unknown))}")
        return replace(self, **{k: v for k, v in given.items() if v is not None})
