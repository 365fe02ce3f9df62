"""Table contracts, status names and run parameters.

Everything here is plain metadata: the operators take DataFrames and these
values, and never touch storage themselves.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (status domain, error codes,
# reason text, defaults).
# ---------------------------------------------------------------------------
ACTIVE = "ACTIVE"  # legacy live status
QUARANTINE = "QUARANTINE"  # row failed a check
BLOCKED = "BLOCKED"  # row passed but its key is held back (key stacking)
FIXED = "FIXED"
RELEASED = "RELEASED"
EXPIRED = "EXPIRED"
LIVE_STATUSES = (QUARANTINE, BLOCKED, ACTIVE)
ALL_STATUSES = (ACTIVE, QUARANTINE, BLOCKED, FIXED, RELEASED, EXPIRED)

STACKED_CODE = "id_already_quarantined"
STACKED_REASON = "ID already quarantined (ID Stacking)"
NULL_CODE_PREFIX = "null_"
BAD_TYPE_CODE_PREFIX = "bad_type_"
REASON_SEPARATOR = ", "

DEFAULT_HOURS = 24
DEFAULT_REQUIRED = ("id", "name", "age")
ALERT_THRESHOLD = 1000
EXPIRING_HORIZON_HOURS = 6
REPORT_SIZE = 10

FULL_AREA = "parquet_full"
PARTIAL_AREA = "parquet_partial"
BATCH_NAME_PATTERN = r"^\d{8}_\d{6}$"
BATCH_TIME_FORMAT = "yyyyMMdd_HHmmss"

# Change-feed metadata columns.
CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
COMMIT_TIMESTAMP = "_commit_timestamp"
CHANGE_METADATA = (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP)


@dataclass(frozen=True)
class Params:
    """What the reference reads from its settings file, as arguments."""

    keys: tuple[str, ...] = ("id",)
    required: tuple[str, ...] = DEFAULT_REQUIRED
    columns: tuple[str, ...] | None = None  # kept columns; None = all of the input
    hours: int = DEFAULT_HOURS
    live: tuple[str, ...] = LIVE_STATUSES

    def required_with_keys(self) -> tuple[str, ...]:
        """A null key always fails, whether or not it is listed (ruling R-3)."""
        extra = tuple(k for k in self.keys if k not in self.required)
        return extra + tuple(self.required)


# ---------------------------------------------------------------------------
# Table shapes.
# ---------------------------------------------------------------------------
DEFAULT_DATA_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
    ]
)

# Names, types and order of the tables' columns.
QUARANTINE_METADATA = T.StructType(
    [
        T.StructField("quarantine_timestamp", T.TimestampNTZType()),
        T.StructField("quarantine_expiry", T.TimestampNTZType()),
        T.StructField("quarantine_status", T.StringType()),
        T.StructField("validation_errors", T.ArrayType(T.StringType())),
        T.StructField("quarantine_reason", T.StringType()),
        T.StructField("fix_attempts", T.IntegerType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("ingestion_timestamp", T.TimestampNTZType()),
    ]
)
QUARANTINE_METADATA_COLUMNS = tuple(f.name for f in QUARANTINE_METADATA.fields)

DEAD_LETTER_EXTRA = T.StructType([T.StructField("moved_to_dead_letter", T.TimestampNTZType())])
HISTORY_EXTRA = T.StructType(
    [
        T.StructField("valid_from", T.TimestampNTZType()),
        T.StructField("valid_to", T.TimestampNTZType()),
        T.StructField("is_current", T.BooleanType()),
    ]
)
CHANGE_EXTRA = T.StructType(
    [
        T.StructField(CHANGE_TYPE, T.StringType()),
        T.StructField(COMMIT_VERSION, T.LongType()),
        T.StructField(COMMIT_TIMESTAMP, T.TimestampNTZType()),
    ]
)


def _concat(*schemas: T.StructType) -> T.StructType:
    return T.StructType([f for s in schemas for f in s.fields])


def clean_schema(data: T.StructType = DEFAULT_DATA_SCHEMA) -> T.StructType:
    return data


def quarantine_schema(data: T.StructType = DEFAULT_DATA_SCHEMA) -> T.StructType:
    return _concat(data, QUARANTINE_METADATA)


def dead_letter_schema(data: T.StructType = DEFAULT_DATA_SCHEMA) -> T.StructType:
    return _concat(data, QUARANTINE_METADATA, DEAD_LETTER_EXTRA)


def history_schema(data: T.StructType = DEFAULT_DATA_SCHEMA) -> T.StructType:
    return _concat(data, HISTORY_EXTRA)


def change_schema(data: T.StructType = DEFAULT_DATA_SCHEMA) -> T.StructType:
    return _concat(data, CHANGE_EXTRA)


CONTRACTS = {
    "clean": clean_schema,
    "quarantine": quarantine_schema,
    "dead_letter": dead_letter_schema,
    "history": history_schema,
}


@dataclass
class RouteResult:
    """Next state of one routing step; all members are lazy DataFrames."""

    clean: object
    quarantine: object
    summary: object = None
    extra: dict = field(default_factory=dict)
