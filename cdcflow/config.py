"""Flat properties of a capture job, read into one options object."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.parse import urlsplit

# The property names a job's configuration uses, with their defaults.
USERNAME = "username"
PASSWORD = "password"
JDBC_URL = "jdbcUrl"
ADDRESS = "address"
TABLE_NAME = "tableName"
PRIMARY_KEY_COLUMNS = "primaryKeyColumns"
UPDATE_TIME_COLUMN = "updateTimeColumn"
TIMEZONE_ZERO = "timezoneZero"
OUTPUT_COLUMNS = "outputColumns"
BINLOG_FILE_NAME = "binlogFileName"
BINLOG_POSITION = "binlogPosition"
BINLOG_TIMESTAMP = "binlogTimestamp"
GTID = "gtid"
SELECT = "select"
LIMIT = "limit"
WAIT_TIME = "waitTime"
INCR_NEEDED = "incrNeeded"
NON_TIME_SUFFIX = "NonTime"
DEFAULT_PAGE_SIZE = 100
DEFAULT_WAIT_MS = 0

# Names of our own: the zone of the shift, the columns it applies to in map images, and the saved row offset.
LOCAL_ZONE = "localZone"
ZONED_COLUMNS = "zonedColumns"
ROW_OFFSET = "rowOffset"


def split_list(text: str | None) -> list[str]:
    """Comma list to names, trimmed, blanks dropped."""
    return [p for p in (part.strip() for part in (text or "").split(",")) if p]


def table_names(text: str | None) -> list[str]:
    """Comma list of tables with an optional ``db.`` prefix, prefix removed."""
    return [name.split(".")[1] if "." in name else name for name in split_list(text)]


def flat_properties(value: object, path: str = "") -> dict[str, object]:
    """A job's nested configuration as one level: ``a.b`` for members, ``a[0]`` for elements."""
    if isinstance(value, Mapping):
        parts = [(f"{path}.{k}" if path else k, v) for k, v in value.items()]
    elif isinstance(value, list):
        parts = [(f"{path}[{i}]", v) for i, v in enumerate(value)]
    else:
        return {path: value}
    return {k: v for name, part in parts for k, v in flat_properties(part, name).items()}


@dataclass(frozen=True)
class CaptureOptions:
    """What to capture, which columns to emit and where to start."""

    database: str
    tables: list[str]
    output_columns: list[str]
    primary_key: list[str] = field(default_factory=list)
    update_time: str | None = None
    shift_to_local: bool = False
    zone: str | None = None
    zoned_columns: list[str] | None = None
    start_file: str | None = None
    start_position: int = 0
    start_timestamp_ms: int | None = None
    gtid_set: str | None = None
    select: str | None = None
    page_size: int = DEFAULT_PAGE_SIZE
    wait_ms: int = DEFAULT_WAIT_MS
    incremental: bool = True
    row_offset: int = 0
    jdbc: dict[str, str] = field(default_factory=dict)

    @property
    def db_tables(self) -> list[str]:
        return [f"{self.database}.{t}" for t in self.tables]

    @classmethod
    def from_properties(
        cls, properties: Mapping[str, object], saved: Mapping[str, str] | None = None
    ) -> CaptureOptions:
        """Read flat properties. Saved progress, when there is any, replaces the start fields."""
        get = lambda key: None if properties.get(key) is None else str(properties[key])
        url = get(JDBC_URL) or get(ADDRESS) or ""
        start = saved or {k: get(k) for k in (BINLOG_FILE_NAME, BINLOG_POSITION, BINLOG_TIMESTAMP, GTID)}
        return cls(
            database=urlsplit(url.removeprefix("jdbc:")).path.strip("/"),
            tables=table_names(get(TABLE_NAME)),
            output_columns=split_list(get(OUTPUT_COLUMNS)),
            primary_key=split_list(get(PRIMARY_KEY_COLUMNS)),
            update_time=(get(UPDATE_TIME_COLUMN) or "").strip() or None,
            shift_to_local=(get(TIMEZONE_ZERO) or "").lower() == "true",
            zone=get(LOCAL_ZONE),
            zoned_columns=split_list(get(ZONED_COLUMNS)) or None,
            start_file=start.get(BINLOG_FILE_NAME) or None,
            start_position=int(start.get(BINLOG_POSITION) or 0),
            start_timestamp_ms=int(start[BINLOG_TIMESTAMP]) if start.get(BINLOG_TIMESTAMP) else None,
            gtid_set=start.get(GTID) or None,
            select=get(SELECT),
            page_size=int(get(LIMIT) or DEFAULT_PAGE_SIZE),
            wait_ms=int(get(WAIT_TIME) or DEFAULT_WAIT_MS),
            incremental=(get(INCR_NEEDED) or "true").lower() == "true",
            row_offset=int((saved or {}).get(ROW_OFFSET) or get(ROW_OFFSET) or 0),
            jdbc={"url": url, "user": get(USERNAME) or "", "password": get(PASSWORD) or ""},
        )

    @classmethod
    def from_json(cls, text: str, saved: Mapping[str, str] | None = None) -> CaptureOptions:
        """Read a JSON document of properties; those further down go by their path."""
        return cls.from_properties(flat_properties(json.loads(text)), saved)
