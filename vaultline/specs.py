"""Metadata records that drive the operators.

They are small by nature (one record per column, screen, check or mapping), live on the driver and
only shape the plan; no data rows ever pass through them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# Names and codes of the data model.
ADD, MODIFY, REMOVE = "ADD", "MODIFY", "REMOVE"
OPERATION = "dlt_operation_nm"
UPDATE_FLAG_SUFFIX = "_upd_ind"
START, END, CURRENT = "start_dt", "end_dt", "curr_ind"
OPEN_END = "9999-12-31 00:00:00"
PASS, REJECT, STOP = "PASS", "REJECT", "STOP"
LOAD_TIME, RECORD_SOURCE, LOAD_ID = "LoadDateTime", "RecordSource", "LoadID"
HASH_DIFF, APPLIED_TIME = "HashDiff", "AppliedDateTime"
HASH_KEY_SUFFIX = "HashKey"
DEFAULT_LOAD_ID = -1

GEOMETRY = "geometry"


@dataclass(frozen=True)
class ColumnSpec:
    """A column of a source file: its Spark type (or ``geometry``) and its part in history keeping."""

    name: str
    data_type: str = "string"
    is_key: bool = False
    keep_history: bool = True
    required: bool = False

    @property
    def spark_type(self) -> str:
        return "binary" if self.data_type == GEOMETRY else self.data_type


@dataclass(frozen=True)
class TableSpec:
    """A source file with its columns in metadata order."""

    table: str
    columns: tuple[ColumnSpec, ...]
    file_id: int = 0
    group_id: int | None = None
    snapshot_type: str = "FULL"

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))
        if self.snapshot_type not in ("FULL", "DELTA"):
            raise ValueError(f"{self.table}: snapshot type must be FULL or DELTA")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def keys(self) -> list[str]:
        keys = [c.name for c in self.columns if c.is_key]
        if not keys:
            raise ValueError(f"{self.table}: no natural key column")
        return keys

    @property
    def tracked(self) -> list[ColumnSpec]:
        return [c for c in self.columns if not c.is_key and c.keep_history]


@dataclass(frozen=True)
class ScreenSpec:
    """A row-level screen: either a predicate that is true for failing rows, or a query that
    returns one ``row_id`` per failing row."""

    screen_id: int
    file_id: int
    order: int
    action: str
    predicate: str | None = None
    query: Callable[[], DataFrame] | None = None
    name: str = ""

    def __post_init__(self):
        if self.action not in (PASS, REJECT, STOP):
            raise ValueError(f"screen {self.screen_id}: unknown action {self.action}")
        if (self.predicate is None) == (self.query is None):
            raise ValueError(f"screen {self.screen_id}: give a predicate or a query")


@dataclass(frozen=True)
class CheckSpec:
    """A scalar check: a query (SQL text or a frame builder) of one number, and its target range."""

    check_id: str
    query: str | Callable[[SparkSession], DataFrame]
    target_min: Decimal | float | None = None
    target_max: Decimal | float | None = None
    name: str = ""
    description: str | None = None
    group: str | None = None

    @property
    def query_text(self) -> str:
        return self.query if isinstance(self.query, str) else getattr(self.query, "__name__", "query")


@dataclass(frozen=True)
class HubSource:
    """One staging object feeding a hub: ``keys`` maps hub key name to source column, in position order."""

    object_name: str
    keys: dict[str, str]
    record_source: str
    schema: str | None = None
    database: str | None = None


@dataclass(frozen=True)
class HubSpec:
    name: str
    sources: tuple[HubSource, ...]
    schema: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "sources", tuple(self.sources))
        if len({tuple(s.keys) for s in self.sources}) != 1:
            raise ValueError(f"{self.name}: all sources must feed the same business keys")

    @property
    def hash_key(self) -> str:
        return self.name[len("Hub"):] + HASH_KEY_SUFFIX

    @property
    def keys(self) -> list[str]:
        return list(self.sources[0].keys)


@dataclass(frozen=True)
class LinkSource:
    """One staging object feeding a link: ``hubs`` maps each hub hash key name to its source columns."""

    object_name: str
    hubs: dict[str, Sequence[str]]
    record_source: str
    schema: str | None = None
    database: str | None = None

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(c for cols in self.hubs.values() for c in cols))


@dataclass(frozen=True)
class LinkSpec:
    name: str
    sources: tuple[LinkSource, ...]
    schema: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "sources", tuple(self.sources))
        if len({tuple(sorted(s.hubs)) for s in self.sources}) != 1:
            raise ValueError(f"{self.name}: all sources must feed the same hub keys")

    @property
    def hash_key(self) -> str:
        return self.name[len("Link"):] + HASH_KEY_SUFFIX

    @property
    def hub_keys(self) -> list[str]:
        return list(self.sources[0].hubs)


@dataclass(frozen=True)
class SatSpec:
    """A satellite. ``keys`` are the business key columns of a raw source; a business satellite is
    staged with its hash key and leaves them empty."""

    name: str
    attributes: tuple[str, ...]
    keys: tuple[str, ...] = ()
    schema: str | None = None
    object_name: str | None = None
    record_source: str | None = None
    key_name: str | None = None
    diff_columns: tuple[str, ...] = ()
    renamed: dict[str, str] = field(default_factory=dict)
    """Source column of an attribute, where its name differs."""
    source_schema: str | None = None
    database: str | None = None

    @property
    def hash_key(self) -> str:
        return self.key_name or self.name[len("Sat"):] + HASH_KEY_SUFFIX

    @property
    def hashed(self) -> list[str]:
        return list(self.diff_columns or self.attributes)
