"""Rows of the log: the union schema, JSON lines, and the driver-side forms of small actions."""

from __future__ import annotations

import enum
import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, MapType, StringType, StructField, StructType

_STRINGS, _LONGS, _FLAGS = MapType(StringType(), StringType()), LongType(), BooleanType()


def _struct(**fields) -> StructType:
    return StructType([StructField(k, v) for k, v in fields.items()])


#: The log format's kinds, their members and types. Every member may be absent in a line.
SCHEMA = _struct(
    add=_struct(path=StringType(), dataChange=_FLAGS, partitionValues=_STRINGS, size=_LONGS, modificationTime=_LONGS, stats=StringType(), tags=_STRINGS),
    remove=_struct(path=StringType(), dataChange=_FLAGS, deletionTimestamp=_LONGS, extendedFileMetadata=_FLAGS, partitionValues=_STRINGS, size=_LONGS, tags=_STRINGS),
    metaData=_struct(id=StringType(), name=StringType(), description=StringType(), format=_struct(provider=StringType(), options=_STRINGS), schemaString=StringType(), partitionColumns=ArrayType(StringType()), configuration=_STRINGS, createdTime=_LONGS),
    txn=_struct(appId=StringType(), version=_LONGS, lastUpdated=_LONGS),
    protocol=_struct(minReaderVersion=IntegerType(), minWriterVersion=IntegerType()),
    cdc=_struct(path=StringType(), dataChange=_FLAGS, partitionValues=_STRINGS, size=_LONGS, tags=_STRINGS),
    commitInfo=_struct(
        version=_LONGS, timestamp=_LONGS, userId=StringType(), userName=StringType(), operation=StringType(), operationParameters=_STRINGS,
        job=_struct(jobId=StringType(), jobName=StringType(), runId=StringType(), jobOwnerId=StringType(), triggerType=StringType()),
        notebook=_struct(notebookId=StringType()), clusterId=StringType(), readVersion=_LONGS, isolationLevel=StringType(), isBlindAppend=_FLAGS,
        operationMetrics=_STRINGS, userMetadata=StringType(), engineInfo=StringType(),
    ),
)
KINDS = tuple(SCHEMA.names)

READER, WRITER = 1, 2  # what this engine can read and write


class Operation(str, enum.Enum):
    """Labels of commits (fixed values)."""

    WRITE = "WRITE"
    STREAMING_UPDATE = "STREAMING_UPDATE"
    DELETE = "DELETE"
    TRUNCATE = "TRUNCATE"
    CONVERT = "CONVERT"
    MERGE = "MERGE"
    UPDATE = "UPDATE"
    CREATE_TABLE = "CREATE_TABLE"
    REPLACE_TABLE = "REPLACE_TABLE"
    SET_TABLE_PROPERTIES = "SET_TABLE_PROPERTIES"
    UNSET_TABLE_PROPERTIES = "UNSET_TABLE_PROPERTIES"
    ADD_COLUMNS = "ADD_COLUMNS"
    CHANGE_COLUMN = "CHANGE_COLUMN"
    REPLACE_COLUMNS = "REPLACE_COLUMNS"
    UPGRADE_PROTOCOL = "UPGRADE_PROTOCOL"
    UPGRADE_SCHEMA = "UPGRADE_SCHEMA"
    MANUAL_UPDATE = "MANUAL_UPDATE"


@dataclass(frozen=True)
class Protocol:
    minReaderVersion: int = READER
    minWriterVersion: int = WRITER


@dataclass(frozen=True)
class Metadata:
    schemaString: str = ""
    partitionColumns: tuple[str, ...] = ()
    configuration: dict = field(default_factory=dict)
    id: str = field(default_factory=lambda: str(uuid.uuid4()))
    name: str | None = None
    description: str | None = None
    format: dict = field(default_factory=lambda: {"provider": "parquet", "options": {}})
    createdTime: int | None = field(default_factory=lambda: int(time.time() * 1000))

    @property
    def schema(self) -> StructType:
        from .schema import parse

        return parse(self.schemaString) if self.schemaString else StructType()

    @property
    def partition_schema(self) -> StructType:
        from .schema import lookup

        return StructType([lookup(self.schema, c) for c in self.partitionColumns])

    @property
    def data_schema(self) -> StructType:
        own = {c.lower() for c in self.partitionColumns}
        return StructType([f for f in self.schema.fields if f.name.lower() not in own])


@dataclass(frozen=True)
class Add:
    path: str
    partitionValues: dict = field(default_factory=dict)
    size: int = 0
    modificationTime: int = 0
    dataChange: bool = True
    stats: str | None = None
    tags: dict | None = None

    def remove(self, timestamp: int | None = None, data_change: bool = True) -> Remove:
        return Remove(self.path, int(time.time() * 1000) if timestamp is None else timestamp, data_change, True, dict(self.partitionValues), self.size, self.tags)


@dataclass(frozen=True)
class Remove:
    path: str
    deletionTimestamp: int | None = None
    dataChange: bool = True
    extendedFileMetadata: bool = False
    partitionValues: dict | None = None
    size: int | None = None
    tags: dict | None = None


@dataclass(frozen=True)
class AddCdc:
    path: str
    partitionValues: dict = field(default_factory=dict)
    size: int = 0
    dataChange: bool = False
    tags: dict | None = None


@dataclass(frozen=True)
class Txn:
    appId: str
    version: int
    lastUpdated: int | None = None


@dataclass(frozen=True)
class CommitInfo:
    version: int | None = None
    timestamp: int | None = None
    operation: str | None = None
    operationParameters: dict = field(default_factory=dict)
    readVersion: int | None = None
    isolationLevel: str | None = None
    isBlindAppend: bool | None = None
    operationMetrics: dict | None = None
    userMetadata: str | None = None
    engineInfo: str | None = None
    userId: str | None = None
    userName: str | None = None
    job: dict | None = None
    notebook: dict | None = None
    clusterId: str | None = None


TYPES = {"add": Add, "remove": Remove, "metaData": Metadata, "txn": Txn, "protocol": Protocol, "cdc": AddCdc, "commitInfo": CommitInfo}
NAMES = {v: k for k, v in TYPES.items()}


def line(action) -> str:
    """One JSON line; absent optional members are left out, required ones always written."""
    return json.dumps({NAMES[type(action)]: {k: list(v) if isinstance(v, tuple) else v for k, v in asdict(action).items() if v is not None}}, separators=(",", ":"), ensure_ascii=False)


#: What an absent member of a line means, where it is not null.
ABSENT = {"add": {"dataChange": False, "partitionValues": {}, "size": 0, "modificationTime": 0}, "remove": {"dataChange": False, "extendedFileMetadata": False}, "cdc": {"dataChange": False, "partitionValues": {}, "size": 0}, "txn": {"version": 0}, "protocol": {"minReaderVersion": 0, "minWriterVersion": 0}, "metaData": {"partitionColumns": (), "configuration": {}, "schemaString": ""}, "commitInfo": {"operationParameters": {}}}


def from_row(kind: str, values: dict):
    """The driver-side form of one action of a collected row."""
    known = TYPES[kind].__dataclass_fields__
    given = {k: (tuple(v) if k == "partitionColumns" else v) for k, v in values.items() if k in known and v is not None}
    absent = {k: None for k in known if k not in given and k in ("id", "createdTime", "deletionTimestamp", "size") and kind in ("metaData", "remove")}
    return TYPES[kind](**(absent | ABSENT[kind] | given))


def unwrap(row: dict):
    """The single action of a row with a member per kind, in the order in which kinds take precedence (fixed values)."""
    for kind in ("add", "remove", "metaData", "txn", "protocol", "cdc", "commitInfo"):
        if row.get(kind) is not None:
            return from_row(kind, row[kind].asDict(recursive=True) if hasattr(row[kind], "asDict") else row[kind])
    return None
