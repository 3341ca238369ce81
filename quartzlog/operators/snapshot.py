"""A table's state at one version, and scans of it."""

from __future__ import annotations

import weakref
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import actions, config
from ..errors import ActionNotFound, InvalidProtocol
from ..functions import predicate as P
from ..paths import canonical, canonical_column, encode, physical
from . import replay
from .segment import Segment

#: Files whose partition values are broadcast to be attached to rows; beyond, they join by shuffle.
BROADCAST_FILES = 100_000
#: Distinct partition tuples up to which each is read with its values as constants, without any join.
CONSTANT_TUPLES = 32


def check_readable(protocol: actions.Protocol) -> None:
    if protocol.minReaderVersion > actions.READER:
        raise InvalidProtocol(f"the table needs reader version {protocol.minReaderVersion}; this is {actions.READER}")


def check_writable(protocol: actions.Protocol) -> None:
    if protocol.minWriterVersion > actions.WRITER:
        raise InvalidProtocol(f"the table needs writer version {protocol.minWriterVersion}; this is {actions.WRITER}")


class Snapshot:
    """Immutable. Frames are lazy; the reconciled state is replayed once and kept while the snapshot is in use."""

    def __init__(self, spark: SparkSession, data_path: str, segment: Segment, now_ms: int, first_in_commit: bool = False):
        self.spark, self.data_path, self.segment, self.now_ms, self.first_in_commit = spark, data_path.rstrip("/"), segment, now_ms, first_in_commit
        if segment.version >= 0:
            self.latest = protocol, metadata = replay.latest(self.actions)
            if protocol is None:
                raise ActionNotFound("protocol", segment.version)
            if metadata is None:
                raise ActionNotFound("metaData", segment.version)
            self.protocol = actions.from_row("protocol", protocol.asDict(recursive=True))
            self.metadata = actions.from_row("metaData", metadata.asDict(recursive=True))
            check_readable(self.protocol)
        else:
            self.protocol, self.metadata = actions.Protocol(), actions.Metadata()

    @property
    def version(self) -> int:
        return self.segment.version

    @property
    def timestamp(self) -> int:
        return self.segment.timestamp

    @property
    def log_files(self) -> list:
        return self.segment.files

    @cached_property
    def actions(self) -> DataFrame:
        return replay.actions(self.spark, self.segment)

    @cached_property
    def reconciled(self) -> DataFrame:
        """Kept under a plan that names the log files' sizes and times: the session shares what it keeps between equal plans,
        and another table may come to stand at the same path."""
        stamp = hash(tuple((f.path, f.size, f.modified_ms) for f in self.segment.files))
        kept = replay.winners(self.actions.where(F.lit(stamp).isNotNull())).persist()
        weakref.finalize(self, kept.unpersist).atexit = False
        return kept

    def release(self) -> None:
        """Give up the kept state; it is replayed again if asked for."""
        if "reconciled" in self.__dict__:
            self.__dict__.pop("reconciled").unpersist()

    @property
    def files(self) -> DataFrame:
        """Active files: the columns of an add."""
        return replay.active_files(self.reconciled)

    @property
    def min_retention_timestamp(self) -> int:
        return self.now_ms - config.tombstone_retention_ms(self.metadata.configuration)

    @property
    def tombstones(self) -> DataFrame:
        """Removed files that are still to be remembered."""
        return replay.tombstones(self.reconciled, self.min_retention_timestamp)

    @cached_property
    def transactions(self) -> dict[str, int]:
        return {r["appId"]: r["version"] for r in replay.transactions(self.actions).collect()}

    @property
    def set_transactions(self) -> DataFrame:
        return replay.transactions(self.actions)

    @cached_property
    def counts(self) -> dict[str, int]:
        """num_files, size_in_bytes, num_removes, num_set_transactions."""
        files = self.files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
        return {"num_files": files["n"], "size_in_bytes": files["bytes"], "num_removes": self.tombstones.count(), "num_set_transactions": len(self.transactions)}

    @property
    def num_files(self) -> int:
        return self.counts["num_files"]

    @property
    def size_in_bytes(self) -> int:
        return self.counts["size_in_bytes"]

    @property
    def schema(self) -> StructType:
        return self.metadata.schema

    def scan(self, predicate: P.Expression | str | None = None, first_in_commit: bool | None = None) -> Scan:
        """Files that can hold rows of the predicate. first_in_commit: of a path's lines in one commit the first decides."""
        if isinstance(predicate, str):
            predicate = P.sql(self.spark, predicate)
        return Scan(self, predicate, self.first_in_commit if first_in_commit is None else first_in_commit)

    def to_df(self, predicate: P.Expression | str | None = None) -> DataFrame:
        return self.scan(predicate).to_df()


def typed_partitions(files: DataFrame, schema: StructType) -> DataFrame:
    """Each file as a struct beside its typed partition values; an empty or absent value is null, a malformed one an error."""
    values = [F.nullif(F.element_at("partitionValues", F.lit(f.name)), F.lit("")).cast(f.dataType).alias(f.name) for f in schema.fields]
    return files.select(F.struct(*files.columns).alias("__file"), *values)


def matching(files: DataFrame, pushed: P.Expression | None, schema: StructType) -> DataFrame:
    """Files of which the partition predicate is true (null is not)."""
    if pushed is None:
        return files
    # the typed values stand in a projection below the filter, so a cast never runs on another conjunct's account
    return typed_partitions(files, schema).where(pushed.column(lambda name: F.col(f"`{name}`"))).select("__file.*")


class Scan:
    """predicate = pushed AND residual. pushed has the conjuncts on partition columns alone; files are those it keeps."""

    def __init__(self, snapshot: Snapshot, predicate: P.Expression | None, first_in_commit: bool = False):
        self.snapshot, self.predicate = snapshot, predicate
        self.first_in_commit = first_in_commit
        self.pushed, self.residual = P.split(predicate, snapshot.metadata.partitionColumns)

    @cached_property
    def files(self) -> DataFrame:
        s = self.snapshot
        every = s.files if not self.first_in_commit else replay.active_files(replay.winners(s.actions, True))
        return matching(every, self.pushed, s.metadata.partition_schema)

    def to_df(self) -> DataFrame:
        """The rows: pruned files read under the data schema (columns that a file lacks are null), partition values from
        the log, columns in the table's order, residual predicate applied (Catalyst pushes it into the Parquet scan)."""
        s, meta = self.snapshot, self.snapshot.metadata
        own = meta.partition_schema
        wanted = [f.name for f in own.fields]
        values = F.array(*(F.nullif(F.element_at("partitionValues", F.lit(n)), F.lit("")) for n in wanted)).cast("array<string>").alias("values")
        files = self.files.select("path", values).collect()  # the file list, as any reader holds it
        rows = read_files(s.spark, s.data_path, [(f["path"], tuple(f["values"])) for f in files], meta)
        return rows if self.residual is None else rows.where(self.residual.column(lambda name: F.col(f"`{name}`")))


def read_files(spark: SparkSession, data_path: str, files: list[tuple[str, tuple]], meta: actions.Metadata) -> DataFrame:
    schema, own = meta.schema, meta.partition_schema
    if not files:
        return spark.createDataFrame([], schema)
    names = [F.col(f"`{f.name}`") for f in schema.fields]
    data_schema = meta.data_schema

    def read(paths):
        return spark.read.schema(data_schema).parquet(*(replay.glob_escaped(physical(data_path, p)) for p in paths))

    if not own.fields:
        return read([p for p, _ in files]).select(*names)
    groups: dict[tuple, list[str]] = {}
    for path, values in files:
        groups.setdefault(values, []).append(path)
    constant = lambda v, f: F.lit(v).cast(f.dataType).alias(f.name)
    if len(groups) <= CONSTANT_TUPLES:
        out = None
        for values, paths in groups.items():
            part = read(paths).withColumns({f.name: constant(v, f) for v, f in zip(values, own.fields)}).select(*names)
            out = part if out is None else out.unionByName(part)
        return out
    located = [(canonical(encode(physical(data_path, p))), list(v)) for p, v in files]
    table = spark.createDataFrame(located, "__path string, __values array<string>")
    table = F.broadcast(table) if len(files) <= BROADCAST_FILES else table
    rows = read([p for p, _ in files]).withColumn("__at", canonical_column(F.col("_metadata.file_path")))
    joined = rows.join(table, F.col("__at") == F.col("__path"))
    return joined.withColumns({f.name: F.col("__values")[k].cast(f.dataType) for k, f in enumerate(own.fields)}).select(*names)

