"""Writing a snapshot's state as one Parquet file (or several parts) beside the commits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..actions import KINDS, SCHEMA
from ..errors import CommitFileExists, IllegalState
from ..paths import checkpoint_names, join
from .segment import write_hint

#: Kinds that a checkpoint holds.
KEPT = ("metaData", "protocol", "txn", "add", "remove")
PART_FILES = 500_000


def rows(snapshot) -> DataFrame:
    """The state as union rows: metadata, protocol, transactions, active files, unexpired removes."""
    spark = snapshot.spark
    empty = {k: F.lit(None).cast(SCHEMA[k].dataType).alias(k) for k in KINDS}

    def only(df: DataFrame, kind: str) -> DataFrame:
        fields = [F.col(n).alias(n) if n in df.columns else F.lit(None).cast(SCHEMA[kind].dataType[n].dataType).alias(n) for n in SCHEMA[kind].dataType.names]
        return df.select(*(F.struct(*fields).cast(SCHEMA[kind].dataType).alias(k) if k == kind else empty[k] for k in KINDS))

    protocol, metadata = snapshot.latest
    single = lambda row, kind: spark.createDataFrame([row.asDict(recursive=True)], SCHEMA[kind].dataType)
    parts = [only(single(metadata, "metaData"), "metaData"), only(single(protocol, "protocol"), "protocol"), only(snapshot.set_transactions, "txn"), only(snapshot.files, "add"), only(snapshot.tombstones, "remove")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write(snapshot, store, parts: int | None = None) -> int:
    """Write the checkpoint of the snapshot's version and point the hint at it; returns its number of rows.

    parts: by default one for every PART_FILES active files, so no task writes more than about that many rows.
    """
    if snapshot.version < 0:
        raise IllegalState("an absent table has no checkpoint")
    parts = parts or max(1, -(-snapshot.num_files // PART_FILES))
    frame = rows(snapshot)
    frame = frame.coalesce(1) if parts == 1 else frame.repartition(parts)
    aside = f".checkpoint-{uuid.uuid4().hex}.tmp"
    try:
        frame.write.option("compression", "snappy").parquet(join(store.folder, aside))
        found = [f for f in store.walk(aside) if f.name.startswith("part-") and f.name.endswith(".parquet")]
        written = snapshot.spark.read.schema(SCHEMA).parquet(join(store.folder, aside))
        total = written.count()
        adds = written.where("add is not null").count()
        if adds != snapshot.num_files:
            raise IllegalState(f"the checkpoint has {adds} files, the snapshot {snapshot.num_files}")
        for source, name in zip(found, checkpoint_names(snapshot.version, None if parts == 1 else len(found))):
            try:
                store.move_in(source.path, name)
            except CommitFileExists:
                pass  # another writer made the same checkpoint
    finally:
        store.remove(aside)
    write_hint(store, snapshot.version, total, None if parts == 1 else len(found))
    return total
