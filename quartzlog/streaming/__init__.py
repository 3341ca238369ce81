"""Tables as ends of Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..actions import KINDS, Operation, Txn
from ..errors import ConcurrentModification
from ..operators.replay import parsed
from ..table import TableLog


ATTEMPTS = 10  # of a batch that meets conflicts


def sink(table: TableLog, app_id: str, partition_by=()) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: appends each micro-batch once. The batch's number is committed with its files under app_id, so a
    batch that is played again after a failure is recognised and skipped. What is read of the application's batches and the
    append are one transaction: of two writers of a batch one conflicts, looks again and finds the batch done."""

    def write(batch: DataFrame, number: int) -> None:
        for left in range(ATTEMPTS - 1, -1, -1):
            tx = table.start_transaction()
            if tx.txn_version(app_id) >= number:
                return
            try:
                table.append(batch, partition_by, Operation.STREAMING_UPDATE, [Txn(app_id, number, table.clock.now_ms())], tx)
                return
            except ConcurrentModification:
                if not left:
                    raise

    return write


def tail(spark: SparkSession, table: TableLog) -> DataFrame:
    """A stream of the log: version, pos and a struct per kind, for each commit as it appears."""
    text = spark.readStream.format("text").schema("value string").option("wholetext", True).option("pathGlobFilter", "*.json").load(table.store.folder)
    version = F.regexp_extract(F.col("_metadata.file_path"), r"(\d+)\.json$", 1).cast("long")
    lines = text.select(version.alias("version"), F.posexplode(F.split("value", "\n")).alias("pos", "line")).where(F.trim("line") != "")
    return lines.select("version", "pos", parsed("line").alias("a")).select("version", "pos", *(F.col(f"a.{k}").alias(k) for k in KINDS))
