"""Log replay as DataFrame plans: the last action of a path wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..actions import KINDS, SCHEMA
from ..paths import canonical_column
from .segment import Segment

ORDERED = "version long, pos struct<block:bigint,line:bigint>, from_checkpoint boolean"


def glob_escaped(path: str) -> str:
    """Spark reads path arguments as globs; this names one file."""
    return "".join("\\" + c if c in "[]{}*?\\" else c for c in path)


def parsed(line: str) -> Column:
    """A log line as a struct of its kinds, null if it is blank; malformed JSON is an error, never a lost row."""
    return F.when(F.col(line).rlike(r"\S"), F.from_json(line, SCHEMA, {"mode": "FAILFAST"}))


def commit_actions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """version, pos, from_checkpoint and a struct per kind, for every line of commit files.

    pos orders the lines of a commit: where the line's split of the file begins, then the lines' running number in it. So a
    commit of millions of lines is read in splits like any text. Blank lines are skipped; a line that is no JSON of the
    schema fails the read.
    """
    if not paths:
        return spark.createDataFrame([], f"{ORDERED}, {', '.join(f'`{k}` {SCHEMA[k].dataType.simpleString()}' for k in KINDS)}")
    text = spark.read.text([glob_escaped(p) for p in paths])
    version = F.regexp_extract(F.col("_metadata.file_path"), r"(\d+)\.json[^/]*$", 1).cast("long")
    pos = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = text.select(version.alias("version"), pos.alias("pos"), F.lit(False).alias("from_checkpoint"), parsed("value").alias("a"))
    return lines.where("a is not null").select("version", "pos", "from_checkpoint", *(F.col(f"a.{k}").alias(k) for k in KINDS))


def checkpoint_actions(spark: SparkSession, paths: list[str], version: int) -> DataFrame:
    rows = spark.read.schema(SCHEMA).parquet(*(glob_escaped(p) for p in paths))
    return rows.select(F.lit(version).cast("long").alias("version"), F.struct(F.lit(-1).cast("long").alias("block"), F.lit(-1).cast("long").alias("line")).alias("pos"), F.lit(True).alias("from_checkpoint"), *KINDS)


def actions(spark: SparkSession, segment: Segment) -> DataFrame:
    """All rows of a segment. Order between them is (version, pos); a checkpoint's rows come first."""
    rows = commit_actions(spark, [f.path for f in segment.commits])
    if segment.checkpoint:
        rows = checkpoint_actions(spark, [f.path for f in segment.checkpoint], segment.checkpoint_version).unionByName(rows)
    return rows


def winners(rows: DataFrame, first_in_commit: bool = False) -> DataFrame:
    """Per path its deciding add or remove: of the highest version, and there the last line (or the first).

    Replayed files no longer change data, and their paths are canonical.
    """
    path = canonical_column(F.coalesce("add.path", "remove.path"))
    files = rows.where("add.path is not null or remove.path is not null").withColumn("path", path)
    order = Window.partitionBy("path").orderBy(F.desc("version"), F.asc("pos") if first_in_commit else F.desc("pos"))
    files = files.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    own = lambda kind: F.when(F.col(kind).isNotNull(), F.col(kind).withField("path", F.col("path")).withField("dataChange", F.lit(False)))
    return files.select("path", own("add").alias("add"), own("remove").alias("remove"))


def active_files(reconciled: DataFrame) -> DataFrame:
    """Columns of the adds that are in force."""
    rows = reconciled.where("add is not null").select("add.*")
    return rows.withColumns({"size": F.coalesce("size", F.lit(0)), "modificationTime": F.coalesce("modificationTime", F.lit(0)), "partitionValues": F.coalesce("partitionValues", F.create_map().cast("map<string,string>"))})


def tombstones(reconciled: DataFrame, min_timestamp: int | None = None) -> DataFrame:
    """Columns of the removes in force, deleted after min_timestamp (an absent time counts as 0)."""
    rows = reconciled.where("add is null and remove is not null").select("remove.*")
    return rows if min_timestamp is None else rows.where(F.coalesce("deletionTimestamp", F.lit(0)) > min_timestamp)


def transactions(rows: DataFrame) -> DataFrame:
    """appId, version, lastUpdated: the last of each application."""
    last = rows.where("txn.appId is not null").groupBy("txn.appId").agg(F.max_by("txn", F.struct("version", "pos")).alias("t"))
    return last.select("t.appId", F.coalesce("t.version", F.lit(0)).alias("version"), "t.lastUpdated")


def latest(rows: DataFrame) -> tuple:
    """The protocol and metadata in force, as rows or None, in one pass."""
    at = F.struct("version", "pos")
    pick = lambda kind: F.max_by(kind, F.when(F.col(kind).isNotNull(), at)).alias(kind)
    found = rows.agg(pick("protocol"), pick("metaData")).first()
    return found["protocol"], found["metaData"]
