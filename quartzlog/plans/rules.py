"""Registered queries over what a commit must keep to: schema rules, properties, retries, checkpoints of an interval.

Each derives its cases from a given table and has the engine judge them, so that SQL over the same table can tell the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DateType, DoubleType, LongType, MapType, StringType, StructField, StructType

from .. import config, schema
from ..actions import Operation, Txn
from ..config import FixedClock
from ..errors import AppendOnlyViolation, DuplicateColumns, InvalidColumnName, NestedNotNull, NonPartitionColumnAbsent, PartitionColumnsNotFound, SchemaChange, TableLogError
from ..functions import predicate as P
from ..operators.segment import find_segment
from ..paths import is_checkpoint, version_of
from ..table import TableLog
from .catalog import built, query, read

TYPES = (LongType(), StringType(), DoubleType(), DateType(), BooleanType())
DAY = 86_400_000


def nations(spark, sf_dir) -> list:
    return read(spark, sf_dir, "nation").orderBy("n_nationkey").collect()  # 25 rows at every size


def regions(spark, sf_dir) -> list:
    return read(spark, sf_dir, "region").orderBy("r_regionkey").collect()  # 5 rows at every size


def refused(call, *errors) -> str | None:
    """The name of the error that the call ends with."""
    try:
        call()
    except errors as e:
        return type(e).__name__
    return None


# schemas


@query("SELECT a.n_nationkey AS old, b.n_nationkey AS new, a.n_regionkey = b.n_regionkey AND (a.n_nationkey % 2 = 1 OR b.n_nationkey % 2 = 0) AS compatible FROM nation a, nation b")
def schema_write_compatible(spark, sf_dir) -> DataFrame:
    """Columns of the region's type, nullable for even nations, nested alike: which read each other's data."""

    def of(n) -> StructType:
        column = StructField("x", TYPES[n["n_regionkey"]], n["n_nationkey"] % 2 == 0)
        return StructType([StructField("s", StructType([column])), StructField("a", ArrayType(TYPES[n["n_regionkey"]], n["n_nationkey"] % 2 == 0))])

    found = nations(spark, sf_dir)
    return spark.createDataFrame([(a["n_nationkey"], b["n_nationkey"], schema.write_compatible(of(a), of(b))) for a in found for b in found], "old long, new long, compatible boolean")


@query("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 1 AND n_regionkey > 0 THEN 'NestedNotNull' END AS error FROM nation")
def schema_nested_not_null(spark, sf_dir) -> DataFrame:
    """Odd nations have a NOT NULL field: in a struct (region 0), or below an array, a map's value or key, or both."""

    def of(n) -> StructType:
        inner = StructType([StructField("x", LongType(), n["n_nationkey"] % 2 == 0)])
        kinds = (inner, ArrayType(inner), MapType(StringType(), inner), MapType(inner, StringType()), ArrayType(MapType(StringType(), inner)))
        return StructType([StructField("c", kinds[n["n_regionkey"]])])

    return spark.createDataFrame([(n["n_nationkey"], refused(lambda: schema.check_nested_not_null(of(n)), NestedNotNull)) for n in nations(spark, sf_dir)], "k long, error string")


@query("SELECT DISTINCT o_orderpriority AS name, CASE WHEN regexp_matches(o_orderpriority, '[ ,;{}()=\\n\\t]') THEN 'InvalidColumnName' END AS error FROM orders UNION ALL SELECT n_name, CASE WHEN contains(n_name, ' ') THEN 'InvalidColumnName' END FROM nation")
def schema_column_names(spark, sf_dir) -> DataFrame:
    """Order priorities and nations as names of columns."""
    names = [r[0] for r in read(spark, sf_dir, "orders").select("o_orderpriority").distinct().collect()] + [n["n_name"] for n in nations(spark, sf_dir)]
    return spark.createDataFrame([(n, refused(lambda: schema.check_names([n]), InvalidColumnName)) for n in names], "name string, error string")


@query("SELECT r_name AS name FROM region UNION ALL SELECT r_name || '.' || n_name FROM region JOIN nation ON n_regionkey = r_regionkey")
def schema_exploded_names(spark, sf_dir) -> DataFrame:
    """A column a region, with its nations as fields of a struct, an array's elements or a map's values."""
    wraps = (lambda s: s, ArrayType, lambda s: MapType(StringType(), s), lambda s: ArrayType(ArrayType(s)), lambda s: MapType(StringType(), ArrayType(s)))
    found = nations(spark, sf_dir)
    own = lambda k: StructType([StructField(n["n_name"], LongType()) for n in found if n["n_regionkey"] == k])
    whole = StructType([StructField(r["r_name"], wraps[r["r_regionkey"] % 5](own(r["r_regionkey"]))) for r in regions(spark, sf_dir)])
    return spark.createDataFrame([(n,) for n in schema.exploded_names(whole)], "name string")


@query("SELECT n_regionkey AS region, CASE WHEN count(DISTINCT lower(left(n_name, 1))) < count(*) THEN 'DuplicateColumns' END AS error FROM nation GROUP BY 1")
def schema_duplicate_columns(spark, sf_dir) -> DataFrame:
    """Columns named by the first letters of a region's nations, every second in lower case."""
    found = nations(spark, sf_dir)

    def of(k) -> StructType:
        letters = [n["n_name"][0] for n in found if n["n_regionkey"] == k]
        return StructType([StructField(x.lower() if i % 2 else x, LongType()) for i, x in enumerate(letters)])

    return spark.createDataFrame([(k, refused(lambda: schema.check_duplicates(of(k)), DuplicateColumns)) for k in sorted({n["n_regionkey"] for n in found})], "region long, error string")


@query("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 5 > 2 THEN 'PartitionColumnsNotFound' WHEN n_nationkey % 5 = 2 THEN 'NonPartitionColumnAbsent' END AS error FROM nation")
def partition_column_rules(spark, sf_dir) -> DataFrame:
    """A table of the columns a and b, partitioned by none, a, (B, a), c, (a, c)."""
    kind = StructType([StructField("a", LongType()), StructField("b", LongType())])
    columns = ([], ["a"], ["B", "a"], ["c"], ["a", "c"])
    check = lambda n: schema.check_partition_columns(kind, columns[n["n_nationkey"] % 5])
    return spark.createDataFrame([(n["n_nationkey"], refused(lambda: check(n), PartitionColumnsNotFound, NonPartitionColumnAbsent)) for n in nations(spark, sf_dir)], "k long, error string")


# properties


@query("SELECT n_nationkey AS k, (n_nationkey::BIGINT * CASE n_regionkey WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 60000 WHEN 3 THEN 86400000 ELSE 604800000 END)::BIGINT AS ms FROM nation")
def property_durations(spark, sf_dir) -> DataFrame:
    """Retention properties of as many units as the nation's number, with the format's prefix for even ones."""
    units = ("millisecond", "seconds", "minute", "days", "week")
    prefix = lambda n: "" if n["n_nationkey"] % 2 else config.PREFIX
    of = lambda n: config.tombstone_retention_ms({prefix(n) + "deletedFileRetentionDuration": f"interval {n['n_nationkey']} {units[n['n_regionkey']]}"})
    return spark.createDataFrame([(n["n_nationkey"], of(n)) for n in nations(spark, sf_dir)], "k long, ms long")


@query("SELECT r_regionkey AS days, CASE WHEN r_regionkey < 2 THEN (SELECT count(DISTINCT n_regionkey) FROM nation) ELSE 0 END AS tombstones FROM region")
def tombstone_expiry(spark, sf_dir) -> DataFrame:
    """Removed files that a table which keeps them two days still knows so many days later."""
    start = 1_704_067_200_000

    def make(t):
        t.clock = FixedClock(start)
        t.create(read(spark, sf_dir, "nation"), ["n_regionkey"], {"deletedFileRetentionDuration": "interval 2 days"})
        t.append(read(spark, sf_dir, "nation").coalesce(1))
        t.delete()

    path = built(spark, sf_dir, "tombstones", make).path
    later = lambda days: TableLog(spark, path, FixedClock(start + days * DAY)).update().counts["num_removes"]
    return spark.createDataFrame([(r["r_regionkey"], later(r["r_regionkey"])) for r in regions(spark, sf_dir)], "days long, tombstones long")


@query("SELECT n_regionkey AS region, 'AppendOnlyViolation' AS error, count(*) AS left_rows FROM nation GROUP BY 1")
def append_only_table(spark, sf_dir) -> DataFrame:
    """Deletes of an append-only table are refused and leave its rows."""
    t = built(spark, sf_dir, "append_only", lambda t: (t.create(read(spark, sf_dir, "nation"), ["n_regionkey"], {"appendOnly": "true"}), t.append(read(spark, sf_dir, "nation").coalesce(1))))
    errors = [(r["r_regionkey"], refused(lambda: t.delete(P.col("n_regionkey") == r["r_regionkey"]), AppendOnlyViolation)) for r in regions(spark, sf_dir)]
    return t.to_df().groupBy(F.col("n_regionkey").alias("region")).agg(F.count(F.lit(1)).alias("left_rows")).join(F.broadcast(spark.createDataFrame(errors, "region long, error string")), "region").select("region", "error", "left_rows")


@query("SELECT r_name AS app, (r_regionkey + 100)::BIGINT AS version FROM region")
def session_defaults(spark, sf_dir) -> DataFrame:
    """A new table takes the session's properties below its own; every region's is told apart by the checkpoint interval."""
    out = []
    for r in regions(spark, sf_dir):
        k = r["r_regionkey"]
        t = built(spark, sf_dir, f"defaults_{k}", lambda t: (t.defaults.update({"checkpointInterval": "7" if k % 2 else str(k + 100), "appendOnly": "true"}), t.create(read(spark, sf_dir, "region"), (), {"checkpointInterval": str(k + 100)} if k % 2 else {})))
        own = t.update().metadata.configuration
        out.append((r["r_name"], config.checkpoint_interval(own) if config.append_only(own) else None))
    return spark.createDataFrame(out, "app string, version long")


# commits


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def commit_retry(spark, sf_dir) -> DataFrame:
    """Blind appends of one region each that were all started on the same version: all land, one version after the other."""

    def make(t):
        rows = read(spark, sf_dir, "nation")
        t.create(rows)
        started = [(r["r_regionkey"], TableLog(spark, t.path).start_transaction()) for r in regions(spark, sf_dir)]
        versions = [t.append(rows.where(F.col("n_regionkey") == k).coalesce(1), tx=tx) for k, tx in started]
        assert versions == list(range(1, len(started) + 1))

    return built(spark, sf_dir, "retried", make).to_df().select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT 0::BIGINT AS version, 'SnapshotIsolation' AS isolation, true AS blind UNION ALL SELECT r_regionkey + 1, 'Serializable', r_regionkey % 2 = 0 FROM region")
def commit_isolation(spark, sf_dir) -> DataFrame:
    """What commits tell of themselves: metadata alone, then a region each, of which the odd ones have read before."""

    def make(t):
        rows = read(spark, sf_dir, "nation")
        t.create(rows, ["n_regionkey"])
        for r in regions(spark, sf_dir):
            tx = t.start_transaction()
            if r["r_regionkey"] % 2:
                tx.mark_files_as_read(P.col("n_regionkey") == r["r_regionkey"])
            t.append(rows.where(F.col("n_regionkey") == r["r_regionkey"]).coalesce(1), tx=tx)

    found = built(spark, sf_dir, "isolation", make).changes(0).where("commitInfo is not null")
    return found.select("version", F.col("commitInfo.isolationLevel").alias("isolation"), F.col("commitInfo.isBlindAppend").alias("blind"))


@query("SELECT DISTINCT n_regionkey AS k, CASE WHEN n_regionkey % 2 = 1 THEN 'SchemaChange' END AS error FROM nation")
def commit_schema_change(spark, sf_dir) -> DataFrame:
    """Metadata that drops a column: refused while files are left (odd regions), taken with the removal of all (even ones)."""
    from dataclasses import replace

    out = []
    for r in regions(spark, sf_dir):
        k = r["r_regionkey"]
        rows = read(spark, sf_dir, "nation").where(F.col("n_regionkey") == k)
        t = built(spark, sf_dir, f"schema_change_{k}", lambda t: t.append(rows.coalesce(1)))
        tx = t.start_transaction()
        if "n_name" not in tx.metadata.schema.names:  # done by an earlier run
            out.append((k, None))
            continue
        gone = [] if k % 2 else t.removes(tx)
        smaller = replace(tx.metadata, schemaString=schema.dump(rows.drop("n_name").schema))
        out.append((k, refused(lambda: tx.commit([smaller, *gone]), SchemaChange)))
    return spark.createDataFrame(out, "k long, error string")


@query("SELECT (r_regionkey + 1)::BIGINT AS version, (r_regionkey + 1) % 2 = 0 AS checkpointed, 2 * ((r_regionkey + 1) // 2) AS state_from FROM region")
def checkpoint_interval(spark, sf_dir) -> DataFrame:
    """A commit a region on a table with a checkpoint every second one: which versions have one and from which each version's
    state comes (0: commits alone)."""

    def make(t):
        t.create(read(spark, sf_dir, "region"), (), {"checkpointInterval": "2"})
        for r in regions(spark, sf_dir):
            t.append(read(spark, sf_dir, "region").where(F.col("r_regionkey") == r["r_regionkey"]).coalesce(1))

    store = built(spark, sf_dir, "interval", make).store
    made = {version_of(f.path) for f in store.list_from() if is_checkpoint(f.path)}
    versions = [r["r_regionkey"] + 1 for r in regions(spark, sf_dir)]
    return spark.createDataFrame([(v, v in made, find_segment(store, v).checkpoint_version or 0) for v in versions], "version long, checkpointed boolean, state_from long")


@query("SELECT r_name AS app, (7 * r_regionkey + CASE WHEN r_regionkey > 2 THEN 1 ELSE 0 END)::BIGINT AS version, r_regionkey > 2 AS again FROM region")
def app_versions(spark, sf_dir) -> DataFrame:
    """The last version of each of several applications, some of which have committed twice."""

    def make(t):
        found = regions(spark, sf_dir)
        t.append(read(spark, sf_dir, "region").coalesce(1), extra=[Txn(r["r_name"], 7 * r["r_regionkey"]) for r in found])
        t.start_transaction().commit([Txn(r["r_name"], 7 * r["r_regionkey"] + 1) for r in found if r["r_regionkey"] > 2], Operation.STREAMING_UPDATE)

    t = built(spark, sf_dir, "app_versions", make)
    twice = t.changes(1).where("txn is not null").select(F.col("txn.appId").alias("app"), F.lit(True).alias("again"))
    last = t.update().set_transactions.select(F.col("appId").alias("app"), "version")
    return last.join(F.broadcast(twice), "app", "left").select("app", "version", F.coalesce("again", F.lit(False)).alias("again"))


@query("SELECT n_nationkey AS k, CASE WHEN n_regionkey = 0 THEN 'PartitioningMismatch' WHEN n_regionkey = 1 THEN 'IllegalState' WHEN n_regionkey = 2 THEN 'InvalidProtocol' END AS error FROM nation")
def commit_rules(spark, sf_dir) -> DataFrame:
    """Staged actions that a commit must refuse: an add of other partitions, a commit info, a newer protocol; else none."""
    from ..actions import Add, CommitInfo, Protocol

    t = built(spark, sf_dir, "commit_rules", lambda t: t.append(read(spark, sf_dir, "nation").coalesce(1), ["n_regionkey"]))
    staged = {0: lambda n: Add(f"f{n['n_nationkey']}", {"other": "1"}, 1, 1, True), 1: lambda n: CommitInfo(), 2: lambda n: Protocol(9, 9)}
    attempt = lambda n: t.start_transaction()._prepare([staged.get(n["n_regionkey"], lambda n: Add(f"f{n['n_nationkey']}", {"n_regionkey": "1"}, 1, 1, True))(n)])
    return spark.createDataFrame([(n["n_nationkey"], refused(lambda: attempt(n), TableLogError)) for n in nations(spark, sf_dir)], "k long, error string")
