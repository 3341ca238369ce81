"""Registered queries over the table log, each with the SQL that gives the same rows on the plain tables.

Tables are built once per session and size in the scratch folder, by commits as an application would make them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..actions import SCHEMA, Operation, Txn
from ..functions import predicate as P
from ..operators import replay
from ..operators.conflict import added_files
from ..operators.snapshot import matching
from ..paths import commit_name, join
from ..scratch import folder
from ..table import TableLog

_built: dict[tuple, TableLog] = {}
_queries: dict = {}
_oracles: dict[str, str] = {}
HOUR = 3_600_000
START = 1_704_067_200_000  # 2024-01-01


def query(sql: str | None = None):
    """Register a query under its function's name, and its SQL."""

    def add(f):
        _queries[f.__name__] = f
        if sql:
            _oracles[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(_queries)


def oracle_sql() -> dict:
    return dict(_oracles)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def built(spark: SparkSession, sf_dir: str, name: str, make) -> TableLog:
    """A table that make(table) fills, once per session and size."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        table = TableLog(spark, folder(spark, name))
        make(table)
        _built[key] = table
    return _built[key]


def lineitem_log(spark: SparkSession, sf_dir: str) -> TableLog:
    return built(spark, sf_dir, "lineitem", lambda t: t.append(read(spark, sf_dir, "lineitem").repartition("l_returnflag"), ["l_returnflag"]))


def orders_log(spark: SparkSession, sf_dir: str) -> TableLog:
    """v0 status F, v1 O, v2 P, v3 removes P, v4 adds P again; commit times an hour apart."""

    def make(t: TableLog) -> None:
        rows = read(spark, sf_dir, "orders")
        for status in ("F", "O", "P"):
            t.append(rows.where(F.col("o_orderstatus") == status).coalesce(4), ["o_orderstatus"])
        t.delete(P.col("o_orderstatus") == "P")
        t.append(rows.where("o_orderstatus = 'P'").coalesce(4))
        set_times(t)

    return built(spark, sf_dir, "orders", make)


def set_times(t: TableLog) -> None:
    """Date the commit files an hour apart, from START on."""
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    conf = t.spark._jsparkSession.sessionState().newHadoopConf()
    for c in t.commits():
        at = path(join(t.store.folder, commit_name(c.version)))
        at.getFileSystem(conf).setTimes(at, START + HOUR * c.version, -1)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem through the log: partition l_returnflag = 'R' pruned, quantity > 30 pushed into the Parquet scan."""
    return lineitem_log(spark, sf_dir).to_df((P.col("l_returnflag") == "R") & (P.col("l_quantity") > 30.0))


# snapshots


@query("SELECT * FROM orders")
def snapshot_latest_rows(spark, sf_dir):
    return orders_log(spark, sf_dir).to_df(version=2)


@query("SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def snapshot_after_delete(spark, sf_dir):
    return orders_log(spark, sf_dir).to_df(version=3)


@query("SELECT * FROM orders")
def snapshot_readd(spark, sf_dir):
    return orders_log(spark, sf_dir).to_df()


@query("SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')")
def time_travel_version(spark, sf_dir):
    return orders_log(spark, sf_dir).to_df(version=1)


@query("SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')")
def time_travel_timestamp(spark, sf_dir):
    return orders_log(spark, sf_dir).to_df(timestamp=START + HOUR + HOUR // 2)


@query("SELECT 3 AS active_files, 0 AS transactions, 5 AS commits, 4 AS version")
def snapshot_counts(spark, sf_dir):
    """One file per status once compacted; the table's own counters."""

    def make(t):
        rows = read(spark, sf_dir, "orders")
        for status in ("F", "O", "P"):
            t.append(rows.where(F.col("o_orderstatus") == status).coalesce(1), ["o_orderstatus"])
        t.delete(P.col("o_orderstatus") == "P")
        t.append(rows.where("o_orderstatus = 'P'").coalesce(1))

    s = built(spark, sf_dir, "orders_one_file", make).update()
    return spark.createDataFrame([(s.num_files, s.counts["num_set_transactions"], len(s.log_files), s.version)], "active_files int, transactions int, commits int, version int")


# scans


def scan_of(name: str, predicate, sql: str) -> None:
    def run(spark, sf_dir):
        return lineitem_log(spark, sf_dir).to_df(predicate)

    run.__name__ = name
    query(f"SELECT * FROM lineitem WHERE {sql}")(run)


flag, quantity = P.col("l_returnflag"), P.col("l_quantity")
scan_of("scan_pushed_eq", flag == "R", "l_returnflag = 'R'")
scan_of("scan_pushed_range", (flag >= "A") & (flag < "R"), "l_returnflag >= 'A' AND l_returnflag < 'R'")
scan_of("scan_pushed_gt_le", (flag > "A") & (flag <= "R"), "l_returnflag > 'A' AND l_returnflag <= 'R'")
scan_of("scan_pushed_not_null", flag.is_not_null(), "l_returnflag IS NOT NULL")
scan_of("scan_pushed_or", (flag == "A") | (flag == "N"), "l_returnflag = 'A' OR l_returnflag = 'N'")
scan_of("scan_pushed_not", ~(flag == "A"), "NOT l_returnflag = 'A'")
scan_of("scan_mixed_residual", (flag == "R") & (quantity > 30.0), "l_returnflag = 'R' AND l_quantity > 30")
scan_of("scan_mixed_disjunction", (flag == "R") | (quantity > 45.0), "l_returnflag = 'R' OR l_quantity > 45")
scan_of("scan_data_only", quantity <= 10.0, "l_quantity <= 10")
scan_of("scan_data_not_null", quantity.is_not_null() & (flag == "N"), "l_quantity IS NOT NULL AND l_returnflag = 'N'")
scan_of("scan_accept_all", None, "true")
scan_of("scan_constant_false", P.FALSE, "false")
scan_of("scan_sql_in_between", "l_returnflag IN ('A', 'N') AND l_quantity BETWEEN 10 AND 20 AND l_linestatus LIKE 'O%'", "l_returnflag IN ('A', 'N') AND l_quantity BETWEEN 10 AND 20 AND l_linestatus LIKE 'O%'")

#: name: (partition expression in Spark SQL, predicate, DuckDB expression, DuckDB condition)
TYPED = {
    "null": ("CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END", lambda p: p.is_null(), "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END", "IS NULL"),
    "date": ("CAST(date_trunc('YEAR', o_orderdate) AS date)", lambda p: p >= P.lit("1998-01-01"), "CAST(date_trunc('year', o_orderdate) AS date)", ">= DATE '1998-01-01'"),
    "timestamp": ("CAST(date_trunc('YEAR', o_orderdate) AS timestamp_ntz)", lambda p: p < P.lit("1998-01-01 00:00:00"), "CAST(date_trunc('year', o_orderdate) AS timestamp)", "< TIMESTAMP '1998-01-01 00:00:00'"),
    "boolean": ("o_totalprice > 100000", lambda p: p == P.TRUE, "o_totalprice > 100000", "= true"),
    "int": ("CAST(o_orderkey % 5 AS int)", lambda p: (p > 1) & (p <= 3), "CAST(o_orderkey % 5 AS int)", "IN (2, 3)"),
    "long": ("o_orderkey % 4", lambda p: p == 2, "o_orderkey % 4", "= 2"),
    "short": ("CAST(o_orderkey % 3 AS smallint)", lambda p: p >= 1, "CAST(o_orderkey % 3 AS smallint)", ">= 1"),
    "byte": ("CAST(o_orderkey % 3 AS tinyint)", lambda p: ~(p == 1), "CAST(o_orderkey % 3 AS tinyint)", "<> 1"),
    "double": ("CAST(o_orderkey % 3 AS double) / 2", lambda p: p < 1.0, "CAST(o_orderkey % 3 AS double) / 2", "< 1"),
    "float": ("CAST(CAST(o_orderkey % 3 AS double) / 2 AS float)", lambda p: p == 0.5, "CAST(CAST(o_orderkey % 3 AS double) / 2 AS float)", "= 0.5"),
    "decimal": ("CAST(o_orderkey % 3 AS decimal(6,2))", lambda p: p > 0, "CAST(o_orderkey % 3 AS decimal(6,2))", "> 0"),
    "string": ("concat('a b=', o_orderpriority)", lambda p: p > "a b=2", "concat('a b=', o_orderpriority)", "> 'a b=2'"),
}


def partition_of(name: str) -> None:
    spark_sql, predicate, duck, condition = TYPED[name]

    def run(spark, sf_dir):
        def make(t):
            t.append(read(spark, sf_dir, "orders").select("o_orderkey", F.expr(spark_sql).alias("p"), "o_totalprice").repartition("p"), ["p"])

        return built(spark, sf_dir, f"partition_{name}", make).to_df(predicate(P.col("p")))

    run.__name__ = f"scan_{name}_partition"
    query(f"SELECT * FROM (SELECT o_orderkey, {duck} AS p, o_totalprice FROM orders) WHERE p {condition}")(run)


for _name in TYPED:
    partition_of(_name)


@query("SELECT count(DISTINCT l_returnflag) AS files_before, count(DISTINCT l_returnflag) FILTER (l_returnflag = 'R') AS files_after FROM lineitem")
def pruned_file_counts(spark, sf_dir):
    s = lineitem_log(spark, sf_dir).update()
    kinds = F.countDistinct("partitionValues.l_returnflag")
    before, after = (files.agg(kinds).first()[0] for files in (s.scan().files, s.scan(P.col("l_returnflag") == "R").files))
    return spark.createDataFrame([(before, after)], "files_before long, files_after long")


# replay of events as actions


def event_actions(spark: SparkSession, sf_dir: str, remove: str | None = None) -> DataFrame:
    """Events as log rows: the day is the version, the time's rank in it the line, the user the path. Events of the type
    `remove` remove the path, all others add it; the event's id stands in the size."""
    events = read(spark, sf_dir, "events")
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    gone = F.lit(False) if remove is None else F.col("event_type") == remove
    blank = lambda kind: F.lit(None).cast(SCHEMA[kind].dataType)

    def action(kind, **given):
        return F.struct(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMA[kind].dataType.fields))

    path = F.col("user_id").cast("string")
    own = {"add": F.when(~gone, action("add", path=path, size=F.col("event_id"), modificationTime=micros)), "remove": F.when(gone, action("remove", path=path, size=F.col("event_id"), deletionTimestamp=micros))}
    return events.select(day.alias("version"), F.struct(F.col("ts"), F.col("event_id")).alias("pos"), F.lit(False).alias("from_checkpoint"), *(own.get(k, blank(k)).alias(k) for k in SCHEMA.names))


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def replay_last_writer(spark, sf_dir):
    return replay.active_files(replay.winners(event_actions(spark, sf_dir))).select(F.col("path").cast("long").alias("user_id"), F.col("size").alias("event_id"))


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts::DATE DESC, ts, event_id) = 1")
def replay_first_in_commit(spark, sf_dir):
    return replay.active_files(replay.winners(event_actions(spark, sf_dir), True)).select(F.col("path").cast("long").alias("user_id"), F.col("size").alias("event_id"))


_LAST = "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


@query(f"SELECT user_id, event_id FROM ({_LAST}) WHERE event_type <> 'error'")
def active_after_tombstones(spark, sf_dir):
    return replay.active_files(replay.winners(event_actions(spark, sf_dir, "error"))).select(F.col("path").cast("long").alias("user_id"), F.col("size").alias("event_id"))


@query(f"SELECT user_id, event_id FROM ({_LAST}) WHERE event_type = 'error' AND ts > TIMESTAMP '2024-01-20'")
def tombstones_retained(spark, sf_dir):
    cut = 1705708800_000_000  # 2024-01-20 in microseconds
    return replay.tombstones(replay.winners(event_actions(spark, sf_dir, "error")), cut).select(F.col("path").cast("long").alias("user_id"), F.col("size").alias("event_id"))


def rows_of_kind(events: DataFrame, kind: str, value) -> DataFrame:
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long")
    return events.select(day.alias("version"), F.struct("ts", "event_id").alias("pos"), F.lit(False).alias("from_checkpoint"), *((value if k == kind else F.lit(None).cast(SCHEMA[k].dataType)).alias(k) for k in SCHEMA.names))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS last_event FROM events GROUP BY user_id")
def txn_last_version(spark, sf_dir):
    txn = F.struct(F.col("user_id").cast("string").alias("appId"), F.col("event_id").alias("version"), F.lit(None).cast("long").alias("lastUpdated"))
    rows = rows_of_kind(read(spark, sf_dir, "events"), "txn", txn)
    return replay.transactions(rows).select(F.col("appId").cast("long").alias("user_id"), F.col("version").alias("last_event"))


@query("SELECT event_id, event_type FROM events WHERE event_type = 'signup' ORDER BY ts DESC, event_id DESC LIMIT 1")
def metadata_last_wins(spark, sf_dir):
    """Signups as metadata among all other events; the last one is in force."""
    kind = SCHEMA["metaData"].dataType
    given = {"id": F.col("event_id").cast("string"), "name": F.col("event_type")}
    meta = F.when(F.col("event_type") == "signup", F.struct(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields)))
    found = replay.latest(rows_of_kind(read(spark, sf_dir, "events"), "metaData", meta))[1]
    return spark.createDataFrame([(int(found["id"]), found["name"])] if found else [], "event_id long, event_type string")


# history


@query("""WITH c AS (SELECT ts::DATE AS day, max(ts) AS t, row_number() OVER (ORDER BY ts::DATE) - 1 AS version FROM events GROUP BY 1)
    SELECT event_id, (SELECT max(version) FROM c WHERE c.t <= e.ts) AS version FROM events e""")
def commit_asof(spark, sf_dir):
    """For each event the last day-commit at or before it. Commit times are the log's listing, which the driver holds; a
    row looks its time up in them without a join."""
    events = read(spark, sf_dir, "events")
    times = sorted(r["t"] for r in events.groupBy(F.col("ts").cast("date")).agg(F.max("ts").alias("t")).collect())
    literal = F.array(*(F.lit(str(t)).cast("timestamp_ntz") for t in times))
    version = F.size(F.filter(literal, lambda t: t <= F.col("ts")))
    return events.select("event_id", F.when(version > 0, (version - 1).cast("long")).alias("version"))


@query("SELECT date_diff('day', DATE '2024-01-01', ts::DATE) AS version, count(*) FILTER (event_type <> 'error') AS adds, count(*) FILTER (event_type = 'error') AS removes FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1")
def change_log_by_version(spark, sf_dir):
    rows = event_actions(spark, sf_dir, "error").where("version >= 9")
    return rows.groupBy("version").agg(F.count("add.path").alias("adds"), F.count("remove.path").alias("removes"))


@query("SELECT user_id % 500 AS log, max(ts::DATE) - min(ts::DATE) + 1 = count(DISTINCT ts::DATE) AS contiguous FROM events GROUP BY 1")
def gap_detection(spark, sf_dir):
    """500 logs with a commit for each day that has events of theirs: which of them lack a version in between."""
    from ..errors import VersionsNotContiguous
    from ..operators.segment import check_contiguous

    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    logs = read(spark, sf_dir, "events").groupBy((F.col("user_id") % 500).alias("log")).agg(F.sort_array(F.collect_set(day)).alias("versions")).collect()

    def whole(versions) -> bool:
        try:
            check_contiguous(versions)
        except VersionsNotContiguous:
            return False
        return True

    return spark.createDataFrame([(r["log"], whole(r["versions"])) for r in logs], "log long, contiguous boolean")


@query("SELECT date_diff('day', DATE '2024-01-01', ts::DATE) AS version, 20::INT AS parts FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(DISTINCT event_id % 20) = 20")
def checkpoint_completeness(spark, sf_dir):
    """A listing with a checkpoint part for each day and remainder of its errors: the complete checkpoints in it."""
    from ..operators.segment import complete_checkpoints
    from ..paths import checkpoint_names
    from ..sources.store import FileMeta

    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).alias("version")
    parts = read(spark, sf_dir, "events").where("event_type = 'error'").select(day, (F.col("event_id") % 20).cast("int").alias("part")).distinct().collect()
    files = [FileMeta(f"x/{checkpoint_names(r['version'], 20)[r['part']]}", 0, 1) for r in parts]
    return spark.createDataFrame([(c.version, c.parts) for c in complete_checkpoints(files)], "version long, parts int")


@query("SELECT * FROM orders")
def checkpoint_equivalence(spark, sf_dir):
    """The rows of a table of which the state comes from a two-part checkpoint and a later commit."""

    def make(t):
        rows = read(spark, sf_dir, "orders")
        t.append(rows.where("o_orderstatus <> 'P'").coalesce(2), ["o_orderstatus"])
        t.checkpoint(2)
        t.append(rows.where("o_orderstatus = 'P'").coalesce(2))

    t = built(spark, sf_dir, "checkpointed", make)
    return TableLog(spark, t.path).to_df()


@query("SELECT 'add' AS kind, 3 AS n UNION ALL SELECT 'protocol', 1 UNION ALL SELECT 'metaData', 1 UNION ALL SELECT 'remove', 1")
def checkpoint_contents(spark, sf_dir):
    """Kinds of rows in the checkpoint of a table of three active files and one removed."""
    from ..operators import checkpoint

    def make(t):
        rows = read(spark, sf_dir, "orders")
        for status in ("F", "O", "P"):
            t.append(rows.where(F.col("o_orderstatus") == status).coalesce(1), ["o_orderstatus"])
        t.delete(P.col("o_orderstatus") == "P")
        t.append(rows.where("o_orderstatus = 'P'").coalesce(1))

    rows = checkpoint.rows(built(spark, sf_dir, "orders_one_file", make).update())
    kind = F.coalesce(*(F.when(F.col(k).isNotNull(), F.lit(k)) for k in SCHEMA.names))
    return rows.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).cast("int").alias("n"))


# conflicts


@query("SELECT count(DISTINCT o_orderpriority) AS conflicts FROM orders WHERE o_orderpriority < '3'")
def conflict_append(spark, sf_dir):
    """Partitions that another transaction added to and the read predicate sees."""
    from pyspark.sql.types import StringType, StructField, StructType

    from ..actions import Add

    kinds = [r[0] for r in read(spark, sf_dir, "orders").select("o_orderpriority").distinct().collect()]
    adds = added_files(spark, [Add(f"f{i}", {"p": k}) for i, k in enumerate(kinds)])
    hit = matching(adds, P.col("p") < "3", StructType([StructField("p", StringType())]))
    return hit.agg(F.count(F.lit(1)).alias("conflicts"))


def _conflicts(spark, sf_dir, winner, mine=lambda kind: [], read_set=None) -> DataFrame:
    """Per order priority the conflict that the sweep finds with a commit about it: p, conflict."""
    from pyspark.sql.types import StringType, StructField, StructType

    from ..errors import ConcurrentModification
    from ..operators.conflict import SERIALIZABLE, ReadSet, Winner, check

    kinds = sorted(r[0] for r in read(spark, sf_dir, "orders").select("o_orderpriority").distinct().collect())  # five
    out = []
    for kind in kinds:
        try:
            check(spark, Winner.of([winner(kind)]), mine(kind), read_set or ReadSet(), StructType([StructField("p", StringType())]), SERIALIZABLE)
            out.append((kind, None))
        except ConcurrentModification as e:
            out.append((kind, type(e).__name__))
    return spark.createDataFrame(out, "p string, conflict string")


def _conflict_sql(name: str, condition: str) -> str:
    return f"SELECT DISTINCT o_orderpriority AS p, CASE WHEN {condition} THEN '{name}' END AS conflict FROM orders"


@query(_conflict_sql("ConcurrentDeleteRead", "o_orderpriority < '3'"))
def conflict_delete_read(spark, sf_dir):
    """Another transaction removes a priority's file; this one has read those below 3."""
    from ..actions import Remove
    from ..operators.conflict import ReadSet
    from ..paths import canonical

    own = ReadSet(files={canonical(r[0]) for r in read(spark, sf_dir, "orders").select("o_orderpriority").distinct().collect() if r[0] < "3"})
    return _conflicts(spark, sf_dir, lambda kind: Remove(kind, 1), read_set=own)


@query(_conflict_sql("ConcurrentDeleteDelete", "o_orderpriority < '3'"))
def conflict_delete_delete(spark, sf_dir):
    """Another transaction removes a priority's file; this one removes those below 3."""
    from ..actions import Remove

    return _conflicts(spark, sf_dir, lambda kind: Remove(kind, 1), lambda kind: [Remove(kind, 2)] if kind < "3" else [Remove("other", 2)])


@query(_conflict_sql("ConcurrentTransaction", "o_orderpriority >= '3'"))
def conflict_transaction(spark, sf_dir):
    """Another transaction commits for an application named by a priority; this one has read those from 3 on."""
    from ..operators.conflict import ReadSet

    own = ReadSet(app_ids={r[0] for r in read(spark, sf_dir, "orders").select("o_orderpriority").distinct().collect() if r[0] >= "3"})
    return _conflicts(spark, sf_dir, lambda kind: Txn(kind, 1), read_set=own)


@query(_conflict_sql("MetadataChanged", "o_orderpriority < '2'"))
def conflict_metadata(spark, sf_dir):
    """Another transaction changes the metadata, or only adds a file that this one has not read."""
    from ..actions import Add, Metadata

    return _conflicts(spark, sf_dir, lambda kind: Metadata() if kind < "2" else Add(kind, {"p": kind}))


@query(_conflict_sql("ProtocolChanged", "o_orderpriority < '2'"))
def conflict_protocol(spark, sf_dir):
    """Another transaction writes the protocol as this one does, or only this one does."""
    from ..actions import Add, Protocol

    return _conflicts(spark, sf_dir, lambda kind: Protocol() if kind < "2" else Add(kind, {"p": kind}), lambda kind: [Protocol()])


@query("SELECT * FROM nation")
def idempotent_append(spark, sf_dir):
    """The same streamed batch offered twice is applied once."""
    from ..streaming import sink

    def make(t):
        write = sink(t, "loader")
        for _ in range(2):
            write(read(spark, sf_dir, "nation").coalesce(1), 0)

    return built(spark, sf_dir, "idempotent", make).to_df()


@query("SELECT 'loader' AS app, 7 AS version, 1 AS applied")
def app_transactions(spark, sf_dir):
    def make(t):
        t.append(read(spark, sf_dir, "region").coalesce(1))
        tx = t.start_transaction()
        tx.txn_version("loader")
        tx.commit([Txn("loader", 7)], Operation.STREAMING_UPDATE)

    s = built(spark, sf_dir, "app_transactions", make).update()
    return s.set_transactions.select(F.col("appId").alias("app"), F.col("version").cast("int").alias("version"), F.lit(1).alias("applied"))


@query("SELECT n_nationkey, n_name, n_regionkey, NULL::VARCHAR AS note FROM nation WHERE n_regionkey < 2 UNION ALL SELECT n_nationkey, n_name, n_regionkey, 'new' FROM nation WHERE n_regionkey >= 2")
def schema_evolution_nulls(spark, sf_dir):
    def make(t):
        rows = read(spark, sf_dir, "nation")
        t.append(rows.where("n_regionkey < 2").coalesce(1))
        t.append(rows.where("n_regionkey >= 2").withColumn("note", F.lit("new")).coalesce(1))

    return built(spark, sf_dir, "evolved", make).to_df()


@query("SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING' UNION ALL SELECT c_custkey, c_name, c_nationkey, 0.0 AS c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def overwrite_partition(spark, sf_dir):
    def make(t):
        rows = read(spark, sf_dir, "customer")
        t.append(rows.repartition("c_mktsegment"), ["c_mktsegment"])
        t.overwrite(rows.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(0.0)).coalesce(1), P.col("c_mktsegment") == "BUILDING")

    return built(spark, sf_dir, "overwritten", make).to_df()


@query("SELECT 'CREATE_TABLE' AS operation, 0 AS version, NULL::INT AS read_version UNION ALL SELECT 'WRITE', 1, 0 UNION ALL SELECT 'DELETE', 2, 1")
def commit_info(spark, sf_dir):
    def make(t):
        rows = read(spark, sf_dir, "region")
        t.create(rows)
        t.append(rows.coalesce(1))
        t.delete()

    t = built(spark, sf_dir, "commit_info", make)
    info = t.changes(0).where("commitInfo is not null")
    return info.select("commitInfo.operation", F.col("version").cast("int").alias("version"), F.col("commitInfo.readVersion").cast("int").alias("read_version"))


@query("""WITH c AS (SELECT ts::DATE AS day, max(ts) AS t, row_number() OVER (ORDER BY ts::DATE) - 1 AS version FROM events GROUP BY 1)
    SELECT day, (SELECT coalesce(max(version), 0) FROM c WHERE epoch_ms(c.t) <= epoch_ms(d.day + INTERVAL 12 HOUR)) AS version,
           (SELECT min(version) FROM c WHERE epoch_ms(c.t) >= epoch_ms(d.day::TIMESTAMP)) AS next_version FROM c d""")
def version_by_time(spark, sf_dir):
    """A listing with a commit at each day's last event: the version in force at every noon (the first one before it), and the
    first at or after every midnight."""
    from ..operators import history
    from ..sources.store import FileMeta

    days = read(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.max("ts").alias("t")).orderBy("day")
    days = days.select("day", F.unix_millis(F.col("t").cast("timestamp")).alias("t"), F.unix_millis(F.col("day").cast("timestamp")).alias("midnight")).collect()
    files = [FileMeta(f"x/{v:020d}.json", r["t"], 1) for v, r in enumerate(days)]
    out = []
    for r in days:
        noon = history.commit_at(files, r["midnight"] + 12 * HOUR, True, False, True).version
        c = history.commit_at(files, r["midnight"], True, False, True)
        out.append((r["day"], noon, c.version if c.timestamp >= r["midnight"] else c.version + 1))
    return spark.createDataFrame(out, "day date, version long, next_version long")


# tables as frames: the rest of Spark SQL applies


def logs(spark, sf_dir):
    """lineitem and orders through the log; the small tables as they are."""
    lineitem_log(spark, sf_dir).to_df().createOrReplaceTempView("log_lineitem")
    orders_log(spark, sf_dir).to_df().createOrReplaceTempView("log_orders")
    for name in ("region", "nation", "customer", "supplier", "part"):
        read(spark, sf_dir, name).createOrReplaceTempView(f"log_{name}")


def sql_over_log(name: str, text: str) -> None:
    """A query with {x} for each table, over the log in Spark and over the plain tables in DuckDB."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

    def run(spark, sf_dir):
        logs(spark, sf_dir)
        return spark.sql(text.format(**{n: f"log_{n}" for n in names}))

    run.__name__ = name
    query(text.format(**{n: n for n in names}))(run)


_REVENUE = "CAST(round(sum(l_extendedprice * (1 - l_discount)), 2) AS decimal(18,2))"
sql_over_log("log_aggregate", "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS bigint) AS sum_qty, count(*) AS n, CAST(min(l_extendedprice) AS decimal(18,2)) AS low FROM {lineitem} GROUP BY l_returnflag, l_linestatus")
sql_over_log("log_join", f"SELECT r_name, n_name, {_REVENUE} AS revenue FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey GROUP BY r_name, n_name")
sql_over_log("log_semi_anti", "SELECT c_custkey FROM {customer} WHERE c_custkey IN (SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'F') AND NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
sql_over_log("log_window", "SELECT o_orderkey, o_custkey, place FROM (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM {orders}) x WHERE place <= 2")
sql_over_log("log_rollup", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {orders} GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
sql_over_log("log_cube", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)")
sql_over_log("log_set_operations", "SELECT o_custkey AS k FROM {orders} WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'O'")
sql_over_log("log_top", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
sql_over_log("log_left_join", "SELECT c_custkey, count(o_orderkey) AS n FROM {customer} LEFT JOIN {orders} ON o_custkey = c_custkey GROUP BY c_custkey")
sql_over_log("log_cte_subquery", "WITH t AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey) SELECT o_custkey, n FROM t WHERE n > (SELECT avg(n) FROM t)")
sql_over_log("log_distinct", "SELECT count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM {lineitem} WHERE l_returnflag = 'R'")
sql_over_log("log_union", "SELECT o_custkey AS k FROM {orders} WHERE o_orderstatus = 'P' UNION SELECT c_custkey FROM {customer} WHERE c_mktsegment = 'BUILDING'")
sql_over_log("log_intersect", "SELECT o_custkey AS k FROM {orders} WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'O'")
