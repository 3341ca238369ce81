import json
import os


import pytest

from quartzlog import TableLog
from quartzlog.actions import Add, CommitInfo, Metadata, Protocol, Remove, Txn, line
from quartzlog.config import FixedClock
from quartzlog.errors import ActionNotFound, CommitFileExists, FileNotFound, IllegalArgument, IllegalState, InvalidProtocol, MissingCheckpointPart, NoReproducibleHistory, TimestampTooEarly, TimestampTooLate, VersionNotFound, VersionsNotContiguous
from quartzlog.functions import predicate as P
from quartzlog.operators import history, replay
from quartzlog.operators.segment import find_segment
from quartzlog.paths import LOG_DIR, commit_name
from quartzlog.sources.store import FileMeta, HadoopStore, LocalStore

INTS = '{"type":"struct","fields":[%s]}' % ",".join(f'{{"name":"col{k}","type":"integer","nullable":true,"metadata":{{}}}}' for k in range(1, 5))


def put(path, version, *found, at=None):
    folder = f"{path}/{LOG_DIR}"
    os.makedirs(folder, exist_ok=True)
    name = f"{folder}/{commit_name(version)}"
    with open(name, "w") as f:
        f.write("".join((x if isinstance(x, str) else line(x)) + "\n" for x in found))
    if at is not None:
        os.utime(name, (at / 1000, at / 1000))


def paths_of(df):
    return sorted(r["path"] for r in df.select("path").collect())


def start(path, *more, partition=(), at=None):
    put(path, 0, CommitInfo(), Protocol(), Metadata(INTS, tuple(partition)), *more, at=at)


def test_replay_last_action_wins(spark, tmp_path):
    start(tmp_path, Add("a", size=1), Add("b", size=2))
    put(tmp_path, 1, Remove("a", 10**15), Add("c", size=4))
    put(tmp_path, 2, Add("a", size=8), Remove("b", 10**15), Txn("x", 1))
    put(tmp_path, 3, Txn("x", 4), Txn("y", 2), Remove("gone", 5))
    s = TableLog(spark, str(tmp_path)).snapshot
    assert (s.version, paths_of(s.files), s.transactions) == (3, ["a", "c"], {"x": 4, "y": 2})
    assert s.counts == {"num_files": 2, "size_in_bytes": 12, "num_removes": 1, "num_set_transactions": 2}
    assert paths_of(s.tombstones) == ["b"]  # `gone` is past its retention
    assert s.files.where("dataChange").count() == 0
    assert [f.name for f in s.log_files] == [commit_name(v) for v in range(4)]


def test_paths_are_canonical(spark, tmp_path):
    start(tmp_path, Add("file:/x/a"), Add("s3://b/k"))
    put(tmp_path, 1, Remove("/x/a", 10**15))
    assert paths_of(TableLog(spark, str(tmp_path)).snapshot.files) == ["s3://b/k"]


def test_scan_keeps_first_line_of_a_commit(spark, tmp_path):
    start(tmp_path, partition=["col1", "col2"])
    values = lambda c2=0: {"col1": "0", "col2": str(c2)}
    put(tmp_path, 1, Add("a", values(), modificationTime=10), Add("b", values(1), modificationTime=11), Add("d", values()))
    put(tmp_path, 2, Add("a", values(), modificationTime=20), Remove("d", 10**15))
    put(tmp_path, 3, Add("f", values(), modificationTime=130), Add("f", values(), modificationTime=131))
    put(tmp_path, 4)  # empty commits are legal
    s = TableLog(spark, str(tmp_path)).snapshot
    both = (P.col("col1") == 0) & (P.col("col2") == 0)
    got = lambda **k: sorted((r["path"], r["modificationTime"]) for r in s.scan(both, **k).files.collect())
    assert got(first_in_commit=True) == [("a", 20), ("f", 130)]
    assert got() == [("a", 20), ("f", 131)]


def test_scan_split_and_pruning(spark, tmp_path):
    adds = [Add(str(i), {"col1": str(i % 3), "col2": str(i % 2)}) for i in range(11)]
    start(tmp_path, *adds, Add("null", {"col1": None, "col2": ""}), partition=["col1", "col2"])
    s = TableLog(spark, str(tmp_path)).snapshot
    c = {k: P.col(f"col{k}") for k in range(1, 5)}
    scan = s.scan((c[1] == 0) & (c[3] == 5) & (c[2] < c[4]))
    assert repr(scan.pushed) == "(Column(col1) = 0)" and "col3" in repr(scan.residual)
    assert paths_of(scan.files) == sorted(["0", "3", "6", "9"])
    assert paths_of(s.scan((c[1] == 0) & (c[2] == 1)).files) == ["3", "9"]
    assert paths_of(s.scan(c[1].is_null() & c[2].is_null()).files) == ["null"]
    assert s.scan(c[3] == 1).pushed is None and s.scan(c[3] == 1).files.count() == 12
    every = s.scan()
    assert (every.predicate, every.pushed, every.residual) == (None, None, None)
    assert paths_of(s.scan(~(c[3].is_null())).files) == paths_of(s.files)  # a data column is never judged by partitions


def test_malformed_partition_value_is_an_error(spark, tmp_path):
    start(tmp_path, Add("a", {"col1": "x"}), partition=["col1"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        TableLog(spark, str(tmp_path)).snapshot.scan(P.col("col1") == 1).files.collect()


def test_time_travel(spark, tmp_path):
    base, minutes = 1_540_415_658_000, 60_000
    start(tmp_path, Add("a"), at=base)
    put(tmp_path, 1, Add("b"), at=base + 20 * minutes)
    put(tmp_path, 2, Add("c"), at=base + 40 * minutes)
    t = TableLog(spark, str(tmp_path))
    at = lambda m: t.snapshot_at_timestamp(base + m * minutes).version
    assert [t.snapshot_at(v).num_files for v in range(3)] == [1, 2, 3]
    assert [at(m) for m in (0, 10, 20, 30, 40)] == [0, 0, 1, 1, 2]
    with pytest.raises(TimestampTooLate):
        at(50)
    with pytest.raises(TimestampTooEarly):
        at(-1)
    for v in (-1, 3):
        with pytest.raises(VersionNotFound):
            t.snapshot_at(v)
    assert [t.version_at_or_before(base + m * minutes) for m in (0, 30, 99)] == [0, 1, 2]
    assert [t.version_at_or_after(base + m * minutes) for m in (-9, 0, 10, 40)] == [0, 0, 1, 2]
    with pytest.raises(TimestampTooLate):
        t.version_at_or_after(base + 41 * minutes)
    absent = TableLog(spark, str(tmp_path / "none"))
    assert (absent.version_at_or_before(0), absent.version_at_or_after(0), absent.exists) == (-1, -1, False)


def test_history_without_first_commits(spark, tmp_path):
    start(tmp_path, Add("0"), at=1000)
    for v in range(1, 36):
        put(tmp_path, v, Add(str(v)), at=1000 * (v + 1))
    t = TableLog(spark, str(tmp_path))
    from quartzlog.operators import checkpoint

    checkpoint.write(t.snapshot_at(30), t.store)
    for v in range(25):
        os.unlink(f"{tmp_path}/{LOG_DIR}/{commit_name(v)}")
    t = TableLog(spark, str(tmp_path))
    assert t.snapshot.num_files == 36
    assert t.version_at_or_before(26_000) == 25 and t.version_at_or_after(1) == 25
    with pytest.raises(TimestampTooEarly):
        t.version_at_or_before(25_999)
    with pytest.raises(VersionNotFound):
        t.snapshot_at(29)
    assert t.snapshot_at(31).num_files == 32
    assert history.earliest_commit(t.store.list_from()) == 25 and history.earliest_reproducible(t.store.list_from()) == 30
    with pytest.raises(NoReproducibleHistory):
        history.earliest_reproducible([FileMeta("x/00000000000000000004.json", 0, 1)])


def test_commit_info_and_changes(spark, tmp_path):
    start(tmp_path, Add("a"))
    put(tmp_path, 1, CommitInfo(operation="DELETE", timestamp=5), Remove("a", 5), '{"cdc":{"path":"c"}}', Txn("x", 1))
    put(tmp_path, 2, Add("b"))
    t = TableLog(spark, str(tmp_path))
    assert (t.commit_info_at(1).operation, t.commit_info_at(1).version, t.commit_info_at(2)) == ("DELETE", 1, CommitInfo(version=2))
    with pytest.raises(VersionNotFound):
        t.commit_info_at(9)
    rows = t.changes(1).collect()
    kinds = {v: [k for r in sorted((r for r in rows if r["version"] == v), key=lambda r: r["pos"]) for k in ("add", "remove", "metaData", "txn", "protocol", "cdc", "commitInfo") if r[k] is not None] for v in (1, 2)}
    assert kinds == {1: ["commitInfo", "remove", "cdc", "txn"], 2: ["add"]}
    assert t.changes(7).count() == 0
    with pytest.raises(IllegalArgument):
        t.changes(-1)
    os.unlink(f"{tmp_path}/{LOG_DIR}/{commit_name(1)}")
    assert {r["version"] for r in t.changes(0).collect()} == {0, 2}
    for first in (0, 1):
        with pytest.raises(IllegalState):
            t.changes(first, fail_on_data_loss=True)


def test_logs_that_do_not_open(spark, tmp_path):
    put(tmp_path / "gap", 0, Protocol(), Metadata(INTS))
    put(tmp_path / "gap", 2, Add("a"))
    with pytest.raises(VersionsNotContiguous):
        TableLog(spark, str(tmp_path / "gap")).snapshot
    put(tmp_path / "reader", 0, Protocol(99, 2), Metadata(INTS))
    with pytest.raises(InvalidProtocol):
        TableLog(spark, str(tmp_path / "reader")).snapshot
    put(tmp_path / "protocol", 0, Metadata(INTS))
    put(tmp_path / "metadata", 0, Protocol())
    for missing in ("protocol", "metadata"):
        with pytest.raises(ActionNotFound, match="0"):
            TableLog(spark, str(tmp_path / missing)).snapshot


def test_update_and_deleted_folder(spark, tmp_path):
    start(tmp_path, Add("a"))
    t = TableLog(spark, str(tmp_path))
    first = t.snapshot
    assert t.update() is first
    put(tmp_path, 1, Add("b"))
    assert t.snapshot is first and t.update().version == 1
    for f in os.scandir(f"{tmp_path}/{LOG_DIR}"):
        os.unlink(f)
    assert t.update().version == -1 and t.snapshot.files.count() == 0


def test_checkpoints(spark, tmp_path):
    start(tmp_path, Add("0", size=1), Txn("x", 3))
    for v in range(1, 15):
        put(tmp_path, v, Remove(str(v - 1), 10**15), Add(str(v), {"k": None} if v == 20 else {}, size=1, tags={"t": "1"}))
    t = TableLog(spark, str(tmp_path))
    plain = {v: paths_of(t.snapshot_at(v).files) for v in (9, 10, 14)}
    from quartzlog.operators import checkpoint

    assert checkpoint.write(t.snapshot_at(10), t.store) == 14  # metadata, protocol, a transaction, a file, ten removes
    for parts in (1, 3):
        again = TableLog(spark, str(tmp_path))
        assert again.snapshot.segment.checkpoint_version == 10 and len(again.snapshot.segment.commits) == 4
        assert {v: paths_of(again.snapshot_at(v).files) for v in plain} == plain
        assert again.snapshot.transactions == {"x": 3} and again.snapshot.counts["num_removes"] == 14
        checkpoint.write(t.snapshot_at(10), t.store, 3)
    with open(f"{tmp_path}/{LOG_DIR}/_last_checkpoint", "w") as f:
        f.write("{damaged")
    assert TableLog(spark, str(tmp_path)).snapshot.segment.checkpoint_version == 10
    for f in os.listdir(f"{tmp_path}/{LOG_DIR}"):
        if "checkpoint.parquet" in f or ".0000000002.0000000003" in f:
            os.unlink(f"{tmp_path}/{LOG_DIR}/{f}")
    assert TableLog(spark, str(tmp_path)).snapshot.segment.checkpoint_version is None  # a part is missing: replay commits
    for v in range(11):
        os.unlink(f"{tmp_path}/{LOG_DIR}/{commit_name(v)}")
    with pytest.raises((MissingCheckpointPart, VersionsNotContiguous)):
        TableLog(spark, str(tmp_path)).snapshot


def test_checkpoint_without_an_action_does_not_open(spark, tmp_path):
    from pyspark.sql import functions as F

    from quartzlog.operators import checkpoint

    start(tmp_path, Add("a"))
    for v in range(1, 11):
        put(tmp_path, v, Add(str(v)))
    t = TableLog(spark, str(tmp_path))
    for kind in ("protocol", "metaData"):
        rows = checkpoint.rows(t.snapshot).where(F.col(kind).isNull())
        rows.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/aside")
        part = next(f"{tmp_path}/aside/{f}" for f in os.listdir(f"{tmp_path}/aside") if f.endswith(".parquet"))
        os.replace(part, f"{tmp_path}/{LOG_DIR}/{10:020d}.checkpoint.parquet")
        with pytest.raises(ActionNotFound, match="10"):
            TableLog(spark, str(tmp_path)).snapshot


@pytest.mark.parametrize("kind", ["local", "hadoop"])
def test_stores(spark, tmp_path, kind):
    store = LocalStore(str(tmp_path / "s")) if kind == "local" else HadoopStore(spark, f"file://{tmp_path}/s")
    assert store.list_from() == [] and not store.exists()
    store.create()
    store.write("b", ["1", "é"])
    store.write("a", ["x"])
    assert [f.name for f in store.list_from() if not f.name.startswith(".")] == ["a", "b"] and [f.name for f in store.list_from("b") if not f.name.startswith(".")] == ["b"]
    assert store.read("b")[:2] == ["1", "é"] and store.exists("a")
    with pytest.raises(CommitFileExists):
        store.write("a", ["y"])
    assert store.read("a")[0] == "x"
    store.write("a", ["z"], overwrite=True)
    assert store.read("a")[0] == "z"
    with pytest.raises(FileNotFound):
        store.read("none")
    with pytest.raises(IllegalArgument):
        store.write("../x", [])
    store.remove("a")
    assert not store.exists("a")


def test_one_of_many_writers_wins(tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def attempt(k):
        try:
            LocalStore(str(tmp_path)).write("00000000000000000001.json", [str(k)] * 50)
            return k
        except CommitFileExists:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [k for k in pool.map(attempt, range(32)) if k is not None]
    assert len(won) == 1 and LocalStore(str(tmp_path)).read("00000000000000000001.json")[:-1] == [str(won[0])] * 50
    assert len(os.listdir(tmp_path)) == 1


def test_rows_through_the_log(spark, tmp_path):
    rows = spark.range(30).selectExpr("id", "case when id % 3 = 0 then null when id % 3 = 1 then 'a b=1' else 'x%y' end p", "cast(id as double) v")
    t = TableLog(spark, str(tmp_path / "t [1]"))
    assert t.append(rows, ["p"]) == 0
    assert set(map(tuple, t.to_df().collect())) == set(map(tuple, rows.collect()))
    assert t.to_df(P.col("p") == "a b=1").count() == 10 and t.to_df(P.col("p").is_null() & (P.col("v") < 10.0)).count() == 4
    import quartzlog.operators.snapshot as module

    keep, module.CONSTANT_TUPLES = module.CONSTANT_TUPLES, 0  # by join on the file's path
    try:
        assert set(map(tuple, t.to_df().collect())) == set(map(tuple, rows.collect()))
    finally:
        module.CONSTANT_TUPLES = keep
    plan = t.to_df((P.col("p") == "x%y") & (P.col("v") > 3.0))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(v,3.0)" in plan
    assert t.append(rows.withColumn("w", rows.v)) == 1
    assert t.to_df().where("w is null").count() == 30 and t.to_df(version=0).columns == ["id", "p", "v"]
    assert t.overwrite(rows.withColumn("w", rows.v).limit(2)) == 2 and t.to_df().count() == 2
    assert t.delete() == 3 and t.to_df().count() == 0 and t.to_df().columns == ["id", "p", "v", "w"]


def test_created_and_empty(spark, tmp_path):
    t = TableLog(spark, str(tmp_path), clock=FixedClock(77), defaults={"checkpointInterval": "2"})
    t.create(spark.range(1), configuration={"x": "y"})
    assert t.snapshot.metadata.configuration == {"checkpointInterval": "2", "x": "y"} and t.to_df().count() == 0
    assert t.commit_info_at(0).timestamp == 77
    t.append(spark.range(3))
    t.append(spark.range(2))
    assert t.snapshot.version == 2 and TableLog(spark, str(tmp_path)).snapshot.segment.checkpoint_version == 2  # the interval's checkpoint
    assert TableLog(spark, str(tmp_path)).to_df().count() == 5


def test_segment_of_absent_version(spark, tmp_path):
    start(tmp_path)
    with pytest.raises(IllegalState):
        find_segment(LocalStore(f"{tmp_path}/{LOG_DIR}"), 5)
    assert json.loads(TableLog(spark, str(tmp_path)).snapshot.metadata.schemaString)["type"] == "struct"


def test_streaming(spark, tmp_path):
    from quartzlog.streaming import sink, tail

    t = TableLog(spark, str(tmp_path / "t"))
    write = sink(t, "app")
    batch = spark.range(4).coalesce(1)
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert t.to_df().count() == 8 and t.snapshot.transactions == {"app": 1}
    spark.range(6).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run has nothing new
        q = stream.writeStream.foreachBatch(sink(t, "stream")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
    assert t.to_df().count() == 14
    q = tail(spark, t).writeStream.format("memory").queryName("tailed").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("tailed").where("add is not null").count() == 3 and spark.table("tailed").agg({"version": "max"}).first()[0] == 2


def test_replay_of_a_checkpoint_equals_replay_of_commits(spark, tmp_path):
    start(tmp_path, *(Add(f"f{k}", size=k) for k in range(20)))
    for v in range(1, 6):
        put(tmp_path, v, *(Remove(f"f{k}", 10**15) for k in range(v, 20, 5)), *(Add(f"g{v}{k}", size=1) for k in range(3)))
    t = TableLog(spark, str(tmp_path))
    before = [sorted(map(str, t.snapshot_at(v).files.collect())) for v in range(6)]
    from quartzlog.operators import checkpoint

    for v in (1, 3, 5):
        checkpoint.write(t.snapshot_at(v), t.store, 1 + v % 2)
    assert [sorted(map(str, TableLog(spark, str(tmp_path)).snapshot_at(v).files.collect())) for v in range(6)] == before
    assert replay.commit_actions(spark, []).count() == 0



def test_table_through_hadoop_file_systems(spark, tmp_path, monkeypatch):
    import quartzlog.table as module

    monkeypatch.setattr(module, "open_store", lambda s, folder: HadoopStore(s, f"file://{folder}"))
    t = TableLog(spark, str(tmp_path / "t"))
    rows = spark.range(12).selectExpr("id", "cast(id % 3 as int) p")
    t.append(rows, ["p"])
    t.delete(P.col("p") == 1)
    t.checkpoint(2)
    t.append(rows.where("p = 1"))
    again = TableLog(spark, str(tmp_path / "t"))
    assert again.snapshot.segment.checkpoint_version == 1 and again.snapshot.version == 2
    assert sorted(map(tuple, again.to_df().collect())) == sorted(map(tuple, rows.collect()))
    assert again.to_df(P.col("p") == 2).count() == 4 and again.to_df(version=1).count() == 8


@pytest.mark.parametrize("bad", ['{"add":{"path":"b"', "garbled", '{"add":{"path":"b","size":"many"}}'])
def test_malformed_lines_fail_and_blank_ones_do_not(spark, tmp_path, bad):
    start(tmp_path / "t", Add("a"), "", "  ", Add("c"))
    assert paths_of(TableLog(spark, str(tmp_path / "t")).snapshot.files) == ["a", "c"]
    put(tmp_path / "t", 1)  # an empty commit
    assert TableLog(spark, str(tmp_path / "t")).snapshot.num_files == 2
    put(tmp_path / "t", 2, Add("d"), bad, Add("e"))
    with pytest.raises(Exception, match="(?i)malformed"):
        TableLog(spark, str(tmp_path / "t")).snapshot.files.collect()


def test_a_table_made_anew_at_its_path_is_read_anew(spark, tmp_path):
    import shutil

    t = TableLog(spark, str(tmp_path / "t"))
    t.append(spark.range(30).repartition(3))
    assert t.snapshot.num_files == 3 and t.to_df().count() == 30
    shutil.rmtree(tmp_path / "t")
    other = TableLog(spark, str(tmp_path / "t"))
    other.append(spark.range(5).coalesce(1))
    again = TableLog(spark, str(tmp_path / "t"))
    assert (again.snapshot.num_files, again.to_df().count(), t.update().num_files) == (1, 5, 1)


def test_two_sinks_of_one_batch_write_it_once(spark, tmp_path, monkeypatch):
    from quartzlog.streaming import sink

    TableLog(spark, str(tmp_path)).append(spark.range(1).coalesce(1))
    late, early = TableLog(spark, str(tmp_path)), TableLog(spark, str(tmp_path))
    batch, write_files = spark.range(10).coalesce(1), late.write_files

    def after_the_other(*args):
        monkeypatch.setattr(late, "write_files", write_files)
        sink(early, "app")(batch, 0)
        return write_files(*args)

    monkeypatch.setattr(late, "write_files", after_the_other)
    sink(late, "app")(batch, 0)
    assert TableLog(spark, str(tmp_path)).to_df().count() == 11


def test_a_failed_checkpoint_leaves_the_commit(spark, tmp_path, monkeypatch):
    from quartzlog.operators import checkpoint

    t = TableLog(spark, str(tmp_path), defaults={"checkpointInterval": "1"})
    t.create(spark.range(1))
    monkeypatch.setattr(checkpoint, "write", lambda *a: 1 / 0)
    with pytest.warns(UserWarning, match="version 1 is committed"):
        assert t.append(spark.range(3)) == 1
    assert TableLog(spark, str(tmp_path)).to_df().count() == 3


def test_checkpoints_come_in_parts_by_size(spark, tmp_path, monkeypatch):
    from quartzlog.operators import checkpoint

    monkeypatch.setattr(checkpoint, "PART_FILES", 8)
    start(tmp_path, *(Add(f"f{k}", size=k) for k in range(20)))
    t = TableLog(spark, str(tmp_path))
    t.checkpoint()
    assert len(TableLog(spark, str(tmp_path)).snapshot.segment.checkpoint) == 3 and TableLog(spark, str(tmp_path)).snapshot.num_files == 20


@pytest.mark.parametrize("conditional", [True, False])
def test_two_writers_of_a_hadoop_store(spark, tmp_path, conditional):
    stores = [HadoopStore(spark, f"file://{tmp_path}/s") for _ in range(2)]
    for s in stores:
        s.conditional = conditional
        s.create()
    wins = []
    for k, s in enumerate(stores):
        try:
            s.write("a", [f"writer {k}"])
            wins.append(k)
        except CommitFileExists:
            pass
    assert wins == [0] and stores[1].read("a") == ["writer 0", ""]
    stores[1].write("a", ["new"], overwrite=True)
    assert stores[0].read("a") == ["new", ""] and [f.name for f in stores[0].list_from("a")] == ["a"]


def test_a_damaged_hint_is_read_again(spark, tmp_path, monkeypatch):
    from quartzlog.operators import segment

    monkeypatch.setattr(segment, "HINT_PAUSE", 0)

    class Store:
        reads = ["{", '{"version": 3, "size": 1}']

        def read(self, name):
            return [self.reads.pop(0)]

    assert segment.read_hint(Store()) == (3, None)
    Store.reads = ["{"] * 3
    assert segment.read_hint(Store()) is None and not Store.reads


def test_overwrite_refuses_rows_of_other_partitions(spark, tmp_path):
    t = TableLog(spark, str(tmp_path))
    rows = spark.range(12).selectExpr("id", "cast(id % 3 as int) p")
    t.append(rows, ["p"])
    with pytest.raises(IllegalArgument):
        t.overwrite(rows, P.col("p") == 1)
    with pytest.raises(IllegalArgument):
        t.overwrite(rows, P.col("id") == 1)
    assert t.overwrite(rows.where("p = 1 and id > 5"), P.col("p") == 1) == 1 and t.to_df().count() == 10
