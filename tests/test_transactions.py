import multiprocessing

import pytest

from quartzlog import TableLog, schema
from quartzlog.actions import Add, CommitInfo, Metadata, Operation, Protocol, Remove, Txn
from quartzlog.errors import AppendOnlyViolation, ConcurrentAppend, ConcurrentDeleteDelete, ConcurrentDeleteRead, ConcurrentTransaction, IllegalState, InvalidProtocol, MetadataAbsent, MetadataChanged, NonPartitionColumnAbsent, PartitioningMismatch, PartitionColumnsNotFound, ProtocolChanged, SchemaChange
from quartzlog.functions import predicate as P

PLAIN = "x int, y int"
X1 = P.col("x") == 1


def xadd(path, x):
    return Add(path, {"x": str(x)}, 1)


def table(spark, path, *files, by=()):
    t = TableLog(spark, str(path))
    tx = t.start_transaction()
    from pyspark.sql.types import StructType

    tx.update_metadata(Metadata(schema.dump(StructType.fromDDL(PLAIN)), tuple(by)))
    tx.commit(list(files), Operation.CREATE_TABLE)
    return t


#: name: (partitioned, files, what A reads, what B commits, what A commits, the conflict)
MATRIX = {
    "append / append": (False, [], lambda a: a.metadata, [Add("a")], [Add("b")], None),
    "disjoint transactions": (False, [], lambda a: a.txn_version("t1"), [Txn("t2", 0)], [], None),
    "disjoint delete / read": (True, [xadd("a", 2)], lambda a: a.mark_files_as_read(X1), [Remove("a", 4)], [], None),
    "disjoint add / read": (True, [], lambda a: a.mark_files_as_read(X1), [xadd("a", 2)], [], None),
    "add / read without write": (True, [], lambda a: a.mark_files_as_read(X1), [xadd("a", 1)], [], None),
    "delete / delete": (False, [Add("a")], lambda a: None, [Remove("a", 4)], [Remove("a", 5)], ConcurrentDeleteDelete),
    "add / read and write": (True, [], lambda a: a.mark_files_as_read(X1), [xadd("a", 1)], [xadd("b", 1)], ConcurrentAppend),
    "delete / read": (True, [xadd("a", 1)], lambda a: a.mark_files_as_read(X1), [Remove("a", 4)], [], ConcurrentDeleteRead),
    "schema change": (False, [], lambda a: a.metadata, "metadata", [], MetadataChanged),
    "conflicting transactions": (False, [], lambda a: a.txn_version("t1"), [Txn("t1", 0)], [], ConcurrentTransaction),
    "upgrade / upgrade": (False, [], lambda a: a.metadata, [Protocol()], [Protocol()], ProtocolChanged),
    "whole table / add": (True, [xadd("a", 2)], lambda a: (a.mark_files_as_read(X1), a.read_whole_table()), [xadd("b", 3)], [xadd("c", 4)], ConcurrentAppend),
    "whole table / remove": (False, [Add("a")], lambda a: a.read_whole_table(), [Remove("a", 4)], [Add("b")], ConcurrentDeleteRead),
    "read without predicate / add": (False, [], lambda a: a.mark_files_as_read(), [Add("a")], [Add("b")], ConcurrentAppend),
}


@pytest.mark.parametrize("name", MATRIX)
def test_conflicts(spark, tmp_path, name):
    partitioned, files, read, first, second, conflict = MATRIX[name]
    t = table(spark, tmp_path, *files, by=["x"] if partitioned else [])
    a = t.start_transaction()
    read(a)
    b = TableLog(spark, str(tmp_path)).start_transaction()
    if first == "metadata":
        from dataclasses import replace

        first = [replace(b.metadata, description="new")]
    assert b.commit(first) == 1
    if conflict is None:
        assert a.commit(second) == 2 and t.snapshot.version == 2
    else:
        with pytest.raises(conflict):
            a.commit(second)
        assert TableLog(spark, str(tmp_path)).snapshot.version == 1


def test_commit_info_of_a_commit(spark, tmp_path):
    t = table(spark, tmp_path)
    tx = t.start_transaction()
    v = tx.commit([Add("a")], Operation.WRITE, {"mode": "Append"}, "note", {"files": "1"})
    info = t.commit_info_at(v)
    assert (info.operation, info.readVersion, info.isolationLevel, info.isBlindAppend, info.userMetadata, info.operationParameters) == ("WRITE", 0, "Serializable", True, "note", {"mode": "Append"})
    tx = t.start_transaction()
    tx.mark_files_as_read(P.TRUE)
    info = t.commit_info_at(tx.commit([Add("b", dataChange=False)]))
    assert (info.isolationLevel, info.isBlindAppend) == ("SnapshotIsolation", False)
    with pytest.raises(IllegalState):
        tx.commit([])
    with pytest.raises(IllegalState):
        t.start_transaction().commit([CommitInfo()])


def test_first_commit_needs_metadata(spark, tmp_path):
    with pytest.raises(MetadataAbsent):
        TableLog(spark, str(tmp_path)).start_transaction().commit([Add("a")])
    assert not TableLog(spark, str(tmp_path)).exists


def test_metadata_rules(spark, tmp_path):
    t = table(spark, tmp_path, xadd("a", 1), by=["x"])
    s = lambda ddl: schema.dump(spark.createDataFrame([], ddl).schema)
    for bad, error in ((Metadata(s(PLAIN), ("z",)), PartitionColumnsNotFound), (Metadata(s(PLAIN), ("x", "y")), NonPartitionColumnAbsent), (Metadata(s(PLAIN), ("x",), {"delta.minReaderVersion": "1"}), IllegalState)):
        with pytest.raises(error):
            t.start_transaction().update_metadata(bad)
    for bad in (Metadata(s("x int"), ()), Metadata(s("x int, y string"), ("x",)), Metadata(s(PLAIN), ("y",))):
        with pytest.raises(SchemaChange):
            t.start_transaction().commit([bad])
    assert t.start_transaction().commit([Metadata(s("x int, y string"), ("x",)), Remove("a", 1, partitionValues={"x": "1"})]) == 1  # no old data stays
    tx = t.start_transaction()
    tx.update_metadata(Metadata(s("x int, y string, z int"), ("x",)))
    with pytest.raises(IllegalState):
        tx.update_metadata(tx.metadata)
    assert tx.commit([]) == 2 and t.schema.names == ["x", "y", "z"]


def test_files_and_protocol_rules(spark, tmp_path):
    t = table(spark, tmp_path, xadd("a", 1), by=["x"])
    for bad, error in ((Add("b"), PartitioningMismatch), (Add("b", {"x": "1", "y": "1"}), PartitioningMismatch), (Protocol(1, 7), InvalidProtocol)):
        with pytest.raises(error):
            t.start_transaction().commit([bad])
    from dataclasses import replace

    t.start_transaction().commit([replace(t.snapshot.metadata, configuration={"appendOnly": "true"})])
    with pytest.raises(AppendOnlyViolation):
        t.start_transaction().commit([Remove("a", 1)])
    assert t.start_transaction().commit([Remove("a", 1, dataChange=False)]) == 2


def test_paths_are_relative_to_the_table(spark, tmp_path):
    t = table(spark, tmp_path)
    t.start_transaction().commit([Add(f"{tmp_path}/a"), Add("/elsewhere/b"), Add("s3://k/c")])
    assert {a.path for a in t.actions_of(1) if isinstance(a, Add)} == {"a", "file:///elsewhere/b", "s3://k/c"}


def _append(path, k):
    from quartzlog.errors import CommitFileExists
    from quartzlog.paths import LOG_DIR, commit_name
    from quartzlog.sources.store import LocalStore

    store, version = LocalStore(f"{path}/{LOG_DIR}"), 1
    while True:
        try:
            store.write(commit_name(version), ['{"add":{"path":"%s","partitionValues":{},"size":1,"modificationTime":0,"dataChange":true}}' % k])
            return version
        except CommitFileExists:
            version += 1


def test_processes_race(spark, tmp_path):
    t = table(spark, tmp_path)
    with multiprocessing.get_context("spawn").Pool(4) as pool:
        versions = pool.starmap(_append, [(str(tmp_path), k) for k in range(12)])
    assert sorted(versions) == list(range(1, 13)) and t.update().num_files == 12


def test_blind_appends_of_stale_handles_all_land(spark, tmp_path):
    table(spark, tmp_path)
    waiting = [TableLog(spark, str(tmp_path)).start_transaction() for _ in range(3)]
    assert [tx.commit([Add(f"f{k}")]) for k, tx in enumerate(waiting)] == [1, 2, 3]
