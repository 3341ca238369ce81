import json

import pytest
from pyspark.sql.types import ArrayType, DecimalType, IntegerType, LongType, MapType, StringType, StructField, StructType

from quartzlog import config, paths, schema
from quartzlog.actions import Add, AddCdc, CommitInfo, Metadata, Operation, Protocol, Remove, Txn, line, unwrap
from quartzlog.errors import DuplicateColumns, IllegalArgument, InvalidColumnName, InvalidPartitionColumn, NestedNotNull, NonPartitionColumnAbsent, PartitionColumnsNotFound, SchemaChange, UnknownColumn

S = lambda *fields: StructType([StructField(*f) for f in fields])


def test_schema_round_trip_and_aliases():
    s = S(("a", LongType(), True, {"k": 1}), ("b", ArrayType(S(("x", IntegerType())))), ("m", MapType(StringType(), DecimalType(5, 2))))
    assert schema.parse(schema.dump(s)) == s
    text = json.dumps({"type": "struct", "fields": [{"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in (("a", "bigint"), ("b", "tinyint"), ("c", "smallint"), ("d", "null"), ("e", "decimal"), ("f", {"type": "array", "elementType": "bigint", "containsNull": True}))]})
    assert [f.dataType.simpleString() for f in schema.parse(text).fields] == ["bigint", "tinyint", "smallint", "void", "decimal(10,0)", "array<bigint>"]


A = S(("a", IntegerType(), True), ("n", S(("x", IntegerType(), True)), True), ("l", ArrayType(S(("x", IntegerType(), True))), True), ("m", MapType(StringType(), IntegerType(), True), True))


def changed(name, kind, nullable=True):
    return StructType([StructField(f.name, kind, nullable) if f.name == name else f for f in A.fields])


@pytest.mark.parametrize(
    "new,fits",
    [
        (A, True),
        (StructType([*A.fields, StructField("z", IntegerType(), False)]), True),
        (StructType(A.fields[1:]), False),
        (changed("a", LongType()), False),
        (changed("a", IntegerType(), False), False),
        (changed("n", S(("x", IntegerType(), False))), False),
        (changed("n", S(("x", IntegerType()), ("y", IntegerType()))), True),
        (changed("l", ArrayType(S(("X", IntegerType())))), False),
        (changed("l", ArrayType(S(("x", IntegerType())), False)), False),
        (changed("m", MapType(StringType(), IntegerType(), False)), False),
        (changed("m", MapType(IntegerType(), IntegerType(), True)), False),
        (changed("a", DecimalType(5, 2)), False),
    ],
)
def test_write_compatible(new, fits):
    assert schema.write_compatible(A, new) is fits


def test_write_compatible_refuses_names_by_case():
    with pytest.raises(SchemaChange):
        schema.write_compatible(A, S(("a", IntegerType()), ("A", IntegerType())))


def test_nested_not_null():
    schema.check_nested_not_null(S(("a", S(("x", IntegerType(), False)), False)))
    for kind in (ArrayType(S(("x", IntegerType(), False))), MapType(S(("x", IntegerType(), False)), StringType()), MapType(StringType(), ArrayType(S(("x", IntegerType(), False))))):
        with pytest.raises(NestedNotNull):
            schema.check_nested_not_null(S(("a", kind)))


@pytest.mark.parametrize("bad", list(" ,;{}()\n\t="))
def test_forbidden_names(bad):
    for name in (f"{bad}a", f"a{bad}", f"a{bad}b"):
        with pytest.raises(InvalidColumnName):
            schema.check_names([name])


def test_allowed_names():
    schema.check_names([f"a{c}b" for c in ".`#!@$%^&*~_<>?/:"])


def test_exploded_names_and_duplicates():
    s = S(("a", IntegerType()), ("b", ArrayType(IntegerType())), ("c", S(("c0", IntegerType()), ("c1", ArrayType(IntegerType())))), ("d", MapType(StringType(), IntegerType())), ("e.f", IntegerType()))
    assert schema.exploded_names(s) == ["a", "b", "c", "c.c0", "c.c1", "d", "`e.f`"]
    with pytest.raises(DuplicateColumns):
        schema.check_duplicates(S(("a", ArrayType(S(("x", IntegerType()), ("X", IntegerType()))))))
    with pytest.raises(UnknownColumn):
        schema.lookup(s, "zz")


def test_partition_columns():
    s = S(("a", StringType()), ("b", LongType()))
    schema.check_partition_columns(s, ["A"])
    schema.check_partition_columns(s, [])
    with pytest.raises(PartitionColumnsNotFound):
        schema.check_partition_columns(s, ["c"])
    with pytest.raises(NonPartitionColumnAbsent):
        schema.check_partition_columns(s, ["a", "b"])
    with pytest.raises(InvalidPartitionColumn):
        schema.check_partition_columns(S(("a b", LongType()), ("c", LongType())), ["a b"])


def test_log_names():
    assert paths.commit_name(7) == "00000000000000000007.json"
    assert paths.checkpoint_names(3, 2) == ["00000000000000000003.checkpoint.0000000001.0000000002.parquet", "00000000000000000003.checkpoint.0000000002.0000000002.parquet"]
    assert paths.is_checkpoint("x/00000000000000000003.checkpoint.parquet") and not paths.is_commit("x/00000000000000000003.checkpoint.parquet")
    assert paths.is_commit("00000000000000000003.json") and paths.version_of("a/00000000000000000003.json") == 3
    assert (paths.parts_of(paths.checkpoint_name(3, 1, 2)), paths.part_of(paths.checkpoint_name(3, 1, 2)), paths.parts_of(paths.checkpoint_name(3))) == (2, 1, None)


def test_path_forms():
    assert {paths.canonical(p) for p in ("file:/x/y", "file:///x/y", "/x/y")} == {"file:///x/y"}
    assert paths.canonical("a/b") == "a/b" and paths.canonical("s3://b/k") == "s3://b/k"
    assert paths.relative_to("/t", "a") == "a" and paths.relative_to("/t", "/t/a") == "a" and paths.relative_to("/t", "file:/u/a") == "file:///u/a"
    assert paths.relative_to("s3://b/t", "s3://b/t/a") == "s3://b/t/a"
    assert paths.physical("/t", "c=a%20b%253D1/f") == "/t/c=a b%3D1/f" and paths.encode("c=a b%3D1/f") == "c=a%20b%253D1/f"
    assert paths.partition_values("d/c=a b%3D1/p=__HIVE_DEFAULT_PARTITION__/f.parquet") == {"c": "a b=1", "p": None}
    with pytest.raises(IllegalArgument):
        paths.join("/t", "../u")


def test_durations_and_properties():
    assert config.duration_ms("interval 1 week") == 604_800_000 and config.duration_ms("interval 30 days") == 30 * 86_400_000 and config.duration_ms("interval 2 minutes") == 120_000
    for bad in ("1 week", "interval x day", "interval 1 month"):
        with pytest.raises(IllegalArgument):
            config.duration_ms(bad)
    assert config.checkpoint_interval({}) == 10 and config.checkpoint_interval({"checkpointInterval": "5", "delta.checkpointInterval": "3"}) == 3
    assert config.append_only({"appendOnly": "TRUE"}) and not config.append_only({})
    assert config.merged({"a": "1", "b": "2"}, {"a": "3"}) == {"a": "3", "b": "2"}
    with pytest.raises(IllegalArgument):
        config.checkpoint_interval({"checkpointInterval": "0"})
    clock = config.FixedClock(5)
    assert clock.wait_until(9) == 9 and clock.now_ms() == 9


@pytest.mark.parametrize(
    "action",
    [
        Add("a b", {"p": None, "q": "1"}, 3, 4, False, '{"numRecords":1}', {"t": "x"}), Add("x"), Remove("r"), Remove("r", 5, False, True, {"p": "1"}, 9, {"t": "y"}), AddCdc("c", {"p": "1"}, 2),
        Metadata('{"type":"struct","fields":[]}', ("p",), {"k": "v"}, "id", "n", "d", {"provider": "parquet", "options": {}}, 7), Metadata("", id="i", createdTime=None), Protocol(), Protocol(3, 7), Txn("app", 0), Txn("app", 2, 3),
        CommitInfo(None, 5, "WRITE", {"mode": "x"}, 1, "Serializable", True, {"n": "1"}, "u", "e", "id", "name", {"jobId": "1"}, {"notebookId": "2"}, "c"), CommitInfo(),
    ],
)
def test_actions_round_trip(action):
    assert unwrap(json.loads(line(action))) == action


def test_absent_members():
    assert unwrap({"add": {"path": "a"}}) == Add("a", dataChange=False)
    assert unwrap({"txn": {"appId": "x"}}).version == 0
    assert unwrap({"other": {}}) is None
    assert Add("a", {"p": "1"}, 3).remove(8) == Remove("a", 8, True, True, {"p": "1"}, 3)
    assert len(Operation) == 17
