import datetime
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from quartzlog.errors import FieldTypeMismatch
from quartzlog.functions import predicate as P

VALUES = {
    "int": (1, 2), "bigint": (1, 2), "smallint": (1, 2), "tinyint": (1, 2), "float": (1.0, 2.5), "double": (1.0, 2.5), "boolean": (False, True),
    "string": ("a", "b"), "decimal(6,2)": (decimal.Decimal("1.10"), decimal.Decimal("2.20")), "binary": (bytearray(b"\x01"), bytearray(b"\x80")),
    "date": (datetime.date(2020, 1, 1), datetime.date(2020, 1, 2)), "timestamp": (datetime.datetime(2020, 1, 1), datetime.datetime(2020, 1, 2)),
}


def evaluate(spark, kind, left, right, build):
    row = spark.createDataFrame([(left, right)], f"l {kind}, r {kind}")
    return row.select(build(P.col("l"), P.col("r")).column().alias("v")).first()["v"]


@pytest.mark.parametrize("kind", VALUES)
def test_comparisons(spark, kind):
    low, high = VALUES[kind]
    row = spark.createDataFrame([(low, high, None)], f"a {kind}, b {kind}, n {kind}")
    a, b, n = (P.col(c) for c in "abn")
    cases = {a == b: False, a < b: True, a <= b: True, a > b: False, a >= b: False, a == a: True, a <= a: True, a >= a: True, a < a: False, b > a: True, a == n: None, n < a: None, n >= n: None}
    got = row.select(*(c.column().alias(str(k)) for k, c in enumerate(cases))).first()
    assert list(got) == list(cases.values())


LOGIC = [(True, True), (True, False), (True, None), (False, False), (False, None), (None, None)]


@pytest.mark.parametrize("left,right", LOGIC)
def test_three_valued_logic(spark, left, right):
    known = {True, False}
    both = left if left is False else right if right is False else None if None in (left, right) else True
    either = True if True in (left, right) else None if None in (left, right) else False
    assert evaluate(spark, "boolean", left, right, lambda x, y: x & y) is both
    assert evaluate(spark, "boolean", left, right, lambda x, y: x | y) is either
    strict = None if not {left, right} <= known else (left and right)
    assert evaluate(spark, "boolean", left, right, lambda x, y: P.strict("AND", x, y)) is strict
    strict = None if not {left, right} <= known else (left or right)
    assert evaluate(spark, "boolean", left, right, lambda x, y: P.strict("OR", x, y)) is strict


def test_unary(spark):
    row = spark.createDataFrame([(True, None)], "t boolean, n boolean")
    t, n = P.col("t"), P.col("n")
    got = row.select(*(e.column() for e in (~t, ~n, n.is_null(), n.is_not_null(), t.is_null(), P.TRUE, P.FALSE))).first()
    assert list(got) == [False, None, True, False, False, True, False]


def test_text_and_references():
    e = (P.col("a") == 1) & ~(P.col("b").is_null())
    assert repr(e) == "((Column(a) = 1) AND (NOT (Column(b)) IS NULL))"
    assert e.references == {"a", "b"}
    with pytest.raises(FieldTypeMismatch):
        P.col("a", ArrayType(IntegerType()))
    with pytest.raises(FieldTypeMismatch):
        P.col("a", StructType([StructField("x", IntegerType())]))


def test_split():
    a, b, c = P.col("A"), P.col("b"), P.col("c")
    pushed, residual = P.split((a == 1) & (b < c) & ~(c.is_null()) & (b == 2), ["a", "B"])
    assert repr(pushed) == "((Column(A) = 1) AND (Column(b) = 2))"
    assert repr(residual) == "((Column(b) < Column(c)) AND (NOT (Column(c)) IS NULL))"
    assert P.split(None, ["a"]) == (None, None)
    assert P.split(c == 1, ["a"])[0] is None
    assert P.split((a == 1) | (c == 1), ["a"])[0] is None
    assert P.split(P.TRUE, [])[1] is None


def test_sql_conditions(spark):
    pushed, residual = P.split(P.sql(spark, "p IN (1, 2) AND upper(q) LIKE 'A%' AND p BETWEEN 1 AND 5"), ["P"])
    assert pushed.references == {"p"} and residual.references == {"q"}
    row = spark.createDataFrame([(1, "ab")], "p int, q string")
    assert row.where(pushed.column()).where(residual.column()).count() == 1


def test_typed_columns_and_literals(spark):
    row = spark.createDataFrame([("5",)], "x string")
    assert row.select((P.col("x", IntegerType()) > P.lit(4, IntegerType())).column()).first()[0] is True
    assert row.select(P.lit(None).column().isNull()).first()[0] is True
    assert row.select(P.Literal("a").column() == F.lit("a")).first()[0] is True
