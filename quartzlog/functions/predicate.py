"""Predicates that know the columns they refer to, and become Catalyst expressions.

Comparisons and logic follow SQL: null operands give null, AND and OR are three-valued, and a filter keeps only rows for
which its predicate is true. `strict` gives AND and OR that are null as soon as one side is.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column as SparkColumn
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, NullType, StructType

from ..errors import FieldTypeMismatch


class Expression:
    """Base of the tree. Operators build nodes: ==, <, <=, >, >=, &, |, ~."""

    children: tuple[Expression, ...] = ()

    def column(self, resolve: Callable[[str], SparkColumn] = F.col) -> SparkColumn:
        raise NotImplementedError

    @property
    def references(self) -> frozenset[str]:
        return frozenset().union(*(c.references for c in self.children))

    def __eq__(self, other):
        return Binary("=", self, lift(other))

    def __hash__(self):
        return hash(repr(self))

    def __lt__(self, other):
        return Binary("<", self, lift(other))

    def __le__(self, other):
        return Binary("<=", self, lift(other))

    def __gt__(self, other):
        return Binary(">", self, lift(other))

    def __ge__(self, other):
        return Binary(">=", self, lift(other))

    def __and__(self, other):
        return Binary("AND", self, lift(other))

    def __or__(self, other):
        return Binary("OR", self, lift(other))

    def __invert__(self):
        return Unary("NOT", self)

    def is_null(self):
        return Unary("IS NULL", self)

    def is_not_null(self):
        return Unary("IS NOT NULL", self)


@dataclass(frozen=True, eq=False, repr=False)
class Column(Expression):
    name: str
    type: DataType | None = None

    def __post_init__(self):
        if isinstance(self.type, (ArrayType, MapType, StructType, NullType)):
            raise FieldTypeMismatch(f"column {self.name} of type {self.type.simpleString()} cannot be compared")

    def column(self, resolve=F.col):
        own = resolve(self.name)
        return own if self.type is None else own.cast(self.type)

    @property
    def references(self):
        return frozenset([self.name])

    def __repr__(self):
        return f"Column({self.name})"


@dataclass(frozen=True, eq=False, repr=False)
class Literal(Expression):
    value: object
    type: DataType | None = None

    def column(self, resolve=F.col):
        own = F.lit(self.value)
        return own if self.type is None else own.cast(self.type)

    def __repr__(self):
        return str(self.value).lower() if isinstance(self.value, bool) else "null" if self.value is None else str(self.value)


TRUE, FALSE = Literal(True), Literal(False)

#: The operators' names.
_BINARY = {"=": operator.eq, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "AND": operator.and_, "OR": operator.or_}


@dataclass(frozen=True, eq=False, repr=False)
class Binary(Expression):
    name: str
    left: Expression
    right: Expression

    @property
    def children(self):
        return self.left, self.right

    def column(self, resolve=F.col):
        return _BINARY[self.name](self.left.column(resolve), self.right.column(resolve))

    def __repr__(self):
        return f"({self.left!r} {self.name} {self.right!r})"


@dataclass(frozen=True, eq=False, repr=False)
class Strict(Binary):
    """AND or OR that is null as soon as one side is null."""

    def column(self, resolve=F.col):
        left, right = self.left.column(resolve), self.right.column(resolve)
        return F.when(left.isNotNull() & right.isNotNull(), _BINARY[self.name](left, right))


@dataclass(frozen=True, eq=False, repr=False)
class Unary(Expression):
    name: str
    child: Expression

    @property
    def children(self):
        return (self.child,)

    def column(self, resolve=F.col):
        own = self.child.column(resolve)
        return {"NOT": lambda: ~own, "IS NULL": own.isNull, "IS NOT NULL": own.isNotNull}[self.name]()

    def __repr__(self):
        return f"(NOT {self.child!r})" if self.name == "NOT" else f"({self.child!r}) {self.name}"


@dataclass(frozen=True, eq=False, repr=False)
class Sql(Expression):
    """Any Spark SQL condition, as Catalyst's parser reads it: IN, LIKE, BETWEEN, functions and so on."""

    text: str
    names: frozenset[str]

    def column(self, resolve=F.col):
        return F.expr(self.text)

    @property
    def references(self):
        return self.names

    def __repr__(self):
        return self.text


def strict(name: str, left: Expression, right: Expression) -> Expression:
    return Strict(name, left, right)


def lift(value) -> Expression:
    return value if isinstance(value, Expression) else Literal(value)


def col(name: str, type: DataType | None = None) -> Column:
    return Column(name, type)


def lit(value, type: DataType | None = None) -> Literal:
    return Literal(value, type)


def sql(spark: SparkSession, text: str) -> Expression:
    """The condition's conjuncts, each with the columns that it refers to."""

    def walk(node) -> Expression:
        if node.getClass().getSimpleName() == "And":
            return walk(node.left()) & walk(node.right())
        leaves, names = node.collectLeaves(), []
        for k in range(leaves.size()):
            if leaves.apply(k).getClass().getSimpleName() == "UnresolvedAttribute":
                names.append(leaves.apply(k).nameParts().head())
        return Sql(node.sql(), frozenset(names))

    return walk(spark._jsparkSession.sessionState().sqlParser().parseExpression(text))


def conjuncts(predicate: Expression) -> list[Expression]:
    """The AND tree's leaves from left to right."""
    if isinstance(predicate, Binary) and predicate.name == "AND":
        return conjuncts(predicate.left) + conjuncts(predicate.right)
    return [predicate]


def conjoin(parts: list[Expression]) -> Expression | None:
    return functools.reduce(lambda a, b: Binary("AND", a, b), parts) if parts else None


def on_partitions_only(predicate: Expression, partition_columns) -> bool:
    """Whether all columns it refers to, at any depth, are partition columns (letter case aside)."""
    return {r.lower() for r in predicate.references} <= {c.lower() for c in partition_columns}


def split(predicate: Expression | None, partition_columns) -> tuple[Expression | None, Expression | None]:
    """(pushed, residual): the conjuncts on partition columns alone, and the others."""
    if predicate is None:
        return None, None
    parts = conjuncts(predicate)
    pushed = [p for p in parts if on_partitions_only(p, partition_columns)]
    return conjoin(pushed), conjoin([p for p in parts if not on_partitions_only(p, partition_columns)])
