"""Schema codec and rules."""

from __future__ import annotations

import json
import re

from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from .errors import DuplicateColumns, InvalidColumnName, InvalidPartitionColumn, NestedNotNull, NonPartitionColumnAbsent, PartitionColumnsNotFound, SchemaChange, UnknownColumn

#: Other names of types that schemas in logs use.
ALIASES = {"bigint": "long", "tinyint": "byte", "smallint": "short", "null": "void", "int": "integer", "bool": "boolean"}
#: Characters that column names cannot hold.
FORBIDDEN = re.compile(r"[ ,;{}()\n\t=]")


def _plain(node):
    if isinstance(node, str):
        if node in ALIASES:
            return ALIASES[node]
        m = re.fullmatch(r"decimal\(\s*(\d+)\s*,\s*(-?\d+)\s*\)", node)
        return f"decimal({m[1]},{m[2]})" if m else "decimal(10,0)" if node == "decimal" else node
    out = dict(node)
    for key in ("type", "elementType", "keyType", "valueType"):
        if key in out and not (key == "type" and out[key] in ("struct", "array", "map") and not isinstance(out[key], dict)):
            out[key] = _plain(out[key])
    if "fields" in out:
        out["fields"] = [{"metadata": {}, "nullable": True, **_plain(f)} for f in out["fields"]]
    return out


def parse(text: str) -> StructType:
    """A schema from its JSON; type names of either dialect."""
    return StructType.fromJson(_plain(json.loads(text)))


def parse_type(text: str) -> DataType:
    """A type from its name or JSON."""
    from pyspark.sql.types import _parse_datatype_json_value

    node = json.loads(text) if text.lstrip().startswith(("{", '"')) else text
    return _parse_datatype_json_value(_plain(node))


def dump(schema: StructType) -> str:
    return schema.json()


def lookup(schema: StructType, name: str) -> StructField:
    for f in schema.fields:
        if f.name.lower() == name.lower():
            return f
    raise UnknownColumn(f"no column {name!r} in {schema.names}")


def write_compatible(old: DataType, new: DataType) -> bool:
    """Whether data written under `old` reads under `new`: every column is there in the same case, of the same type, and
    not less nullable; new columns may come."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        names = {f.name.lower(): f for f in new.fields}
        if len(names) < len(new.fields):
            raise SchemaChange("columns that differ by letter case only")
        for f in old.fields:
            g = names.get(f.name.lower())
            if g is None or g.name != f.name or f.nullable and not g.nullable or not write_compatible(f.dataType, g.dataType):
                return False
        return True
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return (new.containsNull or not old.containsNull) and write_compatible(old.elementType, new.elementType)
    if isinstance(old, MapType) and isinstance(new, MapType):
        return (new.valueContainsNull or not old.valueContainsNull) and write_compatible(old.keyType, new.keyType) and write_compatible(old.valueType, new.valueType)
    return type(old) is type(new) and (isinstance(old, (StructType, ArrayType, MapType)) or old == new)


def _not_null_below(kind: DataType, path: str) -> str | None:
    if isinstance(kind, StructType):
        return next((p for f in kind.fields if (p := (None if f.nullable else f"{path}.{f.name}") or _not_null_below(f.dataType, f"{path}.{f.name}"))), None)
    if isinstance(kind, ArrayType):
        return _not_null_below(kind.elementType, path)
    if isinstance(kind, MapType):
        return _not_null_below(kind.keyType, path) or _not_null_below(kind.valueType, path)
    return None


def check_nested_not_null(schema: StructType, path: str = "") -> None:
    """NOT NULL is refused below an array's elements and a map's keys and values."""
    for f in schema.fields:
        here = f"{path}.{f.name}" if path else f.name
        if isinstance(f.dataType, StructType):
            check_nested_not_null(f.dataType, here)
        elif isinstance(f.dataType, (ArrayType, MapType)) and (bad := _not_null_below(f.dataType, here)):
            raise NestedNotNull(f"NOT NULL field {bad} inside {here}")


def check_names(names, error=InvalidColumnName) -> None:
    for name in names:
        if FORBIDDEN.search(name):
            raise error(f"column name {name!r} holds one of ' ,;{{}}()\\n\\t='")


def exploded_names(kind: StructType, prefix: str = "") -> list[str]:
    """Dotted paths of all columns, through structs, arrays and maps; names with dots in back-ticks."""
    out = []
    for f in kind.fields:
        here = prefix + (f"`{f.name}`" if "." in f.name else f.name)
        out.append(here)
        below = f.dataType
        while isinstance(below, ArrayType):
            below = below.elementType
        for part in (below.keyType, below.valueType) if isinstance(below, MapType) else (below,):
            while isinstance(part, ArrayType):
                part = part.elementType
            if isinstance(part, StructType):
                out += exploded_names(part, here + ".")
    return out


def check_duplicates(schema: StructType) -> None:
    seen: set[str] = set()
    for name in exploded_names(schema):
        if name.lower() in seen:
            raise DuplicateColumns(f"column {name} twice")
        seen.add(name.lower())


def check_partition_columns(schema: StructType, columns) -> None:
    """Partition columns are columns of the schema, and one column at least is not among them."""
    names = {n.lower() for n in schema.names}
    if missing := [c for c in columns if c.lower() not in names]:
        raise PartitionColumnsNotFound(f"{missing} not in {schema.names}")
    if columns and {c.lower() for c in columns} >= names:
        raise NonPartitionColumnAbsent("all columns are partition columns")
    check_names(columns, InvalidPartitionColumn)
