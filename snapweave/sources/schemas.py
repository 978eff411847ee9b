"""Reader schemas from files: Avro schema JSON (``.avsc``), Spark JSON, or DDL.

Imports are often described by an Avro schema file.  The conversion covers
what such files hold for flat and nested records: primitives, ``[null, T]``
unions (nullable T), records, arrays, maps, enums, fixed, and the date /
timestamp / decimal logical types.  A union of int and long reads as long, one of
float and double as double.  Any other of several types raises in :func:`avro_record`
unless ``member_structs`` is set; :func:`load_schema` sets it, and reads such a union
as a struct with one nullable field per member (``member0``, ``member1``...), as
Spark's Avro source does.  Defaults are kept in the form Spark casts from: the stored numbers of
logical types become dates, times and decimals, and a union's default is its
first member's.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal

from pyspark.sql import types as T

from ..plans.schema import DEFAULT_KEY

# Avro primitive type names and their Spark types.
_PRIMITIVES = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}


def _logical(node: dict) -> T.DataType | None:
    kind = node.get("logicalType")
    if kind == "date":
        return T.DateType()
    if kind in ("timestamp-millis", "timestamp-micros"):
        return T.TimestampType()
    if kind in ("local-timestamp-millis", "local-timestamp-micros"):
        return T.TimestampNTZType()
    if kind == "decimal":
        return T.DecimalType(int(node["precision"]), int(node.get("scale", 0)))
    return None


def avro_type(node, names: dict | None = None, member_structs: bool = False) -> tuple[T.DataType, bool]:
    """(Spark type, nullable) of an Avro schema node; ``names`` holds the named types met so far."""
    names = {} if names is None else names
    if isinstance(node, str):
        if node in _PRIMITIVES:
            return _PRIMITIVES[node], node == "null"
        if names.get(node) is None:
            raise ValueError(f"named type {node!r} is unknown here, or refers to itself")
        return names[node], False
    if isinstance(node, list):
        members = [m for m in node if m != "null"]
        return _union([avro_type(m, names, member_structs)[0] for m in members], member_structs), len(members) != len(node)
    kind = node.get("type")
    logical = _logical(node)
    if kind == "record":
        dtype = avro_record(node, names, member_structs)
    elif logical is not None:
        dtype = logical
    elif kind == "array":
        element, nullable = avro_type(node["items"], names, member_structs)
        return T.ArrayType(element, nullable), False
    elif kind == "map":
        value, nullable = avro_type(node["values"], names, member_structs)
        return T.MapType(T.StringType(), value, nullable), False
    elif kind == "enum":
        dtype = T.StringType()
    elif kind == "fixed":
        dtype = T.BinaryType()
    else:
        return avro_type(kind, names, member_structs)
    if "name" in node:
        _remember(node, dtype, names)
    return dtype, False


def _union(members: list[T.DataType], member_structs: bool) -> T.DataType:
    kinds = {type(m) for m in members}
    if not members:
        return T.NullType()
    if len(members) == 1:
        return members[0]
    if kinds <= {T.IntegerType, T.LongType}:
        return T.LongType()
    if kinds <= {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if not member_structs:
        raise ValueError(f"a union of {[m.simpleString() for m in members]} reads as a struct of members; set member_structs")
    return T.StructType([T.StructField(f"member{i}", m, True) for i, m in enumerate(members)])


EPOCH = dt.datetime(1970, 1, 1)


def default_value(node, dtype: T.DataType, default):
    """A field's Avro default as JSON that Spark reads as ``dtype``."""
    if default is None:
        return None
    if isinstance(node, list):
        members = [m for m in node if m != "null"]
        if node[0] == "null" or not members:
            raise ValueError(f"the default {default!r} of union {node} is not of its first member")
        if isinstance(dtype, T.StructType) and len(members) > 1:
            return {"member0": default_value(node[0], dtype["member0"].dataType, default)}
        return default_value(node[0], dtype, default)
    if isinstance(dtype, T.DateType):
        return (EPOCH + dt.timedelta(days=default)).date().isoformat()
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        unit = 1000 if node["logicalType"].endswith("millis") else 1
        text = (EPOCH + dt.timedelta(microseconds=default * unit)).isoformat(sep=" ")
        return text + "+00:00" if isinstance(dtype, T.TimestampType) else text
    if isinstance(dtype, T.DecimalType):
        unscaled = int.from_bytes(default.encode("latin-1"), "big", signed=True)
        return str(Decimal(unscaled).scaleb(-dtype.scale))
    if isinstance(node, dict):
        inner = node["type"] if isinstance(node["type"], (dict, list)) else node
        if inner is not node:
            return default_value(inner, dtype, default)
    if isinstance(dtype, T.ArrayType) and isinstance(node, dict) and "items" in node:
        return [default_value(node["items"], dtype.elementType, x) for x in default]
    if isinstance(dtype, T.MapType) and isinstance(node, dict) and "values" in node:
        return {k: default_value(node["values"], dtype.valueType, x) for k, x in default.items()}
    if isinstance(dtype, T.StructType) and isinstance(node, dict) and "fields" in node:
        return {f["name"]: default_value(f["type"], dtype[f["name"]].dataType, default[f["name"]])
                for f in node["fields"] if f["name"] in default}
    return default


def _remember(node: dict, dtype: T.DataType, names: dict) -> None:
    names[node["name"]] = dtype
    if node.get("namespace"):
        names[f"{node['namespace']}.{node['name']}"] = dtype


def avro_record(node: dict, names: dict | None = None, member_structs: bool = False) -> T.StructType:
    """A record's fields; a default other than null is kept in the field's metadata."""
    names = {} if names is None else names
    fields = []
    for field in node["fields"]:
        dtype, nullable = avro_type(field["type"], names, member_structs)
        default = default_value(field["type"], dtype, field.get("default"))
        fields.append(T.StructField(field["name"], dtype, nullable, None if default is None else {DEFAULT_KEY: default}))
    return T.StructType(fields)


def load_schema(spec: str) -> T.StructType:
    """A reader schema from a ``.avsc`` / ``.json`` file path, or DDL text."""
    if os.path.isfile(spec):
        with open(spec) as fh:
            text = fh.read()
        if spec.endswith(".avsc"):
            return avro_record(json.loads(text), member_structs=True)
        if spec.endswith(".json"):
            return T.StructType.fromJson(json.loads(text))
        spec = text
    return T._parse_datatype_string(spec)
