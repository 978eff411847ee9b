"""Schema reconciliation for snapshots whose schema evolved between imports.

Planned on the driver from the input schemas only (no data is read).  The
target schema is the union of fields by name:

* a field defined by several inputs takes its position from the *last* input
  that defines it; fields are ordered by (that position, name);
* types must agree up to lossless numeric widening (byte < short < int < long;
  byte and short also widen to float, int to double, float to double).  A long
  with a float or a double raises, since rounding would join distinct records;
  so does anything else, before any union is built, because Spark's own union
  coercion would accept e.g. int vs string and fail at run time;
* records inside records (and inside arrays) are reconciled field by field;
* every field is nullable; a field missing from an input reads as the default
  that its schema carries (``default`` in the field's metadata), else as null.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The integers, and for each the narrowest of float and double that holds it exactly.
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_EXACT_FRACTION = {T.ByteType: T.FloatType, T.ShortType: T.FloatType, T.IntegerType: T.DoubleType}
DEFAULT_KEY = "default"


def named(name: str) -> Column:
    """A top-level column by its exact name: dots or spaces are not nesting."""
    return F.col("`" + name.replace("`", "``") + "`")


class SchemaConflict(TypeError):
    """Two inputs define one field with types that do not widen."""


def _widen_numbers(a: T.DataType, b: T.DataType) -> T.DataType | None:
    if type(a) in _INTEGERS and type(b) in _INTEGERS:
        return a if _INTEGERS.index(type(a)) >= _INTEGERS.index(type(b)) else b
    fractions = (T.FloatType, T.DoubleType)
    if type(a) in fractions and type(b) in fractions:
        return T.DoubleType()
    if type(b) in _EXACT_FRACTION and type(a) in fractions:
        a, b = b, a
    if type(a) in _EXACT_FRACTION and type(b) in fractions:
        return b if _EXACT_FRACTION[type(a)] is T.FloatType else T.DoubleType()
    return None


def _strip_nullability(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_strip_nullability(dtype.elementType), True)
    if isinstance(dtype, T.MapType):
        return T.MapType(_strip_nullability(dtype.keyType), _strip_nullability(dtype.valueType), True)
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _strip_nullability(f.dataType), True) for f in dtype.fields])
    return dtype


def widen(left: T.DataType, right: T.DataType, name: str = "?") -> T.DataType:
    """The common type of two field definitions, or :class:`SchemaConflict`."""
    a, b = _strip_nullability(left), _strip_nullability(right)
    if a == b:
        return a
    number = _widen_numbers(a, b)
    if number is not None:
        return number
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return reconcile([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType, name), True)
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    raise SchemaConflict(f"field {name!r}: {left.simpleString()} and {right.simpleString()} "
                         "do not widen to a common type")


def can_widen(source: T.DataType, target: T.DataType) -> bool:
    """True when values of ``source`` fit ``target`` without a lossy cast."""
    try:
        return widen(source, target) == _strip_nullability(target)
    except SchemaConflict:
        return False


def reconcile(schemas, exclude=()) -> T.StructType:
    """Target schema for a by-name union of ``schemas`` (see module doc)."""
    exclude = set(exclude)
    merged: dict[str, tuple[int, T.DataType]] = {}
    defaults: dict[str, dict] = {}
    for schema in schemas:
        for pos, field in enumerate(schema.fields):
            if field.name in exclude:
                continue
            if field.name in merged:
                dtype = widen(merged[field.name][1], field.dataType, field.name)
            else:
                dtype = _strip_nullability(field.dataType)
            defaults.setdefault(field.name, {}).update(
                {k: v for k, v in (field.metadata or {}).items() if k == DEFAULT_KEY})
            merged[field.name] = (pos, dtype)
    ordered = sorted(merged.items(), key=lambda item: (item[1][0], item[0]))
    return T.StructType([T.StructField(name, dtype, True, defaults[name]) for name, (_, dtype) in ordered])


def _missing(field: T.StructField) -> Column:
    """What a field reads as where an input lacks it: its default, else a typed null."""
    default = (field.metadata or {}).get(DEFAULT_KEY)
    if default is None:
        return F.lit(None).cast(field.dataType)
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(F.lit(json.dumps(default)), field.dataType)
    if isinstance(field.dataType, T.BinaryType):
        return F.lit(default.encode("latin-1"))
    return F.lit(default).cast(field.dataType)


def _read_as(col: Column, have: T.DataType, want: T.DataType, name: str) -> Column:
    if _strip_nullability(have) == _strip_nullability(want):
        return col
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        inner = {f.name: f.dataType for f in have.fields}
        fields = [(_read_as(col.getField(f.name), inner[f.name], f.dataType, f"{name}.{f.name}")
                   if f.name in inner else _missing(f)).alias(f.name) for f in want.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(col, lambda x: _read_as(x, have.elementType, want.elementType, name))
    if not can_widen(have, want):
        raise SchemaConflict(f"field {name!r}: {have.simpleString()} cannot be read as {want.simpleString()}")
    return col.cast(want)


def conform_columns(df: DataFrame, target: T.StructType) -> list[Column]:
    """Columns that read ``df`` as ``target``; see the module doc for missing fields."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return [(_read_as(named(f.name), have[f.name], f.dataType, f.name) if f.name in have else _missing(f)).alias(f.name)
            for f in target.fields]


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    return df.select(*conform_columns(df, target))


def has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(has_map(f.dataType) for f in dtype.fields)
    return False
