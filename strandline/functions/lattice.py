"""The least type that holds the values of several.

``join`` is commutative, associative and idempotent, so the type of a column
does not depend on the order in which files are seen:

    byte < short < int < long < decimal < double
    float < double
    date < timestamp_ntz < timestamp
    anything else that differs: string

A decimal takes the integer digits and the scale of both; beyond 38 digits it
is a double. Structs join field by field, arrays and maps by their elements,
keys and values; names that differ in case only are one field. A nested type and another kind
of type meet as string (JSON text).
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import types as T

_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}     # decimal digits
_DAYS = (T.DateType, T.TimestampNTZType, T.TimestampType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def is_nested(t: T.DataType) -> bool:
    return isinstance(t, _NESTED)


def join(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type above both."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(join(a.keyType, b.keyType), join(a.valueType, b.valueType), True)
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE[type(t)])
    numbers = (*_WHOLE, T.DecimalType, T.FloatType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        (p, s), (q, r) = _digits(a), _digits(b)
        scale, whole = max(s, r), max(p - s, q - r)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if isinstance(a, _DAYS) and isinstance(b, _DAYS):
        return max(a, b, key=lambda t: _DAYS.index(type(t)))
    return T.StringType()


def _digits(t: T.DataType) -> tuple[int, int]:
    return (t.precision, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[type(t)], 0)


def _struct(a: T.StructType, b: T.StructType) -> T.StructType:
    """The fields of both. Equal lists of names keep their order; else fields stand
    by name, so that the order of joins does not matter."""
    same = [f.name.lower() for f in a.fields] == [f.name.lower() for f in b.fields]
    got: dict[str, T.StructField] = {}
    for f in (*a.fields, *b.fields):
        low = f.name.lower()
        old = got.get(low)
        got[low] = T.StructField(f.name if old is None else min(old.name, f.name),
                                 f.dataType if old is None else join(old.dataType, f.dataType), True)
    return T.StructType(list(got.values()) if same else [got[k] for k in sorted(got)])


def join_columns(schemas: Iterable[T.StructType]) -> T.StructType:
    """The columns of all schemas, of joined types. A column stands at the least
    place that it has in any of them (then by name), under the least of its
    spellings: whatever the order of ``schemas``, the same."""
    places: dict[str, list[tuple[int, T.StructField]]] = {}
    for s in schemas:
        for i, f in enumerate(s.fields):
            places.setdefault(f.name.lower(), []).append((i, f))
    at = {low: (min(i for i, _ in got), low) for low, got in places.items()}
    return T.StructType([T.StructField(min(f.name for _, f in places[low]),
                                       reduce(join, (f.dataType for _, f in places[low])), True)
                         for low in sorted(places, key=at.__getitem__)])


#: Scalar types that Spark's Parquet reader reads as another without a loss.
_READ_AS = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DecimalType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DecimalType, T.DoubleType),
    T.LongType: (T.DecimalType,),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampNTZType,),
}


def widened(stored: T.DataType, new: T.DataType) -> T.DataType:
    """The type that a table's column takes when values of type ``new``
    arrive: the join, as far as files already written as ``stored`` can be
    read by it; else the stored type stays (and what does not fit is rescued).
    Struct fields keep their places, new ones follow."""
    if stored == new or isinstance(new, T.NullType):
        return stored
    if isinstance(stored, T.StructType) and isinstance(new, T.StructType):
        by_name = {f.name.lower(): f for f in new.fields}
        have = {f.name.lower() for f in stored.fields}
        old = [T.StructField(f.name, widened(f.dataType, by_name[f.name.lower()].dataType)
                             if f.name.lower() in by_name else f.dataType, True) for f in stored.fields]
        return T.StructType(old + [T.StructField(f.name, f.dataType, True) for f in new.fields
                                   if f.name.lower() not in have])
    if isinstance(stored, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(stored.elementType, new.elementType), True)
    if isinstance(stored, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(stored.keyType, widened(stored.valueType, new.valueType), True)
    up = join(stored, new)
    if type(up) in _READ_AS.get(type(stored), ()):
        return up
    if isinstance(stored, T.DecimalType) and isinstance(up, T.DecimalType):
        return up
    return stored


def relaxed(t: T.DataType) -> T.DataType:
    """The type with every part nullable, as files are read back."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, relaxed(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(relaxed(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(relaxed(t.keyType), relaxed(t.valueType), True)
    return t
