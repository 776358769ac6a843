"""Does a value fit a type, and if not, which part of it does not?

``conform`` lines a value up with a type part by part: structs field by
field, arrays by element, maps by value. A part that does not fit becomes
NULL where it stands, and its text is an entry under its address; the rest
of the value stays. ``restore`` is the inverse: it puts entries back at their
addresses.

An address is the column's name, then ``.field``, ``[index]`` (from 0) or
``["key"]`` (quoted as JSON) for each step down. A name with other characters than
letters, digits and ``_`` is written in backquotes within an address; a
column's own name alone is always plain.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.lattice import is_nested

ENTRIES = "array<struct<key:string,value:string>>"
_WHOLE = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
#: Types whose values can be cast to one another and compared.
_PLAIN = (*_WHOLE, T.DoubleType, T.FloatType, T.DecimalType, T.BooleanType, T.DateType,
          T.TimestampType, T.TimestampNTZType)
#: Scalar casts that Spark has no rule for.
_NO_CAST = ((T.BooleanType, (T.DateType,)), (T.DateType, (*_WHOLE, T.DoubleType, T.FloatType, T.DecimalType, T.BooleanType)),
            (T.TimestampNTZType, (*_WHOLE, T.DoubleType, T.FloatType, T.DecimalType, T.BooleanType)),
            (_WHOLE, (T.DateType, T.TimestampNTZType)),
            ((T.DoubleType, T.FloatType, T.DecimalType), (T.DateType, T.TimestampNTZType, T.BinaryType)),
            ((T.BooleanType,), (T.TimestampNTZType, T.BinaryType)),
            (T.BinaryType, (*_PLAIN,)), ((T.DateType, T.TimestampType, T.TimestampNTZType), (T.BinaryType,)))


def castable(src: T.DataType, dst: T.DataType) -> bool:
    """Whether Spark has a cast between two scalar types."""
    if is_nested(src) or is_nested(dst):
        return False
    return not any(isinstance(src, a) and isinstance(dst, b) for a, b in _NO_CAST)


# ---------------------------------------------------------------------------
# Scalars
# ---------------------------------------------------------------------------

def misfit(src: Column, src_type: T.DataType, cast: Column, dst_type: T.DataType) -> Column:
    """True where a non-NULL scalar does not survive the cast there and back.

    Text is held to the value it states, not to its spelling: '1.50' fits a
    double and 'yes' a boolean. A misfit is a number with more digits than a
    decimal, float or double column keeps; a time of day in a date column; for
    a timestamp a time without a day (Spark would take today's), digits beyond
    microseconds, or a zone where the column has none. A value always fits text.
    """
    lost = cast.isNull()
    if src_type == dst_type:
        return F.lit(False)
    if isinstance(src_type, T.StringType):
        if isinstance(dst_type, T.DecimalType):
            # a cast only rounds, and a number that was rounded has other digits
            lost = lost | (_digits(src) != _digits(cast.cast(T.StringType())))
        elif isinstance(dst_type, T.DateType):
            only_day = src.rlike(r"^\s*[+-]?[0-9]{4,7}(-[0-9]{1,2}){0,2}\s*$")
            midnight = F.coalesce(src.try_cast(T.TimestampNTZType()) == cast.cast(T.TimestampNTZType()), F.lit(False))
            lost = lost | ~(only_day | (midnight & ~_beyond_micros(src) & ~_has_zone(src)))
        elif isinstance(dst_type, (T.TimestampType, T.TimestampNTZType)):
            lost = lost | ~src.rlike(r"^\s*[+-]?[0-9]{4}") | _beyond_micros(src)
            if isinstance(dst_type, T.TimestampNTZType):
                lost = lost | _has_zone(src)
        elif isinstance(dst_type, (T.DoubleType, T.FloatType)):
            lost = lost | ~_digits_kept(src, cast, dst_type)
    elif isinstance(src_type, _PLAIN) and isinstance(dst_type, _PLAIN):
        lost = lost | ~cast.try_cast(src_type).eqNullSafe(src)
    return src.isNotNull() & lost


def _beyond_micros(text: Column) -> Column:
    return text.rlike(r":[0-9]{1,2}\.[0-9]{6}[0-9]*[1-9]")


def _has_zone(text: Column) -> Column:
    return text.rlike(r":[0-9]{1,2}(\.[0-9]*)?\s*[A-Za-z+-]")


def _digits(text: Column) -> Column:
    """The significant digits that a number's text states."""
    return F.regexp_replace(F.regexp_replace(text, "[eE].*$|[^0-9]", ""), "^0+|0+$", "")


def _digits_kept(src: Column, cast: Column, dst_type: T.DataType) -> Column:
    """True where a float or double states the number that its text did: the
    text's significant digits are those of the number's own text, or so few
    that every normal number keeps them. Overflow and underflow keep none."""
    few, least = (15, 2.2250738585072014e-308) if isinstance(dst_type, T.DoubleType) else (6, 1.1754943508222875e-38)
    normal = (F.abs(cast) >= F.lit(least)) & (F.abs(cast) < F.lit(float("inf")))
    return (F.when((F.length(src) <= few) & ~src.rlike("[eEpP]"), F.lit(True))
            .otherwise((_digits(src) == _digits(cast.cast(T.StringType())))
                       | (normal & (F.length(_digits(src)) <= few))))


# ---------------------------------------------------------------------------
# Addresses
# ---------------------------------------------------------------------------

def _name(name: str) -> str:
    return name if re.fullmatch(r"\w+", name) else "`" + name.replace("`", "``") + "`"


def root(name: str, columns: Iterable[str] = ()) -> str:
    """The head of addresses inside column ``name``. Where another column is
    called like such an address, the head is in backquotes."""
    out = _name(name)
    if out == name and any(c != name and c.lower().startswith((name.lower() + ".", name.lower() + "[")) for c in columns):
        out = f"`{name}`"
    return out


def _field(at: Column, name: str) -> Column:
    return F.concat(at, F.lit("." + _name(name)))


def _index(at: Column, i: Column) -> Column:
    return F.concat(at, F.lit("["), i.cast("string"), F.lit("]"))


def _key(at: Column, key: Column) -> Column:
    # a one-element JSON array is ["..."]: the step itself
    return F.concat(at, F.to_json(F.array(key.cast("string"))))


def text_of(value: Column, t: T.DataType) -> Column:
    """A value as text: nested values as JSON."""
    return F.to_json(value) if is_nested(t) else value.cast(T.StringType())


def _none() -> Column:
    return F.array().cast(ENTRIES)


def _entry(at: Column, text: Column) -> Column:
    """One entry, or none where the text is NULL."""
    return F.when(text.isNotNull(), F.array(F.struct(at.alias("key"), text.alias("value")))).otherwise(_none())


def _all(parts: list[Column], none) -> Column:
    return parts[0] if len(parts) == 1 else F.concat(*parts) if parts else none()


# ---------------------------------------------------------------------------
# There
# ---------------------------------------------------------------------------

def conform(src: Column, src_type: T.DataType, dst_type: T.DataType, at: Column) -> tuple[Column, Column]:
    """(value of ``dst_type``, entries of what did not fit) of one value."""
    if src_type == dst_type:
        return src, _none()
    if isinstance(src_type, T.NullType):
        return F.lit(None).cast(dst_type), _none()
    if isinstance(dst_type, T.StringType):
        return text_of(src, src_type), _none()
    if isinstance(src_type, T.StructType) and isinstance(dst_type, T.StructType):
        by_name = {f.name.lower(): f for f in src_type.fields}
        fields, entries = [], []
        for f in dst_type.fields:
            own = by_name.pop(f.name.lower(), None)
            if own is None:
                fields.append(F.lit(None).cast(f.dataType).alias(f.name))
                continue
            value, missed = conform(src.getField(own.name), own.dataType, f.dataType, _field(at, f.name))
            fields.append(value.alias(f.name))
            if own.dataType != f.dataType:
                entries.append(missed)
        for own in by_name.values():        # fields that the type does not take
            entries.append(_entry(_field(at, own.name), text_of(src.getField(own.name), own.dataType)))
        return F.when(src.isNotNull(), F.struct(*fields)), _all(entries, _none)
    if isinstance(src_type, T.ArrayType) and isinstance(dst_type, T.ArrayType):
        a, b = src_type.elementType, dst_type.elementType
        value = F.transform(src, lambda x: conform(x, a, b, at)[0])
        missed = F.flatten(F.transform(src, lambda x, i: conform(x, a, b, _index(at, i))[1]))
        return value, F.coalesce(missed, _none())
    if isinstance(src_type, T.MapType) and isinstance(dst_type, T.MapType):
        (k, a), (m, b) = ((t.keyType, t.valueType) for t in (src_type, dst_type))
        if k == m or (not is_nested(k) and castable(k, m)):
            keys = F.map_keys(src)
            cast = keys if k == m else F.transform(keys, lambda x: x.try_cast(m))
            # keys that do not fit, or meet, would lose entries: then the whole map is one
            bad = F.lit(False) if k == m else (
                F.exists(F.zip_with(keys, cast, lambda x, y: misfit(x, k, y, m)), lambda x: x)
                | (F.size(F.array_distinct(cast)) < F.size(keys)))
            values = F.transform(F.map_values(src), lambda x: conform(x, a, b, at)[0])
            missed = F.flatten(F.transform(F.map_entries(src), lambda e: conform(
                e["value"], a, b, _key(at, e["key"]))[1]))
            return (F.when(~bad, F.map_from_arrays(F.when(~bad, cast), values)),
                    F.when(src.isNull(), _none()).when(bad, _entry(at, F.to_json(src)))
                    .otherwise(F.coalesce(missed, _none())))
    if not castable(src_type, dst_type):
        return F.lit(None).cast(dst_type), _entry(at, text_of(src, src_type))
    cast = src.try_cast(dst_type)
    miss = misfit(src, src_type, cast, dst_type)
    return F.when(~miss, cast), _entry(at, F.when(miss, text_of(src, src_type)))


# ---------------------------------------------------------------------------
# And back
# ---------------------------------------------------------------------------

def parsed(text: Column, t: T.DataType) -> Column:
    """A rescued text as a value: nested values from their JSON."""
    if is_nested(t):
        return F.from_json(text, t)
    return text.try_cast(t)


def restore(value: Column, src_type: T.DataType, dst_type: T.DataType, at: Column, m: Column) -> Column:
    """``value`` as ``dst_type``, each NULL part taken from the entry at its
    address in ``m`` (map<string,string>). An entry for the whole value is
    used where the value is NULL."""
    whole = parsed(m[at], dst_type)
    if isinstance(src_type, T.StructType) and isinstance(dst_type, T.StructType):
        by_name = {f.name.lower(): f for f in src_type.fields}
        fields = []
        for f in dst_type.fields:
            own = by_name.get(f.name.lower())
            here = _field(at, f.name)
            fields.append((parsed(m[here], f.dataType) if own is None else
                           restore(value.getField(own.name), own.dataType, f.dataType, here, m)).alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields)).otherwise(whole)
    if isinstance(src_type, T.ArrayType) and isinstance(dst_type, T.ArrayType):
        return F.coalesce(F.transform(value, lambda x, i: restore(
            x, src_type.elementType, dst_type.elementType, _index(at, i), m)), whole)
    if isinstance(src_type, T.MapType) and isinstance(dst_type, T.MapType) and src_type.keyType == dst_type.keyType:
        return F.coalesce(F.transform_values(value, lambda k, x: restore(
            x, src_type.valueType, dst_type.valueType, _key(at, k), m)), whole)
    if src_type == dst_type:
        return F.coalesce(value, whole)
    if isinstance(dst_type, T.StringType):
        return F.coalesce(text_of(value, src_type), whole)
    return F.coalesce(value.try_cast(dst_type), whole) if castable(src_type, dst_type) else whole


def held(value: Column, t: T.DataType, at: Column, m: Column) -> Column:
    """The addresses in ``value`` whose entry in ``m`` states the value that
    stands there, as array<string>."""
    def none():
        return F.array().cast("array<string>")
    text = m[at]
    there = parsed(text, t)
    same = (F.to_json(value) == F.to_json(there)) if is_nested(t) else (value == there)
    own = F.when(text.isNotNull() & there.isNotNull() & same, F.array(at)).otherwise(none())
    if isinstance(t, T.StructType):
        parts = [held(value.getField(f.name), f.dataType, _field(at, f.name), m) for f in t.fields]
        return F.concat(own, *parts)
    if isinstance(t, T.ArrayType):
        parts = F.flatten(F.transform(value, lambda x, i: held(x, t.elementType, _index(at, i), m)))
        return F.concat(own, F.coalesce(parts, none()))
    if isinstance(t, T.MapType):
        parts = F.flatten(F.transform(F.map_entries(value), lambda e: held(e["value"], t.valueType, _key(at, e["key"]), m)))
        return F.concat(own, F.coalesce(parts, none()))
    return own


def any_of(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)
