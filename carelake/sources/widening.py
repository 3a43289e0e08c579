"""Which column types a stored column may grow to.

Whole numbers grow to wider whole numbers, to decimals that hold all of them and to doubles; floats
and decimals grow to doubles, decimals also to decimals with more digits on either side; dates grow to
timestamps; lists, maps and structs grow as what is in them. Nothing else grows, text least of all.
"""

from __future__ import annotations

from pyspark.sql import types as T

#: whole numbers from narrow to wide, and their decimal digits
WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_ORDER = list(WHOLE)
MOST_DIGITS = 38


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that both grow to, or None."""
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if kinds <= set(WHOLE):
        return a if _ORDER.index(type(a)) > _ORDER.index(type(b)) else b
    if kinds <= {*WHOLE, T.DecimalType}:
        return _decimal(a, b)
    if kinds <= {*WHOLE, T.DecimalType, T.FloatType, T.DoubleType}:
        return T.DoubleType()
    for stamp in (T.TimestampType, T.TimestampNTZType):
        if kinds == {T.DateType, stamp}:
            return stamp()
    if kinds == {T.ArrayType}:
        inner = wider(a.elementType, b.elementType)
        return inner and T.ArrayType(inner, a.containsNull or b.containsNull)
    if kinds == {T.MapType}:
        inner = wider(a.valueType, b.valueType)
        return inner and a.keyType == b.keyType and T.MapType(a.keyType, inner, True) or None
    if kinds == {T.StructType}:
        try:
            return widened(a, b)
        except TypeError:
            return None
    return None


def _decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    """Digits before and behind the point that hold both; doubles where those are too many."""
    sides = [(x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (WHOLE[type(x)], 0) for x in (a, b)]
    before, behind = (max(s[i] for s in sides) for i in (0, 1))
    return T.DecimalType(before + behind, behind) if before + behind <= MOST_DIGITS else T.DoubleType()


def widened(known: T.StructType, more: T.StructType) -> T.StructType:
    """Fields of both by name, in order of first appearance, each of a type that holds both. A field
    whose types have none in common raises TypeError."""
    new = {f.name: f.dataType for f in more}
    fields = []
    for field in known:
        kind = wider(field.dataType, new.get(field.name, field.dataType))
        if kind is None:
            stored, given = field.dataType.simpleString(), new[field.name].simpleString()
            raise TypeError(f"column {field.name} is {stored}, which {given} does not fit")
        fields.append(T.StructField(field.name, kind, True))
    fields += [T.StructField(f.name, f.dataType, True) for f in more if f.name not in known.names]
    return T.StructType(fields)


def same_types(a: T.StructType, b: T.StructType) -> bool:
    """Whether the fields that both have are of the same types, so that files of either can be read
    as the other's."""
    kinds = {f.name: f.dataType.simpleString() for f in a}
    return all(kinds.get(f.name, f.dataType.simpleString()) == f.dataType.simpleString() for f in b)
