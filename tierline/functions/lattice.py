"""The common type of columns whose type changed between versions."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, FractionalType,
                               IntegerType, IntegralType, LongType, MapType, NullType, ShortType, StringType, StructField,
                               StructType, TimestampNTZType, TimestampType)

#: Whole numbers by size, with the digits they need as a decimal.
_WHOLE = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}
_DAYS = (DateType, TimestampType, TimestampNTZType)
_NESTED = (StructType, ArrayType, MapType)


def common_type(a: DataType, b: DataType) -> DataType:
    """The least type that holds the values of both.

    Whole numbers widen to the larger, with fractions to double or to a decimal
    that holds both; dates to timestamps; structs field by field, arrays and maps
    by their parts. Other single values meet as text. A nested type has none in
    common with a single value.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(common_type(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    if isinstance(a, _NESTED) or isinstance(b, _NESTED):
        raise ValueError(f"{a.simpleString()} and {b.simpleString()} have no common type")
    numbers = (IntegralType, FractionalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return _number(a, b)
    if isinstance(a, _DAYS) and isinstance(b, _DAYS):
        return TimestampNTZType() if {type(a), type(b)} == {DateType, TimestampNTZType} else TimestampType()
    return StringType()


def _number(a: DataType, b: DataType) -> DataType:
    if isinstance(a, IntegralType) and isinstance(b, IntegralType):
        return max(a, b, key=_WHOLE.__getitem__)
    if isinstance(a, (FloatType, DoubleType)) or isinstance(b, (FloatType, DoubleType)):
        return DoubleType()
    a, b = (t if isinstance(t, DecimalType) else DecimalType(_WHOLE[t], 0) for t in (a, b))
    scale = max(a.scale, b.scale)
    digits = max(a.precision - a.scale, b.precision - b.scale) + scale
    return DecimalType(digits, scale) if digits <= 38 else DoubleType()


def merged(a: StructType, b: StructType) -> StructType:
    """The columns of ``a`` in their order, then those only ``b`` has, each of the common type."""
    others = {f.name: f.dataType for f in b}
    fields = [StructField(f.name, common_type(f.dataType, others.get(f.name, NullType()))) for f in a]
    return StructType(fields + [StructField(f.name, f.dataType) for f in b if f.name not in a.names])
