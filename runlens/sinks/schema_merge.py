"""K3/K4: merge of nested schemas, and rows rebuilt to a merged schema.

Two schemas are merged field by field, at every depth: structs get the fields
of both, arrays and maps the merge of their elements, keys and values, and
atomic types the narrowest type that holds both without loss of range. Names
compare without case; the first schema's spelling and order come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, MapType, NullType, ShortType, StringType, StructField, StructType, TimestampNTZType,
                               TimestampType)

# A type widens to every type after it in its line.
WIDENING = [
    [ByteType(), ShortType(), IntegerType(), LongType(), DoubleType()],
    [ByteType(), ShortType(), FloatType(), DoubleType()],
    [DateType(), TimestampNTZType(), TimestampType()],
]


class Incompatible(ValueError):
    """Two types without a common wider one, or a column that would have to be narrowed."""


def _decimal_of(t: DataType) -> DecimalType | None:
    digits = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}
    return t if isinstance(t, DecimalType) else DecimalType(digits[t], 0) if t in digits else None


def _wider_decimal(a: DecimalType, b: DecimalType) -> DecimalType | None:
    scale = max(a.scale, b.scale)
    precision = max(a.precision - a.scale, b.precision - b.scale) + scale
    return DecimalType(precision, scale) if precision <= DecimalType(38, 0).precision else None


def merged_type(a: DataType, b: DataType, at: str = "") -> DataType:
    """The narrowest type that holds the values of both."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged_schema(a, b, at)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(merged_type(a.elementType, b.elementType, f"{at}[]"), a.containsNull or b.containsNull)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(merged_type(a.keyType, b.keyType, f"{at}.key"), merged_type(a.valueType, b.valueType, f"{at}.value"),
                       a.valueContainsNull or b.valueContainsNull)
    if isinstance(a, DecimalType) or isinstance(b, DecimalType):
        if isinstance(a, (FloatType, DoubleType)) or isinstance(b, (FloatType, DoubleType)):
            return DoubleType()
        both = (_decimal_of(a), _decimal_of(b))
        wider = _wider_decimal(*both) if all(both) else None
        if wider is not None:
            return wider
    for line in WIDENING:
        if a in line and b in line:
            return line[max(line.index(a), line.index(b))]
    if {a, b} <= {ty for line in WIDENING[:2] for ty in line}:
        return DoubleType()  # an int or long with a float
    raise Incompatible(f"no type holds both {a.simpleString()} and {b.simpleString()} at {at.lstrip('.') or 'the top'}")


def merged_schema(a: StructType, b: StructType, at: str = "") -> StructType:
    theirs = {f.name.lower(): f for f in b.fields}
    fields = []
    for f in a.fields:
        other = theirs.pop(f.name.lower(), None)
        kind = f.dataType if other is None else merged_type(f.dataType, other.dataType, f"{at}.{f.name}")
        fields.append(StructField(f.name, kind, True, f.metadata))
    return StructType(fields + [StructField(f.name, f.dataType, True, f.metadata) for f in b.fields if f.name.lower() in theirs])


def conformed(c: Column, have: DataType, want: DataType, at: str = "") -> Column:
    """``c`` of type ``have`` as ``want``, rebuilt where its nested fields differ: absent ones are null, others in the
    order wanted. Raises where a value would have to be narrowed or a nested field be dropped."""
    if have == want:
        return c
    if isinstance(have, NullType):
        return c.cast(want)
    if isinstance(have, StructType) and isinstance(want, StructType):
        there = {f.name.lower(): f for f in have.fields}
        lost = set(there) - {f.name.lower() for f in want.fields}
        if lost:
            raise Incompatible(f"fields {sorted(lost)} of {at.lstrip('.') or 'the rows'} are not in the target")
        fields = []
        for f in want.fields:
            mine = there.get(f.name.lower())
            value = F.lit(None).cast(f.dataType) if mine is None else conformed(
                c.getField(mine.name), mine.dataType, f.dataType, f"{at}.{f.name}")
            fields.append(value.alias(f.name))
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(c, lambda e: conformed(e, have.elementType, want.elementType, f"{at}[]"))
    if isinstance(have, MapType) and isinstance(want, MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            conformed(e.getField("key"), have.keyType, want.keyType, f"{at}.key"),
            conformed(e.getField("value"), have.valueType, want.valueType, f"{at}.value")))
        return F.map_from_entries(entries)
    if merged_type(have, want, at) != want:
        raise Incompatible(f"{have.simpleString()} does not fit {want.simpleString()} at {at.lstrip('.')}")
    return c.cast(want)


def conformed_rows(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in the columns of ``schema``, at every depth."""
    there = {f.name.lower(): f for f in df.schema.fields}
    lost = [f.name for f in df.schema.fields if f.name.lower() not in {g.name.lower() for g in schema.fields}]
    if lost:
        raise Incompatible(f"columns not in the target table: {lost}")
    columns = []
    for f in schema.fields:
        mine = there.get(f.name.lower())
        value = F.lit(None).cast(f.dataType) if mine is None else conformed(
            df[mine.name], mine.dataType, f.dataType, f.name)
        columns.append(value.alias(f.name))
    return df.select(*columns)
