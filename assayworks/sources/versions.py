"""Reading files that were written under several versions of a schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

_WHOLE = [ByteType(), ShortType(), IntegerType(), LongType()]
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}


class IncompatibleSchemas(ValueError):
    """A column changed to a type that does not hold its old values: the table needs a full refresh."""


def wider(name: str, a: DataType, b: DataType) -> DataType:
    """The type that holds all values of both and that Parquet files of either can be read as."""
    if a == b:
        return a
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged_schema([a, b], f"{name}.")
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    for one, other in ((a, b), (b, a)):
        if isinstance(one, DecimalType) and isinstance(other, DecimalType) or isinstance(one, DecimalType) and other in _WHOLE:
            scale, digits = (other.scale, other.precision - other.scale) if isinstance(other, DecimalType) else (0, _DIGITS[other])
            scale = max(one.scale, scale)
            whole = max(one.precision - one.scale, digits)
            if whole + scale <= DecimalType(38, 0).precision:
                return DecimalType(whole + scale, scale)
        # A double holds every whole number of up to 32 bits.
        if isinstance(one, DoubleType) and (isinstance(other, FloatType) or other in _WHOLE[:3]):
            return one
        if isinstance(one, TimestampNTZType) and isinstance(other, DateType):
            return one
    raise IncompatibleSchemas(f"{name}: {a.simpleString()} and {b.simpleString()} have no common wider type")


def merged_schema(schemas: Sequence[StructType], within: str = "") -> StructType:
    """All columns of all versions in order of appearance, each in its widest type and nullable."""
    def both(a: StructType, b: StructType) -> StructType:
        kinds = {f.name: f.dataType for f in a}
        for f in b:
            kinds[f.name] = wider(within + f.name, kinds[f.name], f.dataType) if f.name in kinds else f.dataType
        return StructType([StructField(n, t, True) for n, t in kinds.items()])

    return reduce(both, schemas, StructType())


def merged_read(spark: SparkSession, versions: Sequence[str]) -> DataFrame:
    """One table over folders of several schema versions, one schema each: columns a version lacks are NULL, narrower types are read as the wider.

    The driver reads one file's schema per version; all files are then one scan with one schema, which the Parquet
    reader widens to while it decodes. Columns are matched by name and are never dropped or renamed. A
    change of type that could lose values raises IncompatibleSchemas.
    """
    schema = merged_schema([spark.read.parquet(v).schema for v in versions])
    return spark.read.schema(schema).parquet(*versions)
