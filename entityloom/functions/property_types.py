"""Which property type a column gets, and the cast that takes it there.

=====================================  ==========  =================================
Spark type                             property    conversion
=====================================  ==========  =================================
byte, short, int, long                 long        widened
boolean                                bool        as it is
binary                                 blob        as it is
float, double                          double      widened
decimal                                double      nearest double; or kept by option
string, char, varchar                  string      as it is, blanks included
date                                   timestamp   midnight in the session time zone
timestamp, timestamp_ntz               timestamp   as it is
array, map, struct                     string      JSON, nulls shown
anything else (time, interval, void)   string      cast
=====================================  ==========  =================================
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMAL = "decimal"  # only where kept as such
LONG, DOUBLE, BOOL, STRING, BLOB, TIMESTAMP = (
    "long",
    "double",
    "bool",
    "string",
    "blob",
    "timestamp",
)

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEXTS = (T.StringType, T.CharType, T.VarcharType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def to_property(col: Column, data_type: T.DataType, decimal: str = "double") -> Column:
    """``col`` of ``data_type`` converted to its property type."""
    if isinstance(data_type, _INTEGERS):
        return col if isinstance(data_type, T.LongType) else col.cast("bigint")
    if isinstance(data_type, T.FloatType):
        return col.cast("double")
    if isinstance(data_type, T.DecimalType):
        return col if decimal == "keep" else col.cast("double")
    if isinstance(data_type, T.DateType):
        return col.cast("timestamp")
    if isinstance(data_type, _NESTED):
        return F.to_json(col, {"ignoreNullFields": "false"})
    if stored_kind(data_type) is not None:
        return col
    return col.cast("string")


def stored_kind(data_type: T.DataType) -> str | None:
    """Value type of an already converted column; None if it is not one."""
    if isinstance(data_type, T.LongType):
        return LONG
    if isinstance(data_type, T.DoubleType):
        return DOUBLE
    if isinstance(data_type, T.BooleanType):
        return BOOL
    if isinstance(data_type, _TEXTS):
        return STRING
    if isinstance(data_type, T.BinaryType):
        return BLOB
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return TIMESTAMP
    return None
