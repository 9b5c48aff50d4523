"""Source column types -> sidecar type names and Spark types."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Which source dictionary type names (exact case) are written as
# which sidecar type.  Names not listed pass through unchanged.
NORMALISED_TYPES = {
    "string": ["enum", "varchar", "datetime", "timestamp", "text", "date", "char",
               "longblob", "mediumtext", "longtext", "set", "blob", "tinyblob",
               "VARCHAR2", "DATE"],
    "double": ["decimal", "float", "FLOAT"],
    "int": ["tinyint", "smallint", "mediumint", "bit", "NUMBER"],
    "long": ["bigint"],
}

_SOURCE_TO_NORMAL = {src: norm for norm, srcs in NORMALISED_TYPES.items() for src in srcs}


def normalise_type(c: Column) -> Column:
    """Map a type-name column through the fixed table (unknown names kept)."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v))
                                          for k, v in _SOURCE_TO_NORMAL.items()))
    return F.coalesce(m[c], c)


# Sidecar / dictionary type name -> Spark type used when parsing a dump.
_SPARK_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(),
    "long": T.LongType(), "bigint": T.LongType(), "integer": T.IntegerType(),
    "boolean": T.BooleanType(), "float": T.FloatType(), "date": T.DateType(),
    "timestamp": T.TimestampNTZType(), "time": T.StringType(), "year": T.IntegerType(),
}


def spark_type(type_name: str) -> T.DataType:
    """Spark type for a normalised (or raw) type name; unknown -> string."""
    name = _SOURCE_TO_NORMAL.get(type_name, type_name)
    return _SPARK_TYPES.get(name.lower(), T.StringType())
