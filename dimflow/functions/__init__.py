"""Column-expression helpers: time arithmetic, cleansing, type names."""

from dimflow.functions.cleanse import cleanse, cleanse_column, separator, separator_expr, to_delimited
from dimflow.functions.timeutil import (batch_path, hour_of_minute, hour_ts, minute_string, next_minute_stamp,
                                        ntz, parse_minute, to_pacific, truncate_to_second, utc_hour)
from dimflow.functions.typemap import normalise_type, spark_type

__all__ = [
    "batch_path", "cleanse", "cleanse_column", "hour_of_minute", "hour_ts", "minute_string", "next_minute_stamp",
    "normalise_type", "ntz", "parse_minute", "separator", "separator_expr", "spark_type",
    "to_delimited", "to_pacific", "truncate_to_second", "utc_hour",
]
