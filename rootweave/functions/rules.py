"""Column rules shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

# Fixed value: the validity end that means "still valid".
OPEN_END = "9999-12-31"


def open_ended(valid_to: str, data_type: DataType) -> Column:
    """True while a validity interval is open.

    Temporal columns are compared as such, so the test reaches the Parquet reader;
    text columns are compared by prefix.
    """
    if isinstance(data_type, (TimestampType, TimestampNTZType, DateType)):
        return F.col(valid_to) >= F.lit(OPEN_END).cast(data_type)
    if isinstance(data_type, StringType):
        return F.col(valid_to).startswith(OPEN_END)
    return F.col(valid_to).cast("string").startswith(OPEN_END)


def not_blank(*columns: str) -> Column:
    """True when none of the columns is NULL, empty or only spaces."""
    test = F.lit(True)
    for name in columns:
        test = test & F.col(name).isNotNull() & (F.trim(F.col(name)) != "")
    return test


def key_as_string(column: str) -> Column:
    return F.col(column).cast("string")


def key_as_long(column: str) -> Column:
    """Numeric presentation of a key; NULL where the key is not a whole number."""
    return F.col(column).try_cast("bigint")


def better_root(candidate: str) -> Column:
    """Aggregate: the smallest number among the candidates, else the smallest text.

    The candidate is returned exactly as it was recorded, leading zeros included.
    """
    number = key_as_long(candidate)
    rank = F.struct(number.isNull().alias("text"), number.alias("number"), F.col(candidate).alias("value"))
    return F.min(rank)["value"]


def table_name_of(stem: Column) -> Column:
    """Catalog-safe table name for a file stem."""
    return F.regexp_replace(F.lower(stem), "[^a-z0-9_]", "_")
