"""How large rows are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType


def row_bytes(df: DataFrame) -> Column:
    """Size of a row: the length of its texts and nested values, and a fixed width per column."""

    def varying(field: StructField) -> Column | None:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            return F.octet_length(column)
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            return F.octet_length(F.to_json(F.struct(column)))
        return None

    lengths = (F.coalesce(c, F.lit(0)).cast("long") for c in map(varying, df.schema) if c is not None)
    return reduce(lambda a, b: a + b, lengths, F.lit(16 * len(df.columns)).cast("long"))
