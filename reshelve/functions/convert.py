"""Convert every value of a frame, at any depth, to what a document store holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _converted(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        fields = [_converted(column[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda item: _converted(item, kind.elementType))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return column.cast("date").cast("timestamp_ntz")
    return column


def convert_values(df: DataFrame) -> DataFrame:
    """Dates and timestamps become midnight datetimes; decimals stay exact decimals."""
    return df.select(*[_converted(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])
