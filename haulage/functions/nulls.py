"""Empty-ish values to null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# JSON texts of the values that count as empty. Spark writes every whole or
# decimal zero as 0 and a floating-point zero as 0.0 or -0.0.
FALSY_JSON = ("null", "false", '""', "0", "0.0", "-0.0", "[]", "{}")


def falsy_to_null(column: str | Column, dtype: T.DataType) -> Column:
    """Null for the "nothing there" value of the column's type, else the value.

    That value is ``''`` for text, 0 for numbers, false for booleans and the
    empty collection for arrays and maps. A variant is judged by the type of
    the JSON value it holds. Dates, timestamps and structs are never falsy.
    """
    col = F.col(column) if isinstance(column, str) else column
    if isinstance(dtype, T.VariantType):
        return F.when(~F.to_json(col).isin(*FALSY_JSON), col)
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.nullif(col, F.lit(""))
    if isinstance(dtype, T.BooleanType):
        return F.nullif(col, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.nullif(col, F.lit(0).cast(dtype))
    if isinstance(dtype, T.BinaryType):
        return F.when(F.length(col) > 0, col)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.when(F.size(col) > 0, col)
    return col
