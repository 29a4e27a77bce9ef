"""One text per row from the text columns of any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def cell_text(name: str, kind: T.DataType, parity: bool = False) -> Column | None:
    """A column's cell as text, null if it says nothing; None if such a column holds no text.

    ``parity`` also takes dates, decimals, booleans, and structs (their field names).
    """
    c = F.col(name)
    if isinstance(kind, T.StringType):
        out = stripped(c)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StringType, T.NumericType, T.DateType)):
        items = F.filter(F.transform(c, lambda x: stripped(x.cast("string"))), lambda x: x != "")
        out = F.array_join(items, " ")
    elif parity and isinstance(kind, (T.DateType, T.DecimalType)):
        out = c.cast("string")
    elif parity and isinstance(kind, T.BooleanType):
        out = F.initcap(c.cast("string"))
    elif parity and isinstance(kind, T.StructType):
        out = F.when(c.isNotNull(), F.lit(" ".join(kind.names)))
    else:
        return None
    return F.when(out != "", out)


def is_null_cell(name: str, kind: T.DataType) -> Column:
    """Null, NaN, or an array without a value."""
    c = F.col(name)
    if isinstance(kind, T.ArrayType):
        return c.isNull() | (F.size(F.filter(c, lambda x: x.isNotNull())) == 0)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def row_text(df: DataFrame, columns: list[str] | None = None, parity: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep..., text: the text columns' cells joined by spaces; rows without text are dropped. Other columns are not read."""
    fields = [f for f in df.schema.fields if f.name not in keep and (columns is None or f.name in columns)]
    cells = [c for f in fields if (c := cell_text(f"`{f.name}`", f.dataType, parity)) is not None]
    if not cells:
        return df.select(*keep, F.lit(None).cast("string").alias("text")).limit(0)
    return df.select(*keep, F.concat_ws(" ", *cells).alias("text")).where("text <> ''")
