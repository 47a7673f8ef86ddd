"""Fields of documents: columns, or places inside their JSON."""

from __future__ import annotations

import datetime
import decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE = "_source"

# What the text of a JSON value is read as to be compared with a Python value; the widest decimal keeps 64-bit integers.
_LIKE = {
    bool: "boolean",
    int: "decimal(38,18)",
    float: "double",
    decimal.Decimal: "decimal(38,18)",
    datetime.date: "date",
    datetime.datetime: "timestamp",
}


def in_source(df: DataFrame, field: str, source_col: str = SOURCE) -> bool:
    """Whether ``df`` has no column for the field but JSON documents that may hold it."""
    columns = {c.lower() for c in df.columns}
    return not field.startswith("`") and field.split(".")[0].lower() not in columns and source_col in columns


def field_column(df: DataFrame, field: str, like=None, source_col: str = SOURCE) -> Column:
    """The column of a field or, of documents kept as JSON, the text found at its path, NULL where there is none.

    ``like`` is a value to compare with: text that does not read as its type is NULL then.  An array
    is its JSON text; :func:`mapped` reads arrays and other types as such.
    """
    if not in_source(df, field, source_col):
        return F.col(field)
    if "'" in field:
        raise ValueError(f"no path inside {source_col} for {field!r}")
    found = F.get_json_object(source_col, "$" + "".join(f"['{name}']" for name in field.split(".")))
    return found.try_cast(_LIKE[type(like)]) if type(like) in _LIKE else found


def is_array(df: DataFrame, field: str) -> bool:
    return not in_source(df, field) and isinstance(df.select(field).schema[0].dataType, T.ArrayType)


def mapped(df: DataFrame, mapping: str, source_col: str = SOURCE) -> DataFrame:
    """Add the fields of a mapping such as ``"price double, tags array<string>"`` as typed columns.

    They are read from the JSON documents, so clauses, sorting and aggregations treat them like stored columns; only
    fields that a query uses are parsed.  A value of another type is NULL; a name that ``df`` has is refused.
    """
    shape = T.StructType.fromDDL(mapping)
    twice = {n.lower() for n in shape.names} & {c.lower() for c in df.columns}
    if twice:
        raise ValueError(f"columns {sorted(twice)} are there already")
    parsed = F.from_json(source_col, shape)
    return df.select("*", *[parsed.getField(n).alias(n) for n in shape.names])
