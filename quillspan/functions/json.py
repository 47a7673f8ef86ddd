"""JSON text as values: equality, hashing, typed reading and writing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


_INSIDE = r'(?:[^"\\]++|\\.)*+'
_STRING = f'"{_INSIDE}"'
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+"
# Texts whose strings start with "s" hold their numbers as strings that start with "n".
_TO_NUMBER = rf'(?s)\G((?:[^"\-0-9]++|{_STRING})*+)({_NUMBER})'
_TO_MARKED = rf'(?s)\G((?:[^"]++|"s{_INSIDE}")*+)"n([^"]*+)"'
_NO_NUMBER_AS_NAME = rf'(?s)^(?:[^"]++|"s{_INSIDE}"|"n[^"]*+"(?!\s*+:))*+$'
_SLOT = "\u0001"


def _once(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often ``body`` names it: Spark would repeat it behind a condition."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def canonical_numbers(texts: Column) -> Column:
    """One spelling per number of an array, exact however long: whole numbers as they are, others by digits and power of ten.

    ``1.0``, ``1.00`` and ``10e-1`` give ``1.0``; ``1`` stays apart from them. Where the point lies more than 16 digits
    away, an exponent is written. An exponent that is no 64-bit number keeps its spelling.
    """

    def read(text):
        part = F.regexp_extract(text, r"\.([0-9]+)", 1)
        power = F.regexp_extract(text, r"[eE]\+?(-?[0-9]+)$", 1)
        return F.struct(
            F.regexp_replace(F.concat(F.regexp_extract(text, r"^-?([0-9]+)", 1), part), "^0+", "").alias("digits"),
            F.length(part).alias("behind"),
            F.when(power == "", F.lit(0).cast("bigint")).otherwise(power.try_cast("bigint")).alias("power"),
        )

    def placed(n):
        return F.struct(
            F.regexp_replace(n["digits"], "0++$", "").alias("kept"),
            # Where the point stands, counted from the first digit that is not zero.
            F.try_add(n["power"], (F.length(n["digits"]) - n["behind"]).cast("bigint")).alias("point"),
        )

    def spelled(text, n):
        kept, point = n["kept"], n["point"]
        near = point.cast("int")
        plain = (
            F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -near), kept))
            .when(point >= F.length(kept), F.concat(F.rpad(kept, near, "0"), F.lit(".0")))
            .otherwise(F.concat(F.substring(kept, F.lit(1), near), F.lit("."), F.substring(kept, near + 1, F.length(kept))))
        )
        exact = F.when(point.between(-16, 16), plain).otherwise(F.concat(F.lit("0."), kept, F.lit("e"), point.cast("string")))
        signed = F.concat(F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")), exact)
        return F.when(kept == "", F.lit("0.0")).when(point.isNull(), F.lower(text)).otherwise(signed)

    def number(text):
        other = _once(read(text), lambda n: _once(placed(n), lambda m: spelled(text, m)))
        return F.when(text == "-0", F.lit("0")).when(~text.rlike("[.eE]"), text).otherwise(other)

    return F.transform(texts, number)


def canonical_json(text: Column) -> Column:
    """One spelling per JSON value: equal trees give equal text, whatever their key order.

    ``1`` and ``1.0`` stay apart, ``1.0`` and ``1.00`` do not; numbers are compared exactly, so ``1e400`` is not ``1e500``.
    Text that is not one strict JSON value gives NULL, as do objects that hold a key twice and values that Spark's
    VARIANT cannot hold (more than 1000 levels or 16 MB). Lone surrogates become ``?``.

    Only built-in functions run: numbers are turned into strings before VARIANT sorts the keys, since it would
    read long ones as doubles, and back again after it.
    """

    def with_strings(marked):
        numbers = canonical_numbers(F.regexp_extract_all(marked, F.lit(_TO_NUMBER), F.lit(2)))
        slots = F.split(F.regexp_replace(marked, _TO_NUMBER, f'$1"n{_SLOT}"'), _SLOT, -1)
        filled = F.zip_with(slots, numbers, lambda s, n: F.concat(s, F.coalesce(n, F.lit(""))))
        return F.when(F.instr(text, _SLOT) == 0, F.array_join(filled, ""))

    def in_order(as_strings):
        # Parsers stop after the first value: text behind it would have to continue both an array and an object.
        named = F.try_parse_json(F.concat(F.lit('{"p":'), as_strings, F.lit("}")))
        listed = F.try_parse_json(F.concat(F.lit("["), as_strings, F.lit("]")))
        return F.when(named.isNotNull() & as_strings.rlike(_NO_NUMBER_AS_NAME), F.to_json(listed))

    def unmarked(out):
        bare = F.regexp_replace(F.substring(out, F.lit(2), F.length(out) - 2), _TO_MARKED, "$1$2")
        return F.when(F.json_array_length(out) == 1, F.regexp_replace(bare, f'(?s)"s({_INSIDE})"', '"$1"'))

    marked = F.regexp_replace(text, f'(?s)"({_INSIDE})"', '"s$1"')
    return _once(_once(_once(marked, with_strings), in_order), unmarked)


def json_hash(*parts: Column, document: Column) -> Column:
    """64-bit hash of some key columns and a JSON document, blind to key order."""
    return F.xxhash64(*parts, canonical_json(document))


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def snake_schema(data_type: T.DataType) -> T.DataType:
    """The same type with every field name in snake case."""
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [T.StructField(snake_case(f.name), snake_schema(f.dataType), f.nullable) for f in data_type]
        )
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(snake_schema(data_type.elementType), data_type.containsNull)
    if isinstance(data_type, T.MapType):
        return T.MapType(data_type.keyType, snake_schema(data_type.valueType), data_type.valueContainsNull)
    return data_type


def _as_type(schema) -> T.DataType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def from_snake_json(text: Column, schema) -> Column:
    """Read snake-case JSON into ``schema``, whose names may be camel case; unknown keys are dropped."""
    wanted = _as_type(schema)
    return F.from_json(text, snake_schema(wanted)).cast(wanted)


def to_snake_json(value: Column, schema) -> Column:
    """Write a struct of type ``schema`` as JSON with snake-case keys."""
    return F.to_json(value.cast(snake_schema(_as_type(schema))))


def is_json(text: Column) -> Column:
    """Whether ``text`` holds a JSON value (the literal ``null`` included)."""
    return F.get_json_object(text, "$").isNotNull() | F.coalesce(F.trim(text) == "null", F.lit(False))


def has_key(text: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(text), key), F.lit(False))
