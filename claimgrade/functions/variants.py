"""Helpers over VARIANT columns: JSON whose shape is not known in advance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANY_ARRAY = "array<variant>"
ANY_MAP = "map<string,variant>"


def parse(text: Column) -> Column:
    """The JSON value of the whole text; NULL when it is not JSON.

    The parser itself stops after the first value and does not look at what follows.
    Reading the text as the only element of a list makes it see all of it.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    elements = F.try_variant_get(wrapped, "$", ANY_ARRAY)
    return F.when(F.size(elements) == 1, F.get(elements, F.lit(0)))


def at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", ANY_MAP).isNotNull()


def is_array(value: Column) -> Column:
    return F.try_variant_get(value, "$", ANY_ARRAY).isNotNull()


def is_string(value: Column) -> Column:
    return F.coalesce(kind(value) == "STRING", F.lit(False))


def string_at(value: Column, path: str) -> Column:
    """The string at ``path``; NULL when there is none or it is of another type."""
    found = at(value, path)
    return F.when(is_string(found), F.try_variant_get(value, path, "string"))


def array_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, ANY_ARRAY)


def keys(value: Column) -> Column:
    return F.map_keys(F.try_variant_get(value, "$", ANY_MAP))
