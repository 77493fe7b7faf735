"""Expressions for compact names and ``(scheme)value`` strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the form of a classified subject, "(classificationName=x, id=y)code".
CLASSIFIED = r"(?s)^\(classificationName=([^,)]*)(?:, id=([^)]*))?\)(.*)$"


def expand_iri(name: Column, prefixes: Column) -> Column:
    """``prefix:rest`` to a full IRI through a ``map<string,string>`` of prefixes.

    Names whose prefix the map does not hold (full IRIs among them) stay as they are.
    """
    base = F.try_element_at(prefixes, F.substring_index(name, ":", 1))
    rest = F.substr(name, F.instr(name, ":") + F.lit(1))
    return F.when(F.contains(name, F.lit(":")) & base.isNotNull(), F.concat(base, rest)).otherwise(name)


def scheme_of(value: Column) -> Column:
    """``scheme`` of ``(scheme)value``; null when the text has another form."""
    return F.when(
        value.startswith("(") & (F.instr(value, ")") > 0),
        F.substring_index(F.substr(value, F.lit(2)), ")", 1),
    )


def value_of(value: Column) -> Column:
    """``value`` of ``(scheme)value``, the whole text when there is no scheme."""
    return F.when(
        scheme_of(value).isNotNull(), F.substr(value, F.instr(value, ")") + F.lit(1))
    ).otherwise(value)


def classification(value: Column) -> Column:
    """``struct(scheme, scheme_id, value)``; scheme is null for a free keyword."""

    def group(i: int) -> Column:
        return F.regexp_extract(value, CLASSIFIED, i)

    known = value.rlike(CLASSIFIED)
    return F.struct(
        F.when(known, group(1)).alias("scheme"),
        F.when(known, F.nullif(group(2), F.lit(""))).alias("scheme_id"),
        F.when(known, group(3)).otherwise(value).alias("value"),
    )
