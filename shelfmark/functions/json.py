"""Strict JSON on text columns, with Python's idea of validity and truth.

``from_json`` alone is lenient: it accepts trailing text and single quotes.
Every parse here therefore wraps the line as ``[line, marker]`` and asks for
exactly two elements of which the second is the marker, which no trailing text,
extra comma or unclosed bracket in the line can fake.
"""

from __future__ import annotations

import json as _json
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.once import evaluate_once
from shelfmark.session import short_batches

END = "shelfmark~end"
# Numbers may be as long as they are: the parser's own limit of 1,000 digits is lifted.
STRICT = "map('allowSingleQuotes', 'false', 'maxNumLen', '2147483647')"

# Verdicts on a line besides "ok".
BAD_JSON, TOO_DEEP = "bad_json", "too_deep"
MAX_DEPTH = 1_000  # the JVM parser's limit

# Bytes of lines that a worker turns into Python objects at a time; a longer line goes alone.
PORTION_BYTES = 1 << 20

# Spark's parser also takes signed spellings of infinity that Python rejects.
_ODD_INFINITY = r"r'\+Infinity|[+-]?\bINF\b'"
_STRING_LITERAL = r"""r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'"""


def _odd_infinity(line: str) -> str:
    # The literals are blanked only on the rare line that holds the spelling at all.
    return (
        f"CASE WHEN {line} RLIKE {_ODD_INFINITY} "
        f"THEN regexp_replace({line}, {_STRING_LITERAL}, '') RLIKE {_ODD_INFINITY} ELSE false END"
    )


def is_json(line: str) -> Column:
    """True when the whole line is one JSON value by Python's rules; never null."""
    items = f"""from_json(concat('[', {line}, ',"{END}"]'), 'array<string>', {STRICT})"""
    rest = f"slice({items}, 2, 2)"  # two, so that a third element shows
    return F.expr(f"coalesce({rest} = array('{END}') AND NOT {_odd_infinity(line)}, false)")


def wrapped(line: str, fields: str) -> Column:
    """The line and the marker parsed as ``array<struct<fields, marker>>``."""
    schema = f"array<struct<{fields},`{END}`:boolean>>"
    return F.expr(f"""from_json(concat('[', {line}, ',{{"{END}":true}}]'), '{schema}', {STRICT})""")


def object_in(items: str, line: str) -> Column:
    """The object of a :func:`wrapped` line; null when the line is not valid JSON or
    not an object (:func:`reject_reason` tells the two apart)."""
    return F.expr(
        f"CASE WHEN size({items}) = 2 AND element_at({items}, -1).`{END}` AND NOT {_odd_infinity(line)} "
        f"THEN element_at({items}, 1) END"
    )


def _loads(line: str):
    # Python's own limit on digits would turn a valid number into an error.
    sys.set_int_max_str_digits(0)
    return _json.loads(line)


def _portions(lines: pa.Array) -> Iterator[pa.Array]:
    """A column in slices of about ``PORTION_BYTES``, a line at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(lines), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(lines):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PORTION_BYTES, side="right")))
        yield lines.slice(start, stop - start)
        start = stop


def _each(lines: pa.Array, of: Callable[[str], str | bytes | None]) -> pa.Array:
    """``of`` every line that is there, as Python objects of one portion at a time."""
    done = [pa.array([None if x is None else of(x) for x in part.to_pylist()], pa.string()) for part in _portions(lines)]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


@F.arrow_udf(T.StringType())
def _second_look(lines: pa.Array) -> pa.Array:
    def judge(line):
        try:
            _loads(line)
        except RecursionError:
            return TOO_DEEP
        except ValueError:
            return BAD_JSON
        return "ok"

    return _each(lines, judge)


def with_verdict(df: DataFrame, line: str = "line", name: str = "verdict") -> DataFrame:
    """Add ``ok``, ``bad_json`` or ``too_deep`` for a line: the one verdict that merging,
    the report of skipped lines and the readers share.

    The JVM's parser decides for all lines it accepts. It stops at 1,000 levels of
    nesting, so a line that it rejects is shown to Python's parser, and only such a line
    is sent there. ``too_deep`` is what neither of them can read to its end.
    """
    seen = evaluate_once(short_batches(df), __fine=is_json(line))
    rest = _second_look(F.when(~F.col("__fine"), F.col(line)))
    judged = evaluate_once(seen, **{name: F.coalesce(rest, F.lit("ok"))})
    return judged.drop("__fine")


def reject_reason(line: str, parsed: str) -> Column:
    """Null for a parsed object, else ``not_object``, ``bad_json`` or ``too_deep``.

    Readers stay inside the JVM, whose parser stops at 1,000 levels of nesting: a line
    that it rejects and that opens more brackets than that is ``too_deep`` for a reader,
    whether or not it is valid.
    """
    openers = F.length(line) - F.length(F.translate(F.col(line), "[{", ""))
    return F.when(
        F.col(parsed).isNull(),
        F.when(is_json(line), F.lit("not_object"))
        .when(openers > MAX_DEPTH, F.lit(TOO_DEEP))
        .otherwise(F.lit(BAD_JSON)),
    )


def described(value: str) -> Column:
    """``struct(kind, text)`` of a VARIANT: its type's name and its text form.

    The expressions below read these two instead of the VARIANT.
    """
    return F.expr(
        f"struct(schema_of_variant({value}) AS kind, try_variant_get({value}, '$', 'string') AS text)"
    )


def is_compound(field: str) -> str:
    """SQL: a described array or object, which has no text form."""
    return f"coalesce({field}.kind RLIKE '^(ARRAY|OBJECT)', false)"


def truthy(field: str) -> str:
    """SQL: Python truth of a described value: false for missing, null, ``""``, 0,
    false, [] and {}; never null."""
    return (
        f"coalesce(CASE WHEN {field}.kind = 'STRING' THEN {field}.text <> '' "
        f"WHEN {field}.kind = 'BOOLEAN' THEN {field}.text = 'true' "
        f"WHEN {is_compound(field)} THEN {field}.text NOT IN ('[]', '{{}}') "
        f"WHEN {field}.kind <> 'VOID' THEN try_cast({field}.text AS DOUBLE) <> 0 END, false)"
    )


def filled_text(field: str) -> str:
    """SQL: a truthy described scalar as text, else null.

    Strings are taken as they are (blank ones included), numbers in their JSON
    form, ``true`` as ``True``.
    """
    return (
        f"CASE WHEN {truthy(field)} AND NOT {is_compound(field)} "
        f"THEN if({field}.kind = 'BOOLEAN', 'True', {field}.text) END"
    )


def unexpected(field: str) -> str:
    """SQL: a non-empty array or object where a text is expected."""
    return f"({is_compound(field)} AND {truthy(field)})"


@F.arrow_udf(T.StringType())
def _canonical(lines: pa.Array) -> pa.Array:
    def rewrite(line):
        try:
            text = _json.dumps(_loads(line), ensure_ascii=False)
        except RecursionError:  # valid, but nested past what Python can write
            text = line
        except ValueError:
            return None
        return text.encode("utf-8", "replace")  # a lone surrogate has no UTF-8 form

    return _each(lines, rewrite)


def canonical_json(line: Column) -> Column:
    """The line re-serialised with one space after ``,`` and ``:``, non-ASCII kept.

    Null for a malformed line. Key order, repeated keys (last one wins) and
    number spelling follow Python's own serialiser, which no built-in function
    reproduces; it is meant for the text sink only. A line nested too deep for
    that serialiser stays as it is. Give it frames of :func:`session.short_batches`.
    """
    return _canonical(line)
