"""Text expressions: trimming, defaults, fallbacks and composition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Remove Unicode whitespace at both ends; ``trim`` alone knows only spaces."""
    return F.btrim(value, F.lit(WHITESPACE))


def or_empty(value: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(value, F.lit(""))


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty, else null."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def label_with_definition(label: Column, definition: Column) -> Column:
    """``"label. definition"``, or the label alone when there is no definition."""
    return F.concat_ws(". ", label, F.nullif(definition, F.lit("")))


def fixed4(value: Column) -> Column:
    """Four decimals, never grouped by thousands."""
    return F.format_string("%.4f", value)
