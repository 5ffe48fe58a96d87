"""Typed-cast family T1-T7: text staging columns to typed columns.

Each helper is one Catalyst expression, so a whole 49-column staging table
becomes a single ``select`` (one codegen stage, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings accepted as booleans (after lower-casing).
TRUE_WORDS = ["true", "t", "1"]
FALSE_WORDS = ["false", "f", "0"]
# Fixed value: a text is taken as JSON when it starts (after blanks) with an
# object, an array, or a whole quoted string.
JSON_SHAPE = r'^\s*([{\[]|".*")'


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def tri_bool(c) -> Column:
    """true/t/1 → TRUE, false/f/0 → FALSE, anything else → NULL."""
    v = F.lower(F.nullif(_col(c), F.lit("")))
    return (F.when(v.isin(*TRUE_WORDS), F.lit(True))
            .when(v.isin(*FALSE_WORDS), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def blank_to_null_cast(c, to: str) -> Column:
    """T2/T4: '' or NULL → NULL, else an ANSI cast (bad text raises, as the
    database's cast does)."""
    c = _col(c)
    return F.when(_blank(c), F.lit(None).cast(to)).otherwise(c.cast(to))


def json_or_null(c) -> Column:
    """NULL, '' and '""' → NULL; JSON-shaped text is kept as JSON text
    (validated with ``parse_json``: a shape match that is not JSON raises);
    any other text → NULL."""
    c = _col(c)
    return (F.when(c.isNull() | c.isin("", '""'), F.lit(None).cast("string"))
            .when(c.rlike(JSON_SHAPE), F.to_json(F.parse_json(c)))
            .otherwise(F.lit(None).cast("string")))


def text_or_null(c) -> Column:
    """T5: ``NULLIF(c, '')``."""
    return F.nullif(_col(c), F.lit(""))


def text_or_null_quoted(c) -> Column:
    """NULL for '' and for '""'."""
    c = _col(c)
    return F.when(c.isNull() | c.isin("", '""'), F.lit(None).cast("string")).otherwise(c)


def numeric(c, precision: int, scale: int) -> Column:
    """T4 for ``numeric(p,s)`` columns."""
    return blank_to_null_cast(c, f"decimal({precision},{scale})")
