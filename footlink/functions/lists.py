"""Delimited id lists (``a/b/c``) and the string aggregates that build them.

Two split flavours exist in the source SQL and differ on the empty string:

* ``unnest(string_to_array(s, sep))`` (E1): ``''`` gives **no** element.
* ``regexp_split_to_table(s, sep)`` (E2): ``''`` gives **one** ``''``.

Both give no element for NULL. Inside the engine lists stay
``array<string>``; they are joined to text only where a table needs it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_array(s, sep: str = "/") -> Column:
    """E1 as an array: ``''`` → ``[]``, NULL → NULL, else split keeping
    inner and trailing empty pieces."""
    s = _col(s)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(
        F.split(s, re.escape(sep), -1))


def to_array_keep_empty(s, sep: str = "/") -> Column:
    """E2 as an array: ``''`` → ``['']``, NULL → NULL."""
    return F.split(_col(s), re.escape(sep), -1)


def agg_distinct_sorted(c, sep: str = "/") -> Column:
    """A1 ``string_agg(DISTINCT c, sep)`` with a fixed (sorted) order.
    NULLs are ignored; a group with no non-NULL value gives NULL."""
    arr = F.array_sort(F.collect_set(_col(c)))
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))


def agg_all_sorted(c, sep: str = "/") -> Column:
    """A2 ``string_agg(c, sep)``, duplicates kept; the source leaves the
    order unspecified, we sort."""
    arr = F.array_sort(F.collect_list(_col(c)))
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))
