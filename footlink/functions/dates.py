"""Change-feed date handling (D1, D7) as Catalyst expressions.

``sys_period`` is a PostgreSQL range rendered as text, for example
``["2023-12-08 11:44:32.395076+01","2023-12-22 12:52:29.558363+01")``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: the anchored pattern that
# takes the lower bound of the range (the character class is part of the
# semantics: anything outside it ends the match).
RANGE_START_PATTERN = r'^\["?([\d\-:.T+ ]+)'

# Pattern for an ISO-8601 date-time as Python's ``fromisoformat`` accepts it
# (date, optional time with optional fraction, optional offset).
_ISO = (r'^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2}))?(?:[.,](\d+))?)?'
        r'(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?$')


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_start_text(sys_period) -> Column:
    """Lower bound text as the reference normalises it before parsing:
    spaces become ``T``; a ``+00`` offset without ``+00:00`` is widened."""
    m = F.nullif(F.regexp_extract(_col(sys_period), RANGE_START_PATTERN, 1), F.lit(""))
    m = F.replace(m, F.lit(" "), F.lit("T"))
    return F.when(m.contains("+00") & ~m.contains("+00:00"),
                  F.replace(m, F.lit("+00"), F.lit("+00:00"))).otherwise(m)


def range_start(sys_period, strict: bool = False) -> Column:
    """Lower bound of a text range as an instant (``TimestampType``).

    No match (garbage, ``(``-opened, unbounded below) gives NULL. Text that
    matches but does not parse raises in strict mode and is NULL otherwise.
    """
    s = range_start_text(sys_period)
    if strict:
        return F.when(s.isNull(), F.lit(None).cast("timestamp")).otherwise(s.cast("timestamp"))
    return F.try_to_timestamp(s)


def iso_text(text) -> Column:
    """Python ``datetime.fromisoformat(t).isoformat()`` re-expressed on strings.

    Seconds are always printed; the fraction is padded/truncated to six
    digits and dropped when zero; an offset ``+hh``/``+hhmm`` is printed
    ``+hh:mm``; ``Z`` becomes ``+00:00``. Unparseable text gives NULL.
    Staying in strings keeps the original offset, which ``TimestampType``
    would lose.
    """
    t = _col(text)
    ok = t.rlike(_ISO)

    def g(i):
        return F.regexp_extract(t, _ISO, i)

    hh = F.when(g(2) == "", F.lit("00")).otherwise(g(2))
    mi = F.when(g(3) == "", F.lit("00")).otherwise(g(3))
    ss = F.when(g(4) == "", F.lit("00")).otherwise(g(4))
    frac6 = F.substring(F.rpad(g(5), 6, "0"), 1, 6)
    frac = F.when((g(5) == "") | (frac6 == "000000"), F.lit("")).otherwise(F.concat(F.lit("."), frac6))
    off_raw = F.regexp_replace(g(6), ":", "")
    off = (F.when(g(6) == "", F.lit(""))
           .when(g(6) == "Z", F.lit("+00:00"))
           .otherwise(F.concat(
               F.substring(off_raw, 1, 3), F.lit(":"),
               F.when(F.length(off_raw) >= 5, F.substring(off_raw, 4, 2)).otherwise(F.lit("00")),
               F.when(F.length(off_raw) >= 7, F.concat(F.lit(":"), F.substring(off_raw, 6, 2)))
                .otherwise(F.lit("")))))
    out = F.concat(g(1), F.lit("T"), hh, F.lit(":"), mi, F.lit(":"), ss, frac, off)
    return F.when(ok, out)


def quoted_range_start(sys_period) -> Column:
    """The second ``"``-delimited piece of the range, ISO formatted."""
    piece = F.get(F.split(_col(sys_period), '"'), 1)
    return iso_text(piece)


def days_before(as_of, n: int) -> Column:
    """``CURRENT_DATE - INTERVAL 'n days'`` with the date made explicit."""
    return F.date_sub(F.lit(as_of).cast("date"), n).cast("timestamp_ntz")


def pg_day_of_week(d) -> Column:
    """``EXTRACT(DOW FROM d)``: Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(_col(d)) - 1
