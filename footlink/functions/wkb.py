"""Binary geometry (G1): (E)WKB as Spark columns, read and written.

A geometry column dumped by the database is hex EWKB. It is read here byte by
byte with Catalyst expressions (no Python worker): counts and positions run
through ``aggregate``, and a double is put together from its bits, which is
exact. Both byte orders, nested headers, Z and M (EWKB flags and ISO type
numbers) and the SRID are understood; ordinates beyond x and y are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT_T = "struct<x:double,y:double>"
GEOM_T = f"array<array<array<{POINT_T}>>>"

# Geometry types, and the flags of EWKB in the type word.
POINT, POLYGON, MULTIPOLYGON, LAST_TYPE = 1, 3, 6, 17
HAS_Z, HAS_M, HAS_SRID, FLAGS = 0x80000000, 0x40000000, 0x20000000, 0xE0000000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _swap(h: Column, n: int) -> Column:
    return F.concat(*[F.substring(h, 2 * i - 1, 2) for i in range(n, 0, -1)])


def _bytes(b: Column, at: Column, n: int, little: Column) -> Column:
    """n bytes from position ``at`` (from 0) as hex, most significant first."""
    h = F.hex(F.substring(b, (at + 1).cast("int"), F.lit(n)))
    return F.when(little, _swap(h, n)).otherwise(h)


def _word(b: Column, at: Column, little: Column) -> Column:
    return F.conv(_bytes(b, at, 4, little), 16, 10).cast("long")


def _double(b: Column, at: Column, little: Column) -> Column:
    def of(h):
        hi = F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
        lo = F.conv(F.substring(h, 9, 8), 16, 10).cast("long")
        return _let(F.struct(hi.alias("hi"), lo.alias("lo")), value)

    def value(v):
        hi = v.getField("hi")
        exponent = F.shiftright(hi, 20).bitwiseAND(0x7FF)
        fraction = hi.bitwiseAND(0xFFFFF) * F.lit(1 << 32) + v.getField("lo")
        size = (F.when(exponent == 0x7FF, F.lit(float("nan")))
                .when(exponent == 0, fraction.cast("double") * F.lit(2.0 ** -1074))
                .otherwise((fraction + F.lit(1 << 52)).cast("double") * F.pow(F.lit(2.0), exponent - 1075)))
        return F.when(hi >= F.lit(1 << 31), -size).otherwise(size)

    return _let(_bytes(b, at, 8, little), of)


def _header(b: Column, at: Column) -> Column:
    """Byte order, type, ordinates a point, SRID and where the body begins."""
    little = F.hex(F.substring(b, (at + 1).cast("int"), F.lit(1))) == "01"

    def of(h):
        word, order = h.getField("word"), h.getField("little")
        plain = word.bitwiseAND(F.lit(~FLAGS & 0xFFFFFFFF))
        iso = F.floor(plain / 1000)
        has = lambda flag, *kinds: ((word.bitwiseAND(F.lit(flag)) != 0) | iso.isin(*kinds)).cast("int")
        tagged = word.bitwiseAND(F.lit(HAS_SRID)) != 0
        return F.struct(order.alias("little"), (plain % 1000).alias("kind"),
                        (F.lit(2) + has(HAS_Z, 1, 3) + has(HAS_M, 2, 3)).alias("dims"),
                        F.when(tagged, _word(b, at + 5, order)).otherwise(F.lit(0)).cast("int").alias("srid"),
                        (at + F.when(tagged, F.lit(9)).otherwise(F.lit(5))).cast("long").alias("body"))

    return _let(F.struct(little.alias("little"), _word(b, at + 1, little).alias("word")), of)


def _steps(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(1).cast("long"), n)).otherwise(F.array().cast("array<long>"))


def _point(b: Column, at: Column, little: Column) -> Column:
    return F.struct(_double(b, at, little).alias("x"), _double(b, at + 8, little).alias("y"))


def _polygon(b: Column, at: Column) -> Column:
    """Rings of the polygon whose header is at ``at``, and its end."""
    size = F.length(b)

    def of(h):
        little, width = h.getField("little"), h.getField("dims") * 8
        n_rings = _word(b, h.getField("body"), little)

        def ring(acc, _):
            start = acc.getField("at")
            n = _word(b, start, little)
            # A count that the bytes cannot hold ends the walk: NULL, so broken.
            fits = n * width <= size - start - 4
            points = F.transform(_steps(n), lambda i: _point(b, start + 4 + (i - 1) * width, little))
            return F.struct(F.when(fits, start + 4 + n * width).cast("long").alias("at"),
                            F.when(fits, F.concat(acc.getField("rings"), F.array(points))).alias("rings"))

        zero = F.struct((h.getField("body") + 4).cast("long").alias("at"),
                        F.array().cast(f"array<array<{POINT_T}>>").alias("rings"))
        return F.when((h.getField("kind") == POLYGON) & (n_rings * 4 <= size),
                      F.aggregate(_steps(n_rings), zero, ring))

    return _let(_header(b, at), of)


def _multipolygon(b: Column) -> Column:
    size = F.length(b)

    def of(h):
        multi = h.getField("kind") == MULTIPOLYGON
        n = F.when(multi, _word(b, h.getField("body"), h.getField("little"))).otherwise(F.lit(1))

        def part(acc, _):
            return _let(_polygon(b, acc.getField("at")), lambda p: F.struct(
                p.getField("at").alias("at"),
                F.concat(acc.getField("parts"), F.array(p.getField("rings"))).alias("parts")))

        zero = F.struct(F.when(multi, h.getField("body") + 4).otherwise(F.lit(0)).cast("long").alias("at"),
                        F.array().cast(GEOM_T).alias("parts"))
        return F.when(n * 9 <= size, F.aggregate(_steps(n), zero, part))

    return _let(_header(b, F.lit(0)), of)


def is_hex(text) -> Column:
    """Does the text look like hex (E)WKB: byte order and type word?"""
    return _col(text).rlike("(?i)^0[01][0-9A-F]{8}")


def _broken(text: Column, to: str) -> Column:
    return F.raise_error(F.concat(F.lit("cannot read geometry: "), F.left(text, F.lit(80)))).cast(to)


def geometry_from_hex(text) -> Column:
    """Polygon or multipolygon as a multipolygon column. Empty ones and other
    known types are NULL; what ends early, goes on behind the end or holds an
    unknown type raises."""
    t = _col(text)

    def of(b):
        empty = lambda parts: F.size(F.filter(parts, lambda p: F.size(p) > 0)) == 0
        polygonal = lambda k: k.isin(POLYGON, MULTIPOLYGON)
        read = _let(_multipolygon(b), lambda m: F.when(
            F.coalesce(m.getField("at") == F.length(b), F.lit(False)),
            F.when(~empty(m.getField("parts")), m.getField("parts"))).otherwise(_broken(t, GEOM_T)))
        return _let(_header(b, F.lit(0)), lambda h: F.when(polygonal(h.getField("kind")), read)
                    .when(~F.coalesce(h.getField("kind").between(1, LAST_TYPE), F.lit(False)), _broken(t, GEOM_T)))

    return _let(F.try_to_binary(t, F.lit("hex")), lambda b: F.when(b.isNull(), _broken(t, GEOM_T)).otherwise(of(b)))


def point_from_hex(text) -> Column:
    """A point; NULL when empty (its ordinates are NaN) or of another type."""
    t = _col(text)

    def of(b):
        def read(h):
            whole = h.getField("body") + h.getField("dims") * 8 == F.length(b)
            p = _point(b, h.getField("body"), h.getField("little"))
            return (F.when((h.getField("kind") == POINT) & F.coalesce(whole, F.lit(False)),
                           _let(p, lambda v: F.when(~F.isnan(v.getField("x")), v)))
                    .when((h.getField("kind") == POINT)
                          | ~F.coalesce(h.getField("kind").between(1, LAST_TYPE), F.lit(False)), _broken(t, POINT_T)))
        return _let(_header(b, F.lit(0)), read)

    return _let(F.try_to_binary(t, F.lit("hex")), lambda b: F.when(b.isNull(), _broken(t, POINT_T)).otherwise(of(b)))


def srid_from_hex(text) -> Column:
    """SRID of the outer header, 0 when it has none."""
    return _let(F.try_to_binary(_col(text), F.lit("hex")), lambda b: _header(b, F.lit(0)).getField("srid"))


# -- writing ------------------------------------------------------------------

def _out_word(n: Column, little: Column) -> Column:
    return _let(F.lpad(F.hex(n.cast("long")), 8, "0"), lambda h: F.when(little, _swap(h, 4)).otherwise(h))


def _out_double(v: Column, little: Column) -> Column:
    def of(a):
        guess = F.floor(F.log2(a)).cast("int")                      # off by one next to a power of two, at most
        up, down = a >= F.pow(F.lit(2.0), guess + 1), a < F.pow(F.lit(2.0), guess)
        return _let(guess + up.cast("int") - down.cast("int"), lambda e: (
            (e + 1023).cast("long") * F.lit(1 << 52)
            + ((a / F.pow(F.lit(2.0), e) - 1) * F.lit(2.0 ** 52)).cast("long")))

    bits = F.when(v == 0, F.lit(0).cast("long")).otherwise(_let(F.abs(v), of))
    h = F.lpad(F.hex(bits), 16, "0")
    # The sign is the top bit: digits 0-7 become 8-F.
    h = F.when(v < 0, F.concat(F.conv((F.conv(F.left(h, F.lit(1)), 16, 10).cast("int") + 8).cast("string"), 10, 16),
                               F.substring(h, 2, 15))).otherwise(h)
    return _let(h, lambda x: F.when(little, _swap(x, 8)).otherwise(x))


def to_hex(g, srid=None, z=None, little=None) -> Column:
    """Multipolygon column as hex EWKB text; ``srid`` (NULL or 0: none), ``z``
    (write a third ordinate of 0) and ``little`` (byte order) are columns."""
    g = _col(g)
    srid = F.coalesce(F.lit(0) if srid is None else _col(srid), F.lit(0))
    z = F.lit(False) if z is None else _col(z)
    little = F.lit(True) if little is None else _col(little)
    mark = F.when(little, F.lit("01")).otherwise(F.lit("00"))
    flag = F.when(z, F.lit(HAS_Z)).otherwise(F.lit(0))
    third = F.when(z, F.lit("0" * 16)).otherwise(F.lit(""))
    pt = lambda p: F.concat(_out_double(p.getField("x"), little), _out_double(p.getField("y"), little), third)
    ring = lambda r: F.concat(_out_word(F.size(r), little), F.array_join(F.transform(r, pt), ""))
    poly = lambda p: F.concat(mark, _out_word(flag + POLYGON, little), _out_word(F.size(p), little),
                              F.array_join(F.transform(p, ring), ""))
    tagged = F.when(srid != 0, F.lit(HAS_SRID)).otherwise(F.lit(0))
    return F.concat(mark, _out_word(flag + tagged + MULTIPOLYGON, little),
                    F.when(srid != 0, _out_word(srid, little)).otherwise(F.lit("")),
                    _out_word(F.size(g), little), F.array_join(F.transform(g, poly), ""))
