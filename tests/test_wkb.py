"""Hex (E)WKB against Python's own packing of doubles; text that is no
geometry raises."""

import struct

import pytest
from pyspark.sql import functions as F

from footlink.functions import geometry as G
from footlink.functions import wkb

VALUES = [0.0, 1.0, -1.5, 0.1, 1e-7, 123456.789, -6543210.000001, 2.0 ** 30, 1 / 3, 5e-324, 2.2250738585072014e-308,
          1.7976931348623157e308, -0.4, 64.4, 7.0e6 + 1 / 7]


def pack(parts, kind=6, little=True, srid=None, flags=0, iso=0, dims=2):
    end = "<" if little else ">"
    head = lambda k, s: struct.pack(end + "BI", little, k + iso | flags | (0x20000000 if s else 0)) + (
        struct.pack(end + "I", s) if s else b"")

    def poly(rings, s):
        body = b"".join(struct.pack(end + "I", len(r)) + b"".join(
            struct.pack(end + f"{dims}d", *p, *[9.5] * (dims - 2)) for p in r) for r in rings)
        return head(3, s) + struct.pack(end + "I", len(rings)) + body

    if kind == 3:
        return poly(parts[0], srid).hex()
    return (head(6, srid) + struct.pack(end + "I", len(parts)) + b"".join(poly(p, None) for p in parts)).hex()


RING = list(zip(VALUES, reversed(VALUES), strict=True))
PARTS = [[RING, RING[:4]], [RING[2:9]]]


@pytest.mark.parametrize("options", [
    {}, {"little": False}, {"srid": 2154}, {"little": False, "srid": 4326, "flags": 0x80000000, "dims": 3},
    {"flags": 0x40000000, "dims": 3}, {"flags": 0xC0000000, "dims": 4}, {"iso": 1000, "dims": 3}, {"iso": 3000, "dims": 4}])
@pytest.mark.parametrize("kind", [3, 6])
def test_bits_are_read_exactly(spark, options, kind):
    parts = PARTS[:1] if kind == 3 else PARTS
    text = pack(parts, kind, **options)
    df = spark.createDataFrame([(text,), (text.upper(),)], "w string")
    for r in df.select(G.read_geometry("w").alias("g"), G.read_srid("w").alias("s")).collect():
        assert [[[tuple(p) for p in ring] for ring in poly] for poly in r.g] == parts
        assert r.s == options.get("srid", 0)


def test_writing_and_reading_back(spark):
    normal = [v for v in VALUES if v == 0 or 1e-300 < abs(v) < 1e300]
    ring = list(zip(normal, reversed(normal), strict=True))
    df = spark.createDataFrame([(pack([[ring]]), i) for i in range(8)], "w string, i int").select("i", "w", G.read_geometry("w").alias("g"))
    out = df.select("w", "i", "g", wkb.to_hex("g", F.when(F.col("i") >= 4, F.lit(2154)), F.col("i") % 4 >= 2, F.col("i") % 2 == 0)
                    .alias("h"))
    for r in out.select("*", G.read_geometry("h").alias("back"), G.read_srid("h").alias("s")).collect():
        assert r.back == r.g and r.s == (2154 if r.i >= 4 else 0)
        if r.i == 0:
            assert r.h.lower() == r.w


def test_points_empties_and_other_types(spark):
    rows = ["POINT(1 2)", "SRID=4326;POINT Z (1 2 3)", struct.pack("<BIdd", 1, 1, 1, 2).hex(),
            struct.pack(">BIIddd", 0, 0xA0000001, 4326, 1, 2, 7).hex(), "", None, "POINT EMPTY", "POLYGON((0 0, 1 0, 1 1, 0 0))",
            struct.pack("<BIdd", 1, 1, float("nan"), float("nan")).hex(), pack(PARTS)]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(rows)], "i int, w string")
    got = [r.p and tuple(r.p) for r in df.select("i", G.read_point("w").alias("p")).orderBy("i").collect()]
    assert got == [(1.0, 2.0)] * 4 + [None] * 6
    others = ["POINT(1 2)", "LINESTRING(0 0, 1 1)", "", None, "MULTIPOLYGON EMPTY", pack([]), struct.pack("<BIdd", 1, 1, 1, 2).hex()]
    df = spark.createDataFrame([(w,) for w in others], "w string")
    assert all(r.g is None for r in df.select(G.read_geometry("w").alias("g")).collect())


@pytest.mark.parametrize("text", ["POLYGN((0 0, 1 0, 1 1, 0 0))", "hello", pack(PARTS)[:-2], pack(PARTS) + "00", pack(PARTS)[:40],
                                  "01060000000F0000FF", "0163000000" + "00" * 8, pack(PARTS)[:-1] + "x"])
def test_broken_polygons_raise(spark, text):
    with pytest.raises(Exception, match="cannot read geometry"):
        spark.createDataFrame([(text,)], "w string").select(G.read_geometry("w").alias("g")).collect()


@pytest.mark.parametrize("text", ["POINT(1)", "POINT(a b)", "PINT(1 2)", "0101000000000000000000F03F", "01FF000000" + "00" * 16])
def test_broken_points_raise(spark, text):
    with pytest.raises(Exception, match="cannot read geometry"):
        spark.createDataFrame([(text,)], "w string").select(G.read_point("w").alias("p")).collect()
