"""List splitting traps (E1 vs E2) and the link merges."""

from pyspark.sql import functions as F

from footlink.functions.lists import agg_distinct_sorted, to_array, to_array_keep_empty
from footlink.operators import links as LK


def test_split_empty_string_traps(spark):
    df = spark.createDataFrame([("",), (None,), ("a//b/",)], "s string")
    got = df.select(to_array("s").alias("e1"), to_array_keep_empty("s").alias("e2")).collect()
    assert got[0].e1 == [] and got[0].e2 == [""]
    assert got[1].e1 is None and got[1].e2 is None
    assert got[2].e1 == ["a", "", "b", ""] and got[2].e2 == ["a", "", "b", ""]


def test_string_agg_distinct_null_group(spark):
    df = spark.createDataFrame([("k", None), ("k", None), ("j", "b"), ("j", "a"), ("j", "b")], "k string, v string")
    got = {r.k: r.v for r in df.groupBy("k").agg(agg_distinct_sorted("v").alias("v")).collect()}
    assert got == {"k": None, "j": "a/b"}


def test_merge_keeps_empty_existing_element(spark):
    treated = spark.createDataFrame([("c1", "Batiments semblables", "B2")], "cleabs string, traitement string, liens_vers_batiment string")
    lt = spark.createDataFrame([("c1", ""), ("c2", "X")], "cleabs string, liens_vers_batiment string")
    r = LK.merge_links_with_labels(treated, lt).collect()
    assert [(x.cleabs, x.liens_vers_batiment, x.traitement) for x in r] == [("c1", "/B2", "Batiments semblables")]


def test_drop_destroyed(spark):
    lt = spark.createDataFrame([("c1", "A/B", "f1", False), ("c2", "B", "f2", False), ("c3", "C", "f3", False),
                                ("c4", "B", "f4", True)],
                               "cleabs string, liens_vers_batiment string, gcms_fingerprint string, gcms_detruit boolean")
    gone = spark.createDataFrame([("B",)], "cleabs string")
    got = {r.cleabs: r.liens_vers_batiment for r in LK.drop_destroyed_links(lt, gone).collect()}
    assert got == {"c1": "A", "c2": None}
