"""Sources and sinks: typed link-table CSV (S3), since-filter (S2), table
replace with blanks as NULL and a run-date comment (K1, K9)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from footlink.sources import feed as FD
from footlink.sources import fixtures as FX
from footlink.sources import sinks as SK


def test_link_table_csv(spark, tmp_path):
    names = [f.name for f in FD.LINK_SCHEMA.fields]
    vals = {n: "" for n in names}
    vals.update(cleabs="BATRNB1", identifiant_rnb="R1", liens_vers_batiment="B1/B2", gcms_detruit="false",
                gcms_date_creation="2024-01-30 10:00:00", diffusion="true", gcms_numrec="7",
                gcms_territoire="FXX", geometrie="POINT(1 2)", parent_buildings='"[""a""]"')
    p = tmp_path / "l.csv"
    p.write_text(",".join(names) + "\n" + ",".join(vals[n] for n in names) + "\n")
    r = FD.read_link_table(spark, str(p)).first()
    assert (r.cleabs, r.gcms_detruit, r.gcms_numrec, r.parent_buildings) == ("BATRNB1", False, 7, '["a"]')
    assert str(r.gcms_date_creation) == "2024-01-30 10:00:00"


def test_link_rows_that_do_not_load(spark, tmp_path):
    """Bad rows raise, or go to the reject folder with column, value and
    reason; a quoted empty list is not NULL."""
    names = [f.name for f in FD.LINK_SCHEMA.fields]
    base = dict.fromkeys(names, "") | {"cleabs": "L1", "gcms_detruit": "f", "diffusion": "t", "gcms_numrec": "7",
                                       "gcms_territoire": "FXX", "geometrie": "POINT(1 2)"}
    rows = [{}, {"liens_vers_batiment": '""'}, {"gcms_detruit": "maybe"}, {"gcms_numrec": "12x"},
            {"gcms_date_creation": "2024-13-01 00:00:00"}, {"gcms_territoire": ""}, {"cleabs": "L" * 25},
            {"parent_buildings": "{no"}, {"gcms_numrec": "1.5", "gcms_detruit": "2"}]
    lines = [",".join((base | r)[n] for n in names) for r in rows] + ["L9,too,few"]
    p = tmp_path / "l.csv"
    p.write_text("\n".join([",".join(names), *lines]) + "\n")
    with pytest.raises(ValueError, match="maybe|12x|2024-13|null|longer|json|fields"):
        FD.read_link_table(spark, str(p))
    good = FD.read_link_table(spark, str(p), rejects=str(tmp_path / "bad")).collect()
    assert sorted((r.liens_vers_batiment is None, r.gcms_numrec) for r in good) == [(False, 7), (True, 7)]
    bad = spark.read.parquet(str(tmp_path / "bad")).orderBy("row").collect()
    assert [[(x.column, x.value, x.reason) for x in r.problems] for r in bad] == [
        [("gcms_detruit", "maybe", "boolean")], [("gcms_numrec", "12x", "int")],
        [("gcms_date_creation", "2024-13-01 00:00:00", "timestamp_ntz")], [("gcms_territoire", None, "null")],
        [("cleabs", "L" * 25, "longer than 24")], [("parent_buildings", "{no", "json")],
        [("gcms_detruit", "2", "boolean"), ("gcms_numrec", "1.5", "int")], [(None, None, "number of fields")]]
    assert bad[-1].line == "L9,too,few"


def test_declared_constraints_take_one_scan(spark):
    from footlink.operators import constraints as C
    df = FX.link_rows(spark, SF_SMALL)
    out = C.schema_violations(df, C.DECLARED["links"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and len({r.check for r in out.select("check").distinct().collect()}) >= 7


def test_since_filter(spark, tmp_path):
    head = ",".join(FD.FEED_COLUMNS)
    row = lambda rid, per: f'update,{rid},constructed,1,"{per}",,,,,,1,update'
    (tmp_path / "a.csv").write_text("\n".join([head, row("x", '[""2024-01-02 00:00:00+00"",)'),
                                               row("y", '[""2024-03-02 00:00:00+00"",)')]) + "\n")
    got = [r.rnb_id for r in FD.read_feed_since(spark, str(tmp_path), "2024-02-01").collect()]
    assert got == ["y"]


def test_replace_table_blanks_and_comment(spark, tmp_path):
    df = spark.createDataFrame([("a", ""), ("b", "x")], "rnb_id string, v string")
    SK.replace_table(df, str(tmp_path / "t"), table="footlink_test_t", comment="Ne pas supprimer - 2024-02-01")
    got = {r.rnb_id: r.v for r in spark.table("footlink_test_t").collect()}
    assert got == {"a": None, "b": "x"}
    desc = spark.sql("DESCRIBE TABLE EXTENDED footlink_test_t").collect()
    assert any("Ne pas supprimer - 2024-02-01" in (r.data_type or "") for r in desc)
    spark.sql("DROP TABLE footlink_test_t")


def test_balcony_compat_delete(spark):
    """The intended delete removes the claimed keys; ``compat_delete``
    reproduces the source's delete, which empties every non-'' key of B."""
    from footlink.operators import matching as M
    r_cols = M.R_COLS + M.MEAS
    r_schema = ", ".join(f"{c} string" for c in r_cols)
    R = spark.createDataFrame([], r_schema)
    RT = spark.createDataFrame([], r_schema + ", traitement string, liens_vers_batiment string")
    B = spark.createDataFrame([("B1", None), ("B2", None), ("", None)], "cleabs string, geometrie string")
    BT = spark.createDataFrame([], "cleabs string, traitement string, identifiant_rnb string, geometrie string")
    X = spark.createDataFrame([("B1", "R1", "balcony")],
                              "liens_vers_batiment string, identifiant_rnb string, traitement string")
    pools = M.Pools(R, B, RT, BT)
    intended = M.update_pools_balcony(pools, X, compat_delete=False)
    compat = M.update_pools_balcony(pools, X, compat_delete=True)
    assert sorted(r.cleabs for r in intended.B.collect()) == ["", "B2"]
    assert sorted(r.cleabs for r in compat.B.collect()) == [""]
    assert [r.cleabs for r in intended.BT.collect()] == ["B1"]
    rt = intended.RT.collect()          # left join: an unmatched claim still lands in RT
    assert [(r.cleabs, r.identifiant_rnb, r.liens_vers_batiment) for r in rt] == [(None, "R1", "B1")]
