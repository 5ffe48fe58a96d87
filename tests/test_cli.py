"""The command-line jobs on tables derived from the fixtures."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from footlink.plans import cli
from footlink.plans import jobs as JB
from footlink.sources import boxes as BX
from footlink.sources import fixtures as FX


def test_match_jobs_and_drop_destroyed(spark, tmp_path):
    links = (BX.registry_rows(spark, SF_SMALL)
             .withColumnRenamed("point_wkt", "geometrie").withColumnRenamed("shape_wkt", "geometrie_enveloppe")
             .withColumn("gcms_fingerprint", F.lit(None).cast("string")))
    bats = (BX.topo_rows(spark, SF_SMALL).withColumnRenamed("geometrie_wkt", "geometrie")
            .withColumn("gcms_date_destruction", F.lit(None).cast("timestamp_ntz")))
    links.write.parquet(str(tmp_path / "links"))
    bats.write.parquet(str(tmp_path / "bats"))
    args = ["--links", str(tmp_path / "links"), "--buildings", str(tmp_path / "bats"),
            "--as-of", FX.AS_OF, "--out", str(tmp_path / "out")]
    cli.main(["match-registry"] + args, spark=spark)
    out = spark.read.parquet(str(tmp_path / "out" / "update_batiment_rnb_creation"))
    # 7 claimed cases per 10 lots, case 3 twice: 160 rows at sf0.001
    assert out.count() == 160
    cli.main(["drop-destroyed"] + args, spark=spark)
    assert spark.read.parquet(str(tmp_path / "out" / "update_bdtopo_suppr")).count() == 0


def test_weekday_gates(spark, tmp_path):
    assert JB.on_weekday("2024-02-01", 4) and not JB.on_weekday("2024-02-02", 4)      # a Thursday, a Friday
    assert JB.on_weekday("2024-02-04", 0)
    links = FX.links(spark, SF_SMALL)
    gone = FX.destroyed_buildings(spark, SF_SMALL)
    assert JB.job_topo_destroyed(links, gone, "2024-02-02", enforce_weekday=True) is None
    assert JB.job_topo_destroyed(links, gone, "2024-02-01", enforce_weekday=True) is not None


def test_sync_then_work_tables(spark, tmp_path):
    from footlink.sources.sinks import export_csv
    export_csv(FX.diff(spark, SF_SMALL).drop("pos"), str(tmp_path / "feed"))
    cli.main(["sync", "--feed", str(tmp_path / "feed"), "--out", str(tmp_path / "diff")], spark=spark)
    lt = FX.link_table_geo(spark, SF_SMALL)
    from footlink.functions.geometry import to_wkt
    lt.withColumn("geometrie_enveloppe", to_wkt("geometrie_enveloppe")).write.parquet(str(tmp_path / "links"))
    cli.main(["work-tables", "--diff", str(tmp_path / "diff"), "--links", str(tmp_path / "links"),
              "--out", str(tmp_path / "w")], spark=spark)
    upd = spark.read.parquet(str(tmp_path / "w" / "update_moissonnage"))
    assert upd.count() > 0 and set(r.commentaire_centralise for r in upd.collect()) <= {"", "to_link"}
