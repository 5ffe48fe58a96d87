"""Steps of the jobs that must not be worked out again in every stage, and
what boxes may settle without geometry."""

import pytest
from pyspark.sql import functions as F

from footlink.functions import geometry as G
from footlink.operators import matching as M
from footlink.operators.components import boundary_measures, union_boundary
from footlink.operators.localise import new_to_insert
from footlink.operators.nearby import Near, within
from footlink.plans import catalog, jobs
from footlink.sources.fixtures import AS_OF

SF = "/root/testdata/sf0.001"


class _Seen(Exception):
    pass


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _pool(spark, rows, key, geom):
    df = spark.createDataFrame(rows, f"{key} string, t string")
    return G.with_measures(df.select(key, G.from_wkt("t").alias(geom)), geom)


@pytest.mark.parametrize("job", ["job_registry_change", "job_topo_created"])
def test_the_cascade_reads_written_pools(spark, monkeypatch, job):
    got = []

    def stop(R, B, *_):
        got.extend([R, B])
        raise _Seen

    monkeypatch.setattr(jobs, "run_cascade", stop)
    R, B = catalog._pools(spark, SF)
    with pytest.raises(_Seen):
        getattr(jobs, job)(R, catalog._link_table(spark, SF), B, AS_OF)
    for pool in got:
        assert pool.count() > 0
        assert "Join" not in _plan(pool) and "Aggregate" not in _plan(pool)


def test_the_feed_is_reduced_once_for_both_lists(spark, monkeypatch):
    plans = []

    def insert(lc, *rest):
        plans.append(_plan(lc))
        return new_to_insert(lc, *rest)

    monkeypatch.setattr(catalog.LO, "new_to_insert", insert)
    assert catalog.initial_pool(spark, SF).count() > 0
    assert len(plans) == 1 and "Aggregate" not in plans[0]


def test_boxes_settle_a_cell_without_geometry(spark):
    """A building 14 m from a lone point needs no shape; one between the bounds does."""
    points = spark.createDataFrame([("p", 0.0, 0.0), ("q", 1000.0, 0.0)], "p_id string, px double, py double")
    shapes = _pool(spark, [("sure", "POLYGON((10 10, 90 10, 90 20, 10 20, 10 10))"), ("open", "POLYGON((1040 -60, 1040 -120, 1081 -120, 1040 -60))"),
                           ("out", "POLYGON((1081 -60, 1040 -120, 1081 -120, 1081 -60))")], "b_id", "geom")
    near = Near(points, shapes, 100.0)
    looked = []
    by_shape = near._by_shape
    near._by_shape = lambda rows: looked.extend(r.b_id for r in rows.select("b_id").distinct().collect()) or by_shape(rows)
    assert {r.b_id for r in near.buildings(within(100.0)).collect()} == {"sure", "open"}
    assert "sure" not in looked and {"open", "out"} <= set(looked)
    assert {r.p_id for r in Near(points, shapes, 100.0).near_points(within(100.0)).collect()} == {"p", "q"}


def test_boxes_settle_components_only_where_they_may(spark, monkeypatch):
    """A box 10 m away is near by its box; triangles whose boxes are 14 m apart are 28 m apart."""
    parts = _pool(spark, [("a", "POLYGON((0 0, 14 0, 14 14, 0 14, 0 0))"), ("t", "POLYGON((1000 0, 1010 0, 1000 10, 1000 0))")],
                  "id", "g").withColumn("comp", F.col("id")).drop("g")
    other = _pool(spark, [("b", "POLYGON((24 0, 38 0, 38 14, 24 14, 24 0))"),
                          ("u", "POLYGON((1030 30, 1020 30, 1030 20, 1030 30))")], "k", "g").drop("g")
    measured = []
    pair_measures = M.pair_measures
    monkeypatch.setattr(M, "pair_measures", lambda pairs, *rest: measured.extend(
        r.l_id for r in pairs.select("l_id").collect()) or pair_measures(pairs, *rest))
    assert [r.comp for r in M.near_components(parts, other, "k", M.Params()).collect()] == ["a"]
    assert measured == ["t"]


def test_a_part_that_touches_no_other_keeps_its_boundary(spark):
    parts = _pool(spark, [("a", "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0))"), ("b", "POLYGON((4 0, 8 0, 8 4, 4 4, 4 0))"),
                          ("c", "POLYGON((20 0, 23 0, 23 3, 20 3, 20 0), (21 1, 22 1, 22 2, 21 2, 21 1))")], "id", "g")
    parts = parts.withColumn("comp", F.when(F.col("id") == "b", "a").otherwise(F.col("id")))
    touching = spark.createDataFrame([("a", "b")], "a string, b string")
    got = {r.comp: (r.u_area, r.u_perim) for r in boundary_measures(union_boundary(parts, touching)).collect()}
    assert got == {"a": (32.0, 24.0), "c": (8.0, 16.0)}


def test_where_edges_cut_is_compiled(spark):
    """A filtered array never is."""
    from footlink.functions import edges as E
    cols = [F.lit(float(v)) for v in range(8)]
    rows = spark.range(1).select(E.cuts(E.Edge(*[F.col("id") + c for c in cols[:4]]), E.Edge(*[F.col("id") + c for c in cols[4:]])))
    assert "lambda" not in _plan(rows)
