"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same check at sf0.01), and the entry smoke check."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_harness import compare, duck

FAST = ["diff_range_start", "diff_latest", "diff_latest_ties", "diff_removed", "diff_recalc", "diff_dates",
        "dup_keys", "diff_upsert", "typed_cast", "key_violations", "work_deactivated", "work_demolished",
        "links_explode", "links_merge_labels", "links_merge", "links_drop_destroyed", "geom_measures",
        "pairs_intersect", "pairs_within_20", "match_equal", "match_identical", "match_similar",
        "match_similar_nbp", "match_contained", "match_balcony", "match_point", "match_semantic",
        "candidates_100m", "candidates_registry_100m", "sync_csv", "staging_load", "srid_violations",
        "work_new", "work_changed", "match_dissolved", "unmatchable", "job_registry_change",
        "job_topo_created", "stage_counts", "match_contained_shapes", "pairs_shapes", "candidates_500m",
        "initial_pool", "stream_upsert", "reduce_precision", "links_load", "schema_violations", "wkb_load",
        "near_limit_100m", "near_limit_500m", "near_limit_registry_100m"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_or_is_listed():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(FAST) <= set(q)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    q, o = E.queries(), E.oracle_sql()
    if name not in o:
        pytest.skip("rows-only query")
    r = compare(q[name](spark, SF_SMALL), con, o[name])
    assert r["cols_match"] and r["values_match"], r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["rnb_id", "event_id", "action", "status", "is_active", "updated_at_us", "first_pos"]
