"""Registered queries against their SQL.

The default run takes a cross-section on the smallest tables; ZONEREACH_ALL=1 takes every query and
ZONEREACH_SF another data folder.
"""

import os

import pytest

from zonereach.compare import compare, connect
from zonereach.conformance import ORACLES, QUERIES, bind
from zonereach.plans.export import catalog_rows

FOLDER = os.environ.get("ZONEREACH_SF", "/root/testdata/sf0.001")
CROSS_SECTION = [
    "access_core", "access_all_levels", "access_keep_zero_demand", "xmfca", "contour_jobs_r5", "access_incremental",
    "catalog_coverage", "zones_table", "city_region", "poi_counts", "ev_counts", "city_summary", "point_in_polygon",
    "bbox_overlap", "dissolve_outline", "contiguous_catchment", "od_matrix_ingest", "od_compact_codes",
    "dissolve_rings", "contiguous_shell", "od_ingest_rejects", "od_ingest_partial", "acs_json_rejects", "text_rejects", "pair_sample_by_mode",
    "means_by_position", "acs_json_ingest", "origin_ols", "ratio_box_stats", "scale_rmse", "access_disadvantage", "corr_matrix",
]
NAMES = list(QUERIES) if os.environ.get("ZONEREACH_ALL") else CROSS_SECTION


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    ok, text = compare(spark, con, name, bind(QUERIES[name]), ORACLES.get(name), FOLDER)
    assert ok, text


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_city_files_hold_the_whole_catalog(spark, con):
    ok, text = compare(spark, con, "city_csv_export", bind(QUERIES["city_csv_export"]), ORACLES["city_csv_export"], FOLDER)
    assert ok, text
    fields = {r[0] for r in catalog_rows()}
    assert len(fields) == 600 and fields < set(bind(QUERIES["city_csv_export"])(spark, FOLDER).columns)
