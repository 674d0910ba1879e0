"""Every registered query against its SQL twin, over whole tables."""

import os

import pytest
from compare import compare, duck

from chronolode.queries import all_oracles, all_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns[0] == "pv"


@pytest.mark.parametrize(
    "name",
    ["dataset_resolve", "dataset_buckets", "spatial_enrich", "validate_requests", "pv_statistics_hot", "radix_median", "annotation_datasets"],
)
def test_matches_sql_without_broadcasts(spark, con, name, monkeypatch):
    """The way beyond the broadcast limits gives the same rows."""
    from chronolode.operators import ranks

    monkeypatch.setattr(ranks, "BROADCAST_ROWS", -1)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) == ""
    finally:
        for key in settings:
            spark.conf.unset(key)
