"""Queries of the training-data operators that have a SQL twin, over whole tables."""

import os

import pytest
from compare import compare, duck

from chronolode.llm.queries import llm_oracles, llm_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_matches_sql(spark, name):
    assert compare(spark, duck(SF), name, llm_queries()[name], llm_oracles()[name], SF) == ""
