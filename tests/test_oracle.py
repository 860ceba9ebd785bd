"""Every registered query against its SQL, on the smallest test tables."""

import pathlib

import pytest

from engrama.plans.catalog import REGISTRY
from tools import compare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_agrees_with_sql(spark, con, name):
    status, _, _, _, note = compare.compare(spark, con, SF_DIR, name)
    assert status in ("ok", "rows"), note
    assert not note, note
