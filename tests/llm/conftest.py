from __future__ import annotations

import os

import pytest

from tests.conftest import SF_SMALL


@pytest.fixture()
def sf_small(spark):
    from lakemart.llm.common import prepare

    prepare(spark)
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test tables not present")
    return SF_SMALL
