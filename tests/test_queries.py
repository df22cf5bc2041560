"""Every registered query against its SQL twin, on the smallest data."""

import pytest

import tapeloom.plans.catalog  # noqa: F401
from tapeloom.plans.compare import differences
from tapeloom.plans.registry import REGISTRY

from conftest import SF


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_twin(spark, con, name):
    diff, rows = differences(spark, con, name, SF)
    assert not diff, diff
    assert rows >= 0
