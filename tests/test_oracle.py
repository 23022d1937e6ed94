"""Every query of the library's own operators against DuckDB."""

from __future__ import annotations

import pytest

from quillspark.jobs import registry


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_agrees_with_sql(agrees, name):
    agrees(registry.queries()[name], registry.oracle_sql()[name])


def test_every_query_has_sql():
    assert registry.queries().keys() == registry.oracle_sql().keys()
