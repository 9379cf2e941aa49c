from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare, connect  # noqa: E402

from plumbline import registry  # noqa: E402


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n in registry.ORACLE_SQL])
def test_query_equals_its_sql(spark, sf_dir, name):
    said = compare(spark, connect(sf_dir), registry.QUERIES[name], registry.ORACLE_SQL[name], sf_dir)
    assert said in ("", "no rows")


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in registry.ORACLE_SQL])
def test_query_runs(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() >= 0


def test_entry_points(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() >= 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
