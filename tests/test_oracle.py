"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

from __future__ import annotations

import os

import pytest

from tallgrass.plans.registry import load_all

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
REG = load_all()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, name):
    from oracle_check import compare
    status = compare(spark, SF, [name], verbose=False)[name]
    assert status[0] in ("OK", "NO-ORACLE"), status


def test_entry_contract(spark):
    import importlib.util
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    assert set(mod.oracle_sql()) <= set(mod.queries())
    df = mod.entry(spark)
    assert df.count() >= 0 and df.columns
