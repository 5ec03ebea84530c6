"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from tessera.plans import registry
from tests.compare import differs

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query(spark, name):
    said = differs(registry.QUERIES[name](spark, SF), registry.ORACLE_SQL[name], SF)
    assert said is None, said


def test_clinical_rows(spark):
    rows = registry.QUERIES["clinical_rows"](spark, SF)
    assert len(rows.columns) == 27 and rows.count() == 9000
    assert 0.15 < rows.agg({"ckd_diagnosis": "avg"}).first()[0] < 0.5
