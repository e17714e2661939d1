"""Every query of the subpackage that SQL can express, against its SQL."""

from __future__ import annotations

import pytest

from tests.compare import differences
from tests.conftest import DATA
from tickloom.llm.oracle import ORACLE
from tickloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    sf_dir = f"{DATA}/sf0.001"
    assert differences(QUERIES[name](spark, sf_dir), ORACLE[name], sf_dir)[:3] == []
