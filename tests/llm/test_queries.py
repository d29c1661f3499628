from __future__ import annotations

import pytest

from tests.compare import connect, differences
from wheelhouse.llm import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == []


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")) == list(range(1, 14))
