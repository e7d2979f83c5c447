import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from oracle import same  # noqa: E402

from tickweave.plans.registry import ORACLE_SQL, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    same(QUERIES[name](spark, "/root/testdata/sf0.001"), ORACLE_SQL[name], "/root/testdata/sf0.001")
