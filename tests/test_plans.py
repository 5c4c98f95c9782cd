"""Plans: filters and columns reach the scan, and no query pairs all rows with all rows."""

import pytest

from tallyforge.queries import QUERIES
from tests.test_queries import SF


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    ("name", "pushed", "read"),
    [
        ("pushed_range_page", "GreaterThanOrEqual(o_orderdate", "o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>"),
        ("keyset_page", "GreaterThan(o_orderkey,1000)", "struct<o_orderkey:bigint>"),
        ("select_unit_tag_inner", "In(p_size, [1,5,9])", "struct<p_partkey:bigint,p_brand:string,p_size:int>"),
    ],
)
def test_pushdown(spark, name, pushed, read):
    text = plan(spark, name)
    assert pushed in text and read in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
