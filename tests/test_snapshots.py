"""First snapshots of the mart's tables: what they cost."""

import pytest

from cdcmart.plans import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["mart_dim_customer", "mart_dim_product", "mart_fact_orders", "mart_fact_order_items"])
def test_a_snapshot_is_parsed_once(spark, name):
    """The merge names the newest rows several times; none of them parses the records again."""
    plan = registry.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("from_json(") == 0
