"""End-to-end run query (B1): rows written by each stage."""

from __future__ import annotations

from sparkmart import adapter
from sparkmart.end_to_end import EndToEndConfig, run_end_to_end, stage_rows_frame
from sparkmart.plans import query
from sparkmart.plans.q_baskets import _recursive
from sparkmart.plans.q_models import TEST_RATIO
from sparkmart.session import scratch_path

# Order × brand baskets (see q_baskets): per-customer baskets of the test
# tables are too dense for FP-Growth at a useful support.
TESTDATA_CONFIG = EndToEndConfig(
    k=5, item_col="brand", basket_key=["order_id"], min_support=0.01, min_confidence=0.1
)


@query(
    "end_to_end_stage_rows",
    _recursive(
        f"""SELECT 'customer_features' AS stage, count(*) AS rows_written FROM customers
UNION ALL SELECT 'customer_clusters', count(*) FROM customers
UNION ALL SELECT 'classification_results', count(*) FROM customers
  WHERE CAST(((customer_id % 2147483648) * 2654435761) % 4294967296 AS DOUBLE) / 4294967296 < {TEST_RATIO}
UNION ALL SELECT 'association_rules', count(*) FROM rules"""
    ),
)
def end_to_end_stage_rows(spark, sf_dir):
    c, ol, p = adapter.domain(spark, sf_dir)
    base = scratch_path(spark, "end-to-end")
    _, written = run_end_to_end(
        spark, c.select("customer_id", "customer_name", "city", "age"), ol, p, base, TESTDATA_CONFIG
    )
    return stage_rows_frame(spark, written)
