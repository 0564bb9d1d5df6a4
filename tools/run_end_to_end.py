"""Run the end-to-end pipeline (B1) and print stage timings with the running
total (B2).

    python tools/run_end_to_end.py --sf /root/testdata/sf0.01          # driver test tables
    python tools/run_end_to_end.py --synthetic 200000 --customers 2000  # generated data
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkmart import adapter, synth  # noqa: E402
from sparkmart.end_to_end import EndToEndConfig, run_end_to_end  # noqa: E402
from sparkmart.plans.q_end_to_end import TESTDATA_CONFIG  # noqa: E402
from sparkmart.reports import cumulative_timings, timing_frame  # noqa: E402
from sparkmart.session import build_session, scratch_path  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--synthetic", type=int, default=0, help="generate this many base orders")
    ap.add_argument("--customers", type=int, default=synth.N_CUSTOMERS)
    ap.add_argument("--master", default="local[8]")
    a = ap.parse_args()
    spark = build_session(a.master, shuffle_partitions=8)
    base = scratch_path(spark, "end-to-end-run")
    if a.synthetic:
        c, o, p = synth.dataset(spark, a.synthetic, a.customers)
        # customer-day baskets: planted companions share the customer and date
        cfg = EndToEndConfig(basket_key=["customer_id", "order_date"], min_support=0.001,
                             min_confidence=0.3)
    else:
        c, o, p = adapter.domain(spark, a.sf)
        c = c.select("customer_id", "customer_name", "city", "age")
        cfg = TESTDATA_CONFIG
    timings, written = run_end_to_end(spark, c, o, p, base, cfg)
    cumulative_timings(timing_frame(spark, timings)).orderBy("seq").show(truncate=False)
    print("rows written:", written)
    spark.stop()


if __name__ == "__main__":
    main()
