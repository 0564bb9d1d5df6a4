"""Streaming ingestion query: customers landed as files, taken by the stream."""

from __future__ import annotations

from sparkmart import adapter
from sparkmart.plans import query
from sparkmart.plans.oracle import with_domain
from sparkmart.session import scratch_path
from sparkmart.sinks.files import write_csv
from sparkmart.sources.files import read_csv
from sparkmart.streaming.landing import ingest_landing_stream


@query(
    "stream_ingest_customers",
    with_domain()
    + "SELECT customer_id, customer_name, city, age, 'csv' AS source_type FROM customers",
)
def stream_ingest_customers(spark, sf_dir):
    c = adapter.customers(spark, sf_dir).select("customer_id", "customer_name", "city", "age")
    landing = scratch_path(spark, "landing-customers")
    lake = scratch_path(spark, "lake")
    # the whole table lands as four files; two files per trigger → two batches
    write_csv(c.repartition(4), f"{landing}/drop")
    target = "raw/stream/customers/customers.csv"
    q = ingest_landing_stream(
        spark, f"{landing}/*", c.schema, "customers_stream", "csv", target,
        lake, f"{lake}/logs/ingestion_log", scratch_path(spark, "stream-checkpoint"),
        max_files_per_trigger=2,
    )
    q.awaitTermination()
    raw = read_csv(spark, f"{lake}/{target.rsplit('/', 1)[0]}/*/customers.csv/*",
                   schema=c.schema.add("source_type", "string").add("ingestion_time", "string"))
    return raw.select("customer_id", "customer_name", "city", "age", "source_type")
